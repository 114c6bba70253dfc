"""Running a stream until its present input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.streaming.aggregate import STATE_PROVIDER


def use_rocksdb(spark) -> None:
    """Keep keyed state in RocksDB, which spills to disk, as the state processors need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there now into parquet files, and stop; a later call goes on from the checkpoint."""
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()


def run_batches(stream: DataFrame, write, checkpoint: str, mode: str = "append") -> None:
    """The same through ``foreachBatch``."""
    query = (
        stream.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
