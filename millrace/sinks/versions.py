"""Tables that grow by a version a micro-batch, so that a micro-batch that runs again changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import stage

#: After so many versions the table is written anew in one piece.
COMPACT_EVERY = 20


def write_batch(rows: DataFrame, out: str, batch_id: int) -> None:
    """Each micro-batch has its own folder, so one that runs again replaces what it wrote."""
    rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={batch_id}")


class OpenTable:
    """Counters per key, and rows of the open groups, in one version a micro-batch.

    ``counters`` has a row per key touched: the latest one counts. Its ``since`` is the version with which its open group begins, so rows of earlier
    versions are dead without being deleted. A version is there once its counters are, which are written last; a micro-batch that runs
    again overwrites its own version and reads only those before it.
    """

    def __init__(self, spark: SparkSession, path: str, keys: T.StructType, counters: str, **rows: T.StructType):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys.names
        kinds = T.StructType.fromDDL(", ".join(filter(None, [counters, "since bigint"])))
        self.schemas = {name: T.StructType([*keys, *kind]) for name, kind in rows.items()}
        self.schemas["counters"] = T.StructType([*keys, *kinds])

    def _files(self):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def versions(self, before: int, base_before: int | None = None) -> tuple[int | None, list[int]]:
        """The latest version in one piece, lower than ``base_before``, and the single versions after it, all finished and lower than ``before``."""
        limit = {"v": before, "base": before if base_before is None else base_before}
        files, found = self._files(), {"base": [], "v": []}
        folder = self._path("counters")
        if files.exists(folder):
            for status in files.listStatus(folder):
                kind, _, number = status.getPath().getName().partition("=")
                done = self._path("counters", status.getPath().getName(), "_SUCCESS")
                if kind in found and int(number) < limit[kind] and files.exists(done):
                    found[kind].append(int(number))
        base = max(found["base"], default=None)
        return base, sorted(v for v in found["v"] if base is None or v > base)

    def read(self, name: str, before: int, base_before: int | None = None) -> DataFrame:
        """Rows of the versions before ``before`` with ``v``, the version that wrote them."""
        base, single = self.versions(before, base_before)
        places = [(f"base={base}", base)] if base is not None else []
        places += [(f"v={v}", v) for v in single]
        out = self.spark.createDataFrame([], self.schemas[name]).withColumn("v", F.lit(0).cast("long"))
        for place, v in places:
            part = self.spark.read.schema(self.schemas[name]).parquet(f"{self.path}/{name}/{place}")
            out = out.unionByName(part.withColumn("v", F.lit(v).cast("long")))
        return out

    def counters(self, before: int, base_before: int | None = None) -> DataFrame:
        """The latest row of every key."""
        rows = self.read("counters", before, base_before)
        names = [c for c in self.schemas["counters"].names if c not in self.keys]
        latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*names), "v").alias("_mr_c"))
        return latest.select(*self.keys, "_mr_c.*")

    def live(self, name: str, before: int, of: DataFrame, base_before: int | None = None) -> DataFrame:
        """Rows of open groups of the keys in ``of``, which has their ``since``."""
        gid = F.struct(*self.keys).alias("_mr_gid")
        wanted = of.select(gid, F.col("since").alias("_mr_since"))
        rows = self.read(name, before, base_before).select("*", gid).join(wanted, "_mr_gid")
        return rows.filter("v >= _mr_since").select(*self.schemas[name].names)

    def write(self, version: int, kind: str = "v", **tables: DataFrame) -> None:
        """Write a version: its rows, then its counters, which are what makes it one."""
        self._files().delete(self._path("counters", f"{kind}={version}"), True)
        for name in [*(n for n in tables if n != "counters"), "counters"]:
            tables[name].select(*self.schemas[name].names).write.mode("overwrite").parquet(f"{self.path}/{name}/{kind}={version}")

    def compact(self, version: int, only_open: str | None = None) -> None:
        """Write the table as of ``version`` in one piece, without keys that have no rows in ``only_open``.

        What the piece before it made superfluous is deleted; what ``version`` itself reads stays, so that it can still run again.
        """
        old_base, _ = self.versions(version)
        counters = stage(self.counters(version + 1, version), "open-counters")
        if only_open:
            counters = stage(counters.join(self.live(only_open, version + 1, counters, version).select(*self.keys).distinct(), self.keys, "left_semi"), "open-counters")
        rows = {n: self.live(n, version + 1, counters, version) for n in self.schemas if n != "counters"}
        self.write(version, "base", counters=counters.withColumn("since", F.lit(version).cast("long")), **rows)
        if old_base is None:
            return
        files = self._files()
        for name in self.schemas:
            for status in files.listStatus(self._path(name)):
                kind, _, number = status.getPath().getName().partition("=")
                if int(number) < old_base or kind == "v" and int(number) == old_base:
                    files.delete(status.getPath(), True)
