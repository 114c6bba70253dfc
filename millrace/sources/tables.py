"""Tables read by query, whole or a number of rows per poll."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.numbering import number_rows, order_columns


def read_table(
    spark: SparkSession,
    query: str,
    url: str | None = None,
    partition: tuple[str, object, object, int] | None = None,
    options: dict | None = None,
) -> DataFrame:
    """S3: one row per message.

    Without ``url`` the query runs on Spark's own catalog.  With a JDBC url it runs in the
    database; ``partition`` (column, lower, upper, number) then splits it into parallel
    range reads, without which one task reads everything.
    """
    if url is None:
        return spark.sql(query)
    reader = spark.read.format("jdbc").options(url=url, **(options or {}))
    if partition is None:
        return reader.option("query", query).load()
    column, lower, upper, number = partition
    # "query" and "partitionColumn" exclude each other; a derived table does the same.
    return reader.options(
        dbtable=f"({query}) q", partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=number
    ).load()


def poll_chunks(df: DataFrame, order, max_rows: int, out: str = "poll", hot_rows: int | None = None) -> DataFrame:
    """S4 over a whole table: the number (from 1) of the poll that would read each row.

    Positions come from range partitions and their counts, not from one sorted partition.
    """
    return _chunked(df, order, max_rows, out, hot_rows).drop("_mr_rn")


def _chunked(df: DataFrame, order, max_rows: int, out: str, hot_rows: int | None) -> DataFrame:
    numbered = number_rows(df, [], order_columns(order), "_mr_rn", hot_rows)
    return numbered.withColumn(out, F.expr(f"(_mr_rn - 1) div {max_rows} + 1"))


def row_lists(df: DataFrame, order, max_rows: int, hot_rows: int | None = None) -> DataFrame:
    """S3 with ``split=False``: one message per poll holding the list of its rows."""
    chunks = _chunked(df, order, max_rows, "poll", hot_rows)
    item = F.struct("_mr_rn", F.struct(*df.columns).alias("row"))
    return (
        chunks.groupBy("poll")
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select("poll", F.transform("items", lambda x: x["row"]).alias("payload"))
    )


class TablePoller:
    """Each poll returns the next rows by key, and remembers them when committed.

    The first poll cuts the keys that are there into ranges of ``max_rows`` rows and stores the cuts; every poll then is one range, a plain
    filter that the source can use to skip data and that many tasks read, in no particular order. When the last range is consumed, the next
    poll plans anew for what has come since. Rows that share a key are never parted, so a poll may have some more than
    ``max_rows``, as it does when rows come late into a range that is already cut.

    The position (the highest key consumed) is kept below ``state_path`` too, so that a restarted
    program goes on where the last commit ended.  A poll that was not committed is read again.
    """

    def __init__(self, spark: SparkSession, state_path: str, key: str | Sequence[str], max_rows: int, hot_rows: int | None = None):
        self.spark = spark
        self.state_path = state_path.rstrip("/")
        self.key = [key] if isinstance(key, str) else list(key)
        self.max_rows = max_rows
        self.hot_rows = hot_rows

    def _path(self, *below: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.state_path, *below]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _finished(self, kind: str) -> list[int]:
        """The numbers of the finished commits, or plans, still kept, oldest first."""
        path, files = self._path(kind)
        if not files.exists(path):
            return []
        numbers = [int(s.getPath().getName()) for s in files.listStatus(path) if s.isDirectory()]
        return sorted(n for n in numbers if files.exists(self._path(kind, str(n), "_SUCCESS")[0]))

    def _write(self, kind: str, rows: DataFrame) -> None:
        """A new commit or plan; all but the one before it are deleted."""
        done = self._finished(kind)
        rows.write.mode("overwrite").parquet(f"{self.state_path}/{kind}/{done[-1] + 1 if done else 0}")
        for old in done[:-1]:
            path, files = self._path(kind, str(old))
            files.delete(path, True)

    def mark(self):
        """The key values last committed as a row, or None."""
        commits = self._finished("commits")
        return self.spark.read.parquet(f"{self.state_path}/commits/{commits[-1]}").first() if commits else None

    def _beyond(self, df: DataFrame, mark, holds) -> DataFrame:
        """Rows whose key compares with the mark as ``holds`` says."""
        if mark is None:
            return df
        if len(self.key) == 1:
            # A plain comparison, which the source can use to skip data.
            return df.filter(holds(F.col(self.key[0]), F.lit(mark[0])))
        return df.filter(holds(F.struct(*self.key), F.struct(*[F.lit(v).alias(k) for k, v in zip(self.key, mark)])))

    def _next_cut(self, mark):
        """The upper end of the first planned range that is not consumed, or None."""
        plans = self._finished("plans")
        if not plans:
            return None
        cuts = self._beyond(self.spark.read.parquet(f"{self.state_path}/plans/{plans[-1]}"), mark, lambda key, at: key > at)
        found = cuts.agg(F.min(F.struct(*self.key)).alias("m")).first().m
        return found

    def _plan(self, df: DataFrame) -> None:
        numbered = number_rows(df.select(*self.key), [], self.key, "_mr_rn", self.hot_rows, total="_mr_n")
        ends = (F.col("_mr_rn") % self.max_rows == 0) | (F.col("_mr_rn") == F.col("_mr_n"))
        self._write("plans", numbered.filter(ends).select(*self.key).distinct())

    def poll(self, df: DataFrame) -> DataFrame:
        """The rows of the next range after the mark."""
        mark = self.mark()
        rest = self._beyond(df, mark, lambda key, at: key > at)
        # A NULL key is in no range.
        for k in self.key:
            rest = rest.filter(F.col(k).isNotNull())
        cut = self._next_cut(mark)
        if cut is None:
            self._plan(rest)
            cut = self._next_cut(mark)
        return rest.limit(0) if cut is None else self._beyond(rest, cut, lambda key, at: key <= at)

    def commit(self, rows: DataFrame) -> None:
        """Remember the highest key of the rows; call it after they were stored."""
        top = rows.agg(F.max(F.struct(*self.key)).alias("m")).filter("m is not null").select("m.*")
        if not top.isEmpty():
            self._write("commits", top)


def unconsumed(df: DataFrame, consumed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """S4 for keys that do not grow: the rows whose key is not in the table of consumed keys."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(consumed.select(*keys), keys, "left_anti")
