"""K8: documents stored under an id, a later one replacing an earlier one.

Documents are dealt by a hash of index and id over a fixed number of buckets. A manifest names, for each bucket, the version that wrote it last. An
upsert reads and rewrites the buckets that its documents fall into, beside the old ones, and then puts a new manifest in place. Whoever reads follows the
latest manifest, so that a crash at any point leaves the table as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.messages import as_column
from millrace.session import stage

INDEX_HEADER = "INDEX_NAME"
#: Buckets of a new table; a table keeps the number it was made with.
BUCKETS = 64
#: Manifests kept for readers that began with them.
KEPT_MANIFESTS = 2


def latest_documents(df: DataFrame, id: str | Column, order, index: str | None = None, payload: str | Column = "payload") -> DataFrame:
    """The last document per index and id: columns ``index``, ``id``, ``version``, ``document``.

    The header ``INDEX_NAME`` names the index, else the option does.  ``order`` must be a
    column or list of columns; the last one breaks ties.  Versions fold before the shuffle.
    """
    order = [order] if isinstance(order, (str, Column)) else list(order or [])
    if not order:
        raise ValueError("an upsert needs an order column")
    named = F.lit(index).cast("string")
    if "headers" in df.columns:
        # An empty name would be stored like a missing one.
        named = F.coalesce(F.nullif(F.col("headers")[INDEX_HEADER], F.lit("")), named)
    rows = df.select(
        named.alias("index"), as_column(id).cast("string").alias("id"),
        F.struct(*[as_column(c).alias(f"o{i}") for i, c in enumerate(order)]).alias("version"),
        as_column(payload).alias("document"),
    )
    return _fold(rows)


def _fold(rows: DataFrame) -> DataFrame:
    return rows.groupBy("index", "id").agg(
        F.max("version").alias("version"), F.max_by("document", "version").alias("document")
    )


def merge_documents(current: DataFrame | None, changes: DataFrame) -> DataFrame:
    """The stored documents after the changes; repeating the same changes changes nothing."""
    return changes if current is None else _fold(current.select(changes.columns).unionByName(changes))


class DocumentTable:
    """The files below ``target``: ``manifest/<number>`` and ``data/<version>/bucket=<n>``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark, self.target = spark, target.rstrip("/")

    def _at(self, *below: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.target, *below]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        path, files = self._at("manifest")
        names = [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n) for n in names if n.isdigit())

    def manifest(self, number: int | None = None) -> dict | None:
        """The latest manifest: ``buckets``, ``schema``, and ``places``, the version of each bucket that has documents."""
        if number is None:
            number = max(self._numbers(), default=None)
        if number is None:
            return None
        text = self.spark.read.text(f"{self.target}/manifest/{number}", wholetext=True).first().value
        return json.loads(text) | {"number": number}

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The documents, of some buckets only if told so; None if there is no table, or nothing in those buckets."""
        manifest = self.manifest()
        if manifest is None:
            return None
        places = {int(b): v for b, v in manifest["places"].items()}
        wanted = sorted(places if buckets is None else set(buckets) & set(places))
        if not wanted:
            return None
        schema = T.StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*(f"{self.target}/data/{places[b]}/bucket={b}" for b in wanted))

    def write(self, documents: DataFrame, touched: list[int], manifest: dict) -> None:
        """Store the documents of the touched buckets (with a column ``bucket``) as a new version and switch to it."""
        version = uuid.uuid4().hex
        documents.write.partitionBy("bucket").parquet(f"{self.target}/data/{version}")
        schema = T.StructType([f for f in documents.schema if f.name != "bucket"])
        places = manifest["places"] | {str(b): version for b in touched}
        self._switch(manifest["number"] + 1, {"buckets": manifest["buckets"], "schema": schema.jsonValue(), "places": places})
        self._clean()

    def _switch(self, number: int, content: dict) -> None:
        """Put a manifest in place by a rename. A number that is taken means that somebody else has written."""
        final, files = self._at("manifest", str(number))
        made, _ = self._at("manifest", f"{number}.{uuid.uuid4().hex}")
        out = files.create(made, True)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()
        if files.exists(final) or not files.rename(made, final):
            files.delete(made, False)
            raise RuntimeError(f"another upsert has changed {self.target}")

    def _clean(self) -> None:
        """Delete manifests that are no longer kept, and the versions that only they name. What a crash left unnamed stays."""
        numbers = self._numbers()
        named = {v for n in numbers[-KEPT_MANIFESTS:] for v in self.manifest(n)["places"].values()}
        for n in numbers[:-KEPT_MANIFESTS]:
            for v in set(self.manifest(n)["places"].values()) - named:
                path, files = self._at("data", v)
                files.delete(path, True)
            path, files = self._at("manifest", str(n))
            files.delete(path, False)


def read_documents(spark: SparkSession, target: str) -> DataFrame:
    """What :func:`upsert` has stored: ``index``, ``id``, ``version``, ``document``."""
    documents = DocumentTable(spark, target).read()
    if documents is None:
        raise ValueError(f"no documents at {target}")
    return documents


def upsert(spark: SparkSession, df: DataFrame, target: str, id, order, index: str | None = None, payload="payload", buckets: int = BUCKETS) -> None:
    """Merge the messages into the documents at ``target``; :func:`read_documents` reads them.

    Only the buckets that the messages fall into are read and written again; ``buckets`` counts for a new table alone. The new version is
    written beside the old one and then switched to, so a crash leaves the old one. Being idempotent, it may be called from ``foreachBatch``. A second
    writer at the same time is an error for the one that comes last.
    """
    table = DocumentTable(spark, target)
    manifest = table.manifest() or {"buckets": buckets, "places": {}, "number": -1}
    changes = stage(latest_documents(df, id, order, index, payload), "changes")
    bucket = F.pmod(F.xxhash64("index", "id"), F.lit(manifest["buckets"])).cast("int")
    # No more rows than buckets.
    touched = sorted(r.bucket for r in changes.select(bucket.alias("bucket")).distinct().collect())
    if not touched:
        return
    merged = merge_documents(table.read(touched), changes)
    table.write(merged.withColumn("bucket", bucket).repartition("bucket"), touched, manifest)
