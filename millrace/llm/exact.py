"""Exact dedup in two passes over a Bloom filter, with DataFrame functions alone.

The first pass counts how many rows hit each of two positions of their text's hash, and keeps the positions that were
hit twice or more as bitmaps. The second pass tests every row against the bitmaps, in place: a row that
misses one of them has no equal and goes straight through. Only the others shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, fresh, id_and_text, join_groups
from millrace.session import stage

#: Bits of a filter per row, and the most that one of the two filters may have: 32 MB each are broadcast at most.
#: Beyond 2 ** 28 / 8 rows more rows pass the test without need and shuffle; the result stays the same.
BITS_PER_ROW = 8
MAX_BITS = 1 << 28


def _position(sha: Column, which: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(sha, F.lit(which)), F.lit(bits)) + F.lit(which * bits + 1)


def _repeated_positions(prints: DataFrame, bits: int) -> DataFrame:
    """(block, bitmap) of the positions that two or more rows hit; at most ``2 * bits / 32768`` rows of 4 KB."""
    hits = prints.select(F.explode(F.array(*(_position(F.col("sha"), k, bits) for k in range(2)))).alias("pos"))
    twice = hits.groupBy("pos").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.groupBy(F.bitmap_bucket_number("pos").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("pos")).alias("bitmap"))


def _maybe_repeated(rows: DataFrame, blocks: DataFrame, bits: int, sha: str, flag: str) -> DataFrame:
    """Add ``flag``: whether both positions of the row are among the repeated ones. No shuffle: ``blocks`` is bounded and broadcast."""
    kept = rows.columns
    tests = []
    for k in range(2):
        block, bitmap = fresh(rows, f"_block{k}"), fresh(rows, f"_bitmap{k}")
        pos = _position(column(rows, sha), k, bits)
        side = blocks.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap))
        rows = rows.join(F.broadcast(side), F.bitmap_bucket_number(pos) == F.col(block), "left")
        bit = F.bitmap_bit_position(pos)
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(F.call_function("getbit", byte, (bit % 8).cast("int")) == 1, F.lit(False)))
    return rows.select(*(column(rows, c) for c in kept), (tests[0] & tests[1]).alias(flag))


def _first_pass(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int, int]:
    prints = stage(id_and_text(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha")), "fingerprints")
    total = prints.count()
    bits = min(MAX_BITS, max(1 << 15, 1 << (BITS_PER_ROW * total - 1).bit_length())) if total else 1 << 15
    return prints, _repeated_positions(prints, bits), bits, total


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the largest doc_id stays.

    A group may hold any share of the rows: it is counted with a map side, and joined back by :func:`join_groups`.

    NULL and empty texts are equal. NULL doc_id: smaller than any other. Rows with the same doc_id and text
    (repeated rows) cannot be told apart, so all of them have ``kept`` if one has; :func:`drop_copies` lets one
    pass. Empty table: no rows. Other columns are not read.
    """
    prints, blocks, bits, total = _first_pass(docs, id_col, text_col)
    tested = _maybe_repeated(prints, blocks, bits, "sha", "maybe")
    alone = tested.filter("not maybe").select("doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    maybe = tested.filter("maybe").select("doc_id", "sha")
    groups = maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = alone.unionByName(join_groups(maybe, groups, ["sha"], "group_size", total))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each text, that with the largest doc_id, all columns as they were.

    Rows without a possible equal are not shuffled. Edge cases as in :func:`mark_copies`.
    """
    prints, blocks, bits, _ = _first_pass(docs, id_col, text_col)
    maybe = _maybe_repeated(prints, blocks, bits, "sha", "maybe").filter("maybe")
    stays = maybe.groupBy("sha").agg(F.max("doc_id").alias("keep_id"))
    sha, flag = fresh(docs, "_sha"), fresh(docs, "_maybe")
    wide = docs.withColumn(sha, F.unhex(F.sha2(F.coalesce(column(docs, text_col).cast("string"), F.lit("")), 256)))
    wide = _maybe_repeated(wide, blocks, bits, sha, flag)
    chosen = wide.filter(F.col(flag)).join(stays.withColumnRenamed("sha", "_other").withColumnRenamed("keep_id", "_keep"), (F.col(sha) == F.col("_other")) & column(wide, id_col).eqNullSafe(F.col("_keep")), "left_semi")
    out = wide.filter(~F.col(flag)).unionByName(chosen.dropDuplicates([sha]))
    return out.select(*(column(out, c) for c in docs.columns))
