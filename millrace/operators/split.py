"""One message into several, and several back into one."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.messages import as_column

PART_ROWS = 100_000
#: Numbers in one word of a bitmap, as a power of two.
WORD_BITS = 6


def split_messages(
    df: DataFrame,
    expression: str | Column | None = None,
    delimiter: str | None = None,
    correlation: str | Column | None = None,
) -> DataFrame:
    """One row per element of an array (or map entry), or per piece between delimiters.

    Adds ``correlation_id``, ``sequence_number`` (from 1) and ``sequence_size``, which
    :func:`reassemble` needs.  ``correlation`` names the parent message; without it no
    id is added.
    """
    if (expression is None) == (delimiter is None):
        raise ValueError("give either an expression or a delimiter")
    pieces = F.split("payload", re.escape(delimiter)) if delimiter is not None else as_column(expression)
    rest = [c for c in df.columns if c != "payload"]
    if correlation is not None:
        df = df.withColumn("correlation_id", as_column(correlation))
        rest = [c for c in rest if c != "correlation_id"] + ["correlation_id"]
    kind = df.select(pieces.alias("p")).schema["p"].dataType.typeName()
    if kind == "map":
        pieces = F.map_entries(pieces)
    # The size is taken before the explode, or every piece would carry the whole array along; and the
    # outer form keeps Spark from splitting the text again for a filter on empty arrays.
    return (
        df.withColumn("_mr_pieces", pieces)
        .withColumn("sequence_size", F.coalesce(F.size("_mr_pieces"), F.lit(0)))
        .select(*rest, "sequence_size", F.posexplode_outer("_mr_pieces").alias("_mr_pos", "payload"))
        .filter(F.col("_mr_pos").isNotNull())
        .select(*rest, "payload", (F.col("_mr_pos") + 1).alias("sequence_number"), "sequence_size")
    )


def reassemble(
    df: DataFrame,
    correlation: str = "correlation_id",
    seq: str = "sequence_number",
    size: str = "sequence_size",
    payload: str = "payload",
    part_rows: int = PART_ROWS,
    unique: bool = False,
) -> DataFrame:
    """A3: the payloads of each complete group, by sequence number.

    A group is complete when every number 1..size has arrived, a number that arrived more than once counts once (smallest payload). Groups of more
    than ``part_rows`` members come out as several rows (``part`` 0, 1, …), so no task holds a whole giant group. Messages without a
    correlation or with a number outside 1..size are left out. If messages of one group name different sizes, the largest counts,
    of those up to ``part_rows`` and of the larger ones by themselves.

    Payloads are shuffled once, by group and part. Groups of one part are counted where they then are; for larger ones bitmaps of the numbers,
    64 in a row, tell beforehand which are complete, so payloads of the others are not gathered at all.

    ``unique`` promises that no number arrives twice, as straight after :func:`split_messages`; it saves the folding of repeats. On a stream
    this is :func:`millrace.streaming.aggregate.reassemble_stream`, or :func:`millrace.streaming.batches.reassemble_batches` where groups may be large.
    """
    if df.isStreaming:
        from millrace.streaming.aggregate import reassemble_stream

        return reassemble_stream(df, correlation, seq, size, payload, part_rows=part_rows)
    rows = df.select(
        F.col(correlation).alias("correlation"), F.col(seq).cast("long").alias("seq"),
        F.col(size).cast("long").alias("size"), F.col(payload).alias("payload"),
    ).filter("seq between 1 and size and correlation is not null")
    whole = whole_groups(bit_words(rows.filter(F.col("size") > part_rows)))
    # A row per part, so that the join finds the payloads where their shuffle has put them.
    parts = whole.select("correlation", F.explode(F.expr(f"sequence(0, (size - 1) div {part_rows})")).alias("part"), F.lit(True).alias("_mr_whole"))
    dealt = rows.withColumn("part", F.expr(f"(seq - 1) div {part_rows}")).repartition("correlation", "part")
    rows = dealt.join(parts, ["correlation", "part"], "left").filter((F.col("size") <= part_rows) | F.col("_mr_whole"))
    if not unique:
        rows = rows.groupBy("correlation", "part", "seq").agg(F.max("size").alias("size"), _smallest(rows, "payload").alias("payload"))
    items = F.collect_list(F.struct("seq", "payload"))
    gathered = rows.groupBy("correlation", "part").agg(F.max("size").alias("size"), (F.sort_array(items) if _ordered(rows, "payload") else F.array_sort(items, _by_seq)).alias("items"))
    complete = F.size("items") == F.least(F.col("size") - F.col("part") * part_rows, F.lit(part_rows))
    return gathered.filter(complete).select("correlation", "part", "size", F.transform("items", lambda x: x["payload"]).alias("payloads"))


def _ordered(rows: DataFrame, name: str) -> bool:
    kind = rows.schema[name].dataType.simpleString()
    return "map<" not in kind and "variant" not in kind


def _by_seq(a: Column, b: Column) -> Column:
    return (a["seq"] - b["seq"]).cast("int")


def _smallest(rows: DataFrame, name: str) -> Column:
    """The smallest value, or any where values have no order."""
    return F.min(name) if _ordered(rows, name) else F.any_value(name)


def bit_words(rows: DataFrame) -> DataFrame:
    """(correlation, word, bits, size): which numbers of each group there are, 64 to a row; merged with a map side."""
    word = F.shiftright(F.col("seq") - 1, WORD_BITS)
    bit = F.expr(f"shiftleft(1L, cast((seq - 1) & {(1 << WORD_BITS) - 1} as int))")
    return rows.groupBy("correlation", word.alias("word")).agg(F.bit_or(bit).alias("bits"), F.max("size").alias("size"))


def whole_groups(words: DataFrame) -> DataFrame:
    """(correlation, size) of the groups whose bitmaps, of one or several :func:`bit_words`, have all numbers."""
    merged = words.groupBy("correlation", "word").agg(F.bit_or("bits").alias("bits"), F.max("size").alias("size"))
    groups = merged.groupBy("correlation").agg(F.sum(F.bit_count("bits")).alias("_mr_n"), F.max("size").alias("size"))
    return groups.filter("_mr_n = size").drop("_mr_n")
