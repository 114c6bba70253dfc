"""Merkle manifest of a dataset: a tree of 16 per group, over the groups' subroots a tree of the same kind.

A leaf's place is a rank query, not a sort. Ids of a group are merged into bitmaps of 64 bits, of which only those with a bit are kept.
A popcount directory counts the rows before each bitmap; rank = rows before + popcount of the lower bits. At most 64 ids share a key, so a group may
hold any share of the rows. Places then key the levels: a node gathers its up to 16 children as a slot array,
and paths go down from the root, again by keys of at most 16.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import column, join_groups
from millrace.operators.numbering import number_rows
from millrace.session import stage

#: Children of a node, as a power of two.
FAN_BITS = 4
#: Words of 64 ids that one container of the directory covers, as a power of two.
CONTAINER_BITS = 9
#: The word of NULL ids: before that of any 64-bit id.
NO_ID = -(1 << 58)
#: Where this divides the CRC-32 of the decimal id, the text is tampered with.
TAMPERED = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, grp, leaf, forged): ``forged`` is the leaf of the tampered text, NULL where nothing was tampered with. ``grp`` is empty for a NULL source."""
    doc_id, source, lang, n_chars = (column(docs, c) for c in ("doc_id", "source", "lang", "n_chars"))
    text = column(docs, "text").cast("string")
    head = F.concat(*(_field(c) for c in (doc_id, source, lang, n_chars)))
    forged = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % TAMPERED == 0
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string"))).alias("grp"),
        digest(head, _field(text)).alias("leaf"),
        F.when(forged, digest(head, _field(F.translate(text, _UPPER, _LOWER)))).alias("forged"),
    )


def _word_and_bit(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "word": F.coalesce(F.shiftright("doc_id", 6), F.lit(NO_ID)),
        "bit": F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int"),
    })


def directory(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n, before, total): the non-empty bitmaps of a group, rows in one, rows of the group before it, rows of the group.

    Bitmaps merge by OR with a map side. Counts add up within containers of 512 words, and over a group's containers by sums of ranges.
    """
    words = _word_and_bit(rows).groupBy("grp", "word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count("*").alias("n"))
    words = stage(words.withColumn("box", F.shiftright("word", CONTAINER_BITS)), "id-bitmaps")
    in_box = Window.partitionBy("grp", "box").orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("inside", F.coalesce(F.sum("n").over(in_box), F.lit(0)))
    return words.join(_container_sums(words.groupBy("grp", "box").agg(F.sum("n").alias("in_box"))), ["grp", "box"]).select(
        "grp", "word", "bits", "n", (F.col("ahead") + F.col("inside")).alias("before"), "total")


def _container_sums(boxes: DataFrame) -> DataFrame:
    """(grp, box, ahead, total). Sums run over range partitions, so a group may have any number of containers."""
    n = max(1, boxes.count() // 100_000)
    laid = stage(boxes.repartitionByRange(n, "grp", "box").sortWithinPartitions("grp", "box").withColumn("part", F.spark_partition_id()), "containers")
    # One row per group and range: no more than groups + ranges.
    parts = laid.groupBy("grp", "part").agg(F.sum("in_box").alias("in_part"))
    by_group = Window.partitionBy("grp")
    parts = parts.select(
        "grp", "part", F.coalesce(F.sum("in_part").over(by_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("parts_ahead"),
        F.sum("in_part").over(by_group).alias("total"))
    here = Window.partitionBy("grp", "part").orderBy("box").rowsBetween(Window.unboundedPreceding, -1)
    return laid.withColumn("ahead", F.coalesce(F.sum("in_box").over(here), F.lit(0))).join(parts, ["grp", "part"]).select(
        "grp", "box", (F.col("parts_ahead") + F.col("ahead")).alias("ahead"), "total")


def place(rows: DataFrame) -> DataFrame:
    """Add ``pos`` (from 0, by id within ``grp``) and ``total`` to leaves."""
    words = stage(directory(rows), "id-directory")
    rows = _word_and_bit(rows)
    lower = F.expr("bit_count(bits & ~shiftleft(-1L, bit))")
    single = rows.join(words.filter("n = bit_count(bits)"), ["grp", "word"])
    placed = single.select("doc_id", "grp", "leaf", "forged", (F.col("before") + lower).alias("pos"), "total")
    crowded = words.filter("n > bit_count(bits)")
    if crowded.isEmpty():
        return placed
    # Ids that rows share: these few words are numbered row by row, by id and leaf.
    again = number_rows(rows.join(crowded.drop("bits", "n"), ["grp", "word"]), ["grp", "word"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")])
    return placed.unionByName(again.select("doc_id", "grp", "leaf", "forged", (F.col("before") + F.col("rn") - 1).alias("pos"), "total"))


def _nodes(total: Column, level: int) -> Column:
    """How many nodes a group of ``total`` leaves has on a level."""
    return F.shiftright(total + ((1 << FAN_BITS * level) - 1), FAN_BITS * level)


def _parents(children: DataFrame, level: int, *more: str) -> DataFrame:
    """(grp, pos, total, kids, node) of the level above ``level``: kids is the slot array, in order, with the columns ``more`` beside each digest.

    A group with a lone leaf gets one parent that is that leaf, so that paths can start there too.
    """
    kids = F.array_sort(F.collect_list(F.struct(F.col("pos").bitwiseAND((1 << FAN_BITS) - 1).alias("slot"), "node", *more)))
    up = children.groupBy("grp", F.shiftright("pos", FAN_BITS).alias("up"), "total").agg(kids.alias("kids"))
    joined = F.concat_ws("", F.col("kids.node"))
    return up.select("grp", F.col("up").alias("pos"), "total", "kids", F.when(_nodes(F.col("total"), level) == 1, joined).otherwise(F.sha2(joined, 256)).alias("node"))


def _levels(first: DataFrame, label: str, *more: str) -> list[DataFrame]:
    """The levels above ``first`` (grp, pos, total, node, and ``more``), written one by one; the last has one node per group that gets there."""
    levels = [stage(_parents(first, 0, *more), label)]
    longest = levels[0].agg(F.max("total")).first()[0] or 0
    while longest > 1 << FAN_BITS * len(levels):
        below = levels[-1].filter(_nodes(F.col("total"), len(levels)) > 1)
        levels.append(stage(_parents(below.drop("kids"), len(levels)), label))
    return levels


def _tops(levels: list[DataFrame]) -> list[DataFrame]:
    """Of each level above the first the groups' last nodes; of every other level nothing is left out, it goes on."""
    return [level.filter(_nodes(F.col("total"), i) == 1) for i, level in enumerate(levels, 1)]


def _siblings(kids: str, slot: Column) -> Column:
    """The digests before and after a slot, each put together."""
    left = F.concat_ws("", F.transform(F.filter(F.col(kids), lambda kid: kid["slot"] < slot), lambda kid: kid["node"]))
    right = F.concat_ws("", F.transform(F.filter(F.col(kids), lambda kid: kid["slot"] > slot), lambda kid: kid["node"]))
    return F.struct(left.alias("left"), right.alias("right"))


def _no_path() -> Column:
    return F.expr("cast(array() as array<struct<left: string, right: string>>)")


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first of ``levels`` with ``path`` (from there to the root) and the other columns of ``above``, which has one row per group."""
    done = [c for c in above.columns if c != "grp"]
    down = None
    for i in range(len(levels), 0, -1):
        level = levels[i - 1]
        here = _tops(levels)[i - 1].join(above, "grp").select(*level.columns, *done)
        if down is not None:
            parent = down.select("grp", F.col("pos").alias("up"), F.col("kids").alias("brothers"), *done)
            lower = level.filter(_nodes(F.col("total"), i) > 1).withColumn("up", F.shiftright("pos", FAN_BITS)).join(parent, ["grp", "up"])
            step = _siblings("brothers", F.col("pos").bitwiseAND((1 << FAN_BITS) - 1))
            lower = lower.withColumn("path", F.concat(F.array(step), F.col("path")))
            here = here.unionByName(lower.select(*here.columns))
        down = stage(here, "paths") if i > 1 else here
    return down


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and source and position.

    ``docs`` has doc_id (a whole number), source, lang, n_chars and text. A leaf is the digest of these five, a NULL one as ``-``. ``folded_root`` is recomputed from the
    leaf, tampered with where :data:`TAMPERED` says so, and its untouched siblings; ``verified`` tells whether that is the root.

    NULL source: a group of its own, the first. NULL doc_id: first in its group, no number for the CRC (so that of an empty string, 0: tampered with). Rows that share a
    doc_id: in the order of their leaves; equal rows are equal leaves at places next to each other. A tampered text without A-Z still verifies. Empty
    table: no rows. Other columns are not read.
    """
    rows = stage(leaves(docs), "leaves")
    placed = place(rows).withColumnRenamed("leaf", "node")
    levels = _levels(placed, "nodes", "doc_id", "forged")
    tops = reduce(DataFrame.unionByName, [t.select("grp", F.col("node").alias("subroot")) for t in _tops(levels)])
    tops = stage(tops, "subroots")
    groups = tops.count()
    numbered = number_rows(tops, [], F.col("grp"), "rank")
    first = numbered.select(F.lit(0).alias("grp"), (F.col("rank") - 1).alias("pos"), F.lit(groups).cast("long").alias("total"), F.col("subroot").alias("node"), F.col("grp").alias("of"))
    over = _levels(first, "group-nodes", "of")
    root = over[-1].select("grp", F.col("node").alias("root"), _no_path().alias("path"))
    runs = _paths(over, root)
    subroots = runs.select("root", "kids", "path", "total", F.explode("kids").alias("kid")).select(
        F.col("kid.of").alias("grp"), F.col("kid.node").alias("subroot"), "root",
        F.when(F.col("total") == 1, F.col("path")).otherwise(F.concat(F.array(_siblings("kids", F.col("kid.slot"))), F.col("path"))).alias("path"))
    subroots = stage(subroots, "group-paths")
    runs = _paths(levels, subroots)
    rows = runs.select("grp", "pos", "total", "subroot", "root", "kids", "path", F.explode("kids").alias("kid"))
    path = F.when(F.col("total") == 1, F.col("path")).otherwise(F.concat(F.array(_siblings("kids", F.col("kid.slot"))), F.col("path")))
    rows = rows.select("grp", (F.shiftleft("pos", FAN_BITS) + F.col("kid.slot")).alias("pos"), "kid", "subroot", "root", path.alias("path"))
    start = F.coalesce(F.col("kid.forged"), F.col("kid.node"))
    folded = F.aggregate("path", start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))
    proof = F.sha2(F.concat_ws("", F.transform("path", lambda step: F.concat(step["left"], step["right"]))), 256)
    out = rows.select(
        F.col("kid.doc_id").alias("doc_id"), F.col("kid.node").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"),
        F.when(F.col("grp") != "", F.substring("grp", 2, 1 << 30)).alias("source"), F.col("pos").alias("position"))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "source", "position")
