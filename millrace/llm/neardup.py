"""Near-duplicate detection: DartMinHash signatures, banded joining, an exact check, and classes of linked texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import ragged
from millrace.llm.common import column, fresh, id_and_text, join_groups
from millrace.session import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: With 36 bands of 6 coordinates two texts of similarity 0.8 share a band with probability 0.99998, of 0.5 with 0.43, of 0.3 with 0.03.
BANDS, ROWS = 36, 6
#: Counters that order shingles from rare to frequent, and texts of a side in a block of pairs.
SLOTS = 1 << 20
BLOCK = 1_000
_SLACK = 1e-9


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct runs of ``size`` words of each text. A shorter text has one, of all its words."""
    starts, lengths, text = ragged.words(raw, offsets)
    hashes = ragged.spread_hashes(raw, starts, lengths)
    n = len(offsets) - 1
    per_text = np.bincount(text, minlength=n)
    first = ragged.bounds(per_text)[:-1]
    runs = np.where(per_text == 0, 0, np.maximum(per_text - size + 1, 1))
    owner = np.repeat(np.arange(n), runs)
    at = ragged.ragged_index(first, runs)
    left = (first + per_text)[owner] - at
    value = np.zeros(len(at), np.uint64)
    for k in range(size):
        more = left > k
        value[more] = ragged.mix(value[more] * np.uint64(0x9FB21C651E98DF25) + hashes[at[more] + k])
    if not len(value):
        return owner, value, np.zeros(0, np.int64)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(value)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def dart_signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """DartMinHash: ``k`` coordinates for each of ``n`` weighted sets, zeros for an empty one.

    An element of weight w is a strip of height w along a time axis. Darts fall on it at random, by a Poisson process that
    only the element's hash decides, each for a random coordinate; a set keeps the earliest dart that hits one of its
    strips, for each coordinate. Two sets agree in a coordinate with the probability of their weighted Jaccard similarity. Darts are thrown up
    to a time by which all coordinates are probably hit, later where some are not. A strip is cut into cells of
    height one, whose darts are independent; a dart above the weight misses.
    """
    signature = np.zeros((n, k), np.uint64)
    total = np.bincount(owner, weights=weight, minlength=n)
    limit = np.divide(np.log(k) + 4.0, total, out=np.zeros(n), where=total > 0)
    open_sets = total > 0
    while open_sets.any():
        mine = np.flatnonzero(open_sets[owner])
        cells = np.ceil(weight[mine]).astype(np.int64)
        cell = ragged.ragged_index(np.zeros(len(mine), np.int64), cells)
        mine = np.repeat(mine, cells)
        seed = ragged.mix(element[mine] + cell.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        room = np.minimum(weight[mine] - cell, 1.0)
        who, until = owner[mine], limit[owner[mine]]
        time = np.zeros(len(mine))
        earliest = np.full(n * k, np.inf)
        chosen = np.zeros(n * k, np.uint64)
        thrown, block = 0, 1
        while len(seed):
            number = np.arange(thrown + 1, thrown + block + 1, dtype=np.uint64)
            dart = ragged.mix(seed[:, None] + number * np.uint64(0x9E3779B97F4A7C15))
            at = time[:, None] + np.cumsum(-np.log(_uniform(dart)), axis=1) / k
            other = ragged.mix(dart ^ np.uint64(0x165667B19E3779F9))
            good = (at <= until[:, None]) & (_uniform(ragged.mix(other + np.uint64(1))) <= room[:, None])
            row, _ = np.nonzero(good)
            place = who[row] * k + (other[good] % np.uint64(k)).astype(np.int64)
            moment, name = at[good], dart[good]
            np.minimum.at(earliest, place, moment)
            won = moment == earliest[place]
            chosen[place[won]] = name[won]
            time = at[:, -1]
            alive = time <= until
            seed, room, who, until, time = seed[alive], room[alive], who[alive], until[alive], time[alive]
            thrown += block
            block = min(64, max(1, thrown))
        full = np.isfinite(earliest).reshape(n, k).all(axis=1) & open_sets
        signature[full] = chosen.reshape(n, k)[full]
        open_sets &= ~full
        limit[open_sets] *= 2
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One hash per set and band, different from band to band."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = ragged.mix(key * np.uint64(0x9FB21C651E98DF25) + parts[:, :, r])
    return key


def signatures(docs: DataFrame, weighted: bool = False, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, sha, bands) of a table (doc_id, text): hash of the text, and band keys, none for a text without words."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, "text", ragged.SLICE_BYTES // 2):
                raw, offsets = ragged.flat(part.column("text"))
                owner, element, count = shingles(raw, offsets)
                weight = count.astype(float) if weighted else np.ones(len(count))
                keys = band_keys(dart_signatures(owner, element, weight, part.num_rows, bands * rows), bands, rows)
                some = np.bincount(owner, minlength=part.num_rows) > 0
                ends = pa.array(ragged.bounds(np.where(some, bands, 0)).astype(np.int32))
                data = raw.tobytes()
                shas = [hashlib.sha256(data[a:b]).digest()[:16] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(shas, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(keys[some].ravel().view(np.int64)))],
                    names=["doc_id", "sha", "bands"],
                )

    return docs.mapInArrow(run, f"doc_id {kind}, sha binary, bands array<bigint>")


def _sets(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """(id, shingles) of a table (doc_id, text): the distinct shingles, as hashes.

    With weights each occurrence of a shingle has a hash of its own, by its number: the plain similarity of such sets is the weighted one of the texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                owner, element, count = shingles(*ragged.flat(part.column("text")))
                if weighted:
                    again = ragged.ragged_index(np.zeros(len(count), np.int64), count).astype(np.uint64)
                    owner, element = np.repeat(owner, count), np.repeat(element, count)
                    element = np.where(again > 0, ragged.mix(element + again * np.uint64(0xC2B2AE3D27D4EB4F)), element)
                ends = pa.array(ragged.bounds(np.bincount(owner, minlength=part.num_rows)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(element.view(np.int64)))], names=["id", "shingles"])

    return docs.mapInArrow(run, f"id {kind}, shingles array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of the nodes of ``edges`` (a, b): the smallest id that each is connected with.

    Labels spread over the edges and jump along themselves until none changes; each round is stored. A node of any degree is
    fine: minima have a map side, and Spark splits a skewed join.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels.id == near.a).select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        spread = stage(spread, "labels")
        jump = spread.select(F.col("id").alias("via"), F.col("label").alias("further"))
        now = stage(spread.join(jump, spread.label == jump.via, "left").select("id", F.least("label", F.coalesce("further", "label")).alias("label"), "old"), "labels")
        labels = now.drop("old")
        if now.filter("label != old").isEmpty():
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have at least that Jaccard similarity."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")).join(pairs.select("b").distinct(), "b", "left_semi")
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("common") >= similarity * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")


def classes(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_id (smallest doc_id with the same text), class_id.

    ``class_id`` is the smallest doc_id that is linked with the row's text through texts of which each two neighbours have a Jaccard
    similarity of at least ``similarity`` over their sets of five-word runs (words as in :func:`millrace.llm.ragged.words`); ``weighted`` counts each
    occurrence of a run.

    Equal texts count once. Texts that share a band key meet in a bucket, and are compared exactly with the bucket's centre: the
    text that shares most buckets with others, which in a group of altered copies is the original. Where a bucket then holds several
    classes, texts of different classes are compared with each other, in buckets of any size, wherever :func:`_possible` cannot
    rule a link out. So two texts with a common key (at 0.8 with probability 0.99998) that are alike are always linked. No bucket is capped. A bucket may hold any share of the rows.

    NULL text: empty. Texts without a word: only equal ones are alike. Fewer than five words: one run of all words. Rows that share a
    doc_id are one node. NULL doc_id: text_id and class_id of an equal text, or NULL. Empty table: no rows.
    """
    narrow = id_and_text(docs, id_col, text_col)
    prints = stage(signatures(narrow, weighted), "signatures")
    texts = prints.groupBy("sha").agg(F.min("doc_id").alias("text_id"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    texts = stage(texts, "texts")
    labels = _labels(narrow, texts.filter("text_id is not null").select(F.col("text_id").alias("id"), "bands"), similarity, weighted)
    total = prints.count()
    rows = join_groups(prints.select("doc_id", "sha"), texts.select("sha", "text_id", "copies"), ["sha"], "copies", total).select("doc_id", "text_id")
    if labels is None:
        return rows.withColumn("class_id", F.col("text_id"))
    return rows.join(labels.withColumnRenamed("id", "text_id"), "text_id", "left").select("doc_id", "text_id", F.coalesce("label", "text_id").alias("class_id"))


def _labels(docs: DataFrame, texts: DataFrame, similarity: float, weighted: bool = False) -> DataFrame | None:
    entries = texts.select("id", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    total = texts.count()
    met = stage(join_groups(entries, shared, ["key"], "n", total, how="inner").distinct(), "buckets")
    if met.isEmpty():
        return None
    popular = met.groupBy("id").agg(F.sum("n").alias("popular"))
    left = stage(met.join(popular, "id"), "buckets")
    wanted = popular.select(F.col("id").alias("doc_id"))
    sets = stage(_sets(docs.join(wanted, "doc_id", "left_semi"), weighted).dropDuplicates(["id"]), "shingles")

    centre = left.groupBy("key").agg(F.max("n").alias("size"), F.max(F.struct("popular", (-F.col("id")).alias("minus"))).alias("top"))
    heads = stage(centre.select("key", "size", (-F.col("top.minus")).alias("centre")), "centres")
    pairs = join_groups(left.select("key", "id"), heads, ["key"], "size", total, how="inner").filter("id != centre")
    tested = stage(pairs.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct(), "pairs")
    edges = stage(_verified(tested, sets, similarity), "links")
    labels = components(edges)

    # All texts of a bucket that holds several classes, linked with its centre or not, are compared with all that a link is possible with.
    named = left.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    apart = stage(_mixed(named, total), "apart")
    if apart.isEmpty():
        return labels
    pairs = stage(_possible(sets.join(apart, "id"), similarity).join(tested, ["a", "b"], "left_anti"), "pairs")
    more = stage(_verified(pairs, sets, similarity), "links")
    return labels if more.isEmpty() else components(edges.unionByName(more))


def _mixed(entries: DataFrame, total: int) -> DataFrame:
    """The texts (id, label) in buckets of ``entries`` (key, id, label) with more than one label."""
    mixed = entries.groupBy("key").agg(F.count("*").alias("now"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    return join_groups(entries, mixed.select("key", "now"), ["key"], "now", total, how="inner").select("id", "label").distinct()


def _possible(open_sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of ``open_sets`` (id, shingles, label) with different labels that may be ``similarity`` alike, and few others.

    In any one order of all shingles, the first one that two such sets have in common stands among the first n - ceil(similarity * n) + 1 of
    either, n its size. The order here goes from rare to frequent, so a passage that many texts share comes last. Sizes, and what is left
    after the two places, bound the overlap. Texts of the most frequent label of a shingle are not paired with each other; pairs
    of a frequent shingle are dealt over blocks of ``BLOCK`` times ``BLOCK`` texts.
    """
    entries = stage(_rare_shingles(open_sets, similarity), "rare")
    per_label = entries.groupBy("shingle", "label").agg(F.count("*").alias("c"))
    mixed = per_label.groupBy("shingle").agg(F.sum("c").alias("n"), F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels")).filter("labels > 1")
    met = join_groups(entries, mixed.select("shingle", "n", F.col("top.label").alias("main")), ["shingle"], "n", entries.count(), how="inner")
    met = stage(met.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "met")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    one = met.filter("label != main").select("shingle", F.col("id").alias("x"), F.col("label").alias("lx"), F.col("size").alias("nx"), F.col("place").alias("px"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("i"), every.alias("j"))
    two = met.select("shingle", F.col("id").alias("y"), F.col("label").alias("ly"), F.col("size").alias("ny"), F.col("place").alias("py"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("j"), every.alias("i"))
    alike = (F.col("lx") != F.col("ly")) & (F.least("nx", "ny") >= similarity * F.greatest("nx", "ny") - _SLACK)
    enough = F.least(F.col("nx") - F.col("px"), F.col("ny") - F.col("py")) >= similarity / (1 + similarity) * (F.col("nx") + F.col("ny")) - _SLACK
    return one.join(two, ["shingle", "i", "j"]).filter(alike & enough).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def _rare_shingles(open_sets: DataFrame, similarity: float) -> DataFrame:
    """(id, label, size, place, shingle): the first shingles of each set, as :func:`_possible` needs them, and their place from 0.

    Shingles are ordered by the count of their slot, then by hash. A slot counts all shingles of a hash class, so it
    is bounded whatever the corpus, and any shingle is at most as frequent; one whose slot counts 1 is in no other set.
    """
    slots = open_sets.select(F.explode("shingles").alias("s")).groupBy(F.pmod("s", F.lit(SLOTS)).alias("slot")).agg(F.count("*").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[slots.column("slot").to_numpy()] = slots.column("n").to_numpy()
    kind = open_sets.schema["id"].dataType.simpleString()
    counts = open_sets.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = part.column("shingles")
                value = sets.flatten().to_numpy(zero_copy_only=False)
                size = np.diff(sets.offsets.to_numpy()).astype(np.int64)
                owner = np.repeat(np.arange(part.num_rows), size)
                seen = counts.value[value % SLOTS]
                order = np.lexsort((value, seen, owner))
                place = ragged.ragged_index(np.zeros(part.num_rows, np.int64), size)
                first = size - np.ceil(similarity * size - _SLACK).astype(np.int64) + 1
                keep = (place < first[owner]) & (seen[order] > 1)
                mine = owner[keep]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(mine)), part.column("label").take(pa.array(mine)), pa.array(size[mine]), pa.array(place[keep]), pa.array(value[order][keep])],
                    names=["id", "label", "size", "place", "shingle"],
                )

    return open_sets.select("id", "label", "shingles").mapInArrow(run, f"id {kind}, label {kind}, size bigint, place bigint, shingle bigint")


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, that with the smallest doc_id, all columns as they were. Edge cases as in :func:`classes`; rows with NULL doc_id stay."""
    found = stage(classes(docs, similarity, weighted, id_col, text_col).filter("doc_id is not null"), "classes")
    several = found.groupBy("class_id").agg(F.count("*").alias("rows")).filter("rows > 1")
    doubt = join_groups(found, several, ["class_id"], "rows", found.count(), how="inner").select(F.col("doc_id").alias("_id"), (F.col("doc_id") == F.col("class_id")).alias("_stays")).distinct()
    verdict = fresh(docs, "_verdict")
    joined = docs.join(doubt, column(docs, id_col) == F.col("_id"), "left").select(*(column(docs, c) for c in docs.columns), F.col("_stays").alias(verdict))
    out = joined.filter(F.col(verdict).isNull()).unionByName(joined.filter(F.col(verdict)).dropDuplicates([id_col]))
    return out.drop(verdict)
