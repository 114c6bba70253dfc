"""Language identification by a bit-sliced Bloom filter that gives, for an n-gram, all languages that have it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import ragged
from millrace.llm.common import column
from millrace.session import stage

#: Documents of each language that are learned from, about; chosen by a hash of the id.
SAMPLE_DOCS = 2_000
#: Lengths of the n-grams, in code points; words are framed by blanks.
ORDERS = (2, 3, 4)
#: Slots of the filter (a language set each), and slots that an n-gram looks at.
SLOTS = 1 << 20
PROBES = 2
#: An n-gram belongs to the languages where it came at least so often, and at least at this share of its highest rate.
LEAST_COUNT = 3
LEAST_SHARE = 0.25
UNKNOWN = "und"


@dataclass
class Filter:
    """``masks[slot, word]`` holds a bit per language; ``chance`` the share of absent n-grams that seem to be in each language."""

    languages: list[str]
    masks: np.ndarray
    chance: np.ndarray


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text number of every n-gram, and how many letters each text has."""
    raw, offsets = ragged.flat(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    points, at = ragged.code_points(raw)
    text = np.searchsorted(offsets, at, side="right") - 1
    letter = ragged.class_table()[points] == ragged.LETTER
    letters = np.bincount(text[letter], minlength=len(texts))
    first = np.ones(len(points), bool)
    first[1:] = text[1:] != text[:-1]
    keep = letter.copy()
    keep[:-1] |= letter[1:] & ~first[1:]
    keep[1:] |= letter[:-1] & ~first[1:]
    points, text = np.where(letter, points, 0)[keep], text[keep]
    if not len(points):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    # One blank before each text and one at the end frame the first and last words.
    begins = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    points = np.insert(points, np.append(begins, len(points)), 0).astype(np.uint64)
    owner = np.insert(text, np.append(begins, len(text)), np.append(text[begins], text[-1]))
    out, who = [], []
    for n in ORDERS:
        if len(points) < n:
            continue
        size = len(points) - n + 1
        value = np.full(size, np.uint64(n))
        inner = np.ones(size, bool)
        for k in range(n):
            value = (value + points[k : k + size]) * np.uint64(0x9FB21C651E98DF25)
            if 0 < k < n - 1:
                inner &= points[k : k + size] != 0
        inner &= (points[:size] != 0) | (points[n - 1 :] != 0)
        out.append(ragged.mix(value[inner]))
        who.append(np.where(points[:size] != 0, owner[:size], owner[n - 1 :])[inner])
    return np.concatenate(out), np.concatenate(who), letters


def _slots(grams: np.ndarray) -> list[np.ndarray]:
    shift = np.uint64(64 - (SLOTS.bit_length() - 1))
    return [(ragged.mix(grams + np.uint64(k + 1)) >> shift).astype(np.int64) for k in range(PROBES)]


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text leaves 2 when divided by 4. A NULL id is not."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Filter:
    """Learn from a table (doc_id, text, lang) of documents that may be learned from.

    ``sample_docs`` bounds the labelled rows of each language. N-grams are counted in tasks and added up by Spark; the finished filter has at
    most ``SLOTS`` rows per 64 languages, whatever the corpus, and only that comes to the driver.
    """
    spark = docs.sparkSession
    labelled = docs.filter("lang is not null and text is not null")
    per_language = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(per_language)
    if not languages:
        return Filter([], np.zeros((1, 1), np.uint64), np.zeros(0))
    shares = spark.createDataFrame([(k, sample_docs / n, i) for i, (k, n) in enumerate(sorted(per_language.items()))], "lang string, share double, code int")
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.join(F.broadcast(shares), "lang").filter(draw < F.col("share")).select("code", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                grams, text, _ = _grams(part.column("text"))
                codes = part.column("code").to_numpy(zero_copy_only=False)[text]
                for code in np.unique(codes):
                    seen, times = np.unique(grams[codes == code], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), code, np.int32)), pa.array(seen.view(np.int64)), pa.array(times)], names=["code", "gram", "n"])

    counts = sample.mapInArrow(count, "code int, gram bigint, n bigint").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    counts = stage(counts, "ngrams")
    totals = counts.groupBy("code").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), "code").withColumn("rate", F.col("n") / F.col("total"))
    rates = rates.withColumn("most", F.max("rate").over(Window.partitionBy("gram")))
    own = rates.filter((F.col("n") >= LEAST_COUNT) & (F.col("rate") >= F.col("most") * LEAST_SHARE)).select("code", "gram")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy()
            for slot in _slots(batch.column("gram").to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(codes // 64), pa.array((np.uint64(1) << (codes % 64).astype(np.uint64)).view(np.int64))], names=["slot", "word", "bits"])

    filled = own.mapInArrow(place, "slot bigint, word int, bits bigint").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    masks = np.zeros((SLOTS, -(-len(languages) // 64)), np.uint64)
    masks[filled["slot"].to_numpy(), filled["word"].to_numpy()] = filled["bits"].to_numpy().view(np.uint64)
    fill = np.array([np.count_nonzero(masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / SLOTS for i in range(len(languages))])
    return Filter(languages, masks, fill**PROBES)


def _scores(texts: pa.Array, masks: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the best language's number, its score, and whether there is a letter."""
    grams, text, letters = _grams(texts)
    slots = _slots(grams)
    n = len(texts)
    total = np.maximum(np.bincount(text, minlength=n), 1)
    share = np.zeros((n, len(chance)))
    for word in range(masks.shape[1]):
        found = masks[slots[0], word]
        for slot in slots[1:]:
            found &= masks[slot, word]
        for i in range(word * 64, min(len(chance), word * 64 + 64)):
            hit = (found >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
            share[:, i] = np.bincount(text[hit], minlength=n) / total
    share = np.clip((share - chance) / (1 - chance), 0, None)
    best = share.argmax(axis=1)
    top = share[np.arange(n), best]
    share[np.arange(n), best] = 0
    second = share.max(axis=1)
    return best, np.divide(top, top + second, out=np.zeros(n), where=top > 0), letters > 0


def predict(docs: DataFrame, known: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, from the text alone.

    Each n-gram's slots are and-ed into the set of languages that have it; the sets are counted per language, what the
    filter answers by chance is taken off, and the highest share of n-grams decides. ``score`` is that share against the sum of
    it and the next one, 0 to 1.

    ``und`` with score 0: NULL text, a text without a letter, or nothing learned. Ties: the language that sorts first. Very long text: whole. Repeated
    rows: a result each. NULL doc_id: kept. Empty table: no rows. Other columns are not read.
    """
    narrow = docs.select(column(docs, id_col).alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((known.masks, known.chance))
    names = np.array([*known.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, chance = shared.value
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                if len(chance):
                    best, score, any_letter = _scores(part.column("text"), masks, chance)
                else:
                    best, score, any_letter = np.zeros(part.num_rows, int), np.zeros(part.num_rows), np.zeros(part.num_rows, bool)
                labels = names[np.where(any_letter, best, len(names) - 1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(labels, pa.string()), pa.array(np.where(any_letter, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
