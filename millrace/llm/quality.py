"""Quality rules: word and repetition rules per document, and lines that too many documents of a host share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import ragged
from millrace.llm.common import column, fresh, join_groups
from millrace.session import stage

#: A line is boilerplate of its host if more than this many different documents have it, and more than this share of the host's documents.
LINE_DOCS = 10
LINE_SHARE = 0.01
#: A document is depleted if more than this many percent of its words stand in boilerplate lines.
DEPLETED_PERCENT = 70
MIN_WORDS = 50
REPEATED_PERCENT = 50

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_FEATURES = "row bigint, text_key bigint, host_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _per_text(text: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(text, minlength=n).astype(np.int64)


def _within(values: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ from text to text."""
    return ragged.mix(values + (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))


def _lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length (without the line feed) and text number of every line that is not empty."""
    fresh_line = np.zeros(len(raw) + 1, bool)
    fresh_line[np.flatnonzero(raw == 0x0A) + 1] = True
    fresh_line[offsets[:-1]] = True
    starts = np.flatnonzero(fresh_line[:-1])
    ends = np.append(starts[1:], len(raw))
    lengths = ends - starts - (raw[ends - 1] == 0x0A)
    full = lengths > 0
    return starts[full], lengths[full], np.searchsorted(offsets, starts[full], side="right") - 1


def measure(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The figures of each text, and of its lines with words: text number, hash of the words, number of words."""
    n = len(offsets) - 1
    starts, lengths, text = ragged.words(raw, offsets)
    hashes = ragged.spread_hashes(raw, starts, lengths)
    lead = ragged.bounds((raw & 0xC0) != 0x80)
    chars = np.zeros(n, np.int64)
    np.add.at(chars, text, lead[starts + lengths] - lead[starts])
    symbols = ragged.bounds(_SYMBOLS[raw])

    repeat = np.zeros(len(starts), bool)
    if len(starts) > 2:
        at = np.flatnonzero(text[2:] == text[:-2])
        three = hashes[at] * np.uint64(3) + ragged.mix(hashes[at + 1]) * np.uint64(5) + ragged.mix(hashes[at + 2] + np.uint64(7)) * np.uint64(11)
        three = _within(three, text[at])
        order = np.argsort(three)
        again = three[order][1:] == three[order][:-1]
        twice = np.unique(np.concatenate([order[1:][again], order[:-1][again]]))
        for k in range(3):
            repeat[at[twice] + k] = True

    line_start, line_length, line_text = _lines(raw, offsets)
    first = np.searchsorted(starts, line_start)
    after = np.searchsorted(starts, line_start + line_length)
    with_word = after > first
    line_start, line_length, line_text, first, after = (x[with_word] for x in (line_start, line_length, line_text, first, after))
    whole = _within(ragged.spread_hashes(raw, line_start, line_length), line_text)
    _, once = np.unique(whole, return_index=True)
    if len(first):
        place = ragged.ragged_index(np.zeros(len(first), np.int64), after - first).astype(np.uint64)
        normal = np.add.reduceat(ragged.mix(hashes[first[0] : after[-1]] + place * np.uint64(0xA0761D6478BD642F)), first - first[0])
    else:
        normal = np.zeros(0, np.uint64)
    lines = _per_text(line_text, n)
    return {
        "n_words": _per_text(text, n),
        "word_chars": chars,
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": lines - _per_text(line_text[once], n),
        "n_repeat_words": _per_text(text[repeat], n),
        "line_text": line_text,
        "line_hash": ragged.mix(normal),
        "line_words": after - first,
    }


def _key_columns(docs: DataFrame, text_col: str, host_col: str | None) -> tuple[Column, Column]:
    """Hashes of a row's text and host."""
    host = column(docs, host_col).cast("string") if host_col else F.lit("")
    return F.xxhash64(F.coalesce(column(docs, text_col).cast("string"), F.lit(""))), F.xxhash64(F.lit("host"), F.coalesce(host, F.lit("")))


def features(docs: DataFrame, id_col: str, text_col: str, host_col: str | None) -> DataFrame:
    """One row per document: a row number, its figures, and keys and word counts of its lines (``keys``, ``line_words``)."""
    text_key, host_key = _key_columns(docs, text_col, host_col)
    narrow = docs.select(column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"), text_key.alias("text_key"), host_key.alias("host_key"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                raw, offsets = ragged.flat(part.column("text"))
                found = measure(raw, offsets)
                hosts = part.column("host_key").to_numpy(zero_copy_only=False).view(np.uint64)
                keys = ragged.mix(found["line_hash"] ^ hosts[found["line_text"]]).view(np.int64)
                ends = pa.array(ragged.bounds(_per_text(found["line_text"], part.num_rows)).astype(np.int32))
                figures = [pa.array(found[c]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.arange(number, number + part.num_rows)),
                        part.column("text_key"),
                        part.column("host_key"),
                        *figures,
                        pa.ListArray.from_arrays(ends, pa.array(keys)),
                        pa.ListArray.from_arrays(ends, pa.array(found["line_words"].astype(np.int32))),
                    ],
                    names=["doc_id", *(c.split()[0] for c in _FEATURES.split(", ")), "keys", "line_words"],
                )
                number += part.num_rows

    return narrow.mapInArrow(run, f"doc_id {kind}, {_FEATURES}, keys array<bigint>, line_words array<int>")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)


def boilerplate(found: DataFrame, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """Lines that too many different documents of their host have: key, n (lines that have it, for splitting hot ones).

    Copies of a text are one document, on both sides of the share. A plain count with a map side leaves the few lines that can be over the
    limit; only of those the different texts are counted.
    """
    lines = found.select("host_key", "text_key", F.explode(F.array_distinct("keys")).alias("key"))
    often = lines.groupBy("key").agg(F.count("*").alias("n"), F.first("host_key").alias("host_key")).filter(F.col("n") > line_docs)
    hosts = found.groupBy("host_key").agg(F.count_distinct("text_key").alias("host_docs"))
    often = often.join(hosts, "host_key").filter(F.col("n") > F.col("host_docs") * line_share)
    often = stage(often.select("key", "n", "host_docs"), "lines")
    total = found.count()
    texts = join_groups(lines.select("key", "text_key"), often, ["key"], "n", total, how="inner").select("key", "text_key", "n", "host_docs").distinct()
    counted = texts.groupBy("key").agg(F.count("*").alias("texts"), F.max("n").alias("n"), F.max("host_docs").alias("host_docs"))
    return counted.filter((F.col("texts") > line_docs) & (F.col("texts") > F.col("host_docs") * line_share)).select("key", "n")


def _judged(docs: DataFrame, id_col: str, text_col: str, host_col: str | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    found = stage(features(docs, id_col, text_col, host_col), "quality")
    limits = stage(boilerplate(found), "boilerplate")
    lines = found.filter(~base_failed()).select("row", F.explode(F.arrays_zip("keys", "line_words")).alias("line")).select("row", F.col("line.keys").alias("key"), F.col("line.line_words").alias("words"))
    hits = join_groups(lines, limits, ["key"], "n", found.count(), how="inner")
    cut = hits.groupBy("row").agg(F.sum("words").alias("cut_words"), F.collect_set("key").alias("cut_keys"))
    judged = found.drop("keys", "line_words").join(cut, "row", "left").withColumn("base_failed", base_failed()).withColumn("cut_words", F.coalesce("cut_words", F.lit(0)))
    return found, limits, judged.withColumn("kept", ~F.col("base_failed") & (F.col("cut_words") * 100 <= F.col("n_words") * DEPLETED_PERCENT))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, cut_words.

    ``base_failed``: fewer than 50 words, or more than half of them in 3-word windows that come twice. ``kept``: not that, and not depleted:
    at most 70 % of its words stand in lines that more than 10 different documents, and 1 % of all, of its host share.
    Lines are compared by a 64-bit hash of their words. One task never holds a line's or a host's documents together: counts have a
    map side, joins treat hot lines apart.

    NULL and empty text: no words, so failed. NULL host: a host of its own, with the empty name. Very long text: whole, alone in its slice. Repeated
    rows: a result each; they count as one document of the line count. Empty table: no rows. Other columns are not read.
    """
    _, _, judged = _judged(docs, id_col, text_col, host_col)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("cut_words").cast("long").alias("cut_words"))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str | None = "source") -> DataFrame:
    """``docs`` without the rejected ones, and without the boilerplate lines in those that stay; same columns.

    A column ``n_chars`` follows the text where it changed. Edge cases as in :func:`judge`; rows with equal doc_id and text are judged alike
    within a host, and all kept or all dropped.
    """
    _, _, judged = _judged(docs, id_col, text_col, host_col)
    stays = judged.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_text"), F.col("host_key").alias("_host"), F.coalesce("cut_keys", F.array().cast("array<bigint>")).alias("_cut"))
    stays = stays.dropDuplicates(["_id", "_text", "_host"])
    id_name, text_name, host_name, cut = (fresh(docs, c) for c in ("_doc_id", "_text_key", "_host_key", "_cut_keys"))
    kind, names = docs.schema, list(docs.columns)
    text_key, host_key = _key_columns(docs, text_col, host_col)
    keyed = docs.withColumns({text_name: text_key, host_name: host_key})
    joined = keyed.join(stays, column(keyed, id_col).eqNullSafe(F.col("_id")) & (F.col(text_name) == F.col("_text")) & (F.col(host_name) == F.col("_host")))
    joined = joined.select(*(column(joined, c) for c in docs.columns), F.col(host_name), F.col("_cut").alias(cut))
    untouched = joined.filter(F.size(cut) == 0).drop(host_name, cut)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, text_col):
                raw, offsets = ragged.flat(part.column(text_col))
                out = []
                hosts = part.column(host_name).to_numpy(zero_copy_only=False).view(np.uint64)
                for k, keys in enumerate(part.column(cut).to_pylist()):
                    one = raw[offsets[k] : offsets[k + 1]]
                    found = measure(one, np.array([0, len(one)]))
                    bad = np.isin(ragged.mix(found["line_hash"] ^ hosts[k]).view(np.int64), keys)
                    texts = one.tobytes().split(b"\n")
                    with_word = [j for j, line in enumerate(texts) if line.strip(b" \t\n\v\f\r")]
                    gone = {j for j, b in zip(with_word, bad, strict=True) if b}
                    out.append(b"\n".join(line for j, line in enumerate(texts) if j not in gone).decode())
                columns = [pa.array(out, pa.string()) if name == text_col else part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    stripped = joined.filter(F.size(cut) > 0).mapInArrow(strip, kind)
    if "n_chars" in docs.columns:
        stripped = stripped.withColumn("n_chars", F.length(column(stripped, text_col)).cast(docs.schema["n_chars"].dataType))
    return untouched.unionByName(stripped)
