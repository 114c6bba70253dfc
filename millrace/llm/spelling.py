"""Words grouped by spelling: words one edit apart, and for each rare word the frequent one it stands for.

Letters are hashed to a few symbols, so that many words share a reduced word and a reduced word has few neighbours. The full one-edit neighbourhood
of each reduced word (itself, replacements, insertions, deletions) is joined with the reduced vocabulary; what meets is
compared in the original spelling. How many symbols are enough is measured per word length: too few would let too many
words meet, and with as many symbols as letters only true neighbours do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import column, fresh
from millrace.session import stage

# Fixed values of the query's contract.
RUN = "[A-Za-zÀ-ÿ]+"
CHANGED, LEAST_LETTERS, LEAST_COUNT, TIMES = 97, 5, 3, 2

LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Numbers of symbols to choose from; the last is the identity.
SYMBOLS = (2, 3, 4, 6, 8, 12, 16, 32, len(LETTERS))
#: Words of this length and longer share their choice.
LONGEST = 24
#: Words that share a reduced word, seen from a word of it, on average: the fewest symbols with no more than this are taken.
SHARED = 8
#: Neighbours that are held at a time.
AT_ONCE = 1 << 20

_RANDOM = np.random.default_rng(20)
_BASE = int(_RANDOM.integers(1 << 62, dtype=np.uint64)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)
_VALUES = _RANDOM.integers(1 << 63, size=len(LETTERS), dtype=np.uint64)
#: Code point → letter number; others (words given by a caller) go by their code point.
_NUMBER = {c: i for i, c in enumerate(LETTERS)}
_TABLE = np.array([_NUMBER.get(c, c % len(LETTERS)) for c in range(0x100)], np.uint64)


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word): every run of letters of every text, A-Z lower-cased, with one letter left out where the CRC-32 of ``<doc_id>:<run>`` says so."""
    low = F.translate(F.coalesce(column(docs, text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(F.coalesce(column(docs, id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    # Leaving a letter out only makes a run shorter.
    runs = runs.filter(F.char_length("run") >= LEAST_LETTERS).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % CHANGED == 0, shorter).otherwise(F.col("run")).alias("word")).filter(F.char_length("word") >= LEAST_LETTERS)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``least`` occurrences; counted with a map side."""
    return occurrences(docs, id_col, text_col).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _symbols(codes: np.ndarray, count: int) -> np.ndarray:
    """Letter numbers → symbols; with as many symbols as letters every letter keeps its own."""
    numbers = np.where(codes < 0x100, _TABLE[np.minimum(codes, 0xFF)], codes % len(LETTERS)).astype(np.uint64)
    return numbers if count >= len(LETTERS) else (numbers * np.uint64(0x9E3779B1) >> np.uint64(7)) % np.uint64(count)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _seed(space: int, length: int) -> np.uint64:
    """Keeps keys of other lengths, and of the same length under other symbols, apart."""
    return np.uint64((space * 0x9E3779B97F4A7C15 ^ length * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)


def keys(symbols: np.ndarray, space: int) -> np.ndarray:
    """A number for each row of a matrix of symbols: sum of value × base^place, modulo 2^64. Equal numbers are candidates, nothing more."""
    rows, length = symbols.shape
    return (_VALUES[symbols] * _powers(length)).sum(axis=1, dtype=np.uint64) + _seed(space, length)


def neighbours(symbols: np.ndarray, space: int, count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of all different words one edit or none away, in pieces of about ``AT_ONCE``.

    A space ``s`` is the symbols chosen for words of length ``s``, and holds words of length ``s`` and ``s + 1``. So a word of length ``s`` has its
    replacements and insertions there, and one of length ``s + 1`` its deletions.
    """
    rows, length = symbols.shape
    if not rows:
        return
    step = max(1, AT_ONCE // max(1, length * (2 * count + 1)))
    if rows > step:
        for at in range(0, rows, step):
            for row, key in neighbours(symbols[at:at + step], space, count):
                yield row + at, key
        return
    power, values = _powers(length + 1), _VALUES[symbols]
    terms = values * power[:length]
    whole = terms.sum(axis=1, dtype=np.uint64)
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(terms, axis=1, out=before[:, 1:])
    if length == space + 1:
        # Leaving out one of several equal symbols in a row gives the same word: only the last of them.
        differs = np.ones((rows, length), bool)
        differs[:, :-1] = symbols[:, :-1] != symbols[:, 1:]
        row, place = np.nonzero(differs)
        yield row, before[row, place] + (whole[row] - before[row, place + 1]) * np.uint64(_BACK) + _seed(space, length - 1)
        return
    yield np.arange(rows), whole + _seed(space, length)
    for symbol in range(count):
        value = _VALUES[symbol]
        row, place = np.nonzero(symbols != symbol)
        yield row, whole[row] + (value - values[row, place]) * power[place] + _seed(space, length)
        # Before an equal symbol is the same as behind it: only where another one follows, or none.
        fits = np.ones((rows, length + 1), bool)
        fits[:, :-1] = symbols != symbol
        row, place = np.nonzero(fits)
        yield row, before[row, place] + value * power[place] + (whole[row] - before[row, place]) * np.uint64(_BASE) + _seed(space, length + 1)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, indices, matrix of code points) for the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(sizes):
        where = np.nonzero(sizes == length)[0]
        # A fixed-width array would lose NULs at a word's end, so code points are taken from the encoded text.
        codes = np.frombuffer("".join(words[i] for i in where).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        yield int(length), where, codes.reshape(len(where), length)


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(keys).view(np.int64))


def choose_symbols(words: DataFrame) -> dict[int, int]:
    """For each word length (from ``LONGEST`` on for all) the fewest symbols with which few words share a reduced word. One row per length and choice comes back."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, codes in _by_length(batch.column(0).to_pylist()):
                for count in SYMBOLS[:-1] or SYMBOLS:
                    key = keys(_symbols(codes, count), length)
                    space, choice = (np.full(len(key), v, np.int32) for v in (min(length, LONGEST), count))
                    yield pa.RecordBatch.from_arrays([pa.array(space), pa.array(choice), _signed(key)], ["space", "symbols", "key"])

    shared = words.select("word").mapInArrow(reduced, "space int, symbols int, key long").groupBy("space", "symbols", "key").agg(F.count("*").cast("double").alias("n"))
    measured = shared.groupBy("space", "symbols").agg((F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("meet")).collect()
    fits: dict[int, int] = {}
    for row in measured:
        best = row.symbols if row.meet <= SHARED else SYMBOLS[-1]
        fits[row.space] = min(fits.get(row.space, SYMBOLS[-1]), best)
    return fits


def members(words: DataFrame, chosen: dict[int, int]) -> DataFrame:
    """(key, space, reduced, word, n): each word under its own length's symbols and under those of the next shorter length."""

    def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(1).to_numpy()
            for length, where, codes in _by_length(batch.column(0).to_pylist()):
                for space in (length, length - 1):
                    if min(space, LONGEST) not in chosen:
                        continue
                    symbols = _symbols(codes, chosen[min(space, LONGEST)])
                    flat = np.ascontiguousarray(symbols.astype(np.uint8))
                    offsets = pa.py_buffer(np.arange(0, flat.size + 1, length, dtype=np.int32).tobytes())
                    reduced = pa.Array.from_buffers(pa.binary(), len(where), [None, offsets, pa.py_buffer(flat.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [_signed(keys(symbols, space)), pa.array(np.full(len(where), space, np.int32)), reduced, batch.column(0).take(pa.array(where)), pa.array(counts[where])],
                        ["key", "space", "reduced", "word", "n"])

    return words.select("word", "n").mapInArrow(spaces, "key long, space int, reduced binary, word string, n long")


def _meetings(reduced: DataFrame, chosen: dict[int, int]) -> DataFrame:
    """(key, near_key): the neighbourhood of every reduced word."""

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, space, words = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            for kind in np.unique(np.stack([space, sizes], 1), axis=0):
                where = np.nonzero((space == kind[0]) & (sizes == kind[1]))[0]
                symbols = np.frombuffer(b"".join(words[i] for i in where), np.uint8).reshape(len(where), kind[1])
                for row, key in neighbours(symbols, int(kind[0]), chosen[min(int(kind[0]), LONGEST)]):
                    yield pa.RecordBatch.from_arrays([pa.array(own[where[row]]), _signed(key)], ["key", "near_key"])

    return reduced.select("key", "space", "reduced").mapInArrow(around, "key long, near_key long")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) exactly one edit apart, both ways round.

    Words are one row each, not NULL and not empty. A pair is found whatever the symbols are, they only decide how many others are looked at.
    """
    words = stage(words.select("word", "n"), "spelling-words")
    chosen = choose_symbols(words)
    rows = stage(members(words, chosen), "spelling-members")
    there = rows.select("key").distinct().withColumnRenamed("key", "near_key")
    # A reduced word meets others by the key only, so two that share one by chance are both asked for.
    meet = _meetings(rows.select("key", "space", "reduced").distinct(), chosen).join(there, "near_key").distinct()
    one = rows.select("key", "word", "n").join(meet, "key").drop("key")
    other = rows.select(F.col("key").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return one.join(other, "near_key").filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n")


def follow(forms: DataFrame, word: str = "word", form: str = "form") -> DataFrame:
    """``forms`` with ``root``: the last word when each goes on to its form. Pointers double their reach a round, so chains may be long; they must have an end."""
    root = fresh(forms, "root")
    going = stage(forms.select(column(forms, word).alias("_from"), column(forms, form).alias("_to")).filter("_to is not null"), "spelling-links")
    done = going.limit(0)
    while not going.isEmpty():
        # A link that leads to a last word is done: it takes no further part, but others may end through it.
        ahead = going.withColumn("_done", F.lit(False)).unionByName(done.withColumn("_done", F.lit(True))).select(F.col("_from").alias("_to"), F.col("_to").alias("_next"), "_done")
        onward = going.join(ahead, "_to", "left").select("_from", F.coalesce("_next", "_to").alias("_to"), F.coalesce("_done", F.lit(True)).alias("_done"))
        onward = stage(onward, "spelling-links")
        done = done.unionByName(onward.filter("_done").drop("_done"))
        going = onward.filter("not _done").drop("_done")
    found = forms.join(done.select(F.col("_from").alias("_w"), F.col("_to").alias("_root")), column(forms, word) == F.col("_w"), "left")
    return found.select(*(column(forms, c) for c in forms.columns), F.coalesce("_root", column(forms, word)).alias(root))


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word with the largest count (ties: the first in code-point order) if that is at least ``TIMES`` the word's own. ``root`` is
    where the forms lead. Words without near words are rows too. NULL text: no words. NULL doc_id: as an empty id.
    Repeated rows count each. Empty table: no rows. Other columns are not read.
    """
    words = stage(vocabulary(docs, id_col, text_col), "spelling-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    # Two keys of one pair would count it twice, so pairs are told apart first.
    pairs = near_words(words).groupBy("word", "near").agg(F.first("near_n").alias("near_n"))
    near = pairs.groupBy("word").agg(best.alias("best"), F.count("*").alias("n_near"))
    out = words.join(near, "word", "left")
    taken: Column = -F.col("best.less") >= TIMES * F.col("n")
    out = out.select("word", F.when(taken, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, -F.col("best.less")).alias("form_n"))
    return follow(stage(out, "spelling-forms")).select("word", "form", "root", "n", "n_near", "form_n")
