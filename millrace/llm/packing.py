"""Best-fit packing of tokenised documents into sequences, by bin completion over the histogram of lengths.

Which document of a given length goes where makes no difference, so the search sees only how many pieces there are of
each length: at most ``capacity`` numbers, whatever the size of the corpus. The pieces then take the places
by their rank within their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm import bpe, ragged
from millrace.llm.common import id_and_text
from millrace.session import stage

#: Pieces of a bucket, about; a length that many pieces share is numbered bucket by bucket.
RANK_ROWS = 5_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut documents into pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids (little-endian unsigned 32-bit).

    A document is the ids of its text and ``end_id``. Only the first piece may be shorter than ``capacity``.
    NULL text: empty, so ``end_id`` alone.
    """
    narrow = id_and_text(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.load(tokenizer)
        for batch in batches:
            for part in ragged.slices(batch, "text"):
                raw, offsets = ragged.flat(part.column("text"))
                ids, sizes = model.encode(raw, offsets)
                ids = np.insert(ids, ragged.bounds(sizes)[1:], end_id).astype("<u4")
                sizes = sizes + 1
                pieces = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), pieces)
                number = ragged.ragged_index(np.zeros(len(pieces), np.int64), pieces)
                first = sizes - (pieces - 1) * capacity
                start = np.where(number == 0, 0, first[doc] + (number - 1) * capacity)
                length = np.where(number == 0, first[doc], capacity)
                ends = ragged.bounds(length * 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array(doc)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.BinaryArray.from_buffers(pa.binary(), len(length), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    return narrow.mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best fit, largest lengths first: (lengths of a bin, how many such bins). Equal bins are filled together.

    The fullest bin that has room for a length takes it; with the length in it that bin is fuller still, so it takes all that fit.
    """
    bins: dict[int, list[tuple[list[int], int]]] = {}
    for length in sorted(counts, reverse=True):
        count = counts[length]
        for room in sorted(r for r in bins if r >= length):
            each = room // length
            waiting = bins.pop(room)
            while waiting and count:
                content, times = waiting.pop()
                full, rest = divmod(count, each)
                taken = min(times, full)
                for n, k in ((taken, each), (1 if taken < times and rest else 0, rest)):
                    if n:
                        bins.setdefault(room - k * length, []).append(([*content, *[length] * k], n))
                        count -= n * k
                        times -= n
                if times:
                    waiting.append((content, times))
            if waiting:
                bins.setdefault(room, []).extend(waiting)
            if not count:
                break
        each = capacity // length
        for n, k in ((count // each, each), (1 if count % each else 0, count % each)):
            if n:
                bins.setdefault(capacity - k * length, []).append(([length] * k, n))
    return [one for same in bins.values() for one in same]


def bins_needed(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: bins that large items need for themselves, and what does not fit into the space beside them.

    For each limit up to half the capacity: items larger than ``capacity - limit`` share a bin with nothing of at least ``limit``; those above half the
    capacity are alone of their kind in a bin; the rest down to ``limit`` must fill the space that is left there, or more bins.
    """
    many = np.zeros(capacity + 1, np.int64)
    many[list(counts)] = list(counts.values())
    number, volume = np.cumsum(many), np.cumsum(many * np.arange(capacity + 1))
    half = capacity // 2
    limit = np.arange(half + 1)
    alone = number[-1] - number[capacity - limit]
    large, large_volume = number[capacity - limit] - number[half], volume[capacity - limit] - volume[half]
    small = volume[half] - np.where(limit > 0, volume[np.maximum(limit - 1, 0)], 0)
    over = small - (large * capacity - large_volume)
    return int((alone + large + np.maximum(0, -(-over // capacity))).max())


def fillings(left: dict[int, int], largest: int, capacity: int) -> Iterator[list[tuple[int, int]]]:
    """The undominated contents of a bin with ``largest`` in it, one by one and fullest first: (length, how many), largest first.

    Which sums can be made of the items from a size downwards is a bit set, so no step of the enumeration is in vain. A filling is dominated if
    one of its items, or nothing, can be exchanged for a left-over item that is larger and still fits: those are passed over, as None.
    """
    room = capacity - largest
    sizes = sorted((n for n in left if n <= room), reverse=True)
    spare = [min(left[n] - (n == largest), room // n) for n in sizes]
    mask = (1 << room + 1) - 1
    sums = [1] * (len(sizes) + 1)
    for k in range(len(sizes) - 1, -1, -1):
        reach, rest, step = sums[k + 1], spare[k], 1
        while rest > 0:
            take = min(step, rest)
            reach |= reach << take * sizes[k] & mask
            rest, step = rest - take, step * 2
        sums[k] = reach

    def choices(k: int, need: int) -> Iterator[tuple[int, int, int]]:
        for at in range(k, len(sizes)):
            for n in range(min(spare[at], need // sizes[at]), 0, -1):
                if sums[at + 1] >> need - n * sizes[at] & 1:
                    yield at, n, need - n * sizes[at]
            if not sums[at + 1] >> need & 1:
                return

    for total in range(room, -1, -1):
        if not sums[0] >> total & 1:
            continue
        # One open choice per size in the filling; sizes differ, so there are few.
        chosen, open_choices = [(largest, 1)], [choices(0, total)] if total else []
        if not total:
            yield None if _dominated(chosen, room, left) else list(chosen)
        while open_choices:
            step = next(open_choices[-1], None)
            if step is None:
                open_choices.pop()
                chosen.pop()
                continue
            at, n, rest = step
            chosen.append((sizes[at], n))
            if rest:
                open_choices.append(choices(at + 1, rest))
            else:
                yield None if _dominated(chosen, room - total, left) else list(chosen)
                chosen.pop()


def _dominated(filling: list[tuple[int, int]], space: int, left: dict[int, int]) -> bool:
    """Whether an item beside the first, or nothing, can be exchanged for a larger left-over item that fits into the space as well."""
    used = {}
    for n, k in filling:
        used[n] = used.get(n, 0) + k
    return space > 0 and any(left.get(more, 0) > used.get(more, 0) for n in (0, *(n for n, _ in filling[1:])) for more in range(n + 1, n + space + 1))


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = 5_000) -> list[tuple[list[int], int]]:
    """Fill as few bins as can be found: (lengths of a bin, largest first; how many such bins).

    Branch and bound. Each step takes the largest length left and tries the undominated :func:`fillings` of its bin, fullest first, each for as many
    equal bins as there can be, then half as many, down to one. A branch ends when :func:`bins_needed` says that the rest takes no
    fewer bins than the best solution; :func:`best_fit` gives the first one. ``nodes``, the fillings looked at, bounds the search, not the
    result: every piece always has a place.
    """
    counts = {int(n): int(c) for n, c in counts.items() if c > 0}
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("lengths must lie between 1 and the capacity")
    if not counts:
        return []
    least, best = bins_needed(counts, capacity), best_fit(counts, capacity)
    best_bins = sum(times for _, times in best)

    def moves(left: dict[int, int]) -> Iterator[tuple[dict[int, int], int] | None]:
        for filling in fillings(left, max(left), capacity):
            if filling is None:
                yield None
                continue
            need: dict[int, int] = {}
            for n, k in filling:
                need[n] = need.get(n, 0) + k
            times = min(left[n] // k for n, k in need.items())
            while times:
                yield need, times
                times //= 2

    trail: list[tuple[dict[int, int], list[tuple[dict[int, int], int]], int, Iterator]] = [(counts, [], 0, moves(counts))]
    while trail and best_bins > least and nodes > 0:
        left, bins, used, options = trail[-1]
        move = next(options, ())
        if move == ():
            trail.pop()
            continue
        nodes -= 1
        if move is None:
            continue
        need, times = move
        after = {n: c - times * need.get(n, 0) for n, c in left.items()}
        after = {n: c for n, c in after.items() if c}
        filled = [*bins, move]
        if not after:
            if used + times < best_bins:
                best_bins = used + times
                best = [([n for n in sorted(of, reverse=True) for _ in range(of[n])], many) for of, many in filled]
        elif used + times + bins_needed(after, capacity) < best_bins:
            trail.append((after, filled, used + times, moves(after)))
    return best


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (doc_id, piece, start, length, …), each at most ``capacity`` long.

    ``pieces`` should be stored (:func:`millrace.session.stage`), as it is read twice. One aggregation gives the histogram of lengths, at most
    ``capacity`` rows, which the driver searches (:func:`complete_bins`). Pieces of one length, which may be a third of all, are dealt over
    buckets by a hash; ranks within a bucket and the sizes of the buckets before it give the rank within the length.
    The table of places has a row per length of each kind of bin, some thousands at most.
    """
    spark = pieces.sparkSession
    per_length = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(per_length.values())
    buckets = max(1, -(-total // RANK_ROWS))
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))

    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n")).select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start")
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - F.lit(1)).join(firsts, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_first"))

    places, given, base = [], dict.fromkeys(per_length, 0), 0
    for lengths, times in complete_bins(per_length, capacity):
        offset = 0
        for n in dict.fromkeys(lengths):
            k = lengths.count(n)
            places.append((int(n), given[n], given[n] + times * k, base, offset, k))
            given[n] += times * k
            offset += n * k
        base += times
    table = spark.createDataFrame(places, "length bigint, _from bigint, _to bigint, _base bigint, _offset bigint, _k bigint")
    placed = ranked.join(F.broadcast(table), "length").filter("_rank >= _from and _rank < _to")
    return placed.select(
        *(F.col(c) for c in pieces.columns),
        F.expr("_base + (_rank - _from) div _k").alias("sequence_id"),
        F.expr("_offset + length * ((_rank - _from) % _k)").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids on demand).

    NULL text: a document of ``end_id`` alone. NULL doc_id: packed like any other. Repeated rows: packed each. Ties: equal
    pieces take their places in any order. Empty table: no rows. Other columns are not read.
    """
    pieces = token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    pieces = stage(pieces if with_ids else pieces.drop("ids"), "pieces")
    return pack(pieces, capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces packed with their ids: sequence_id, ids, doc_ids, offsets. A sequence has at most ``capacity`` pieces."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p.ids, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets")
    )
