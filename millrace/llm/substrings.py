"""Removal of repeated 100-byte strings: hash-compared suffix sorting, dealt over the cluster by content.

Sorting all suffixes of a corpus in one array does not spread over machines. Here every 100-byte window belongs to an anchor, the place in
it whose 32-byte hash is smallest. Equal windows have equal anchors at the same place, so the windows of equal anchors are sorted together
and apart from all others. Anchors that come once never travel further than their hash.

The rounds, all keyed by blocks of documents or by buckets of anchors, each of bounded size:

1. every block sends its anchors' hashes, each once, to buckets; those that come again are sent back;
2. every block sends the text around those anchors, each different one once, to buckets, where the suffixes are sorted and all but the
   earliest of equal windows go back as ranges to remove;
3. every block adds what repeats within it, and cuts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import ragged
from millrace.llm.common import column

#: Length of the strings, and of the pieces whose hashes pick the anchors.
LENGTH = 100
PIECE = 32
#: Text of a block, and text of which a bucket gets the repeated parts, about.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
#: An anchor with more surroundings than this is split into runs of HOT_RUN windows, keyed by what all windows of a run have in common.
HOT_CONTEXTS = 2_000
HOT_RUN = 8

_POSITION_BITS = 30
_WINDOWS_AT_ONCE = 200_000


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int = LENGTH, piece: int = PIECE) -> dict[str, np.ndarray]:
    """The anchors of each text: hash, row, first window ``low``, last window ``high``, place ``at``, and hash of all bytes of the windows."""
    n, span = len(raw), length - piece + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return {"hash": np.zeros(0, np.uint64), "row": empty, "low": empty, "high": empty, "at": empty, "around": np.zeros(0, np.uint64)}
    prefix = ragged.prefix_hashes(raw)
    place = np.arange(n - piece + 1)
    grams = ragged.range_hashes(prefix, place, place + piece)
    least = (grams >> np.uint64(_POSITION_BITS) << np.uint64(_POSITION_BITS)) | place.astype(np.uint64)
    width = 1
    while width * 2 <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    start = np.arange(len(least))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(start)]
    fits = start + length <= offsets[1:][row]
    start, row = start[fits], row[fits]
    at = (least[fits] & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    new = np.append(True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]))[: len(at)]
    first = np.flatnonzero(new)
    low, high = start[first], start[np.append(first[1:], len(start)) - 1] if len(first) else empty
    at, row = at[first], row[first]
    return {"hash": grams[at], "row": row, "low": low, "high": high, "at": at, "around": ragged.range_hashes(prefix, low, high + length)}


class SuffixSorter:
    """Mergesort of suffixes, compared by binary search for their common extension over prefix hashes."""

    def __init__(self, raw: np.ndarray):
        self.raw, self.prefix = raw, ragged.prefix_hashes(raw)
        self.power = ragged.powers(len(raw) + 1)

    def _same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[a + length] - self.prefix[a]) * self.power[b] == (self.prefix[b + length] - self.prefix[b]) * self.power[a]

    def extension(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``, at most ``limit``."""
        low, high = np.zeros(len(a), np.int64), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._same(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Negative, 0 or positive as the first ``limit`` bytes at ``a`` sort before, with or after those at ``b``."""
        common = self.extension(a, b, limit)
        inside = common < limit
        step = np.where(inside, common, 0)
        return np.where(inside, self.raw[a + step].astype(np.int16) - self.raw[b + step], 0)

    def sort(self, start: np.ndarray, limit: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sort each group of suffixes; returns the order, and which stand behind an equal one of their group.

        Groups lie on end, ``sizes`` long each; all of a group have one ``limit``. Equal suffixes keep their order. All groups are merged at once, level by level; an
        element finds its place by binary search in the run that its own is merged with. Suffixes that the hashes call equal are then compared byte by byte, and
        a group with a collision is sorted anew by its bytes.
        """
        n = len(start)
        order = np.arange(n)
        base = np.repeat(ragged.bounds(sizes)[:-1], sizes)
        size = np.repeat(sizes, sizes)
        width = 1
        while n and width < int(sizes.max()):
            act = np.flatnonzero(size > width)
            inside = act - base[act]
            run = inside // width
            right = run % 2 == 1
            other = (run + np.where(right, -1, 1)) * width
            begin = base[act] + np.minimum(other, size[act])
            end = base[act] + np.minimum(other + width, size[act])
            low, high = begin.copy(), end.copy()
            mine, cap = start[order[act]], limit[order[act]]
            while True:
                go = np.flatnonzero(low < high)
                if not len(go):
                    break
                middle = (low[go] + high[go]) >> 1
                sign = self.compare(start[order[middle]], mine[go], cap[go])
                before = np.where(right[go], sign <= 0, sign < 0)
                low[go] = np.where(before, middle + 1, low[go])
                high[go] = np.where(before, high[go], middle)
            place = base[act] + np.where(right, run - 1, run) * width + inside % width + (low - begin)
            merged = order.copy()
            merged[place] = order[act]
            order = merged
            width *= 2

        group = np.repeat(np.arange(len(sizes)), sizes)
        equal = np.zeros(n, bool)
        if n > 1:
            a, b, cap = start[order[:-1]], start[order[1:]], limit[order[1:]]
            pair = np.flatnonzero(group[1:] == group[:-1])
            pair = pair[self._same(a[pair], b[pair], cap[pair])]
            true = self._equal_bytes(a[pair], b[pair], cap[pair])
            equal[pair[true] + 1] = True
            for g in np.unique(group[pair[~true]]):
                self._by_bytes(int(ragged.bounds(sizes)[g]), int(sizes[g]), start, limit, order, equal)
        return order, equal

    def _equal_bytes(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        out = np.ones(len(a), bool)
        for k in range(0, len(a), 1 << 14):
            part = slice(k, k + (1 << 14))
            size = length[part]
            differs = self.raw[ragged.ragged_index(a[part], size)] != self.raw[ragged.ragged_index(b[part], size)]
            out[part] = np.add.reduceat(differs, ragged.bounds(size)[:-1], dtype=np.int64) == 0
        return out

    def _by_bytes(self, first: int, size: int, start: np.ndarray, limit: np.ndarray, order: np.ndarray, equal: np.ndarray) -> None:
        text = {k: self.raw[start[k] : start[k] + limit[k]].tobytes() for k in range(first, first + size)}
        ranked = sorted(text, key=lambda k: (text[k], k))
        order[first : first + size] = ranked
        equal[first] = False
        equal[first + 1 : first + size] = [text[x] == text[y] for x, y in zip(ranked[1:], ranked, strict=False)]


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order by key, and the sizes of the groups."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1])[: len(key)])
    return order, np.diff(np.append(first, len(key)))


def repeated_ranges(raw: np.ndarray, key: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray, rank: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, begin, end) of the ranges of each context whose windows also start earlier, in another one.

    A context is the bytes ``start … start + size`` of ``raw`` with the windows of one anchor, which is ``anchor`` bytes into it; contexts of one ``key`` have equal anchors. ``rank``
    says which comes earlier.
    """
    by_rank = np.argsort(rank, kind="stable")
    key, start, size, anchor = key[by_rank], start[by_rank], size[by_rank], anchor[by_rank]
    sorter = SuffixSorter(raw)

    whole = ragged.mix(key + ragged.mix((anchor.astype(np.uint64) << np.uint64(32)) + size.astype(np.uint64)))
    order, sizes = _groups(whole)
    ranked, equal = sorter.sort(start[order], size[order], sizes)
    ranked = order[ranked]
    again = np.zeros(len(key), bool)
    again[ranked[equal]] = True
    out = [(np.flatnonzero(again), np.zeros(int(again.sum()), np.int64), size[again])]

    left = np.flatnonzero(~again)
    by_key, sizes = _groups(key[left])
    left = left[by_key][np.repeat(sizes, sizes) > 1]
    windows = size[left] - length + 1
    cuts = np.searchsorted(np.cumsum(windows), np.arange(1, int(windows.sum()) // _WINDOWS_AT_ONCE + 1) * _WINDOWS_AT_ONCE)
    keys = key[left]
    cuts = [0, *sorted({int(np.searchsorted(keys, keys[c], side="right")) for c in cuts if c < len(left)}), len(left)]
    for begin, end in zip(cuts, cuts[1:], strict=False):
        some, many = left[begin:end], windows[begin:end]
        if not len(some):
            continue
        context = np.repeat(some, many)
        offset = ragged.ragged_index(np.zeros(len(some), np.int64), many)
        group = ragged.mix(key[context] + ragged.mix((anchor[context] - offset + (1 << 20)).astype(np.uint64)))
        order, sizes = _groups(group)
        keep = np.repeat(sizes, sizes) > 1
        order, sizes = order[keep], sizes[sizes > 1]
        if not len(order):
            continue
        # Within a group the contexts still stand by rank: ``left`` is sorted by key, stably.
        ranked, equal = sorter.sort(start[context[order]] + offset[order], np.full(len(order), length), sizes)
        hit = order[ranked[equal]]
        out.append((context[hit], offset[hit], offset[hit] + length))
    context, begin, end = (np.concatenate(x) for x in zip(*out, strict=True))
    return by_rank[context], begin, end


def _block_rows(table: pa.Table) -> tuple[pa.Table, Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """A block's rows by doc_id (NULL first) and text, and slices of them: first row, bytes, offsets."""
    table = table.sort_by([("no_id", "descending"), ("doc_id", "ascending"), ("text", "ascending")])

    def parts() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        row = 0
        batch = pa.RecordBatch.from_arrays([table.column("text").combine_chunks().cast(pa.large_string())], names=["text"]) if table.num_rows else None
        for part in ragged.slices(batch, "text") if batch is not None else ():
            yield row, *ragged.flat(part.column("text"))
            row += part.num_rows

    return table, parts()


def _block_anchors(table: pa.Table, length: int) -> tuple[pa.Table, dict[str, np.ndarray]]:
    """Anchors of a block; positions count from the start of their text, ``again`` marks surroundings that the block has earlier."""
    table, parts = _block_rows(table)
    found = []
    for first, raw, offsets in parts:
        part = anchors(raw, offsets, length)
        for name in ("low", "high", "at"):
            part[name] = part[name] - offsets[part["row"]]
        part["row"] = part["row"] + first
        found.append(part)
    names = ["hash", "row", "low", "high", "at", "around"]
    kinds = [np.uint64, np.int64, np.int64, np.int64, np.int64, np.uint64]
    out = {name: np.concatenate([p[name] for p in found]) if found else np.zeros(0, kind) for name, kind in zip(names, kinds, strict=True)}
    same = ragged.mix(out["hash"] + ragged.mix(out["around"] + (out["at"] - out["low"]).astype(np.uint64)))
    order, sizes = _groups(same)
    out["again"] = np.zeros(len(same), bool)
    first = np.repeat(order[ragged.bounds(sizes)[:-1]], sizes)
    like = first != order
    later, earlier = order[like], first[like]
    like = (out["high"] - out["low"])[later] == (out["high"] - out["low"])[earlier]
    later, earlier = later[like], earlier[like]
    if len(later):
        # Equal hashes are only a reason to compare the bytes.
        raw, offsets = ragged.flat(table.column("text"))
        place = offsets[out["row"]] + out["low"]
        out["again"][later] = ragged.equal_ranges(raw, place[later], raw, place[earlier], (out["high"] - out["low"])[later])
    return table, out


def _blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def _joined(column_: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column_.to_pylist()), kind)


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order, sizes = _groups(bucket)
    edges = ragged.bounds(sizes)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and on demand ``kept``, the bytes that stay.

    A byte goes if it is covered by a string of ``length`` bytes that starts earlier too: in a document with a smaller doc_id, or before in the same one, overlapping
    or not. Strings are judged on the input; they do not cross documents. Ids are whole numbers.

    A block is a hash class of doc_ids of about ``BLOCK_BYTES``, a bucket a hash class of anchors. What a block has several times it sends once, so a passage that all documents
    share weighs one entry per block; an anchor with very many different surroundings is split by them. Documents shuffle once: the three
    rounds read the same exchange.

    NULL and short text: nothing removed. NULL doc_id: before all others. Rows with equal doc_ids: in order of their texts, as documents of
    their own; of repeated rows the first stays. Very long text: whole, in a slice of its own, at about 60 times its size in memory. Empty table: no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(column(docs, id_col).cast("long").alias("doc_id"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks, buckets = max(1, total // BLOCK_BYTES), max(1, total // BUCKET_BYTES)
    narrow = narrow.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", F.col("doc_id").isNull().cast("int").alias("no_id"), "text")
    by_block = narrow.groupBy("block")

    def send_hashes(key: tuple, table: pa.Table) -> pa.Table:
        _, found = _block_anchors(table, length)
        once = found["hash"][~found["again"]]
        hashes, times = np.unique(once, return_counts=True)
        rows = [(b, _blob(hashes[at]), _blob(np.minimum(times[at], 65535).astype(np.uint16))) for b, at in _split((hashes % np.uint64(buckets)).astype(np.int64))]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int64()), "block": pa.array([key[0].as_py()] * len(rows), pa.int64()), "hashes": pa.array([r[1] for r in rows], pa.binary()), "times": pa.array([r[2] for r in rows], pa.binary())})

    def answer(table: pa.Table) -> pa.Table:
        hashes, times = _joined(table.column("hashes"), np.uint64), _joined(table.column("times"), np.uint16).astype(np.int64)
        sizes = np.array([len(x) // 8 for x in table.column("hashes").to_pylist()], np.int64)
        sender = np.repeat(table.column("block").to_numpy(), sizes)
        known, which = np.unique(hashes, return_inverse=True)
        sums = np.bincount(which, weights=times, minlength=len(known))[which]
        asked = np.flatnonzero(sums > 1)
        hot = sums[asked] > HOT_CONTEXTS
        rows = [(b, _blob(hashes[asked[at]]), _blob(hot[at])) for b, at in _split(sender[asked])]
        return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "hashes": pa.array([r[1] for r in rows], pa.binary()), "hot": pa.array([r[2] for r in rows], pa.binary())})

    def send_contexts(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        table, found = _block_anchors(table, length)
        asked, hot = _joined(answers.column("hashes"), np.uint64), _joined(answers.column("hot"), bool)
        order = np.argsort(asked)
        asked, hot = asked[order], hot[order]
        if len(asked):
            at = np.minimum(np.searchsorted(asked, found["hash"]), len(asked) - 1)
            wanted = ~found["again"] & (asked[at] == found["hash"])
            pick, hot = np.flatnonzero(wanted), hot[at[wanted]]
        else:
            pick, hot = np.zeros(0, np.int64), np.zeros(0, bool)
        row, low, high, place, name = (found[c][pick] for c in ("row", "low", "high", "at", "hash"))
        # A hot anchor's windows go in runs whose offset from the anchor is the same everywhere.
        back = place - low
        runs = np.where(hot, back // HOT_RUN - (place - high) // HOT_RUN + 1, 1)
        of = np.repeat(np.arange(len(pick)), runs)
        step = ragged.ragged_index(np.zeros(len(runs), np.int64), runs)
        run = back[of] // HOT_RUN - step
        from_ = np.where(hot[of], np.maximum(low[of], place[of] - run * HOT_RUN - HOT_RUN + 1), low[of])
        to = np.where(hot[of], np.minimum(high[of], place[of] - run * HOT_RUN), high[of])
        texts = table.column("text").combine_chunks().cast(pa.large_string())
        raw, offsets = ragged.flat(texts)
        begin = offsets[row[of]] + from_
        size = to - from_ + length
        own = name[of].copy()
        split = np.flatnonzero(hot[of])
        if len(split):
            # The bytes that all windows of the run have, also those that this context lacks at its ends.
            anchor_at = offsets[row[of[split]]] + place[of[split]]
            core_low = anchor_at - run[split] * HOT_RUN
            core_high = core_low - HOT_RUN + 1 + length
            own[split] = ragged.mix(own[split] + ragged.spread_hashes(raw, core_low, core_high - core_low) + run[split].astype(np.uint64))
        ids = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
        rows = []
        for b, some in _split((own % np.uint64(buckets)).astype(np.int64)):
            rows.append((b, *(_blob(x) for x in (own[some], ids[row[of[some]]], row[of[some]].astype(np.int32), from_[some].astype(np.int64), size[some].astype(np.int32), (place[of[some]] - from_[some]).astype(np.int32), raw[ragged.ragged_index(begin[some], size[some])]))))
        columns = ["bucket", "keys", "ids", "rows", "starts", "sizes", "anchors", "bytes"]
        return pa.table({"block": pa.array([key[0].as_py()] * len(rows), pa.int64()), **{c: pa.array([r[k] for r in rows], pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(columns)}})

    def find_repeats(table: pa.Table) -> pa.Table:
        sizes_of = np.array([len(x) // 4 for x in table.column("sizes").to_pylist()], np.int64)
        sender = np.repeat(table.column("block").to_numpy(), sizes_of)
        keys, ids, rows, starts = (_joined(table.column(c), k) for c, k in (("keys", np.uint64), ("ids", np.int64), ("rows", np.int32), ("starts", np.int64)))
        sizes, places = (_joined(table.column(c), np.int32).astype(np.int64) for c in ("sizes", "anchors"))
        raw = _joined(table.column("bytes"), np.uint8)
        rank = np.empty(len(keys), np.int64)
        rank[np.lexsort((starts, rows, ids))] = np.arange(len(keys))
        context, begin, end = repeated_ranges(raw, keys, ragged.bounds(sizes)[:-1], sizes, places, rank, length)
        begin, end = starts[context] + begin, starts[context] + end
        out = [(b, _blob(rows[context[at]]), _blob(begin[at]), _blob(end[at])) for b, at in _split(sender[context])]
        return pa.table({"block": pa.array([r[0] for r in out], pa.int64()), **{c: pa.array([r[k] for r in out], pa.binary()) for k, c in ((1, "rows"), (2, "begins"), (3, "ends"))}})

    def cut(key: tuple, table: pa.Table, ranges: pa.Table) -> pa.Table:
        table, found = _block_anchors(table, length)
        again = found["again"]
        row = np.concatenate([_joined(ranges.column("rows"), np.int32).astype(np.int64), found["row"][again]])
        begin = np.concatenate([_joined(ranges.column("begins"), np.int64), found["low"][again]])
        end = np.concatenate([_joined(ranges.column("ends"), np.int64), found["high"][again] + length])
        order = np.argsort(row, kind="stable")
        row, begin, end = row[order], begin[order], end[order]
        table, parts = _block_rows(table)
        removed, spans, shas, kept = [], [], [], []
        for first, raw, offsets in parts:
            n = len(offsets) - 1
            mine = slice(*np.searchsorted(row, [first, first + n]))
            shift = offsets[row[mine] - first]
            cover = np.bincount(begin[mine] + shift, minlength=len(raw) + 1) - np.bincount(end[mine] + shift, minlength=len(raw) + 1)
            gone = np.cumsum(cover)[: len(raw)] > 0
            count = ragged.bounds(gone)
            head = gone.copy()
            head[1:] &= ~gone[:-1]
            edge = offsets[:-1][offsets[:-1] < len(raw)]
            head[edge] = gone[edge]
            heads = ragged.bounds(head)
            stays = raw[~gone].tobytes()
            place = offsets - count[offsets]
            removed.append(count[offsets[1:]] - count[offsets[:-1]])
            spans.append(heads[offsets[1:]] - heads[offsets[:-1]])
            pieces = [stays[a:b] for a, b in zip(place[:-1].tolist(), place[1:].tolist(), strict=True)]
            shas += [hashlib.sha256(x).hexdigest() for x in pieces]
            kept += pieces if with_text else []
        sizes = np.diff(ragged.flat(table.column("text"))[1])
        both = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        out = {"doc_id": table.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": both(removed), "n_spans": both(spans), "kept_sha256": pa.array(shas, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    hashes = by_block.applyInArrow(send_hashes, "bucket bigint, block bigint, hashes binary, times binary")
    answers = hashes.groupBy("bucket").applyInArrow(answer, "block bigint, hashes binary, hot binary")
    contexts = by_block.cogroup(answers.groupBy("block")).applyInArrow(send_contexts, "block bigint, bucket bigint, keys binary, ids binary, rows binary, starts binary, sizes binary, anchors binary, bytes binary")
    ranges = contexts.groupBy("bucket").applyInArrow(find_repeats, "block bigint, rows binary, begins binary, ends binary")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_text else "")
    out = by_block.cogroup(ranges.groupBy("block")).applyInArrow(cut, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
