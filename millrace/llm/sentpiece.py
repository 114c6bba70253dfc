"""SentencePiece encoding and decoding for BPE models, by a max-plus scan over chunks.

Pieces t1 … tn are the encoding of a text exactly if each two neighbours are the encoding of their own two strings: merges never cross the end of a
final piece, so whether one would do so depends on its two neighbours alone. That makes encoding a best path: a piece may follow another at weight 0 if the
two are compatible, else at minus infinity, and the one path of weight 0 is the encoding.

Best paths over (max, +) can be cut anywhere. The state at a cut is the piece that covers the last character before it. A chunk yields a matrix with a weight for
each state at its beginning and each at its end; the product of matrices is associative, so chunks are worked on apart, their products give the state at
every cut, and each chunk is then traced back by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import ragged
from millrace.llm.bpe import CachedEncoder
from millrace.llm.common import id_and_text
from millrace.session import stage

BLANK = 0x2581
#: Matrices that one task folds into one; more are folded level by level.
FOLD = 64
#: Characters of a chunk that a document is split into over tasks, and of those that one stretch without a break is split into within a task.
CHUNK = 1 << 15
STRIDE = 256
START, NOTHING = -2, -1
_FAR = np.int64(1 << 40)
_SLOT_BITS = 18

State = tuple[int, int, int]


class PieceModel(CachedEncoder):
    """Pieces, scores and byte pieces of a SentencePiece BPE file whose normaliser only turns blanks into U+2581 and puts one in front."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.size = size
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.unknown = model.unk_id()
        by_text = {texts[i]: i for i in normal}
        alone = sorted({c for i in normal for c in texts[i]} - set(by_text))
        self.chars = alone
        by_text |= {c: size + k for k, c in enumerate(alone)}
        many = sorted((i for i in normal if len(texts[i]) > 1), key=lambda i: (-model.get_score(i), i))
        self.rank = np.zeros(size + len(alone), np.int64)
        self.rank[many] = np.arange(1, len(many) + 1)
        self.left = np.full(size + len(alone), NOTHING)
        self.right = self.left.copy()
        self.length = np.zeros(size + len(alone), np.int64)
        for text, i in by_text.items():
            self.length[i] = len(text)
        self.longest = int(self.length.max())
        whole = {t: i for t, i in by_text.items() if len(t) == 1}
        for i in many:
            parts = self._last_merge(texts[i], by_text)
            if parts is not None:
                self.left[i], self.right[i] = parts
                whole[texts[i]] = i
        self.breaks_before_blank = all("▁" not in t.lstrip("▁") for t in whole)
        pairs = {(whole[t[:k]], whole[t[k:]]): self.rank[i] for t, i in whole.items() for k in range(1, len(t)) if t[:k] in whole and t[k:] in whole}
        key = np.array([a << 20 | b for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.pair_keys, self.pair_ranks = key[order], np.array(list(pairs.values()), np.int64)[order]
        self._make_table(whole)
        known = np.zeros(0x110000, bool)
        known[[ord(t) for t in whole if len(t) == 1]] = True
        self.known = known
        # Bytes of each piece for decoding; a blank stands for U+2581.
        shown = [bytes([int(texts[i][3:5], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else " ⁇ ".encode() if model.is_unknown(i) else texts[i].replace("▁", " ").encode() for i in range(size)]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_sizes = np.array([len(x) for x in shown], np.int64)
        self.shown_at = ragged.bounds(self.shown_sizes)[:-1]
        super().__init__(size)

    def _last_merge(self, text: str, by_text: dict[str, int]) -> tuple[int, int] | None:
        """The two pieces whose merge makes ``text`` out of its characters, if they end as one piece."""
        parts, last = list(text), None
        while len(parts) > 1:
            found = [(self.rank[by_text[a + b]], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in by_text]
            if not found:
                return None
            _, k = min(found)
            last = by_text[parts[k]], by_text[parts[k + 1]]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return last

    def _make_table(self, whole: dict[str, int]) -> None:
        """Pieces by hash, in tables of single slots: those that meet in one go on to the next."""
        texts = list(whole)
        points = np.array([ord(c) for t in texts for c in t], np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = ragged.bounds(sizes)
        hashes = ragged.range_hashes(ragged.prefix_hashes(points), ends[:-1], ends[1:])
        ids = np.array([whole[t] for t in texts])
        self.tables = []
        while len(hashes):
            keys, values = np.zeros(1 << _SLOT_BITS, np.uint64), np.full(1 << _SLOT_BITS, NOTHING)
            slot = self._slot(hashes, len(self.tables))
            keys[slot], values[slot] = hashes, ids
            self.tables.append((keys, values))
            lost = keys[slot] != hashes
            hashes, ids = hashes[lost], ids[lost]

    @staticmethod
    def _slot(hashes: np.ndarray, level: int) -> np.ndarray:
        return (hashes * np.uint64(2 * level + 1) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _piece(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), NOTHING)
        miss = np.arange(len(hashes))
        for level, (keys, values) in enumerate(self.tables):
            slot = self._slot(hashes[miss], level)
            hit = keys[slot] == hashes[miss]
            out[miss[hit]] = values[slot[hit]]
            miss = miss[~hit & (keys[slot] != 0)]
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b stay apart when their joined string is encoded.

        The merges that made the two are undone, latest first; at each stage the pieces that touch must not have a merge that comes
        before the one undone. Of equal merges the left one comes first.
        """
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _FAR)
        while len(at):
            key = a << 20 | b
            entry = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossing = np.where(self.pair_keys[entry] == key, self.pair_ranks[entry], _FAR)
            bad = crossing < limit
            out[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra > 0) | (rb > 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            at = at[go]
        return out

    def pieces_ending(self, points: np.ndarray) -> np.ndarray:
        """``[l, j]``: the piece made of the ``l`` characters before position j, if there is one."""
        prefix = ragged.prefix_hashes(points)
        out = np.full((self.longest + 1, len(points) + 1), NOTHING)
        place = np.arange(len(points) + 1)
        for size in range(1, min(self.longest, len(points)) + 1):
            out[size, size:] = self._piece(ragged.range_hashes(prefix, place[:-size], place[size:]))
        return out

    def forward(self, ending: np.ndarray, start: np.ndarray, stop: np.ndarray, entering: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each lane, the last piece of the only path to every position; lanes run from ``start`` to ``stop`` with a piece (or START) before them.

        Returns the pieces on end, and where each lane begins in them.
        """
        length = stop - start
        base = ragged.bounds(length + 1)[:-1]
        last = np.full(int((length + 1).sum()), NOTHING)
        last[base] = entering
        order = np.argsort(-length, kind="stable")
        sorted_length = -length[order]
        for step in range(1, int(length.max(initial=0)) + 1):
            active = order[: np.searchsorted(sorted_length, -step, side="right")]
            here, to = start[active] + step, base[active] + step
            for size in range(1, min(self.longest, step) + 1):
                piece = ending[size, here]
                before = last[to - size]
                some = np.flatnonzero((piece >= 0) & (before != NOTHING))
                if not len(some):
                    continue
                piece, before = piece[some], before[some]
                fine = before == START
                check = np.flatnonzero(~fine)
                fine[check] = self.compatible(before[check], piece[check])
                last[to[some[fine]]] = piece[fine]
        return last, base

    def trace(self, last: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Marks the pieces of the paths that end at ``end`` of ``last``, back to ``begin``: the piece where it ends, else NOTHING."""
        out = np.full(len(last), NOTHING)
        at = end.copy()
        while True:
            go = at > begin
            if not go.any():
                return out
            at, begin = at[go], begin[go]
            out[at] = last[at]
            at = at - self.length[last[at]]

    def states(self, ending: np.ndarray, cut: int, first: int = 0) -> list[State]:
        """The pieces that cover the character before ``cut``: (start, end, piece)."""
        n = ending.shape[1] - 1
        out = []
        for size in range(1, self.longest + 1):
            for end in range(cut, min(n, cut + size - 1) + 1):
                if end - size >= first and ending[size, end] >= 0:
                    out.append((end - size, end, int(ending[size, end])))
        return out

    def transfer(self, ending: np.ndarray, cuts: list[int], bounds: list[list[State]]) -> list[np.ndarray]:
        """A matrix for each chunk between neighbouring cuts: 0 where a path leads from a state to the next cut's state, else minus infinity."""
        lanes = [(k, i, s[1], min(max(e[1] for e in bounds[k + 1]), ending.shape[1] - 1), s[2]) for k in range(len(cuts) - 1) for i, s in enumerate(bounds[k])]
        chunk, row, start, stop, piece = (np.array(x, np.int64) for x in zip(*lanes, strict=True))
        last, base = self.forward(ending, start, np.maximum(stop, start), piece)
        out = [np.full((len(bounds[k]), len(bounds[k + 1])), -np.inf) for k in range(len(cuts) - 1)]
        tests = [(lane, j, base[lane] + s - start[lane], p) for lane in range(len(lanes)) for j, (s, _, p) in enumerate(bounds[chunk[lane] + 1]) if s >= start[lane]]
        if tests:
            lane, j, where, piece = (np.array(x, np.int64) for x in zip(*tests, strict=True))
            before = last[where]
            fine = before == START
            check = np.flatnonzero((before != NOTHING) & ~fine)
            fine[check] = self.compatible(before[check], piece[check])
            for a, b in zip(lane[fine], j[fine], strict=True):
                out[chunk[a]][row[a], b] = 0.0
        return out

    def long_stretch(self, points: np.ndarray, first: list[State] | None = None, goal: list[State] | None = None, matrix_only: bool = False):
        """Encode one stretch without a break, by chunks of ``STRIDE`` characters.

        ``first``: the states before it (positions in ``points``; the start if None); ``goal``: the states to end in (all that end with it if None). With ``matrix_only``
        the product of the chunks' matrices; else the pieces after the first state up to the goal, of which there must be one path.
        """
        ending = self.pieces_ending(points)
        n = len(points)
        begin = [(0, 0, START)] if first is None else first
        final = [s for s in self.states(ending, n) if s[1] == n] if goal is None else goal
        low = max(s[1] for s in begin)
        high = min(s[0] for s in final)
        cuts = [low, *range(low + STRIDE, high - self.longest, STRIDE), n]
        bounds = [begin, *(self.states(ending, c) for c in cuts[1:-1]), final]
        matrices = self.transfer(ending, cuts, bounds)
        if matrix_only:
            return product(matrices)
        path = best_states(matrices)
        start = np.array([bounds[k][path[k]][1] for k in range(len(cuts) - 1)])
        stop = np.array([bounds[k + 1][path[k + 1]][0] for k in range(len(cuts) - 1)])
        piece = np.array([bounds[k][path[k]][2] for k in range(len(cuts) - 1)])
        last, base = self.forward(ending, start, stop, piece)
        marks = self.trace(last, base, base + stop - start)
        out = []
        edges = np.append(base, len(last))
        for k in range(len(cuts) - 1):
            inside = marks[edges[k] : edges[k + 1]]
            out += [inside[inside >= 0], np.array([bounds[k + 1][path[k + 1]][2]])]
        return np.concatenate(out)

    def to_ids(self, pieces: np.ndarray, owner: np.ndarray, unknown_points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and owners: characters that are no piece (``size + k``; unknown ones are NOTHING, with their code points) become bytes."""
        plain = (pieces >= 0) & (pieces < self.size)
        if plain.all():
            return pieces, owner
        text = np.where(pieces >= self.size, 0, unknown_points)
        odd = np.flatnonzero(~plain)
        encoded = [(self.chars[pieces[k] - self.size] if pieces[k] >= 0 else chr(int(text[k]))).encode() for k in odd]
        sizes = np.ones(len(pieces), np.int64)
        sizes[odd] = [len(x) for x in encoded]
        out = np.repeat(np.where(plain, pieces, 0), sizes)
        at = ragged.ragged_index(ragged.bounds(sizes)[odd], sizes[odd])
        out[at] = self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
        return out, np.repeat(owner, sizes)

    def _encode(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = raw.astype(np.int64)
        odd = ~self.known[points[starts]]
        short = np.flatnonzero(~odd & (lengths <= 2 * STRIDE))
        pieces, owner, text = [np.full(int(odd.sum()), NOTHING)], [np.flatnonzero(odd)], [points[starts[odd]]]
        if len(short):
            flat = points[ragged.ragged_index(starts[short], lengths[short])]
            begin = ragged.bounds(lengths[short])
            last, base = self.forward(self.pieces_ending(flat), begin[:-1], begin[1:], np.full(len(short), START))
            marks = self.trace(last, base, base + lengths[short])
            at = np.flatnonzero(marks >= 0)
            pieces.append(marks[at])
            owner.append(short[np.searchsorted(base, at, side="right") - 1])
            text.append(np.zeros(len(at), np.int64))
        for k in np.flatnonzero(~odd & (lengths > 2 * STRIDE)):
            found = self.long_stretch(points[starts[k] : starts[k] + lengths[k]])
            pieces.append(found)
            owner.append(np.full(len(found), k))
            text.append(np.zeros(len(found), np.int64))
        pieces, owner, text = (np.concatenate(x) for x in (pieces, owner, text))
        order = np.argsort(owner, kind="stable")
        ids, owner = self.to_ids(pieces[order], owner[order], text[order])
        return ids, np.bincount(owner, minlength=len(starts)).astype(np.int64)

    def normalised(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points with U+2581 for blanks and before each text that is not empty, and where each text begins."""
        points, at = ragged.code_points(raw)
        points = np.where(points == 0x20, BLANK, points)
        edges = np.searchsorted(at, offsets)
        full = np.flatnonzero(np.diff(edges))
        return np.insert(points, edges[full], BLANK), edges + np.concatenate([[0], np.cumsum(np.diff(edges) > 0)])

    def stretches(self, points: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where parts start that no piece reaches across: at texts, before blanks, around characters that are in no piece."""
        start = np.zeros(len(points), bool)
        start[edges[:-1][edges[:-1] < len(points)]] = True
        odd = ~self.known[points]
        start |= odd
        start[1:] |= odd[:-1]
        if self.breaks_before_blank:
            start[1:] |= (points[1:] == BLANK) & (points[:-1] != BLANK)
        return np.flatnonzero(start)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the number of each."""
        points, edges = self.normalised(raw, offsets)
        return self.encode_points(points, edges)

    def encode_points(self, points: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.stretches(points, edges)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(edges) - 1, np.int64)
        at, count = self.lookup(points.astype(np.uint32), starts, np.diff(np.append(starts, len(points))))
        total, first = ragged.bounds(count), np.searchsorted(starts, edges)
        ids = self.ids[ragged.ragged_index(at, count.astype(np.int64))].astype(np.uint32)
        return ids, total[first[1:]] - total[first[:-1]]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of id sequences on end; bytes that are no UTF-8 become U+FFFD, ids beyond the vocabulary raise IndexError."""
        ids = ids.astype(np.int64)
        data = self.shown[ragged.ragged_index(self.shown_at[ids], self.shown_sizes[ids])].tobytes()
        edges = ragged.bounds(self.shown_sizes[ids])[ragged.bounds(sizes)]
        return [data[a:b].removeprefix(b" ").decode(errors="replace") for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """The (max, +) product, by halves."""
    if len(matrices) == 1:
        return matrices[0]
    half = len(matrices) // 2
    a, b = product(matrices[:half]), product(matrices[half:])
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def best_states(matrices: list[np.ndarray], enter: int = 0, leave: int | None = None) -> list[int]:
    """The state at every cut on the path of weight 0 from state ``enter`` to ``leave``, or to whichever last state has one."""
    last = np.zeros(matrices[-1].shape[1])
    if leave is not None:
        last[:] = -np.inf
        last[leave] = 0.0
    ahead = [last]
    for m in reversed(matrices):
        ahead.append((m + ahead[-1][None, :]).max(axis=1))
    ahead.reverse()
    if not np.isfinite(ahead[0][enter]):
        raise ValueError("the stretch has no path")
    path = [enter]
    for m, after in zip(matrices, ahead[1:], strict=True):
        path.append(int((m[path[-1]] + after).argmax()))
    return path


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    """The model of a file, kept by each Python worker."""
    return PieceModel(path)


def split_chunks(model: PieceModel, points: np.ndarray) -> Iterator[tuple[bool, bool, bool, int, int, np.ndarray]]:
    """Cut one normalised text every ``CHUNK`` characters, whatever stands there: (within a stretch, at its begin, at its end, begin, end, window).

    A chunk is up to three parts, each with a matrix of its own: the rest of the stretch that the cut before it fell into, whole
    stretches, and the first part of the stretch that the next cut falls into. A part of a stretch has a window with margins, in which ``begin`` and ``end`` are its place.
    ``CHUNK`` must be longer than two of the longest pieces.
    """
    edges = np.append(model.stretches(points, np.array([0, len(points)])), len(points))
    for cut in range(0, len(points), CHUNK):
        stop = min(cut + CHUNK, len(points))
        over = int(np.searchsorted(edges, cut, side="right")) - 1
        last = int(np.searchsorted(edges, stop, side="right")) - 1
        at = cut
        if edges[over] < cut:
            at = int(min(edges[over + 1], stop))
            yield _part(model, points, int(edges[over]), int(edges[over + 1]), cut, at)
        if edges[last] > at:
            yield False, True, True, 0, int(edges[last]) - at, points[at : edges[last]]
            at = int(edges[last])
        if at < stop:
            yield _part(model, points, at, int(edges[last + 1]), at, stop)


def _part(model: PieceModel, points: np.ndarray, stretch: int, end: int, a: int, b: int) -> tuple[bool, bool, bool, int, int, np.ndarray]:
    low, high = max(stretch, a - model.longest), min(end, b + model.longest)
    return True, a == stretch, b == end, a - low, b - low, points[low:high]


def chunk_states(model: PieceModel, points: np.ndarray, begin: int, end: int, first: bool, final: bool) -> tuple[list[State], list[State]]:
    """States at both ends of a part of a stretch; a stretch begins with START alone."""
    ending = model.pieces_ending(points)
    before = [(0, 0, START)] if first else model.states(ending, begin)
    after = [s for s in model.states(ending, len(points)) if s[1] == len(points)] if final else model.states(ending, end)
    return before, after


def chunk_matrix(model: PieceModel, inside: bool, first: bool, final: bool, begin: int, end: int, points: np.ndarray) -> np.ndarray:
    """The transfer matrix from the states at the part's begin to those at its end. A stretch ends in one state, whatever its last piece."""
    if not inside:
        return np.zeros((1, 1))
    before, after = chunk_states(model, points, begin, end, first, final)
    found = model.long_stretch(points, before, after, matrix_only=True)
    if not final:
        return found
    # A piece over the cut may be the stretch's last one.
    done = np.array([0.0 if s[1] == len(points) and s[2] != START else -np.inf for s in before])
    return np.maximum(found.max(axis=1), done)[:, None]


def chunk_ids(model: PieceModel, inside: bool, first: bool, final: bool, begin: int, end: int, points: np.ndarray, enter: int, leave: int) -> np.ndarray:
    """Ids of a part once the states at its ends are known: those after the entering piece, the leaving piece with them."""
    if not inside:
        return model.encode_points(points, np.array([0, len(points)]))[0]
    before, after = chunk_states(model, points, begin, end, first, final)
    if final and not first and before[enter][1] == len(points):
        return np.zeros(0, np.uint32)
    pieces = model.long_stretch(points, [before[enter]], after if final else [after[leave]])
    return model.to_ids(pieces, np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64))[0].astype(np.uint32)


def _steps(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    """Rows with a matrix in order, and the matrices."""
    table = table.sort_by("k")
    return table, [np.where(np.frombuffer(m, bool).reshape(h, -1), 0.0, -np.inf) for h, m in zip(table.column("height").to_pylist(), table.column("matrix").to_pylist(), strict=True)]


def _packed(row: int, k: int, found: np.ndarray) -> dict[str, list]:
    return {"row": [row], "k": [k], "height": [found.shape[0]], "matrix": [np.isfinite(found).tobytes()]}


def states_at_cuts(matrices: DataFrame) -> DataFrame:
    """(row, k, enter, leave): the states at both ends of each part, from (row, k, height, matrix); k counts the parts of a text from 0.

    A tree over tasks: ``FOLD`` matrices in a row become their product, level by level, until a text has no more than so many; from there the states go
    down again, each block getting those at its ends. So no task sees more than ``FOLD`` matrices of a text.
    """
    kinds, states = "row bigint, k bigint, height bigint, matrix binary", "row bigint, k bigint, enter bigint, leave bigint"
    block = F.expr(f"k div {FOLD}")

    def fold(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table(_packed(key[0].as_py(), key[1].as_py(), product(_steps(table)[1])))

    def trace(table: pa.Table) -> pa.Table:
        table, steps = _steps(table)
        ends = (table.column("from")[0].as_py(), table.column("to")[0].as_py()) if "from" in table.column_names else (0, None)
        path = best_states(steps, *ends)
        return pa.table({"row": table.column("row"), "k": table.column("k"), "enter": pa.array(path[:-1], pa.int64()), "leave": pa.array(path[1:], pa.int64())})

    levels = [stage(matrices, "matrices")]
    most = levels[0].agg(F.max("k")).first()[0]
    while most is not None and most >= FOLD:
        levels.append(stage(levels[-1].withColumn("block", block).groupBy("row", "block").applyInArrow(fold, kinds), "matrices"))
        most //= FOLD
    found = levels[-1].groupBy("row").applyInArrow(trace, states)
    for level in reversed(levels[:-1]):
        ends = found.select("row", F.col("k").alias("block"), F.col("enter").alias("from"), F.col("leave").alias("to"))
        found = level.withColumn("block", block).join(ends, ["row", "block"]).groupBy("row", "block").applyInArrow(trace, states)
    return found


_CHUNK_COLUMNS = ["row", "k", "inside", "first", "final", "begin", "end", "points"]


def _encode_long(docs: DataFrame, path: str) -> DataFrame:
    """Like :func:`encode`, for texts of more than a chunk: chunks go to any task, only their small matrices meet by text, and those in a tree."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number = load(path), TaskContext.get().partitionId() << 32
        for batch in batches:
            for k in range(batch.num_rows):
                raw, offsets = ragged.flat(batch.column("text").slice(k, 1))
                points, _ = model.normalised(raw, offsets)
                sha, number = hashlib.sha256(raw.tobytes()).hexdigest(), number + 1
                for n, (inside, first, final, begin, end, window) in enumerate(split_chunks(model, points)):
                    row = {"doc_id": batch.column("doc_id").slice(k, 1), "sha": [sha], "row": [number], "k": [n], "inside": [inside], "first": [first], "final": [final], "begin": [begin], "end": [end], "points": [window.astype("<u4").tobytes().decode("utf-32-le").encode()]}
                    yield pa.RecordBatch.from_pydict(row)

    schema = f"doc_id {kind}, sha string, row bigint, k bigint, inside boolean, first boolean, final boolean, begin bigint, end bigint, points binary"
    chunks = stage(docs.mapInArrow(split, schema).repartition("row", "k"), "chunks")

    def unpacked(batch: pa.RecordBatch) -> Iterator[dict]:
        for one in batch.to_pylist():
            yield one | {"points": np.frombuffer(one["points"].decode().encode("utf-32-le"), "<u4").astype(np.int64)}

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for one in unpacked(batch):
                found = chunk_matrix(model, *(one[c] for c in _CHUNK_COLUMNS[2:]))
                yield pa.RecordBatch.from_pydict(_packed(one["row"], one["k"], found))

    states = states_at_cuts(chunks.drop("doc_id", "sha").mapInArrow(matrices, "row bigint, k bigint, height bigint, matrix binary"))

    def backtrace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for one in unpacked(batch.drop_columns(["doc_id"])):
                ids = chunk_ids(model, *(one[c] for c in _CHUNK_COLUMNS[2:]), one["enter"], one["leave"])
                yield pa.RecordBatch.from_pydict({"row": [one["row"]], "k": [one["k"]], "part": [ids.astype("<u4").tobytes()]})

    parts = chunks.join(states, ["row", "k"]).mapInArrow(backtrace, "row bigint, k bigint, part binary")
    whole = parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", "part"))).alias("p")).select("row", F.expr("aggregate(p.part, cast('' as binary), (a, b) -> concat(a, b))").alias("ids"))
    heads = chunks.filter("k = 0").select("row", "doc_id", F.col("sha").alias("text_sha256"))
    return heads.join(whole, "row").select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "text_sha256")


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, ids (little-endian unsigned 32-bit), n_pieces, text_sha256.

    The ids are those of the ``sentencepiece`` library for a BPE model file. Short stretches between breaks are encoded once and kept in a cache of the
    worker; texts of more than ``CHUNK`` characters are split, so no task holds the work of a giant one.

    NULL and empty text: no ids. NULL doc_id: kept. Repeated rows: a result each. Empty table: no rows. Other columns are not read.
    """
    narrow = id_and_text(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(model)
        for batch in batches:
            for part in ragged.slices(batch, "text", ragged.SLICE_BYTES // 2):
                raw, offsets = ragged.flat(part.column("text"))
                ids, sizes = own.encode(raw, offsets)
                ids = np.ascontiguousarray(ids.astype("<u4"))
                data = raw.tobytes()
                shas = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                ends = pa.py_buffer(ragged.bounds(sizes * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, ends, pa.py_buffer(ids)]), pa.array(sizes), pa.array(shas)],
                    names=["doc_id", "ids", "n_pieces", "text_sha256"],
                )

    short = narrow.filter(F.length("text") <= CHUNK).mapInArrow(run, f"doc_id {kind}, ids binary, n_pieces bigint, text_sha256 string")
    return short.unionByName(_encode_long(narrow.filter(F.length("text") > CHUNK), model))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Add ``text`` to a table with ``ids``; all other columns stay. NULL ids: empty text. U+2581 in the source comes back as a blank, as with the library."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                parts = [x or b"" for x in part.column("ids").to_pylist()]
                texts = own.decode(np.frombuffer(b"".join(parts), "<u4"), np.array([len(x) // 4 for x in parts], np.int64))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])

    return encoded.mapInArrow(run, schema)
