"""Byte-level BPE on ragged arrays: pre-tokens by vector rules, merges rank by rank for all at once.

Gives the ids that the ``tokenizers`` library gives for the same file, which the tests check. The library
itself needs several times the CPU seconds on texts whose words rarely repeat.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

from millrace.llm import ragged
from millrace.llm.ragged import LETTER, SPACE

_NONE = np.int32(2**31 - 1)
_LONG_PART = 4 << 20
_SAFE_CUT = re.compile(rb"[A-Za-z] (?=[A-Za-z])")


def pretokens(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pre-tokens start. ``begins``: sorted starts of the texts; none is empty, the first is 0."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = ragged.classes(raw)
    fresh = np.zeros(n, bool)
    fresh[begins] = True
    start = fresh.copy()
    start[1:] |= kind[1:] != kind[:-1]

    # The last blank before other text: a space joins what follows, another blank stands alone.
    tail = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~fresh[1:])
    lead = tail.copy()
    for _ in range(3):
        inner = (raw[lead] & 0xC0) == 0x80
        if not inner.any():
            break
        lead[inner] -= 1
    start[lead] = True
    start[tail[raw[tail] == 0x20] + 1] = False

    quote = np.flatnonzero((raw == 0x27) & start)
    if len(quote):
        nxt = np.concatenate([raw, np.zeros(3, np.uint8)])
        own = np.concatenate([~fresh, np.zeros(3, bool)])
        one, two = nxt[quote + 1], nxt[quote + 2]
        # The endings that stand alone after an apostrophe are s t m d, and re ve ll.
        short = own[quote + 1] & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pair = one.astype(np.int32) << 8 | two
        long = own[quote + 1] & own[quote + 2] & np.isin(pair, [ord("r") << 8 | ord("e"), ord("v") << 8 | ord("e"), ord("l") << 8 | ord("l")])
        for at, size in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            after = at + size
            after = after[after < n]
            after = after[kind[after] == LETTER]
            start[after] = True
    return np.flatnonzero(start)


class CachedEncoder:
    """Ids of short stretches of text, encoded once each and found again by hash and bytes.

    A direct-mapped table of ``slots`` hashes points into a pool of ids and of the stretches' bytes, which starts anew when it holds more than
    ``pool`` ids or bytes. Stretches of more than ``LONGEST_KEPT`` bytes are encoded each time.
    """

    LONGEST_KEPT = 1 << 10

    def __init__(self, vocabulary: int, slots: int = 1 << 20, pool: int = 1 << 23):
        self.slots, self.pool, self.kind = slots, pool, np.uint16 if vocabulary < 1 << 16 else np.int32
        self._clear()

    def _clear(self) -> None:
        self.seen = np.zeros(self.slots, np.uint64)
        self.at = np.zeros(self.slots, np.int64)
        self.count = np.zeros(self.slots, np.int32)
        self.ids = np.zeros(0, self.kind)
        self.text_at = np.zeros(self.slots, np.int64)
        self.text_size = np.full(self.slots, -1, np.int64)
        self.text = np.zeros(0, np.uint8)

    def lookup(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per pre-token: place of its ids in ``self.ids``, and how many."""
        if len(self.ids) > self.pool or len(self.text) > self.pool:
            self._clear()
        hashes = ragged.token_hashes(raw, starts, lengths)
        shift = np.uint64(64 - (self.slots.bit_length() - 1))
        slot = (hashes >> shift).astype(np.int64)
        at, count = self.at[slot], self.count[slot]
        known = (self.seen[slot] == hashes) & (self.text_size[slot] == lengths)
        hit = np.flatnonzero(known)
        known[hit] = ragged.equal_ranges(raw, starts[hit], self.text, self.text_at[slot[hit]], lengths[hit])
        new = np.flatnonzero(~known)
        if len(new):
            _, first, again = np.unique(hashes[new], return_index=True, return_inverse=True)
            # Those that only share the hash of the first are encoded by themselves, and not kept.
            like = (lengths[new] == lengths[new[first[again]]])
            same = np.flatnonzero(like)
            like[same] = ragged.equal_ranges(raw, starts[new[same]], raw, starts[new[first[again[same]]]], lengths[new[same]])
            pick = np.concatenate([new[first], new[~like]])
            again[~like] = len(first) + np.arange(int((~like).sum()))
            ids, sizes = self._encode(raw, starts[pick], lengths[pick])
            place = len(self.ids) + ragged.bounds(sizes)[:-1]
            self.ids = np.concatenate([self.ids, ids.astype(self.ids.dtype)])
            at[new], count[new] = place[again], sizes[again]
            kept = np.flatnonzero(lengths[new[first]] <= self.LONGEST_KEPT)
            keep = new[first[kept]]
            self.seen[slot[keep]], self.at[slot[keep]], self.count[slot[keep]] = hashes[keep], place[kept], sizes[kept]
            self.text_at[slot[keep]], self.text_size[slot[keep]] = len(self.text) + ragged.bounds(lengths[keep])[:-1], lengths[keep]
            self.text = np.concatenate([self.text, raw[ragged.ragged_index(starts[keep], lengths[keep])]])
        return at, count

    def _encode(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given stretches, on end, and how many each has."""
        raise NotImplementedError


class ByteBpe(CachedEncoder):
    """Vocabulary and merge ranks of a byte-level BPE file, with a cache of the pre-tokens met."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = _byte_letters()
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        key = left << 17 | right
        order = np.argsort(key)
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made[order]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        super().__init__(len(vocab) + len(self.special))

    def parts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the stretches that are split by themselves, and the special strings among them (start, end).

        A text is cut around special strings.
        """
        begins = [offsets[:-1]]
        marks: list[tuple[int, int]] = []
        data = raw.tobytes()
        for content in self.special:
            at = data.find(content)
            while at >= 0:
                text = int(np.searchsorted(offsets, at, side="right")) - 1
                if at + len(content) <= offsets[text + 1]:
                    marks.append((at, at + len(content)))
                    at = data.find(content, at + len(content))
                else:
                    at = data.find(content, at + 1)
        if marks:
            begins.append(np.array(marks).ravel())
        out = np.unique(np.concatenate(begins))
        return out[out < len(raw)], np.array(sorted(marks), np.int64).reshape(-1, 2)

    def tokens(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per pre-token: start and cache slot; then, per text, the number of its first pre-token."""
        begins, marks = self.parts(raw, offsets)
        starts = pretokens(raw, begins)
        if len(marks):
            inside = np.zeros(len(raw) + 1, np.int32)
            np.add.at(inside, marks[:, 0] + 1, 1)
            np.add.at(inside, marks[:, 1], -1)
            starts = starts[np.cumsum(inside)[starts] == 0]
        lengths = np.diff(np.append(starts, len(raw)))
        return starts, lengths, np.searchsorted(starts, offsets)

    def _encode(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols = self.byte_ids[raw[ragged.ragged_index(starts, lengths)]]
        ids, sizes = self.merge(symbols, lengths)
        if self.special:
            longest = max(map(len, self.special))
            edges = ragged.bounds(sizes)
            for k in np.flatnonzero(lengths <= longest):
                text = raw[starts[k] : starts[k] + lengths[k]].tobytes() if raw[starts[k]] == 0x3C else b""
                if text in self.special:
                    ids = np.concatenate([ids[: edges[k]], [self.special[text]], ids[edges[k + 1] :]])
                    sizes[k] = 1
                    edges = ragged.bounds(sizes)
        return ids, sizes

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge each sequence's lowest-ranked pair, everywhere it stands, until none can be merged.

        A pair that a merge makes always ranks after that merge, so all places of one pair can go at once;
        where they overlap (``aaa``) the left one goes first. Finished sequences leave the arrays.
        """
        lengths = lengths.astype(np.int64).copy()
        number = np.arange(len(lengths))
        sizes = np.zeros(len(lengths), np.int64)
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(number):
            starts = ragged.bounds(lengths)[:-1]
            rank, entry = self._pair_ranks(symbols)
            rank[starts + lengths - 1] = _NONE
            best = np.minimum.reduceat(rank, starts)
            over = best == _NONE
            if over.any():
                member = np.repeat(over, lengths)
                sizes[number[over]] = lengths[over]
                done.append((number[over], lengths[over], symbols[member]))
                symbols, rank, entry = symbols[~member], rank[~member], entry[~member]
                number, lengths, best = number[~over], lengths[~over], best[~over]
                if not len(number):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, lengths))
            follows = np.zeros(len(hit), bool)
            follows[1:] = np.diff(hit) == 1
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(hit))))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            symbols[hit] = self.made[entry[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            lengths = np.add.reduceat(keep, ragged.bounds(lengths)[:-1], dtype=np.int64)
            symbols = symbols[keep]
        out = np.zeros(int(sizes.sum()), np.int32)
        first = ragged.bounds(sizes)[:-1]
        for which, size, ids in done:
            out[ragged.ragged_index(first[which], size)] = ids
        return out, sizes

    def _pair_ranks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = symbols.astype(np.int64)
        key = np.empty(len(wide), np.int64)
        key[:-1] = wide[:-1] << 17 | wide[1:]
        key[-1] = -1
        entry = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[entry] == key, self.ranks[entry], _NONE), entry

    def counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Number of tokens of each text."""
        return sum(self._counts(raw[a:b], np.clip(offsets, a, b) - a) for a, b in _stretches(raw))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and the number of each."""
        ids, sizes = zip(*(self._ids(raw[a:b], np.clip(offsets, a, b) - a) for a, b in _stretches(raw)), strict=True)
        return np.concatenate(ids), sum(sizes)

    def _counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        starts, lengths, first = self.tokens(raw, offsets)
        if not len(starts):
            return np.zeros(len(offsets) - 1, np.int64)
        _, count = self.lookup(raw, starts, lengths)
        total = ragged.bounds(count)
        return total[first[1:]] - total[first[:-1]]

    def _ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, lengths, first = self.tokens(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        at, count = self.lookup(raw, starts, lengths)
        total = ragged.bounds(count)
        ids = self.ids[ragged.ragged_index(at, count.astype(np.int64))].astype(np.uint32)
        return ids, total[first[1:]] - total[first[:-1]]


def _stretches(raw: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of a few MB that can be encoded one after the other.

    They end before a space between two ASCII letters, where a pre-token starts whatever stands around;
    without such a space the range goes on.
    """
    cuts, begin = [0], 0
    while len(raw) - begin > 2 * _LONG_PART:
        window = raw[begin + _LONG_PART : begin + 2 * _LONG_PART].tobytes()
        found = _SAFE_CUT.search(window)
        begin += _LONG_PART + (found.start() + 1 if found else len(window))
        if found:
            cuts.append(begin)
    return list(zip(cuts, [*cuts[1:], len(raw)], strict=True))


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """The tokenizer of a file, kept by each Python worker."""
    return ByteBpe(path)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}
