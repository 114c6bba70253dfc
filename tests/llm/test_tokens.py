import bisect
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, packing, ragged, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_character_classes_are_the_librarys():
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    table = ragged.class_table()
    for c in [*range(0x3000), *range(0x3000, 0x110000, 97)]:
        if not 0xD800 <= c < 0xE000:
            kind = 0 if len(split("a" + chr(c))) == 1 else 1 if len(split("1" + chr(c))) == 1 else 2 if len(split("!" + chr(c))) == 1 else 3
            assert kind == table[c], hex(c)


def test_ids_are_the_librarys(library):
    draw = random.Random(3)
    alphabet = [*"ab's tmdrevl  \n\t'!?,12é ñ漢字　  😀<|", "<|endoftext|>", "'re", "'ll", "aaaa", "  "]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(4000)] + [None, "", "a" * 5000, "x'" * 200, "<|endoftext|><|endoftext|>"]
    model = bpe.ByteBpe(PATH)
    raw, offsets = ragged.flat(pa.array(texts))
    ids, sizes = model.encode(raw, offsets)
    edges = ragged.bounds(sizes)
    for k, text in enumerate(texts):
        assert ids[edges[k] : edges[k + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert (model.counts(raw, offsets) == sizes).all()


def test_long_texts_are_cut_where_nothing_changes(library, monkeypatch):
    monkeypatch.setattr(bpe, "_LONG_PART", 500)
    text = "Some words, it's 12 of them!  \n\n And <|endoftext|> more é漢 " * 200
    raw, offsets = ragged.flat(pa.array(["start", text, ""]))
    ids, sizes = bpe.ByteBpe(PATH).encode(raw, offsets)
    assert ids.tolist() == [i for t in ("start", text) for i in library.encode(t, add_special_tokens=False).ids]
    assert sizes[2] == 0


def thue_morse(size):
    """Two texts whose sums of byte times power of any base are equal modulo 2 ** 64."""
    word = "".join("in"[bin(k).count("1") % 2] for k in range(size))
    return word, word.translate({ord("i"): "n", ord("n"): "i"})


@pytest.mark.parametrize("size", [256, 2048])
def test_texts_with_equal_polynomials(documents, library, size):
    rows = [(k, text) for k, text in enumerate(thue_morse(size) * 2)]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents(rows), PATH).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in rows}


def test_equal_hashes_are_told_apart(library, monkeypatch):
    monkeypatch.setattr(ragged, "token_hashes", lambda raw, starts, lengths: (lengths % 3).astype(np.uint64) << np.uint64(60))
    texts = ["some words", "same weird", "other words here", "some words"]
    model = bpe.ByteBpe(PATH)
    for _ in range(2):
        ids, sizes = model.encode(*ragged.flat(pa.array(texts)))
        edges = ragged.bounds(sizes)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_counts(documents, odd_rows, library):
    got = sorted((tuple(r) for r in token_counts.count_tokens(documents(odd_rows), PATH).collect()), key=str)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in odd_rows]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(documents([]), PATH).count() == 0


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        k = bisect.bisect_left(rooms, n)
        room = rooms.pop(k) if k < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_bins_hold_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 1025, [5, 300, 4000, 900][seed]) if seed < 3 else draw.integers(330, 520, 900)
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    bins = packing.complete_bins(counts, 1024)
    used = {}
    for one, times in bins:
        assert sum(one) <= 1024
        for n in one:
            used[n] = used.get(n, 0) + times
    assert used == counts
    assert sum(t for _, t in bins) <= plain_best_fit(lengths.tolist(), 1024)
    assert sum(t for _, t in packing.best_fit(counts, 1024)) == plain_best_fit(lengths.tolist(), 1024)


def test_the_search_beats_best_fit():
    # Best fit puts 6 + 3 together and needs 3 bins of 10; 6 + 2 + 2 and 4 + 3 + 3 fill two.
    assert sum(t for _, t in packing.complete_bins({6: 1, 4: 1, 3: 2, 2: 2}, 10)) == 2


def test_too_long_a_piece_is_refused():
    with pytest.raises(ValueError):
        packing.complete_bins({11: 1}, 10)


def test_packing(documents, odd_rows, library, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    got = packing.pack_documents(documents(odd_rows * 3), PATH, capacity=64, with_ids=True)
    rows = got.collect()
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r["length"] for r in rows)
    assert len(places) <= -(-total // 64) * 1.02 + 1
    long = [r for r in rows if r["doc_id"] == 10]
    want = library.encode(odd_rows[-1][1], add_special_tokens=False).ids + [2]
    one = sorted((r for r in long), key=lambda r: r["start"])[::3]
    assert [i for r in one for i in np.frombuffer(r["ids"], "<u4").tolist()] == want
    assert [r["length"] for r in one][1:] == [64] * (len(one) - 1)
    whole = packing.assemble(got).collect()
    assert sum(len(r["ids"]) for r in whole) == 4 * total
    assert packing.pack_documents(documents([]), PATH).count() == 0


def fewest(counts, capacity):
    """The fewest bins, by trying every place for every item."""
    items = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    best = len(items)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for j, room in enumerate(rooms):
            if room >= items[k] and room not in rooms[:j]:
                place(k + 1, [*rooms[:j], room - items[k], *rooms[j + 1 :]])
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best


def packed_bins(counts, capacity, **limits):
    found = packing.complete_bins(counts, capacity, **limits)
    items = {}
    for lengths, times in found:
        assert sum(lengths) <= capacity and times > 0
        for n in lengths:
            items[n] = items.get(n, 0) + times
    assert items == {n: c for n, c in counts.items() if c}
    return sum(times for _, times in found)


def test_bins_are_the_fewest():
    draw = random.Random(4)
    for _ in range(300):
        capacity = draw.choice([10, 20, 37, 100])
        counts = {draw.randint(1, capacity): draw.randint(1, 3) for _ in range(draw.randint(1, 6))}
        best = fewest(counts, capacity)
        assert packing.bins_needed(counts, capacity) <= best == packed_bins(counts, capacity)


def test_better_than_best_fit():
    # 6+4, 5+5 and 3+7 fill ten each; best fit puts other things beside each other in the second case
    for counts, capacity in [({6: 4, 4: 4, 5: 2, 7: 1, 3: 1}, 10), ({44: 2, 24: 4, 22: 2, 21: 2, 17: 4, 8: 2, 6: 4}, 100)]:
        assert packed_bins(counts, capacity) == fewest(counts, capacity)


@pytest.mark.parametrize("counts", [{520: 50, 1: 20000}, {513: 400, 1: 3000}, {513: 400, 1: 3000, 700: 3}, {1: 10**9, 1024: 10**7, 2: 10**8}, {n: 1 + n % 7 for n in range(1, 1025)}, {}])
def test_many_short_pieces(counts):
    assert packed_bins(counts, 1024) >= (packing.bins_needed(counts, 1024) if counts else 0)
    assert packed_bins(counts, 1024, nodes=0) >= packed_bins(counts, 1024)


def test_many_empty_texts(documents, library):
    word = " the"
    rows = [(i, word * 512) for i in range(40)] + [(100 + i, None) for i in range(300)]
    got = packing.pack_documents(documents(rows), PATH).collect()
    assert len(got) == len(rows) and len({r.sequence_id for r in got}) == 40
