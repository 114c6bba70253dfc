import hashlib
import random

import numpy as np
import pytest

from millrace.llm import substrings


def brute(rows, length=100):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\x01" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(data)))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus():
    draw = random.Random(5)
    text = lambda n: "".join(draw.choice("abcdefghij klmnop\né") for _ in range(n))
    shared = [text(draw.randint(60, 400)) for _ in range(10)]
    rows = []
    for _ in range(120):
        parts = [draw.choice([text(draw.randint(0, 200)), draw.choice(shared), draw.choice(shared)[draw.randint(0, 30) :]]) for _ in range(draw.randint(1, 6))]
        rows.append((draw.randrange(10**6), "".join(parts)))
    rows += [(i + 2 * 10**6, rows[i][1]) for i in range(30)]
    return rows + [(5, None), (6, ""), (None, shared[0] + shared[1]), (7, "a" * 1000), (8, "ab" * 300), (9, "a" * 99), (10, "a" * 100), (12, shared[3]), (12, shared[3]), (12, shared[4])]


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_BYTES": 6000, "BUCKET_BYTES": 3000}, {"BLOCK_BYTES": 6000, "BUCKET_BYTES": 3000, "HOT_CONTEXTS": 1}])
def test_against_every_window(documents, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(substrings, name, value)
    rows = corpus()
    got = substrings.remove_repeats(documents(rows), with_text=True).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(rows)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


def test_odd_rows(documents, odd_rows):
    rows = [(i, t if len(t or "") < 10_000 else t[:20_000]) for i, t in odd_rows]
    assert sorted((tuple(r) for r in substrings.remove_repeats(documents(rows)).collect()), key=str) == brute(rows)
    assert substrings.remove_repeats(documents([])).count() == 0


def test_order_of_suffixes():
    draw = random.Random(2)
    data = "".join(draw.choice("ab") for _ in range(3000)).encode()
    raw = np.frombuffer(data, np.uint8)
    start = np.array([draw.randrange(2900) for _ in range(500)])
    sizes = np.array([1, 199, 2, 98, 200])
    order, equal = substrings.SuffixSorter(raw).sort(start, np.full(500, 40), sizes)
    begin = 0
    for size in sizes:
        part = order[begin : begin + size]
        texts = [data[start[k] : start[k] + 40] for k in part]
        assert sorted(part) == list(range(begin, begin + size)) and texts == sorted(texts)
        assert [bool(e) for e in equal[begin + 1 : begin + size]] == [x == y for x, y in zip(texts[1:], texts, strict=False)]
        begin += size


def test_a_collision_is_found(monkeypatch):
    """With hashes that call everything equal the order comes from the bytes."""
    raw = np.frombuffer(b"bbbbaaaabbbbcccc", np.uint8)
    sorter = substrings.SuffixSorter(raw)
    monkeypatch.setattr(sorter, "_same", lambda a, b, length: np.ones(len(a), bool))
    order, equal = sorter.sort(np.array([0, 4, 8, 12]), np.full(4, 4), np.array([4]))
    assert order.tolist() == [1, 0, 2, 3] and equal.tolist() == [False, False, True, False]
