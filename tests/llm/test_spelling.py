import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from millrace.llm import spelling

UPPER = {c: c + 32 for c in range(65, 91)}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows):
    words = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}
    others = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, near_words in others.items():
        best = min(near_words, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(others[w]), words[forms[w]] if forms[w] else None))
    return Counter(out)


def check(df, rows):
    assert Counter(map(tuple, df.collect())) == brute(rows)


def random_rows(seed, letters, docs=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(120):
            w = rng.choice(stems[:int(1 + 59 * rng.random() ** 2)])
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w = w[:at] + rng.choice(["", rng.choice(letters)]) + w[at + rng.randint(0, 1):]
            words.append(w.title() if rng.random() < 0.2 else w)
        rows.append((i, rng.choice([" ", ", ", "-"]).join(words)))
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "abcdefgh"), (3, "aéñßÀ×"), (4, "abcdefghijklmnopqrstuvwxyz")])
def test_random(documents, seed, letters):
    rows = random_rows(seed, letters)
    check(spelling.variant_groups(documents(rows)), rows)


@pytest.mark.parametrize("symbols", [(2, 90), (90,), (3, 90)])
def test_any_number_of_symbols(documents, monkeypatch, symbols):
    monkeypatch.setattr(spelling, "SYMBOLS", symbols)
    monkeypatch.setattr(spelling, "AT_ONCE", 50)
    rows = random_rows(5, "abcdeé")
    check(spelling.variant_groups(documents(rows)), rows)


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (20, "Word1 word2 wordx wörd ÀÉ"), (21, "a" * 4000 + " " + "a" * 4001 + " ") , *[(i, "a" * 4000 + " " + "a" * 4001 + " " + "a" * 3999 + "b") for i in range(30, 36)], *[(40, "again again agein")] * 3]
    check(spelling.variant_groups(documents(rows)), rows)


def test_long_chain(documents):
    # each word stands for the next, which is twice as frequent
    words = ["aaaaaaaa"[:8 - i] + "b" * i for i in range(8)]
    rows = [(1000 + k, " ".join([w] * (3 * 2 ** k))) for k, w in enumerate(words)]
    check(spelling.variant_groups(documents(rows)), rows)


def test_equal_sums(spark):
    # words whose polynomials are equal whatever the base: candidates only, told apart by their letters
    a = "".join("i" if bin(i).count("1") % 2 else "n" for i in range(2048))
    b = a.translate({ord("i"): "n", ord("n"): "i"})
    words = spark.createDataFrame([(a, 9), (b, 9), (a + "i", 3), (b[:-1], 3), ("plain", 1)], "word string, n long")
    found = {(r.word, r.near) for r in spelling.near_words(words).collect()}
    assert found == {(a, a + "i"), (a + "i", a), (b, b[:-1]), (b[:-1], b)}


def test_neighbourhoods_are_complete_and_distinct():
    rng = np.random.default_rng(3)
    for length, count in [(5, 2), (6, 3), (7, 4)]:
        symbols = rng.integers(0, count, (40, length)).astype(np.uint8)

        def key(word, space):
            return int(spelling.keys(np.array([word], np.uint8), space)[0])

        for space in (length, length - 1):
            found = [set() for _ in symbols]
            for row, keys in spelling.neighbours(symbols, space, count):
                for r, k in zip(row, keys):
                    assert int(k) not in found[r]
                    found[r].add(int(k))
            for word, keys in zip(symbols.tolist(), found):
                if space == length:
                    want = [word] + [word[:i] + [c] + word[i + 1:] for i in range(length) for c in range(count)] + [word[:i] + [c] + word[i:] for i in range(length + 1) for c in range(count)]
                else:
                    want = [word[:i] + word[i + 1:] for i in range(length)]
                assert keys == {key(w, space) for w in want}


def test_empty(documents):
    assert spelling.variant_groups(documents([])).count() == 0
    assert spelling.variant_groups(documents([(1, None), (2, "few words")])).count() == 0
