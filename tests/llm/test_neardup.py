import random
import re

import numpy as np
import pytest

from millrace.llm import neardup

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, size=5):
    words = WORDS.findall(text or "")
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, limit=0.8):
    rows = [r for r in rows if r[0] is not None]
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, t or "", shingle_set(t)) for i, t, *_ in rows]
    for k, (a, ta, sa) in enumerate(sets):
        for b, tb, sb in sets[:k]:
            if ta == tb or sa and sb and len(sa & sb) >= limit * len(sa | sb):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def corpus(seed, groups=25):
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(3000)]
    rows, number = [], 0
    for _ in range(groups):
        base = [draw.choice(words) for _ in range(draw.choice([3, 8, 60, 200]))]
        for _ in range(draw.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(draw.randint(0, max(0, len(base) // 40))):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((draw.randrange(10**6), " ".join(text)))
            number += 1
    return rows


@pytest.mark.parametrize("weighted", [False, True])
def test_signatures_estimate_the_similarity(weighted):
    draw = np.random.default_rng(5)
    n = 400
    weight = np.concatenate([draw.integers(1, 4, n), draw.integers(1, 4, n)]).astype(float) if weighted else np.ones(2 * n)
    element = np.concatenate([np.arange(n), np.arange(n // 4, n // 4 + n)]).astype(np.uint64)
    signature = neardup.dart_signatures(np.repeat([0, 1], n), element, weight, 2, 4096)
    a, b = ({int(e): w for e, w in zip(element[s], weight[s], strict=True)} for s in (slice(0, n), slice(n, None)))
    keys = set(a) | set(b)
    want = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    assert abs((signature[0] == signature[1]).mean() - want) < 0.035
    assert (signature != 0).all()


def test_small_and_empty_sets():
    signature = neardup.dart_signatures(np.array([0, 2, 2]), np.array([7, 7, 9], np.uint64), np.array([1.0, 1.0, 0.5]), 3, 64)
    assert (signature[1] == 0).all() and (signature[0] != 0).all() and 0.3 < (signature[0] == signature[2]).mean() < 0.95


@pytest.mark.parametrize("seed", range(2))
def test_classes(documents, seed):
    rows = corpus(seed)
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(documents(rows)).collect()}
    assert got == brute(rows)


def test_altered_copies_that_are_only_like_the_original(documents):
    """Copies less than 0.8 alike, each like the original, whose id is not the smallest."""
    draw = random.Random(9)
    base = [f"w{k}" for k in range(400)]
    rows = [(500, " ".join(base))]
    for k in range(40):
        text = list(base)
        for at in draw.sample(range(400), 7):
            text[at] = f"x{k}-{at}"
        rows.append((k if k < 20 else 1000 + k, " ".join(text)))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(documents(rows)).collect()}
    assert got == brute(rows) and set(got.values()) == {0}


def test_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    got = neardup.classes(docs).collect()
    assert len(got) == len(odd_rows)
    assert {r["class_id"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert {r["class_id"] for r in got if r["doc_id"] == 5} == {4}
    left = neardup.drop_near_copies(docs)
    assert left.dtypes == docs.dtypes
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([1, 3, 4, None, None, 6, 7, 8, 9, 10], key=str)
    assert neardup.classes(documents([])).count() == 0 and neardup.drop_near_copies(documents([])).count() == 0


def test_one_large_group(documents):
    rows = [(i, "hot copy of one text with some words in it") for i in range(2000)] + [(5000 + i, f"t{i} a b c d e f") for i in range(300)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(documents(rows)).collect()}
    assert all(got[i] == 0 for i in range(2000)) and all(got[5000 + i] == 5000 + i for i in range(300))


def bridge(number, words=204):
    """A is like B but not like the centre, B is like the centre; light copies of the centre make it one."""
    base = [f"g{number}-{k}" for k in range(words)]
    copies = [base, *([*base[:-1], f"last{k}"] for k in range(6))]
    return [" ".join(t) for t in [*copies, base[:-4], base[:162]]]


def test_a_left_over_text_meets_settled_ones(spark):
    texts = [(k, t) for k, t in enumerate(bridge(0))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    met = spark.createDataFrame([(k, [7]) for k, _ in texts], "id bigint, bands array<bigint>")
    got = {r["id"]: r["label"] for r in neardup._labels(docs, met, 0.8).collect()}
    assert set(brute(texts).values()) == {0} and got == brute(texts)


def test_bridges(documents):
    rows = [(100 * g + k, t) for g in range(15) for k, t in enumerate(bridge(g))]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(documents(rows)).collect()}
    assert got == brute(rows)


def test_one_common_key_in_a_large_bucket(spark):
    """Twenty texts meet in one bucket and nowhere else; two of them are alike, and neither is the centre."""
    texts = [(k, " ".join(f"t{k}-{j}" for j in range(60))) for k in range(20)]
    texts[11] = (11, texts[10][1] + " and more")
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    met = spark.createDataFrame([(k, [7]) for k, _ in texts], "id bigint, bands array<bigint>")
    got = {r["id"]: r["label"] for r in neardup._labels(docs, met, 0.8).collect()}
    assert got.get(11) == 10 and all(got.get(k, k) == k for k in range(20) if k != 11)


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 101), (200, 150)]
    got = {r["id"]: r["label"] for r in neardup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(61)) and got[103] == 100 and got[200] == 150


def test_weights_count_when_links_are_tested(documents):
    """Texts with the same runs, some repeated: alike as sets, not as weighted sets."""
    draw = random.Random(12)
    words = [f"w{k}" for k in range(500)]
    base = [draw.choice(words) for _ in range(60)]
    passage = [draw.choice(words) for _ in range(30)]
    once = base + passage
    rows = [(1, " ".join(once)), (2, " ".join(base + passage * 4)), (3, " ".join(base + passage * 4 + ["end"]))]

    def weighted(a, b):
        ca, cb = ({k: sum(x == k for x in g) for k in set(g)} for g in (runs(a), runs(b)))
        return sum(min(ca.get(k, 0), cb.get(k, 0)) for k in ca.keys() | cb.keys()) / sum(max(ca.get(k, 0), cb.get(k, 0)) for k in ca.keys() | cb.keys())

    def runs(text):
        w = text.split()
        return [tuple(w[k:k + 5]) for k in range(len(w) - 4)]

    texts = dict(rows)
    assert weighted(texts[1], texts[2]) < 0.8 <= weighted(texts[2], texts[3])
    plain = {r.doc_id: r.class_id for r in neardup.classes(documents(rows)).collect()}
    counted = {r.doc_id: r.class_id for r in neardup.classes(documents(rows), weighted=True).collect()}
    assert len(shingle_set(texts[1]) & shingle_set(texts[2])) >= 0.8 * len(shingle_set(texts[1]) | shingle_set(texts[2]))
    assert plain == {1: 1, 2: 1, 3: 1} and counted == {1: 1, 2: 2, 3: 2}


def test_recall_with_large_groups(documents):
    """Links between different texts against brute force, with groups of hundreds of altered copies."""
    draw = random.Random(21)
    words = [f"w{k}" for k in range(800)]
    rows = []
    for size in (250, 120, 40, 5, 1, 1):
        base = [draw.choice(words) for _ in range(90)]
        for _ in range(size):
            text = list(base)
            for _ in range(draw.randint(0, 4)):
                text[draw.randrange(len(text))] = draw.choice(words)
            rows.append((len(rows), " ".join(text)))
    got = {r.doc_id: r.class_id for r in neardup.classes(documents(rows)).collect()}
    sets = [shingle_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    recall = sum(got[a] == got[b] for a, b in links) / len(links)
    print(f"recall {recall:.4f} of {len(links)} links")
    assert recall >= 0.99 and got == brute(rows)
