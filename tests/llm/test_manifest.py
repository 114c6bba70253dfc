import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import manifest

UPPER = {c: c + 32 for c in range(65, 91)}


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    doc_id, text, lang, source, n_chars = row
    text = text.translate(UPPER) if low and text is not None else text
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(digests):
    """The root, and for each leaf the [(left, right)] of every level."""
    paths, where, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        runs = [level[i:i + 16] for i in range(0, len(level), 16)]
        for leaf_no, at in enumerate(where):
            run, slot = runs[at // 16], at % 16
            paths[leaf_no].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        where, level = [at // 16 for at in where], [H(*run) for run in runs]
    return level[0], paths


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        group = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[source] = group, *tree([leaf(r) for r in group])
    root, over = tree([trees[s][1] for s in order])
    out = []
    for source, up in zip(order, over):
        group, subroot, paths = trees[source]
        for row, path in zip(group, paths):
            forged = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 5 == 0
            node = leaf(row, low=forged)
            for left, right in path + up:
                node = H(left, node, right)
            proof = H(*(side for step in path + up for side in step))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return Counter(out)


def full(rows):
    return [(r[0], r[1], *(r[2:3] or [None]), *(r[3:4] or [None]), len(r[1]) if r[1] else 0) for r in rows]


def got(df):
    return Counter(map(tuple, df.drop("source", "position").collect()))


def test_odd_rows(documents, odd_rows):
    rows = [*odd_rows, (11, "A", "en", ""), (12, None, None, "é"), (13, "B", "EN", "z"), (-7, "Neg", "en", "z"), (-(1 << 63), "Least", "en", "z"), ((1 << 63) - 1, "Most", "en", "z")]
    assert got(manifest.manifest(documents(rows))) == brute(full(rows))


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17}, {"a": 256, "b": 257, None: 1}, {"hot": 5000, **{f"s{i}": 1 + i % 3 for i in range(40)}}])
def test_sizes(documents, sizes):
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            # far apart, near each other, and not in order
            rows.append(((i * 7919) % 104729 + (i % 3) * (1 << 40), f"Text {i}", "en", source))
    assert got(manifest.manifest(documents(rows))) == brute(full(rows))


def test_shared_ids(documents):
    rows = [(i // 40, f"T{i % 10}", "en", "s") for i in range(400)] + [(i, "x", "en", "s") for i in range(300)]
    assert got(manifest.manifest(documents(rows))) == brute(full(rows))


def test_positions(documents):
    df = manifest.manifest(documents([(i * 3, "x", "en", f"s{i % 2}") for i in range(100)]))
    for source in ("s0", "s1"):
        mine = sorted((r.doc_id, r.position) for r in df.filter(F.col("source") == source).collect())
        assert [p for _, p in mine] == list(range(50))


def test_only_changed_texts_fail(documents):
    rows = manifest.manifest(documents([(i, "Upper" if i % 2 else "lower", "en", "s") for i in range(200)])).collect()
    assert {r.doc_id for r in rows if not r.verified} == {i for i in range(200) if i % 2 and zlib.crc32(str(i).encode()) % 5 == 0}


def test_empty(documents):
    assert manifest.manifest(documents([])).count() == 0


def test_many_containers(documents, monkeypatch):
    rows = [(i << 17, f"t{i}", "en", "s") for i in range(700)]
    assert got(manifest.manifest(documents(rows))) == brute(full(rows))
