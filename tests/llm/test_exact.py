import hashlib
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import exact


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return Counter(out)


def test_odd_rows(documents, odd_rows):
    got = exact.mark_copies(documents(odd_rows))
    assert Counter(map(tuple, got.collect())) == brute(odd_rows)


def test_many_groups(documents):
    rows = [(i, f"text {i % 700}" if i % 3 else "hot") for i in range(6000)]
    assert Counter(map(tuple, exact.mark_copies(documents(rows)).collect())) == brute(rows)


def test_hot_groups_take_the_broadcast_path(documents, monkeypatch):
    rows = [(i, "hot" if i % 2 else f"cold {i // 4}") for i in range(4000)]
    assert Counter(map(tuple, exact.mark_copies(documents(rows)).collect())) == brute(rows)


def test_a_full_filter_changes_nothing(documents, monkeypatch):
    monkeypatch.setattr(exact, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(exact, "BITS_PER_ROW", 1)
    rows = [(i, f"t{i % 9000}") for i in range(12000)]
    assert Counter(map(tuple, exact.mark_copies(documents(rows)).collect())) == brute(rows)


def test_empty_table(documents):
    assert exact.mark_copies(documents([])).count() == 0
    assert exact.drop_copies(documents([])).count() == 0


def test_drop(documents, odd_rows):
    docs = documents(odd_rows)
    got = exact.drop_copies(docs)
    assert got.dtypes == docs.dtypes
    assert got.count() == len({t or "" for _, t in odd_rows})
    assert {r["doc_id"] for r in got.filter(F.col("text") == "same text").collect()} == {5}


def test_native_and_only_candidates_shuffle(documents):
    plan = exact.mark_copies(documents([(i, str(i)) for i in range(100)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
