import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace import session
from millrace.operators.numbering import mark_rows, number_rows


def _events(spark, sf):
    # two thirds of the rows under one key, some under a NULL key
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts", "event_type")
    k = F.when(F.col("event_id") % 3 < 2, F.lit(1)).when(F.col("event_id") % 30 == 5, F.lit(None)).otherwise(F.col("event_id") % 7)
    return e.withColumn("k", k)


@pytest.mark.parametrize("hot_rows", [10**6, 100, 7])
def test_number_rows_equals_plain_window(spark, sf, hot_rows):
    df = _events(spark, sf)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "event_id")).cast("long"))
    got = number_rows(df, ["k"], ["ts", "event_id"], hot_rows=hot_rows)
    assert got.count() == df.count()
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_number_rows_of_the_whole_frame(spark, sf):
    df = _events(spark, sf)
    got = number_rows(df, [], [F.col("event_id").desc()], hot_rows=100)
    n = df.count()
    assert got.filter(F.col("rn") != n - F.col("event_id")).count() == 0
    assert got.count() == n


@pytest.mark.parametrize("hot_rows", [10**6, 50])
def test_marks(spark, sf, hot_rows):
    df = _events(spark, sf)
    mark = F.col("event_type") == "purchase"
    got = mark_rows(df, ["k"], ["ts", "event_id"], mark, hot_rows=hot_rows)
    rows = sorted(got.collect(), key=lambda r: (r.k is None, r.k or 0, r.ts, r.event_id))
    state = {}
    totals = {}
    for r in rows:
        totals[r.k] = totals.get(r.k, 0) + (r.event_type == "purchase")
    for r in rows:
        rn, seen, last = state.get(r.k, (0, 0, 0))
        rn += 1
        assert (r.rn, r.marks_before, r.last_mark, r.marks) == (rn, seen, last, totals[r.k])
        state[r.k] = (rn, seen + 1, rn) if r.event_type == "purchase" else (rn, seen, last)


def test_stored_rows_can_be_released(spark, sf):
    number_rows(_events(spark, sf), ["k"], ["ts", "event_id"], hot_rows=100).count()
    stored = list(session._written)
    assert stored and all(os.path.exists(p.removeprefix("file:")) for p in stored)
    session.release(spark)
    assert not session._written and not any(os.path.exists(p.removeprefix("file:")) for p in stored)


def test_order_is_mandatory(spark, sf):
    with pytest.raises(ValueError):
        number_rows(_events(spark, sf), ["k"], None)


def test_hot_keys_come_from_one_pass_over_the_keys(spark, sf, tmp_path):
    _events(spark, sf).withColumn("wide", F.lit("x")).write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    text = number_rows(df, ["k"], ["ts", "event_id"], hot_rows=100)._jdf.queryExecution().executedPlan().toString()
    # the cold half reads the input once more, the hot half what was stored of it; no join looks for hot keys
    reads = [line for line in text.splitlines() if "FileScan" in line]
    assert sum("/e]" in line for line in reads) == 1 and any("numbered" in line for line in reads)
    assert "LeftAnti" not in text and "LeftSemi" not in text
    none = number_rows(df, ["k"], ["ts", "event_id"])._jdf.queryExecution().executedPlan().toString()
    assert none.count("FileScan") == 1 and none.count("Exchange") == 1


@pytest.mark.parametrize("hot_rows", [10**6, 3])
def test_zeros_of_both_signs_are_one_key(spark, hot_rows):
    df = spark.range(40).selectExpr("case when id % 2 = 0 then 0.0D else -0.0D end as k", "id", "if(id % 3 = 0, null, 'é') as t")
    assert sorted(r.rn for r in number_rows(df, ["k"], "id", hot_rows=hot_rows).collect()) == list(range(1, 41))
    by_text = number_rows(df, ["k", "t"], "id", hot_rows=hot_rows, total="n").collect()
    assert sorted((r.n, r.rn) for r in by_text) == [(n, i) for n in (14, 26) for i in range(1, n + 1)]
