"""Groups on streams that are made by the batch operators: the batch answer, whatever the micro-batches, restarts and repeats."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregate import aggregate, collect_groups, group_rows
from millrace.operators.split import reassemble
from millrace.streaming import batches
from millrace.streaming.batches import OpenTable, aggregate_batches, open_rows, reassemble_batches
from millrace.streaming.runs import run_batches

SCHEMA = "k string, at bigint, payload string"


def rows(seed, n=300):
    draw = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", None]
    return [(draw.choice(keys), i, draw.choice("xyz!")) for i in range(n)]


def frames(spark, all_rows, sizes):
    at = 0
    for n in sizes:
        yield spark.createDataFrame(all_rows[at:at + n], SCHEMA)
        at += n


def listed(df):
    return sorted(((r.k, r.group_no, r.part, r.size, r.closed, tuple(r.payloads)) for r in df.collect()), key=str)


OPTIONS = [{"release_size": 4}, {"release_expr": "payload = '!'"}, {"release_size": 3, "release_expr": "payload = '!'"}]


@pytest.mark.parametrize("options, hot_rows, part_rows, compact_every", [(OPTIONS[0], 20, 3, 2), (OPTIONS[1], None, 1000, 1), (OPTIONS[2], 20, 2, 100)])
def test_any_micro_batches_give_the_batch_answer(spark, tmp_path, options, hot_rows, part_rows, compact_every):
    every = rows(1, 160)
    out, store = str(tmp_path / "out"), str(tmp_path / "store")
    run = aggregate_batches(out, store, "k", "at", part_rows=part_rows, hot_rows=hot_rows, compact_every=compact_every, **options)
    for i, batch in enumerate(frames(spark, every, [80, 7, 73])):
        run(batch, i)
        if i == 1:
            run(batch, i)  # a micro-batch that runs again changes nothing
    want = aggregate(spark.createDataFrame(every, SCHEMA), "k", "at", send_partial=True, part_rows=part_rows, **options)
    got = spark.read.parquet(out).drop("batch")
    assert listed(got) == listed(want.filter("closed"))
    assert listed(collect_groups(open_rows(spark, store, ["k"]), ["k"], part_rows)) == listed(want.filter("not closed"))


def test_a_crash_before_the_version_is_there(spark, tmp_path, monkeypatch):
    every = rows(2, 120)
    out, store = str(tmp_path / "out"), str(tmp_path / "store")
    run = aggregate_batches(out, store, "k", "at", release_size=5, compact_every=2)
    whole = OpenTable.write

    def breaks(self, version, kind="v", **tables):
        # the rows are written, the counters are not
        whole(self, version, kind, **{n: t for n, t in tables.items() if n != "counters"}, counters=1 / 0)

    for i, batch in enumerate(frames(spark, every, [60, 60])):
        for method in ("write", "compact") if i else ():
            with monkeypatch.context() as patch:
                patch.setattr(OpenTable, method, breaks if method == "write" else lambda *a: 1 / 0)
                try:
                    run(batch, i)
                except ZeroDivisionError:
                    pass
        run(batch, i)
    want = aggregate(spark.createDataFrame(every, SCHEMA), "k", "at", release_size=5)
    assert listed(spark.read.parquet(out).drop("batch")) == listed(want)


def test_a_hot_key_is_spread_and_its_messages_written_once(spark, tmp_path):
    # one key, no group ever closes: every version has the new messages only
    out, store = str(tmp_path / "out"), str(tmp_path / "store")
    run = aggregate_batches(out, store, "k", "at", release_expr="payload = '!'", hot_rows=500, part_rows=100)
    for i in range(3):
        run(spark.range(i * 4000, (i + 1) * 4000).selectExpr("'hot' as k", "id as at", "cast(id as string) as payload"), i)
        assert spark.read.parquet(f"{store}/tail/v={i}").count() == 4000
    assert spark.read.parquet(out).count() == 0
    run(spark.createDataFrame([("hot", 99_999, "!")], SCHEMA), 3)
    lists = spark.read.parquet(out).orderBy("part").collect()
    assert [r.size for r in lists] == [100] * 120 + [1] and [int(p) for r in lists[:-1] for p in r.payloads] == list(range(12_000))
    assert open_rows(spark, store, ["k"]).count() == 0


def test_no_task_has_a_whole_hot_key(spark):
    df = spark.range(20_000).selectExpr("'hot' as k", "id as at", "id as payload")
    numbered = group_rows(df, "k", "at", release_size=10, hot_rows=1000)
    per_task = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= 6000 and numbered.filter("closed").count() == 20_000


def test_old_versions_go(spark, tmp_path):
    store = str(tmp_path / "store")
    run = aggregate_batches(str(tmp_path / "out"), store, "k", "at", release_size=1000, compact_every=2)
    for i, batch in enumerate(frames(spark, rows(3), [30] * 5)):
        run(batch, i)
    names = {p.name for p in (tmp_path / "store" / "tail").iterdir()}
    assert names == {"base=1", "v=2", "v=3", "base=3", "v=4"}
    assert open_rows(spark, store, ["k"]).count() == 150


def test_followed_folder_and_restart(spark, sf, tmp_path):
    src, out, store, check = (str(tmp_path / n) for n in ("in", "out", "store", "check"))
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "event_type")
    for half in (events.filter("event_id < 600"), events.filter("event_id >= 600")):
        half.write.mode("append").parquet(src)
        run_batches(spark.readStream.schema(events.schema).parquet(src), aggregate_batches(out, store, "event_type", "event_id", 7, payload="event_id"), check)
    show = lambda df: sorted((r.event_type, r.group_no, tuple(r.payloads)) for r in df.collect())
    assert show(spark.read.parquet(out)) == show(aggregate(events, "event_type", "event_id", 7, payload="event_id"))


PIECES = "correlation_id string, sequence_number int, sequence_size int, payload string"


def pieces(seed):
    draw = random.Random(seed)
    sizes = {f"g{i}": draw.choice([1, 2, 3, 70, 130]) for i in range(30)}
    out = [(c, n, size, f"{c}/{n}") for c, size in sizes.items() for n in range(1, size + 1) if draw.random() > 0.002]
    out += draw.sample(out, 40)
    draw.shuffle(out)
    return out + [(None, 1, 1, "x"), ("bad", 0, 3, "x"), ("bad", 4, 3, "x")]


@pytest.mark.parametrize("part_rows, compact_every", [(50, 2)])
def test_reassembly_over_micro_batches(spark, tmp_path, part_rows, compact_every):
    every = pieces(4)
    out = str(tmp_path / "out")
    run = reassemble_batches(out, str(tmp_path / "store"), part_rows=part_rows, compact_every=compact_every)
    step = len(every) // 3 + 1
    for i in range(3):
        batch = spark.createDataFrame(every[i * step:(i + 1) * step], PIECES)
        run(batch, i)
        if i == 1:
            run(batch, i)
    groups = {}
    for c, n, size, p in every:
        if c and 1 <= n <= size:
            groups.setdefault((c, size), {})[n] = p
    want = {c: [p for _, p in sorted(g.items())] for (c, size), g in groups.items() if len(g) == size}
    got = {}
    for r in spark.read.parquet(out).orderBy("correlation", "part").collect():
        assert len(r.payloads) <= part_rows
        got.setdefault(r.correlation, []).extend(r.payloads)
    # repeats that come after their group was written may make small groups whole a second time
    assert got.keys() == want.keys() and all(got[c][:len(p)] == p for c, p in want.items())


def test_payloads_are_read_back_only_for_whole_groups(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    run = reassemble_batches(str(tmp_path / "out"), store, part_rows=100)
    for i in range(3):
        run(spark.range(i * 1000 + 1, (i + 1) * 1000 + 1).selectExpr("'g' as correlation_id", "id as sequence_number", "3000 as sequence_size", "cast(id as string) as payload"), i)
        held = spark.read.parquet(f"{store}/tail/v={i}").count()
        assert held == (0 if i == 2 else 1000)
    lists = spark.read.parquet(str(tmp_path / "out")).orderBy("part").collect()
    assert [int(p) for r in lists for p in r.payloads] == list(range(1, 3001)) and len(lists) == 30


def test_a_large_group_in_parts(spark):
    df = spark.range(1, 1_000_001).selectExpr("'g' as correlation_id", "id as sequence_number", "1000000 as sequence_size", "id as payload")
    gone = df.withColumn("correlation_id", F.lit("h")).filter("sequence_number <> 77")
    parts = reassemble(df.unionByName(gone), part_rows=10_000)
    assert [tuple(r) for r in parts.groupBy("correlation").agg(F.count("*"), F.sum(F.size("payloads")), F.max(F.size("payloads"))).collect()] == [("g", 100, 1_000_000, 10_000)]


def test_payloads_shuffle_once(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey as correlation_id", "l_linenumber as sequence_number", "7 as sequence_size", "l_returnflag as payload")
    text = reassemble(lines)._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in text.splitlines() if "REPARTITION" in line) == 1
    exchanges = [line for line in text.splitlines() if "Exchange" in line]
    assert sum("correlation" in line and "part" in line and "REPARTITION" in line for line in exchanges) == 1


def test_maps_as_payloads(spark):
    df = spark.range(4).selectExpr("'g' as correlation_id", "4 - id as sequence_number", "4 as sequence_size", "map('n', id) as payload")
    assert [r.payloads for r in reassemble(df).collect()] == [[{"n": 3}, {"n": 2}, {"n": 1}, {"n": 0}]]


def test_wrong_use(spark):
    with pytest.raises(ValueError):
        group_rows(spark.createDataFrame([], SCHEMA), "k", "at")
    with pytest.raises(ValueError):
        group_rows(spark.createDataFrame([], SCHEMA), "k", None, release_size=2)
    assert batches.COMPACT_EVERY > 1
