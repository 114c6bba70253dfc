"""Randomised cases against brute force in plain Python."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregate import aggregate
from millrace.operators.bulk import bulk_load
from millrace.operators.split import reassemble


@pytest.mark.parametrize("seed", [1, 2])
def test_csv_lines_as_written_by_another_program(spark, seed):
    rng = random.Random(seed)
    alphabet = ["a", "é", '"', ",", "|", " ", "'", "\\", "null", "NULL", ""]
    rows = [[str(i)] + ["".join(rng.choices(alphabet, k=rng.randint(0, 4))) for _ in range(3)] for i in range(400)]
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(row)
        lines.append(out.getvalue())
    df = spark.createDataFrame([(x,) for x in lines], "payload string")
    for null_string in (None, "null"):
        good, bad = bulk_load(df, "t", ("i", "a", "b", "c"), "csv", null_string=null_string)
        assert sorted(list(r) for r in good.collect()) == sorted(rows)
        assert bad.count() == 0


def _copy_text(value):
    """A value as the text format writes it."""
    if value is None:
        return "\\N"
    for char, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\r", "\\r"), ("\b", "\\b"), ("|", "\\|")):
        value = value.replace(char, escaped)
    return value


def test_text_lines_as_written_by_a_database(spark):
    rng = random.Random(3)
    alphabet = ["a", "\\", "\t", "N", "|", "n", "\b", "", "x"]
    values = lambda: None if rng.random() < 0.2 else "".join(rng.choices(alphabet, k=rng.randint(0, 5)))
    rows = [(str(i), values(), values()) for i in range(400)]
    for delimiter in ("\t", "|"):
        df = spark.createDataFrame([(delimiter.join(_copy_text(v) for v in r),) for r in rows], "payload string")
        good, bad = bulk_load(df, "t", ("i", "a", "b"), "text", delimiter=delimiter)
        assert {r.i: (r.a, r.b) for r in good.collect()} == {i: (a, b) for i, a, b in rows}
        assert bad.count() == 0


def _groups(rows, size, closes):
    """(key, group, messages, closed) of rows in arrival order."""
    open_, number, out = {}, {}, []
    for key, _, payload in rows:
        open_.setdefault(key, []).append(payload)
        if len(open_[key]) == size if size else closes(payload):
            out.append((key, number.get(key, 0), tuple(open_.pop(key)), True))
            number[key] = number.get(key, 0) + 1
    return out + [(k, number.get(k, 0), tuple(v), False) for k, v in open_.items()]


@pytest.mark.parametrize("options", [{"release_size": 4}, {"release_expr": "payload % 10 = 0"}])
@pytest.mark.parametrize("hot_rows, part_rows", [(10**6, 1000), (60, 3)])
def test_groups_with_a_hot_key(spark, options, hot_rows, part_rows):
    rng = random.Random(7)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, None]), i // 3, i) for i in range(900)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "k int, at int, payload int").repartition(5)
    got = {}
    out = aggregate(df, "k", ["at", "payload"], send_partial=True, hot_rows=hot_rows, part_rows=part_rows, **options)
    for r in out.orderBy("k", "group_no", "part").collect():
        assert len(r.payloads) == r.size <= part_rows
        got.setdefault((r.k, r.group_no, r.closed), []).extend(r.payloads)
    want = _groups(rows, options.get("release_size"), lambda p: p % 10 == 0)
    assert {(k, n, c): list(p) for k, n, p, c in want} == got


@pytest.mark.parametrize("part_rows", [1000, 5])
def test_reassembly_with_losses_and_repeats(spark, part_rows):
    rng = random.Random(11)
    sizes = {g: rng.randint(1, 12) for g in range(60)} | {"hot": 300, "broken": 2}
    rows = [(str(g), i, n, f"{g}/{i}") for g, n in sizes.items() for i in range(1, n + 1) if g != "broken"]
    lost = {rows[i][:2] for i in rng.sample(range(60), 5)}
    rows = [r for r in rows if r[:2] not in lost]
    rows += rng.choices(rows, k=80) + [("broken", 1, 2, f"x{i}") for i in range(500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "correlation_id string, sequence_number int, sequence_size int, payload string").repartition(4)
    got = {}
    for r in reassemble(df, part_rows=part_rows).orderBy("correlation", "part").collect():
        assert len(r.payloads) <= part_rows
        got.setdefault(r.correlation, []).extend(r.payloads)
    gone = {g for g, _ in lost} | {"broken"}
    assert got == {str(g): [f"{g}/{i}" for i in range(1, n + 1)] for g, n in sizes.items() if str(g) not in gone}
    once = df.groupBy("correlation_id", "sequence_number").agg(F.max("sequence_size").alias("sequence_size"), F.min("payload").alias("payload"))
    assert reassemble(once, part_rows=part_rows, unique=True).count() == reassemble(df, part_rows=part_rows).count()
