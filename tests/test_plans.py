"""The plans Spark makes of the operators."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregate import aggregate
from millrace.operators.basic import filter_messages
from millrace.operators.meters import counter, gauge
from millrace.operators.numbering import number_rows
from millrace.operators.posts import search, trending
from millrace.operators.split import reassemble, split_messages
from millrace.plans.queries import QUERIES
from millrace.plans.queries.registry import event_messages, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_reaches_the_scan(spark, sf):
    text = plan(filter_messages(event_messages(spark, sf), "headers['type'] = 'view' and value > 5").select("event_id"))
    assert "EqualTo(event_type,view)" in text and "GreaterThan(value,5.0)" in text
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text.replace("ts:timestamp_ntz,", "")


def test_one_shuffle_each(spark, sf):
    events = table(spark, sf, "events")
    assert plan(counter(event_messages(spark, sf), "c", {"t": "headers['type']"})).count("Exchange") == 1
    assert plan(gauge(events, "c", {"t": "event_type"}, "value", ["ts", "event_id"])).count("Exchange") == 1
    # the shuffle that numbers the rows also serves the grouping
    assert plan(aggregate(events, "event_type", "event_id", release_size=3, payload="props")).count("Exchange") == 1
    assert plan(number_rows(events, ["user_id"], "event_id")).count("Exchange") == 1


def test_counters_combine_before_the_shuffle(spark, sf):
    text = plan(counter(event_messages(spark, sf), "c", {"t": "headers['type']"}))
    assert text.index("partial_sum") > text.index("Exchange")


def test_trending_keeps_k_rows_per_task(spark, sf):
    assert "WindowGroupLimit" in plan(trending(table(spark, sf, "events"), "event_type", "ts", "1 day", 3))


def test_search_takes_the_top_only(spark, sf):
    assert "TakeOrderedAndProject" in plan(search(table(spark, sf, "documents"), "the", order=["doc_id"]).select("doc_id", "page"))


def test_split_carries_no_array(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("payload"))
    split = split_messages(docs, delimiter="\n", correlation="doc_id")
    text = plan(split)
    generate = next(line for line in text.splitlines() if "Generate posexplode" in line)
    assert "_mr_pieces" not in generate.split("[", 1)[1].split("]")[0]
    assert text.count("split(") == 1
    assert "Exchange" not in text
    assert plan(reassemble(split, unique=True)).count("Sort ") == 0


@pytest.mark.parametrize("name, parser, times", [
    ("changes_with_delete_marks", "from_json(", 1), ("bulk_load_csv", "regexp_extract_all(", 1), ("bulk_load_errors", "regexp_extract_all(", 1),
    # the fields of a line, and the escapes of a field
    ("bulk_load_text", "regexp_extract_all(", 2),
    ("json_lists_to_rows", "from_json(", 1), ("json_lists_errors", "from_json(", 1), ("decode_json_payloads", "from_json(", 1),
])
def test_text_is_parsed_once(spark, sf, name, parser, times):
    df = QUERIES[name](spark, sf)
    # also under a filter on what was parsed
    assert plan(df.filter(F.coalesce(*[F.col(c).cast("string") for c in df.columns]) != "x")).count(parser) == times


# The queries that store an intermediate result or run a stream cannot be looked at as one plan.
STORED = {n for n in QUERIES if n.startswith(("stream_", "file_", "records_", "followed", "write_", "upsert", "text_files", "objects", "bulk_load_into", "committed", "empty_files"))}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_row_at_a_time_code_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name == "user_code")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
