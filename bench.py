"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then RUNS times into the ``noop`` sink, its input
read from parquet every time; the figure is the median.  ``BENCH_SF_DIR``, ``BENCH_CPUS``
and ``BENCH_RUNS`` override the defaults.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from millrace.messages import decode_text  # noqa: E402
from millrace.operators.aggregate import aggregate  # noqa: E402
from millrace.operators.basic import filter_messages  # noqa: E402
from millrace.operators.bulk import parse_lines  # noqa: E402
from millrace.operators.headers import enrich_headers  # noqa: E402
from millrace.operators.meters import MEBIBYTE, counter, metric_lines, throughput  # noqa: E402
from millrace.operators.route import route  # noqa: E402
from millrace.operators.split import reassemble, split_messages  # noqa: E402
from millrace.plans.queries.registry import event_messages, table  # noqa: E402
from millrace.session import build_session  # noqa: E402
from millrace.sources.generate import fill_payload, generate_messages  # noqa: E402

GENERATED = 1_000_000


def b1_filter_enrich_count(spark, sf):
    m = filter_messages(decode_text(event_messages(spark, sf)), "headers['type'] <> 'view'")
    m = enrich_headers(m, {"k": "get_json_object(text, '$.k')"})
    return counter(m, "activity", {"type": "headers['type']", "k": "headers['k']"}, "length(text)")


def b2_split_reassemble(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("payload"))
    return reassemble(split_messages(docs, delimiter="\n", correlation="doc_id"), unique=True)


def b3_groups_by_count(spark, sf):
    return aggregate(table(spark, sf, "events"), "event_type", ["ts", "event_id"], release_size=3, payload="props")


def b4_bulk_load(spark, sf):
    orders = table(spark, sf, "orders")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", F.concat(F.lit('"'), "o_orderpriority", F.lit('"')))
    bad = F.pmod(F.xxhash64("o_orderkey"), F.lit(100)) == 0
    lines = orders.select(F.when(bad, F.lit("GARBAGE")).otherwise(line).alias("payload"))
    return parse_lines(lines, ("id", "customer", "priority"), "csv")


def b5_route(spark, sf):
    mappings = {"error": "alerts", "purchase": "sales", "signup": "users", "view": "traffic", "click": "traffic2"}
    return route(decode_text(event_messages(spark, sf)), "headers['type']", mappings, default="other")


def b6_metric_lines(spark, sf):
    lines = table(spark, sf, "lineitem")
    return metric_lines(lines, "price", "l_extendedprice", "unix_millis(cast(l_shipdate as timestamp))", "shop", {"flag": "l_returnflag", "status": "l_linestatus"}).select("payload")


def b7_generate_and_measure(spark, sf):
    load = generate_messages(spark, producers=8, count=GENERATED // 8, size=1000)
    at = F.timestamp_seconds(F.floor(F.col("sequence_number") / 10_000))
    # The payload begins with the message's own number, so that it has to be built.
    filled = load.withColumn("payload", fill_payload(F.concat(F.col("producer").cast("string"), F.lit(":"), F.col("sequence_number").cast("string")), 1000))
    return throughput(filled.withColumn("ts", at), "ts", "10 seconds")


# query: (function, input rows, input bytes as a message payload)
BENCHES = {
    "b1_filter_enrich_count": (b1_filter_enrich_count, "events", "props"),
    "b2_split_reassemble": (b2_split_reassemble, "documents", "text"),
    "b3_groups_by_count": (b3_groups_by_count, "events", "props"),
    "b4_bulk_load": (b4_bulk_load, "orders", "o_orderpriority"),
    "b5_route": (b5_route, "events", "props"),
    "b6_metric_lines": (b6_metric_lines, "lineitem", "l_returnflag"),
    "b7_generate_and_measure": (b7_generate_and_measure, None, None),
}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session("bench", cpus=cpus, shuffle_partitions=8)
    seconds, rates = {}, {}
    for name, (fn, source, payload) in BENCHES.items():
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
        if source is None:
            rows, size = GENERATED, GENERATED * 1000
        else:
            row = table(spark, sf, source).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(payload)).alias("b")).first()
            rows, size = row.n, row.b
        rates[name] = {"rows_per_s": round(rows / seconds[name]), "payload_mb_per_s": round(size / MEBIBYTE / seconds[name], 2)}
    spark.stop()
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(seconds.values()), 4), "unit": "sec",
        "queries": seconds, "rates": rates, "sf": sf.rstrip("/").rsplit("/", 1)[-1].removeprefix("sf"), "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
