"""Message pipelines on Spark DataFrames: read, decode, filter, split, group, route, load, measure."""

from millrace.functions.expressions import is_object, json_path, load_variables
from millrace.messages import decode_json, decode_text, normalise_content_type, to_messages
from millrace.operators.aggregate import aggregate, collect_groups, group_rows
from millrace.operators.basic import bridge, filter_messages, to_request_json, transform_payload
from millrace.operators.bulk import bulk_load, parse_lines
from millrace.operators.entities import json_entities
from millrace.operators.headers import enrich_headers, filter_headers
from millrace.operators.lists import push_batches, push_list
from millrace.operators.lookup import enrich_lookup, with_request
from millrace.operators.meters import counter, gauge, metric_lines, throughput, watched
from millrace.operators.numbering import number_rows
from millrace.operators.posts import closest, dedup_recent, filter_any, search, stable_sample, trending
from millrace.operators.route import route
from millrace.operators.scripts import apply_udf
from millrace.operators.split import reassemble, split_messages
from millrace.plans.compose import compose, compose_named
from millrace.session import release
from millrace.sinks.broker import publish, to_broker
from millrace.sinks.files import write_routed, write_text
from millrace.sinks.tables import load_lines, once_per_batch, table_rows, write_bulk, write_table
from millrace.sinks.upsert import read_documents, upsert
from millrace.sources.changes import read_changes, row_json, unwrap_changes
from millrace.sources.files import line_messages, number_lines, read_files, stream_files
from millrace.sources.generate import generate_messages, generate_stream, tick_stream, time_spine, zero_fill
from millrace.sources.syslog import parse_syslog
from millrace.sources.tables import TablePoller, poll_chunks, read_table, row_lists, unconsumed
from millrace.sources.topics import read_topic, topic_messages
from millrace.streaming.aggregate import aggregate_stream, open_groups, reassemble_stream
from millrace.streaming.batches import aggregate_batches, open_rows, reassemble_batches
from millrace.streaming.runs import run_available, run_batches, use_rocksdb

__all__ = [name for name in dir() if not name.startswith("_") and name not in {
    "functions", "messages", "operators", "plans", "session", "sinks", "sources", "streaming",
}]
