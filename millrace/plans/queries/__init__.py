"""Example queries: every operator on the test tables, most with the same result stated in SQL."""

from millrace.plans.queries import batch, files, groups, loads, posts, sources, streams  # noqa: F401
from millrace.plans.queries.registry import ORACLES, QUERIES  # noqa: F401
