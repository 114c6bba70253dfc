"""Syslog lines as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import compute_once

# The two line formats; a priority is at most 191.  Repetitions that may be long are possessive, which Java
# runs in a loop: a greedy one calls itself for each step and exhausts the stack.
RFC3164 = r"^<(\d{1,2}|1[0-8]\d|19[01])>([A-Za-z]{3} [ \d]\d \d{2}:\d{2}:\d{2}) (\S+) ([^\s:\[]+)(?:\[([^\]]*)\])?: ?([\s\S]*)$"
RFC5424 = r"^<(\d{1,2}|1[0-8]\d|19[01])>(\d{1,2}) (\S++) (\S++) (\S++) (\S++) (\S++) (-|(?:\[[^\]\\]*+(?:\\[\s\S][^\]\\]*+)*+\])++)(?: ([\s\S]*+))?$"

# The number of groups in each.
OLD, NEW = 6, 9


def parse_syslog(df: DataFrame, column: str = "payload") -> DataFrame:
    """Add the fields of RFC 3164 and RFC 5424 lines; ``undecoded`` keeps any other line."""
    line = F.col(column)
    # All groups of a format come out of one replacement; their number tells the format.
    found = F.when(line.rlike(RFC5424), _groups(line, RFC5424, NEW)).when(line.rlike(RFC3164), _groups(line, RFC3164, OLD))
    df = compute_once(df, "_mr_groups", found)
    groups = F.col("_mr_groups")
    is_new = F.size(groups) == NEW

    def at(n: int | None, o: int | None):
        """The n-th group of the newer format, or the o-th of the older."""
        new = F.get(groups, n - 1) if n else F.lit(None).cast("string")
        return F.when(is_new, new).otherwise(F.get(groups, o - 1) if o else F.lit(None).cast("string"))

    def pick(n: int | None, o: int | None):
        value = at(n, o)
        return F.when(~value.isin("", "-"), value)

    pri = pick(1, 1).cast("int")
    out = df.withColumns({
        "facility": F.floor(pri / 8).cast("int"),
        "severity": pri % 8,
        "version": pick(2, None).cast("int"),
        "timestamp_text": pick(3, 2),
        "host": pick(4, 3),
        "app": pick(5, 4),
        "proc_id": pick(6, 5),
        "msg_id": pick(7, None),
        "structured_data": pick(8, None),
        "message": at(NEW, OLD),
        "undecoded": F.when(groups.isNull(), line),
    })
    return out.drop("_mr_groups")


def _groups(line: Column, pattern: str, count: int) -> Column:
    """The groups of a match.  A separator in the line itself is escaped on the way."""
    joined = "\x1e".join(f"${i}" for i in range(1, count + 1))
    safe = F.replace(F.replace(line, F.lit("\x1d"), F.lit("\x1d0")), F.lit("\x1e"), F.lit("\x1d1"))
    parts = F.split(F.regexp_replace(safe, pattern, joined), "\x1e", count)
    return F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\x1d1"), F.lit("\x1e")), F.lit("\x1d0"), F.lit("\x1d")))
