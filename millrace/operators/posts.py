"""Dedup, filter, sample, search and rank posts or other timed messages."""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.geo import box_around, distance_km, in_box
from millrace.messages import as_column


def dedup_recent(df: DataFrame, id: str, ts: str, horizon: str = "30 days", now: Column | str | None = None, ordered: bool = True) -> DataFrame:
    """Messages of the last ``horizon``, each id once (its earliest copy), newest first; those without an id all stay.

    ``now`` defaults to the current time.  On a stream the horizon becomes the watermark
    and the order is that of arrival.
    """
    if df.isStreaming:
        marked = df.withWatermark(ts, horizon)
        return marked.filter(F.col(id).isNotNull()).dropDuplicatesWithinWatermark([id]).unionByName(marked.filter(F.col(id).isNull()))
    kind = df.schema[ts].dataType.simpleString()
    at = F.current_timestamp() if now is None else as_column(now)
    recent = df.filter(F.col(ts) >= (at.cast(kind) - F.expr(f"interval {horizon}")))
    # Messages without an id have nothing in common: all of them stay.
    nameless, recent = recent.filter(F.col(id).isNull()), recent.filter(F.col(id).isNotNull())
    rest = [c for c in df.columns if c != id]
    # Copies fold to the earliest one before the shuffle.  A hash settles ties; maps and variants cannot be hashed.
    hashable = [c for c in rest if df.schema[c].dataType.typeName() not in ("map", "variant")]
    once = recent.groupBy(id).agg(F.min_by(F.struct(*rest), F.struct(ts, F.xxhash64(*hashable))).alias("m"))
    out = once.select(*[F.col(c) if c == id else F.col(f"m.{c}") for c in df.columns])
    out = out.unionByName(nameless)
    return out.orderBy(F.col(ts).desc(), F.col(id).desc()) if ordered else out


# The characters of a word.
WORD = r"\p{L}\p{N}_#@"


def has_word(text: str | Column, any_of: Sequence[str]) -> Column:
    """Does any of the words occur in the text, as a whole word and in any case?

    One pattern for any number of words; words that begin alike share their beginning in it, so its
    cost follows the text and not the length of the list.
    """
    return F.lower(text).rlike(f"(?<![{WORD}])(?:{_any_of([w.lower() for w in any_of])})(?![{WORD}])")


#: Beginnings within beginnings, to which the tree of a pattern goes; deeper texts are listed.
MAX_NESTED = 100


def _any_of(choices: Sequence[str], nested: int = 0) -> str:
    """A pattern for any of the texts, as a tree of their beginnings."""
    choices = sorted(set(choices))
    start = os.path.commonprefix(choices)
    rest = [text[len(start):] for text in choices]
    if rest == [""]:
        return re.escape(start)
    if nested > MAX_NESTED:
        return re.escape(start) + "(?:" + "|".join(re.escape(r) for r in sorted(rest, key=len, reverse=True)) + ")"
    branches = [_any_of(list(same), nested + 1) for first, same in itertools.groupby(rest, key=lambda r: r[:1]) if first]
    return re.escape(start) + "(?:" + "|".join(branches) + ")" + ("?" if "" in rest else "")


def filter_any(
    df: DataFrame,
    text: str | None = None,
    track: Sequence[str] = (),
    user: str | None = None,
    follow: Sequence = (),
    lat: str | None = None,
    lon: str | None = None,
    boxes: Sequence[tuple[float, float, float, float]] = (),
) -> DataFrame:
    """Rows that match any keyword, any user or any box; no criteria at all keeps everything.

    A keyword of several words matches when all of them occur.
    """
    tests = []
    singles = [t for t in track if len(t.split()) == 1]
    if singles:
        tests.append(has_word(text, singles))
    for phrase in (t for t in track if len(t.split()) > 1):
        tests.append(reduce(and_, [has_word(text, [w]) for w in phrase.split()]))
    if follow:
        tests.append(F.col(user).isin(list(follow)))
    tests += [in_box(F.col(lat), F.col(lon), b) for b in boxes]
    if not tests:
        return df
    return df.filter(reduce(or_, [F.coalesce(t, F.lit(False)) for t in tests]))


def stable_sample(df: DataFrame, id: str | Sequence[str], percent: float) -> DataFrame:
    """A sample that depends on the id only, so every reader gets the same rows.

    The first 15 hex digits of the id's MD5 (several ids: their texts on end, each with its length before) as a number,
    compared with that share of the numbers there are; any percentage is met, and other engines can draw the same.
    """
    ids = [F.coalesce(F.col(i).cast("string"), F.lit("")) for i in ([id] if isinstance(id, str) else id)]
    text = ids[0] if len(ids) == 1 else F.concat(*[part for i in ids for part in (F.length(i).cast("string"), F.lit(":"), i)])
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return df.filter(number < int(Fraction(str(percent)) / 100 * 2**60))


def search(
    df: DataFrame,
    query: str | Column | None = None,
    text: str = "text",
    lang: str | None = None,
    since: str | Column | None = None,
    ts: str = "ts",
    lat: str | None = None,
    lon: str | None = None,
    near: tuple[float, float, float] | None = None,
    order=(),
    count: int = 100,
    page: int = 1,
) -> DataFrame:
    """The first ``page`` pages of ``count`` matches, in a total order, numbered in ``page``.

    A text ``query`` must contain each of its words; a column is used as it is.
    ``near`` is (latitude, longitude, radius in km).  ``order`` stands for the result
    type: newest first or most popular first.
    """
    if not order:
        raise ValueError("paging needs a total order")
    if isinstance(query, str):
        for word in query.lower().split():
            df = df.filter(F.contains(F.lower(text), F.lit(word)))
    elif query is not None:
        df = df.filter(query)
    if lang is not None:
        df = df.filter(F.col("lang") == lang)
    if since is not None:
        df = df.filter(F.col(ts) >= as_column(since))
    if near is not None:
        df = within(df, lat, lon, near)
    top = df.orderBy(*order).limit(count * page)
    # At most count * page rows reach this window.
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return top.withColumn("page", F.floor((rank - 1) / count) + 1)


def within(df: DataFrame, lat: str, lon: str, near: tuple[float, float, float]) -> DataFrame:
    """Rows inside a circle (latitude, longitude, radius in km)."""
    at_lat, at_lon, radius = near
    away = distance_km(F.col(lat), F.col(lon), F.lit(float(at_lat)), F.lit(float(at_lon)))
    return df.filter(box_around(F.col(lat), at_lat, radius)).filter(away <= radius)


def trending(
    df: DataFrame,
    topic: str,
    ts: str,
    window: str,
    k: int,
    lat: str | None = None,
    lon: str | None = None,
    near: tuple[float, float, float] | None = None,
) -> DataFrame:
    """The ``k`` most frequent topics per time window, ties by topic name.

    ``near`` (latitude, longitude, radius in km) keeps to the posts around a place.

    Counts shrink to one row per window and topic before ranking, and Spark keeps only k
    rows per window and task ahead of the ranking shuffle.
    """
    if near is not None:
        df = within(df, lat, lon, near)
    counts = df.groupBy(F.window(F.col(ts), window).alias("w"), F.col(topic).alias("topic")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.col("w.start").alias("window_start"), "topic", "n")
    by_rank = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col("topic"))
    return counts.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)


def closest(df: DataFrame, lat: str, lon: str, at: tuple[float, float], k: int, tie: str) -> DataFrame:
    """The ``k`` places nearest to a point, with ``distance_km``."""
    away = distance_km(F.col(lat), F.col(lon), F.lit(float(at[0])), F.lit(float(at[1])))
    return df.withColumn("distance_km", away).orderBy("distance_km", tie).limit(k)
