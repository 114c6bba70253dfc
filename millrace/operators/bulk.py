"""K4, K5, K6: delimited lines loaded into a table, bad lines set aside."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import compute_once

# The dialects' defaults.
TEXT_DELIMITER, TEXT_NULL = "\t", "\\N"
CSV_DELIMITER, CSV_QUOTE = ",", '"'
TEXT_ESCAPES = {"b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v"}
ERROR_COLUMNS = ("table_name", "error_message", "payload")
VARCHAR_LENGTH = 2000

def parse_lines(
    df: DataFrame,
    columns: Sequence[str],
    fmt: str = "text",
    delimiter: str | None = None,
    null_string: str | None = None,
    quote: str | None = None,
    escape: str | None = None,
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Rows ``(columns…, error_message, payload)``; a bad line has an error and NULL columns.

    All columns are text unless ``types`` names theirs (``int``, ``varchar(5)``, ``date not null``); a field that its
    type refuses makes the line a bad one. So do a quoted field without an end and escaped bytes that are no UTF-8.

    ``fmt`` is ``text`` (tab, backslash escapes, ``\\N``) or ``csv`` (quotes; an unquoted
    empty field is NULL unless a null string is given).
    """
    if fmt not in ("text", "csv"):
        raise ValueError(f"unknown format {fmt!r}")
    if fmt == "text" and (quote is not None or escape is not None):
        raise ValueError("quote and escape belong to the csv format")
    delimiter = "\t" if delimiter == "\\t" else delimiter
    for name, value in (("delimiter", delimiter), ("quote", quote), ("escape", escape)):
        if value is not None and len(value) != 1:
            raise ValueError(f"{name} must be a single character")
    payload = F.col("payload")
    if isinstance(df.schema["payload"].dataType, T.BinaryType):
        payload = F.decode(payload, "UTF-8")
    lines = df.select(payload.alias("payload"))
    if fmt == "text":
        return _parse_text(lines, columns, delimiter or TEXT_DELIMITER, TEXT_NULL if null_string is None else null_string, types)
    return _parse_csv(lines, columns, delimiter or CSV_DELIMITER, null_string, quote or CSV_QUOTE, escape, types)


def _class(chars: str) -> str:
    """Characters for use inside a pattern's brackets."""
    return "".join("\\" + c if not c.isalnum() and c.isascii() and c.isprintable() else c for c in chars)


def _parse_text(lines: DataFrame, columns, delimiter: str, null_string: str, types) -> DataFrame:
    # A field is a run of other characters and of backslashes with what follows them.  Every one is found behind a delimiter.
    cut = _class(delimiter)
    pattern = rf"(?s){cut}((?:[^\\{cut}]++|\\.|\\\z)*+)"
    escaped = F.transform(
        F.regexp_extract_all(F.concat(F.lit(delimiter), "payload"), F.lit(pattern), 1),
        lambda t: F.when(t != null_string, F.when(F.contains(t, F.lit("\\")), _unescaped_bytes(t)).otherwise(t.cast("binary"))),
    )
    plain = F.transform(F.split("payload", re.escape(delimiter)), lambda t: F.when(t != null_string, t.cast("binary")))
    rows = compute_once(lines, "_mr_f", F.when(F.contains("payload", F.lit("\\")), escaped).otherwise(plain))
    broken = F.exists("_mr_f", lambda t: _broken_text(t.cast("string")))
    return _checked(rows, columns, F.size("_mr_f"), lambda i: F.get("_mr_f", F.lit(i)).cast("string"), F.when(broken, INVALID), types)


INVALID = "invalid byte sequence"


def _broken_text(text: Column) -> Column:
    """Bytes that are no UTF-8, and NUL, which no text column takes."""
    return ~F.is_valid_utf8(text) | F.contains(text, F.lit("\0"))


def _unescaped_bytes(token: Column) -> Column:
    """The bytes of a field of the text format: letters, octal and hex numbers after a backslash, else the character itself."""
    pieces = F.regexp_extract_all(token, F.lit(r"(?s)(\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|\\|[^\\]++)"), 1)

    def piece(p: Column) -> Column:
        rest = F.substr(p, F.lit(2))
        number = F.when(p.rlike(r"^\\x[0-9A-Fa-f]"), F.conv(F.substr(p, F.lit(3)), 16, 10)).when(p.rlike(r"^\\[0-7]"), F.conv(rest, 8, 10))
        letters = F.create_map(*[F.lit(x) for pair in TEXT_ESCAPES.items() for x in pair])
        plain = F.coalesce(F.element_at(letters, rest), F.when(rest == "", "\\").otherwise(rest))
        text = F.when(p.startswith("\\"), plain).otherwise(p)
        return F.when(number.isNotNull(), F.lpad(F.hex(number.cast("int") % 256), 2, "0")).otherwise(F.hex(F.encode(text, "UTF-8")))

    return F.unhex(F.array_join(F.transform(pieces, piece), ""))


def _parse_csv(lines: DataFrame, columns, delimiter: str, null_string: str | None, quote: str, escape: str | None, types) -> DataFrame:
    # A field is made of plain characters and quoted stretches, in any order; quotes go, and inside them the escape character
    # stands for the quote or escape after it.  All repetitions are possessive, so lines of any length are fine.
    escape = escape or quote
    q, e, cut = _class(quote), _class(escape), _class(delimiter)
    inner = rf"(?:[^{q}]++|{q}{q})*+" if escape == quote else rf"(?:[^{q}{e}]++|{e}[{q}{e}]|{e})*+"
    one = rf"(?:[^{q}{cut}]++|{q}{inner}{q})*+"
    marked = F.concat(F.lit(delimiter), F.col("payload"))
    fields = F.when(F.contains("payload", F.lit(quote)), F.regexp_extract_all(marked, F.lit(rf"(?s){cut}({one})"), 1)).otherwise(F.split("payload", re.escape(delimiter)))
    rows = compute_once(lines, "_mr_f", fields)
    # What a quote without an end keeps from being a field is missing in the fields.
    whole = F.length(F.array_join("_mr_f", delimiter)) == F.length("payload")

    def field(i: int) -> Column:
        token = F.get("_mr_f", F.lit(i))
        bare = F.regexp_replace(token, rf"(?s){q}({inner}){q}", "$1")
        value = F.replace(bare, F.lit(quote * 2), F.lit(quote)) if escape == quote else F.regexp_replace(bare, rf"{e}([{q}{e}])", "$1")
        # Most quoted fields are one stretch with nothing special inside.
        middle = F.substr(token, F.lit(2), F.length(token) - 2)
        special = F.contains(middle, F.lit(quote)) if escape == quote else F.contains(middle, F.lit(quote)) | F.contains(middle, F.lit(escape))
        simple = token.startswith(quote) & token.endswith(quote) & (F.length(token) > 1) & ~special
        quoted = F.contains(token, F.lit(quote))
        return F.when(quoted, F.when(simple, middle).otherwise(value)).when(token != (null_string or ""), token)

    broken = F.when(_broken_text(F.col("payload")), INVALID).when(~whole, "unterminated quoted field")
    return _checked(rows, columns, F.size("_mr_f"), field, broken, types)


def _checked(rows: DataFrame, columns, count: Column, field, broken: Column, types) -> DataFrame:
    """The fields, with an error for a broken line, a wrong number of fields, or a field that its type refuses."""
    count = F.coalesce(F.when(F.col("payload").isNotNull(), count), F.lit(0))
    error = F.when(F.col("payload").isNotNull(), broken)
    error = F.coalesce(error, F.when(count < len(columns), "missing data for a column").when(count > len(columns), "extra data after last expected column"))
    rows = rows.withColumns({"error_message": error, **{c: F.when(error.isNull(), field(i)) for i, c in enumerate(columns)}})
    if types is None:
        return rows.select(*columns, "error_message", "payload")
    values = {c: _typed(F.col(c), kind) for c, kind in zip(columns, types, strict=True)}
    errors = [F.when(F.col("error_message").isNull(), e) for _, e in values.values()]
    rows = rows.withColumn("error_message", F.coalesce("error_message", *errors))
    good = F.col("error_message").isNull()
    return rows.select(*[F.when(good, v).alias(c) for c, (v, _) in values.items()], "error_message", "payload")


def _typed(text: Column, kind: str) -> tuple[Column, Column]:
    """A field as a value of a type such as ``int``, ``varchar(5)`` or ``date not null``, and what is wrong with it."""
    name, _, rest = kind.lower().partition(" not null")
    found = re.fullmatch(r"(?:var)?char\((\d+)\)", name.strip())
    value = text if found else text.try_cast(name)
    wrong = F.when(F.length(text) > int(found[1]), f"value too long for type {name}") if found else F.when(text.isNotNull() & value.isNull(), f"invalid input syntax for type {name}")
    if kind.lower().endswith("not null"):
        wrong = F.coalesce(wrong, F.when(text.isNull(), "null value in a column that allows none"))
    return value, wrong


def bulk_load(
    df: DataFrame,
    table: str,
    columns: Sequence[str] = ("payload",),
    fmt: str = "text",
    **dialect,
) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rows for the error table), from one parse and no retries."""
    names = [f"_mr_c{i}" for i in range(len(columns))]
    parsed = parse_lines(df, names, fmt, **dialect)
    return good_rows(parsed, names, columns), error_rows(parsed, table)


def good_rows(parsed: DataFrame, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    good = parsed.filter(F.col("error_message").isNull())
    return good.select(*[F.col(n).alias(c) for n, c in zip(names, columns)])


def error_rows(parsed: DataFrame, table: str) -> DataFrame:
    bad = parsed.filter(F.col("error_message").isNotNull())
    return bad.select(F.lit(table).alias("table_name"), "error_message", "payload")


def check_error_table(schema: T.StructType) -> None:
    """The error table must offer its three columns before a load starts."""
    missing = [c for c in ERROR_COLUMNS if c not in schema.names]
    if missing:
        raise ValueError(f"the error table has no column {', '.join(missing)}")


def empty_target(columns: Sequence[str] = ("payload",)) -> str:
    """K6: column types of a freshly made target, all VARCHAR(2000) as JDBC's table options want them."""
    return ", ".join(f"{c} VARCHAR({VARCHAR_LENGTH})" for c in columns)
