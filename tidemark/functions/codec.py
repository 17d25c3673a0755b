"""Value codecs, hashes and positions as Column expressions: all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def base64_text(c: Column) -> Column:
    """Base64 in one line, whatever the session's line length is."""
    return F.regexp_replace(F.base64(c), r"[\r\n]", "")


def bytes_text(c: Column, fallback: str = "base64") -> Column:
    """UTF-8 text of bytes; bytes that aren't UTF-8 as base64, or byte by byte as Latin-1."""
    other = base64_text(c) if fallback == "base64" else F.decode(c, "ISO-8859-1")
    return F.coalesce(F.try_validate_utf8(c.cast("string")), other)


def set_text(c: Column) -> Column:
    return F.array_join(F.array_sort(c), ",")


def time_text(seconds: Column) -> Column:
    """[-]HH:MM:SS of a number of seconds, cut towards zero; hours may have more than two digits."""
    whole = F.abs(seconds.cast("long"))
    hours, minutes = F.floor(whole / 3600), F.floor(whole / 60) % 60
    return F.concat(F.when(seconds.cast("long") < 0, "-").otherwise(""), F.format_string("%02d:%02d:%02d", hours.cast("long"), minutes.cast("long"), whole % 60))


def iso_text(c: Column, kind: T.DataType) -> Column:
    """ISO 8601 with T, and microseconds only if there are any."""
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def _texts(c: Column, kind: T.DataType, fallback: str) -> Column:
    """A nested value with all that JSON has no form for (bytes, decimals, times) as text, at any depth."""
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(_texts(c[f.name], f.dataType, fallback).alias(f.name) for f in kind)))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _texts(x, kind.elementType, fallback))
    if isinstance(kind, T.MapType):
        return F.transform_values(F.transform_keys(c, lambda k, _: encode(k, kind.keyType, fallback)), lambda _, v: _texts(v, kind.valueType, fallback))
    if isinstance(kind, (T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.StringType)):
        return c
    return encode(c, kind, fallback)


def encode(c: Column, kind: T.DataType, fallback: str = "base64") -> Column:
    """Any value as the text that the change feed carries; NULL stays NULL."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return bytes_text(c, fallback)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(c, kind)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_texts(c, kind, fallback))
    if isinstance(kind, T.DayTimeIntervalType):
        return time_text(c.cast("long"))
    return c.cast("string")


def date_value(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def datetime_value(c: Column, kind: T.DataType) -> Column:
    """T form with fraction and zone, Z too; the form with a space to whole seconds; milliseconds are kept."""
    text = F.when(F.substring(c, 11, 1) == " ", F.substring(c, 1, 19)).otherwise(c)
    parsed = text.try_cast(kind.simpleString())
    return parsed if isinstance(kind, T.StringType) else F.date_trunc("millisecond", parsed).cast(kind)


def decode(c: Column, kind: T.DataType) -> Column:
    """Text of the feed as a value of the type; what doesn't fit is NULL, never an error."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.DateType):
        return F.coalesce(date_value(c), datetime_value(c, T.TimestampNTZType()).cast("date"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return datetime_value(c, kind)
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(F.trim(c)).isin("true", "1", "yes", "on"), True).when(F.lower(F.trim(c)).isin("false", "0", "no", "off"), False)
    if isinstance(kind, T.IntegralType):  # JSON gives booleans where the source has TINYINT(1)
        c = F.when(F.lower(c) == "true", "1").when(F.lower(c) == "false", "0").otherwise(c)
    return c.try_cast(kind.simpleString())


def row_text(*columns: Column) -> Column:
    """A text that only equal rows share: each value behind its length, NULL as a mark that no length looks like."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts))


def row_key(*columns: Column) -> Column:
    """A key for rows that have none: equal rows get equal keys, NULLs count."""
    return F.md5(row_text(*columns))


def is_deleted(delete_time: Column) -> Column:
    return F.when(delete_time != 0, 1).otherwise(0).cast("byte")


def position_key(file: Column, pos: Column) -> Column:
    """(prefix, number, pos) of a log position; such structs sort as the positions do."""
    named = F.length(F.coalesce(file, F.lit(""))) > 0
    digits = F.regexp_extract(file, r"(\d+)$", 1)
    prefix = F.regexp_replace(file, r"\d+$", "")
    return F.struct(
        F.when(named, prefix).otherwise("").alias("prefix"),
        F.when(named & (digits != ""), digits.try_cast("long")).otherwise(F.lit(0).cast("long")).alias("suffix"),
        F.when(named, F.coalesce(pos.cast("long"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("pos"),
    )


def parse_position(text: Column) -> Column:
    """(file, pos) of "file:pos"; NULL if it isn't one."""
    parts = F.split(text, ":", 2)
    pos = F.get(parts, F.lit(1)).try_cast("long")
    return F.when(pos.isNotNull(), F.struct(parts[0].alias("file"), pos.alias("pos")))


#: Leading white space and comments of a statement: to the line's end, or in /* */; unterminated ones run to the end.
LEADING_COMMENTS = r"(?s)\A(?:\s+|--[^\n]*(?:\n|\z)|#[^\n]*(?:\n|\z)|/\*.*?(?:\*/|\z))+"


def strip_comments(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), LEADING_COMMENTS, ""), r"\s+\z", "")


def html_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def shortened(c: Column, n: int = 500) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("... (truncated)"))).otherwise(c)


#: Parts of error messages that mean the fault may pass.
TRANSIENT = (
    "timeout",
    "timed out",
    "connection",
    "network",
    "broken pipe",
    "temporary",
    "socket",
    "eof",
    "connection reset",
    "connection refused",
    "server closed",
    "lost connection",
    "cannot connect",
)


def first_line(message) -> str:
    lines = str(message).strip().splitlines()
    return lines[0] if lines else ""


def is_transient(message: Column) -> Column:
    return F.lower(message).rlike("|".join(TRANSIENT))


def local_time(c: Column, zone: str = "+04:00") -> Column:
    """A UTC time as the clock of a fixed zone shows it."""
    return F.from_utc_timestamp(c, zone)
