"""Source column metadata to target labels, Spark types, defaults and identifiers.

A column is a mapping with COLUMN_NAME, DATA_TYPE, COLUMN_TYPE, IS_NULLABLE and COLUMN_DEFAULT, as
INFORMATION_SCHEMA gives them; values may be bytes.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark.sql import types as T

log = logging.getLogger(__name__)

#: Bits of the integer types, the other numbers, and what is kept as text.
INTEGER_BITS = {"tinyint": 8, "smallint": 16, "mediumint": 32, "int": 32, "integer": 32, "bigint": 64}
FLOATS = {"float": "Float32", "double": "Float64", "real": "Float64"}
DECIMALS = {"decimal", "numeric"}
TIMES = {"datetime", "timestamp"}

_SIGNED = {8: T.ByteType(), 16: T.ShortType(), 32: T.IntegerType(), 64: T.LongType()}
_UNSIGNED = {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}
_PRECISION = re.compile(r"\(\s*(\d+)\s*,\s*(\d+)\s*\)")
_NUMBER = re.compile(r"-?\d+(\.\d+)?")
_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
#: Spark's largest decimal precision; wider ones are kept as text.
MAX_PRECISION = 38


def _text(column: Mapping, key: str) -> str:
    value = column.get(key)
    if value is None:
        return ""
    return value.decode("utf-8") if isinstance(value, (bytes, bytearray)) else str(value)


def is_nullable(column: Mapping) -> bool:
    return _text(column, "IS_NULLABLE").upper() == "YES"


def _kind(column: Mapping) -> str:
    return _text(column, "DATA_TYPE").lower()


def _scale(column: Mapping) -> tuple[int, int]:
    found = _PRECISION.search(_text(column, "COLUMN_TYPE"))
    return (int(found[1]), int(found[2])) if found else (38, 10)


def _is_unsigned(column: Mapping) -> bool:
    return "unsigned" in _text(column, "COLUMN_TYPE").lower()


def base_label(column: Mapping, timezone: str | None = None) -> str:
    """The target type's name without its nullability."""
    kind = _kind(column)
    if kind in INTEGER_BITS:
        return ("UInt" if _is_unsigned(column) else "Int") + str(INTEGER_BITS[kind])
    if kind in FLOATS:
        return FLOATS[kind]
    if kind in DECIMALS:
        return "Decimal({},{})".format(*_scale(column))
    if kind == "date":
        return "Date"
    if kind in TIMES:
        return f"DateTime64(3, '{timezone}')" if timezone else "DateTime64(3)"
    return "String"


def target_label(column: Mapping, timezone: str | None = None, low_cardinality: bool = False) -> str:
    label = base_label(column, timezone)
    if low_cardinality and label == "String":
        label = "LowCardinality(String)"
    return f"Nullable({label})" if is_nullable(column) else label


def unwrap(label: str) -> str:
    """The lower-case type inside Nullable(...)."""
    inner = re.fullmatch(r"nullable\((.*)\)", label.strip(), re.I | re.S)
    return (inner[1] if inner else label).strip().lower()


def spark_type(column: Mapping, timezone: str | None = None) -> T.DataType:
    """The Spark type that holds every value of the source type."""
    kind = _kind(column)
    if kind in INTEGER_BITS:
        return (_UNSIGNED if _is_unsigned(column) else _SIGNED)[INTEGER_BITS[kind]]
    if kind in FLOATS:
        return T.FloatType() if kind == "float" else T.DoubleType()
    if kind in DECIMALS:
        precision, scale = _scale(column)
        return T.DecimalType(precision, scale) if precision <= MAX_PRECISION else T.StringType()
    if kind == "date":
        return T.DateType()
    if kind in TIMES:
        return T.TimestampType() if timezone else T.TimestampNTZType()
    return T.StringType()


def quote(name) -> str:
    """An identifier in backticks, its own backticks doubled."""
    if name is None:
        raise ValueError("identifier is None")
    name = str(name)
    if not name:
        raise ValueError("identifier is empty")
    if not _PLAIN_NAME.fullmatch(name):
        log.warning("identifier %r needs its quotes", name)
    return "`{}`".format(name.replace("`", "``"))


def literal(value) -> str:
    """A text in single quotes, backslashes and quotes escaped."""
    return "'{}'".format(re.sub(r"([\\'])", r"\\\1", str(value)))


def default_sql(column: Mapping, label: str) -> str | None:
    """The column default as a target expression; None without a default."""
    if column.get("COLUMN_DEFAULT") is None:
        return None
    value, kind = _text(column, "COLUMN_DEFAULT"), _kind(column)
    if kind in INTEGER_BITS or kind in FLOATS or kind in DECIMALS:
        number = value.strip()
        return number if _NUMBER.fullmatch(number) else literal(number)
    if kind == "date" or kind in TIMES:
        name = "parseDateTimeBestEffort" if "DateTime64" in label else "toDateTime" if "DateTime" in label else "toDate"
        return f"{name}({literal(value)})"
    return literal(value)


def default_expr(column: Mapping, timezone: str | None = None) -> str | None:
    """The column default as a Spark SQL expression of the column's type."""
    if column.get("COLUMN_DEFAULT") is None:
        return None
    value = _text(column, "COLUMN_DEFAULT")
    if re.match(r"(current_timestamp|now)\b", value.strip(), re.I):
        return f"cast(current_timestamp() as {spark_type(column, timezone).simpleString()})"
    return f"try_cast({literal(value)} as {spark_type(column, timezone).simpleString()})"


def fallback_expr(kind: T.DataType) -> str:
    """What NULL becomes in a column that takes none: zero, the epoch, or the empty text."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return f"cast(0 as {kind.simpleString()})"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"cast('1970-01-01' as {kind.simpleString()})"
    return "''"
