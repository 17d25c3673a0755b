"""Types derived from what the source's types mean: width, sign, precision, zone, nullability."""

import itertools

import pytest
from pyspark.sql import types as T

from tidemark.functions import types as ft

BYTES = {"tinyint": 1, "smallint": 2, "mediumint": 3, "int": 4, "integer": 4, "bigint": 8}


def made(kind, detail="", nullable=False, default=None):
    return {"COLUMN_NAME": "x", "DATA_TYPE": kind, "COLUMN_TYPE": kind + detail, "IS_NULLABLE": "YES" if nullable else "NO", "COLUMN_DEFAULT": default}


def bits_of(label):
    return int(label.removeprefix("Nullable(").removesuffix(")").lstrip("UInt"))


@pytest.mark.parametrize("kind,unsigned,nullable", list(itertools.product(BYTES, (False, True), (False, True))))
def test_integers_hold_their_range(kind, unsigned, nullable):
    column = made(kind, "(5) unsigned" if unsigned else "(5)", nullable)
    label, spark = ft.target_label(column), ft.spark_type(column)
    assert bits_of(label) >= 8 * BYTES[kind] and ("UInt" in label) == unsigned and label.startswith("Nullable") == nullable
    top = 2 ** (8 * BYTES[kind] - (not unsigned)) - 1
    if isinstance(spark, T.DecimalType):
        assert spark.scale == 0 and 10**spark.precision > top
    else:
        assert 2 ** (8 * {"byte": 1, "short": 2, "integer": 4, "long": 8}[spark.typeName()] - 1) - 1 >= top


@pytest.mark.parametrize("precision,scale", [(5, 0), (18, 4), (38, 38), (39, 1), (65, 30)])
@pytest.mark.parametrize("kind", ["decimal", "numeric"])
def test_decimals_keep_their_precision(kind, precision, scale):
    column = made(kind, f"({precision}, {scale})")
    assert ft.target_label(column) == f"Decimal({precision},{scale})"
    want = T.DecimalType(precision, scale) if precision <= ft.MAX_PRECISION else T.StringType()
    assert ft.spark_type(column) == want


@pytest.mark.parametrize("zone", [None, "Europe/Paris"])
@pytest.mark.parametrize("kind", sorted(ft.TIMES))
def test_times_have_a_zone_if_one_is_set(kind, zone):
    assert (zone or "") in ft.target_label(made(kind), zone) and ft.target_label(made(kind), zone).startswith("DateTime64(3")
    assert ft.spark_type(made(kind), zone) == (T.TimestampType() if zone else T.TimestampNTZType())


@pytest.mark.parametrize("kind", ["geometry", "json", "enum", "set", "varbinary", "mediumtext", "no such type"])
@pytest.mark.parametrize("nullable", [False, True])
def test_anything_else_is_text(kind, nullable):
    column = made(kind, nullable=nullable)
    assert ft.unwrap(ft.target_label(column)) == "string" and ft.spark_type(column) == T.StringType()
    low = ft.target_label(column, low_cardinality=True)
    assert "LowCardinality(String)" in low and low.startswith("Nullable") == nullable


def test_metadata_may_be_bytes():
    for kind in (*BYTES, "double", "date"):
        raw = {k: v.encode() if isinstance(v, str) else v for k, v in made(kind).items()}
        assert ft.spark_type(raw) == ft.spark_type(made(kind)) and ft.target_label(raw) == ft.target_label(made(kind))


def test_defaults_as_expressions(spark):
    """A default of each kind, evaluated by Spark, is the value that the source would have filled in."""
    for kind, default, want in (("int", "-7", -7), ("varchar", "it's", "it's"), ("double", "2.5", 2.5), ("date", "2020-02-29", "2020-02-29"), ("int", "no number", None)):
        got = spark.sql(f"select {ft.default_expr(made(kind, default=default))} x").first().x
        assert got == want or str(got) == want
    assert ft.default_expr(made("int")) is None is ft.default_sql(made("int"), "Int32")
    assert "current_timestamp" in ft.default_expr(made("timestamp", default="now()"))
    assert ft.default_sql(made("bigint", default=" 12 "), "Int64") == "12" and ft.default_sql(made("text", default="a\\'"), "String") == "'a\\\\\\''"
    for label in ("Date", "DateTime", "DateTime64(3)"):
        assert ft.default_sql(made("date", default="2020-01-01"), label).endswith("('2020-01-01')")


def test_names_survive_quoting(spark):
    for name in ("plain", "two words", "back`tick", "\u00fcml\u00e4ut"):
        assert spark.sql(f"select 1 as {ft.quote(name)}").columns == [name]
    for bad in ("", None):
        with pytest.raises(ValueError):
            ft.quote(bad)
