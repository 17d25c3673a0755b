"""Row-change events to log rows: typed columns, commit_time, delete_time and seq."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec, types
from tidemark.plans.registry import DELETED, VERSION, TableSpec

INSERT, UPDATE, DELETE = "WriteRowsEvent", "UpdateRowsEvent", "DeleteRowsEvent"


def image(before: Column, after: Column, values: Column) -> Column:
    """The row that an event leaves: an update's after image over its before image, or else its values."""
    empty = F.create_map().cast("map<string,string>")
    old, new = F.coalesce(before, empty), F.coalesce(after, empty)
    kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
    return F.when(F.size(new) > 0, F.map_concat(kept, new)).otherwise(F.coalesce(values, empty))


def exploded(events: DataFrame) -> DataFrame:
    """One row per changed row: table, kind, image, file, pos, ordinal; order within an event is kept."""
    flat = events.select("*", F.posexplode("rows").alias("ordinal", "row"))
    changed = F.when(F.col("type") == UPDATE, image(F.col("row.before_values"), F.col("row.after_values"), F.col("row.values"))).otherwise(F.coalesce("row.values", F.create_map().cast("map<string,string>")))
    return flat.withColumn("image", changed).drop("rows", "row")


def raw_columns(spec: TableSpec) -> list[Column]:
    """The image's text of each column; columns that the event lacks are NULL, others are dropped."""
    return [F.try_element_at("image", F.lit(f.name)).alias(f"_raw_{i}") for i, f in enumerate(spec.fields)]


def typed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Log rows of one table, with _raw_i beside them where a value didn't fit its type (see quarantine)."""
    raw = rows.select("*", *raw_columns(spec))
    values = []
    for i, f in enumerate(spec.fields):
        value = codec.decode(F.col(f"_raw_{i}"), f.type)
        if not f.nullable:
            value = F.when(F.col(f"_raw_{i}").isNull(), F.expr(types.fallback_expr(f.type))).otherwise(value)
        values.append(value.alias(f.name))
    removed = F.when(F.col("type") == DELETE, F.col(VERSION)).otherwise(F.lit(0)).cast("long").alias(DELETED)
    return raw.select(*values, VERSION, removed, "seq", *(f"_raw_{i}" for i in range(len(spec.fields))))


def tombstones_on_key_change(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Option: delete events for the old keys of updates that change a key column."""
    old, new = F.col("row.before_values"), F.col("row.after_values")
    moved = F.lit(False)
    for k in spec.key:
        was, now = F.try_element_at(old, F.lit(k)), F.try_element_at(new, F.lit(k))
        moved = moved | (now.isNotNull() & ~was.eqNullSafe(now))
    flat = rows.select("*", F.posexplode("rows").alias("ordinal", "row"))
    return flat.where((F.col("type") == UPDATE) & moved).withColumn("image", old).withColumn("type", F.lit(DELETE)).drop("rows", "row")


def from_table(df: DataFrame, op: Column, version: Column, seq: Column) -> DataFrame:
    """A log made of a table whose rows are changes: op is I, U or D."""
    return df.select("*", version.cast("long").alias(VERSION), F.when(op == "D", version).otherwise(F.lit(0)).cast("long").alias(DELETED), seq.alias("seq"))
