"""Rows whose values don't fit: set aside with a reason, the others go on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.plans.registry import TableSpec

REASON_LENGTH = 2000


def failed(raw: Column, value: Column) -> Column:
    """A value was given and none came of it."""
    return raw.isNotNull() & value.isNull()


def reason(spec: TableSpec) -> Column:
    """The columns that failed with their text, NULL if none did."""
    parts = [F.when(failed(F.col(f"_raw_{i}"), F.col(f"`{f.name}`")), F.concat(F.lit(f"{f.name}: not {f.kind}: "), F.col(f"_raw_{i}"))) for i, f in enumerate(spec.fields)]
    text = F.concat_ws("; ", *parts)
    return F.when(text != "", F.substring(text, 1, REASON_LENGTH))


def image_reason(spec: TableSpec) -> Column:
    """The same of a row image whose values aren't typed yet."""
    parts = []
    for f in spec.fields:
        raw = F.try_element_at("image", F.lit(f.name))
        parts.append(F.when(failed(raw, codec.decode(raw, f.type)), F.concat(F.lit(f"{f.name}: not {f.kind}: "), raw)))
    text = F.concat_ws("; ", *parts)
    return F.when(text != "", F.substring(text, 1, REASON_LENGTH))


def split(typed: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of typed rows: bad ones carry error_reason and the text of every column."""
    raw = [f"_raw_{i}" for i in range(len(spec.fields))]
    judged = typed.withColumn("error_reason", reason(spec))
    good = judged.where("error_reason is null").drop("error_reason", *raw)
    source = F.to_json(F.struct(*(F.col(r).alias(f.name) for r, f in zip(raw, spec.fields))))
    bad = judged.where("error_reason is not null").select(F.lit(spec.name).alias("table"), "seq", "commit_time", "error_reason", source.alias("payload"))
    return good, bad
