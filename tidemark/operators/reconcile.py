"""Source against target: counts, checksums, missing, extra and differing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import codec


def missing(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Rows of source whose key target lacks."""
    return source.join(target.select(*key), key, "left_anti")


def extra(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    return missing(target, source, key)


def mismatched(source: DataFrame, target: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Keys on both sides with the columns that differ."""
    s, t = source.select(*key, F.struct(*columns).alias("_s")), target.select(*key, F.struct(*columns).alias("_t"))
    differ = F.array_compact(F.array(*(F.when(~F.col(f"_s.`{c}`").eqNullSafe(F.col(f"_t.`{c}`")), F.lit(c)) for c in columns)))
    return s.join(t, key).select(*key, differ.alias("columns")).where(F.size("columns") > 0)


def checksum(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n, total): number of rows and the sum of the first 60 bits of each row's md5: any order, any partitioning."""
    bits = F.conv(F.substring(F.md5(codec.row_text(*(F.col(c) for c in columns))), 1, 15), 16, 10)
    return df.select(bits.cast("decimal(38,0)").alias("bits")).agg(F.count("*").alias("n"), F.sum("bits").cast("string").alias("total"))


def ordered_checksum(df: DataFrame, columns: list[str], order: list[str], part: Column) -> DataFrame:
    """md5 over the md5s of parts in order, each of its rows' md5s in order.

    part is a coarse function of the order: no part may be larger than a task holds, and of a part only its hash goes on.
    """
    lines = F.sort_array(F.collect_list(F.struct(*order, F.md5(codec.row_text(*(F.col(c) for c in columns))).alias("_line"))))
    parts = df.groupBy(part.alias("_part")).agg(F.md5(F.array_join(F.transform(lines, lambda x: x["_line"]), "")).alias("_sum"))
    sums = F.sort_array(F.collect_list(F.struct("_part", "_sum")))
    return parts.agg(F.md5(F.array_join(F.transform(sums, lambda x: x["_sum"]), "")).alias("checksum"))


def summary(source: DataFrame, target: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row of counts, from one full join of keys and row hashes."""
    h = F.md5(codec.row_text(*(F.col(c) for c in columns)))
    s, t = source.select(*key, h.alias("_s")), target.select(*key, h.alias("_t"))
    both = s.join(t, key, "full")
    return both.agg(
        F.count("_s").alias("source_rows"),
        F.count("_t").alias("target_rows"),
        F.count_if(F.col("_t").isNull()).alias("missing"),
        F.count_if(F.col("_s").isNull()).alias("extra"),
        F.count_if(F.col("_s") != F.col("_t")).alias("mismatched"),
    )
