"""Order-dependent operators without a single-task window.

Rows fall into buckets by a coarse function of their order.  Numbers, sums and predecessors are found inside each
bucket, and a table of one row per bucket carries them over from bucket to bucket.  balanced() makes buckets of bounded
size from fine cells of the order, so that no stretch of it becomes one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import codec


def balanced(df: DataFrame, cell: Column, size: int = 1 << 20, name: str = "bucket") -> DataFrame:
    """df with the number of its bucket: neighbouring cells of the order together, up to about `size` rows."""
    rows = df.withColumn("_cell", cell)
    counts = rows.groupBy("_cell").agg(F.count("*").alias("_n"))  # a row a cell
    before = F.sum("_n").over(Window.orderBy(F.col("_cell").asc_nulls_first())) - F.col("_n")
    named = counts.select(F.col("_cell").alias("_c"), F.floor(before / size).cast("long").alias(name))
    return rows.join(named, F.col("_cell").eqNullSafe(F.col("_c"))).drop("_cell", "_c")


def running_sum(df: DataFrame, bucket: Column, order: list, value: Column, name: str) -> DataFrame:
    """df with the sum of value over all rows up to and with this one."""
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value.cast("long"))
    totals = rows.groupBy("_bucket").agg(F.sum("_value").alias("_total"))
    before = totals.select("_bucket", (F.sum("_total").over(Window.orderBy(F.col("_bucket").asc_nulls_first())) - F.col("_total")).alias("_before"))
    own = F.sum("_value").over(Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    joined = rows.withColumn("_own", own).alias("r").join(before.alias("b"), F.col("r._bucket").eqNullSafe(F.col("b._bucket")))
    return joined.select(*(F.col(f"r.`{c}`") for c in df.columns), (F.col("_own") + F.col("_before")).alias(name))


def row_numbers(df: DataFrame, bucket: Column, order: list, name: str = "rn") -> DataFrame:
    return running_sum(df, bucket, order, F.lit(1), name)


def previous(df: DataFrame, bucket: Column, order: list, value: Column, name: str) -> DataFrame:
    """df with value of the row before; NULL for the first row."""
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    last = rows.groupBy("_bucket").agg(F.max_by("_value", F.struct(*order)).alias("_last"))
    edge = last.select("_bucket", F.lag("_last").over(Window.orderBy(F.col("_bucket").asc_nulls_first())).alias("_edge"))
    w = Window.partitionBy("_bucket").orderBy(*order)
    own = rows.withColumn("_lag", F.lag("_value").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    joined = own.alias("r").join(edge.alias("e"), F.col("r._bucket").eqNullSafe(F.col("e._bucket")))
    return joined.select(*(F.col(f"r.`{c}`") for c in df.columns), F.when(F.col("_first"), F.col("_edge")).otherwise(F.col("_lag")).alias(name))


def chunks(df: DataFrame, bucket: Column, order: list, size: int, name: str = "batch") -> DataFrame:
    """df dealt into runs of `size` rows in order."""
    numbered = row_numbers(df, bucket, order, "_rn")
    return numbered.withColumn(name, F.floor((F.col("_rn") - 1) / size).cast("long")).drop("_rn")


def segments(df: DataFrame, bucket: Column, order: list, is_barrier: Column, name: str = "segment") -> DataFrame:
    """df with the number of barriers up to and with each row: a barrier opens a segment."""
    return running_sum(df, bucket, order, F.when(is_barrier, 1).otherwise(0), name)


def merged(df: DataFrame, bucket: Column, order: list, keys: list[str], text: Column, limit: int | None = None) -> DataFrame:
    """Runs of rows with equal keys in order as one row each: island, keys, n, first, last, and their texts joined.

    A run's texts are one row's worth: `limit`, where it is given, cuts what is shown of them.
    """
    cut = islands(df.withColumn("_text", text), bucket, order, F.struct(*keys))
    at = F.struct(*order)
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "_text"))), lambda x: x["_text"]), ",")
    shown = codec.shortened(lines, limit) if limit else lines
    return cut.groupBy("island", *keys).agg(F.count("*").alias("n"), F.min(at).alias("first"), F.max(at).alias("last"), shown.alias("texts"))


def islands(df: DataFrame, bucket: Column, order: list, key: Column, name: str = "island") -> DataFrame:
    """df with the number of its run of equal keys in order."""
    marked = previous(df, bucket, order, F.struct(key.alias("k")), "_prior").withColumn("_key", F.struct(key.alias("k")))
    new = F.when(F.col("_prior").isNotNull() & F.col("_prior").eqNullSafe(F.col("_key")), 0).otherwise(1)
    return running_sum(marked, bucket, order, new, name).drop("_prior", "_key")
