"""Table snapshots: scan strategies, pages, partitioned reads, and the union with later changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.registry import DELETED, VERSION


def tables_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the tables of a source database: the Parquet files or folders in it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet"))


def discover(names: list[str], include: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """Tables to copy: those included, or all, without those excluded."""
    return [n for n in (include or names) if n in names and n not in (exclude or ())]


def ranges(df: DataFrame, key: str, size: int, after=None) -> list[tuple]:
    """(low, high]: ranges of an integer key with about `size` rows each behind `after`, from one pass over the key."""
    rows = (df if after is None else df.where(F.col(key) > after)).select(key)
    found = rows.agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if not found["n"]:
        return []
    parts = -(-found["n"] // size)
    cuts = rows.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)], 10_000).alias("c")).first()["c"] if parts > 1 else []
    bounds = [after if after is not None else found["low"] - 1, *sorted({c for c in cuts if c < found["high"]}), found["high"]]
    return list(zip(bounds, bounds[1:]))


def copied(df: DataFrame, plan: tuple[str, list[str]], version: int, path: str, size: int, after=None, done=None) -> None:
    """Write a table's rows as log rows under path: by ranges of its key, each told to done(last key, rows), or at once.

    A range is written into a folder of its own, so a copy that is begun again overwrites the one it broke off in.
    """
    how, keys = plan
    if how == "keyset":
        for low, high in ranges(df, keys[0], size, after):
            page = df.where((F.col(keys[0]) > low) & (F.col(keys[0]) <= high))
            target = f"{path}/upto={high}"
            as_log(page, version).write.mode("overwrite").parquet(target)
            if done is not None:
                done(high, df.sparkSession.read.parquet(target).count())
        return
    as_log(df, version).write.mode("overwrite").parquet(f"{path}/upto=0")
    if done is not None:
        done(None, df.sparkSession.read.parquet(path).count())


def strategy(schema: T.StructType, primary_key: list[str]) -> tuple[str, list[str]]:
    """("keyset", key) for a single integer key, else ("offset", order): by the key, or by all columns."""
    if len(primary_key) == 1 and isinstance(schema[primary_key[0]].dataType, T.IntegralType):
        return "keyset", list(primary_key)
    return "offset", list(primary_key) or schema.names


def keyset_page(df: DataFrame, key: str, after=None, size: int = 5000) -> DataFrame:
    """The next page behind a key; the filter reaches the scan, the page is a top-k."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)


def offset_page(df: DataFrame, order: list[str], start: int = 0, size: int = 5000) -> DataFrame:
    if not order:
        raise ValueError("a page by offset needs an order")
    return df.orderBy(*order).offset(start).limit(size)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, **options) -> DataFrame:
    """A table over JDBC, in parallel ranges of an integer key; needs the driver's jar on the class path."""
    if key and bounds:
        return spark.read.jdbc(url, table, column=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts, properties=options)
    return spark.read.jdbc(url, table, properties=options)


def as_log(df: DataFrame, version: int) -> DataFrame:
    """Snapshot rows as live log rows, all of one version: changes behind the snapshot's position win."""
    return df.withColumn(VERSION, F.lit(version).cast("long")).withColumn(DELETED, F.lit(0).cast("long")).withColumn("seq", F.lit(-1).cast("long"))


def with_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    return snapshot.unionByName(changes, allowMissingColumns=True)
