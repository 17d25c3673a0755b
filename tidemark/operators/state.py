"""What a versioned log says: latest rows, live and deleted ones, history, state as of a version, compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import codec
from tidemark.plans.registry import DELETED, VERSION, TableSpec


def latest(log: DataFrame, key: list, tie: list | None = None) -> DataFrame:
    """The row of each key with the greatest version (ties: greatest seq), tombstones included.

    One aggregate with a partial step before its only shuffle: a hot key comes down to one row a task.
    """
    order = F.struct(VERSION, *(tie if tie is not None else (["seq"] if "seq" in log.columns else [])))
    keys = [k if isinstance(k, Column) else F.col(k) for k in key]
    named = [k.alias(f"_k{i}") for i, k in enumerate(keys)]
    return log.groupBy(*named).agg(F.max_by(F.struct(*log.columns), order).alias("_row")).select("_row.*")


def active(log: DataFrame, key: list, tie: list | None = None) -> DataFrame:
    return latest(log, key, tie).where(F.col(DELETED) == 0)


def deleted(log: DataFrame, key: list, tie: list | None = None) -> DataFrame:
    return latest(log, key, tie).where(F.col(DELETED) != 0)


def as_of(log: DataFrame, key: list, version, tie: list | None = None) -> DataFrame:
    """Latest rows as they were at a version; the filter reaches the scan."""
    return latest(log.where(F.col(VERSION) <= version), key, tie)


def history(log: DataFrame, key: list, tie: list | None = None) -> DataFrame:
    """The log with valid_to: the version at which the key's next row took over, NULL for its last."""
    order = [VERSION, *(tie if tie is not None else (["seq"] if "seq" in log.columns else []))]
    return log.withColumn("valid_to", F.lead(VERSION).over(Window.partitionBy(*key).orderBy(*order)))


def version_stats(log: DataFrame) -> DataFrame:
    return log.agg(F.count("*").alias("versions"), F.count_if(F.col(DELETED) == 0).alias("live_versions"), F.count_if(F.col(DELETED) != 0).alias("tombstones"))


def with_flag(log: DataFrame) -> DataFrame:
    return log.withColumn("is_deleted", codec.is_deleted(F.col(DELETED)))


def current(log: DataFrame, spec: TableSpec) -> DataFrame:
    """A table as its readers see it: the live latest rows, or the whole history in that mode."""
    shown = spec.view(log)
    if spec.mode != "latest":
        return shown
    return active(shown, spec.key_columns())


def compact(log: DataFrame, key: list, path: str) -> DataFrame:
    """Write the latest rows, tombstones included, sorted by key inside files, to a new path, and read them back.

    latest() deals rows by key already, so the write needs no shuffle of its own.
    """
    kept = latest(log, key)
    kept.sortWithinPartitions(*key).write.parquet(path)
    return log.sparkSession.read.schema(kept.schema).parquet(path)
