"""The change feed: event envelopes from JSON or Parquet files, in batch or as a stream, and their filters."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec
from tidemark.operators import schema_change
from tidemark.operators.changelog import DELETE, INSERT, UPDATE

QUERY = "QueryEvent"
_VALUES = T.MapType(T.StringType(), T.StringType())
SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("columns", T.StringType()),
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField("values", _VALUES), T.StructField("before_values", _VALUES), T.StructField("after_values", _VALUES)]))),
    ]
)


def read(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    return spark.read.schema(SCHEMA).format(kind).load(path)


def stream(spark: SparkSession, path: str, kind: str = "json", files_per_batch: int | None = None, bytes_per_batch: str | None = None) -> DataFrame:
    """New files of a folder; the two limits bound a batch, so that a backlog never comes at once."""
    reader = spark.readStream.schema(SCHEMA).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.load(path)


def last_position(spark: SparkSession, path: str, kind: str = "json") -> dict | None:
    """The last event that a feed holds: seq, file, pos."""
    try:
        found = read(spark, path, kind).agg(F.max_by(F.struct("seq", "file", "pos"), "seq").alias("x")).select("x.*").first()
    except AnalysisException:  # there is no feed yet
        return None
    return found.asDict() if found and found["seq"] is not None else None


def allowed_name(name: str | None, include: list[str] | None = None, exclude: list[str] | None = None) -> bool:
    return bool(name) and (not include or name in include) and name not in (exclude or ())


def allowed(table: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """The same as a Column; on a table's partition column it prunes files."""
    ok = F.coalesce(table != "", F.lit(False))
    if include:
        ok = ok & table.isin(*include)
    if exclude:
        ok = ok & ~table.isin(*exclude)
    return ok


def row_events(events: DataFrame, include=None, exclude=None, schemas: list[str] | None = None) -> DataFrame:
    kept = events.where(F.col("type").isin(INSERT, UPDATE, DELETE) & allowed(F.col("table"), include, exclude))
    return kept.where(F.col("schema").isin(*schemas)) if schemas else kept


def since(events: DataFrame, file: str, pos: int) -> DataFrame:
    """Events at a log position or behind it."""
    return events.where(codec.position_key(F.col("file"), F.col("pos")) >= codec.position_key(F.lit(file), F.lit(pos)))


def statements(events: DataFrame) -> DataFrame:
    """Schema statements, without those that only frame transactions."""
    return events.where((F.col("type") == QUERY) & ~schema_change.transaction_column(F.col("query")))


def full_images(events: DataFrame) -> DataFrame:
    """Precondition: updates and deletes that lack their row image."""
    lacking = F.exists("rows", lambda r: F.when(F.col("type") == UPDATE, F.coalesce(F.size(r["after_values"]), F.lit(-1)) + F.coalesce(F.size(r["values"]), F.lit(-1)) <= -2).otherwise(F.coalesce(F.size(r["values"]), F.lit(-1)) < 0))
    return events.where(F.col("type").isin(UPDATE, DELETE) & lacking)
