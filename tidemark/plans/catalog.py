"""Named queries over the registered tables, and the SQL that gives the same rows.

`events` serves as a change feed keyed by user: signup inserts, error deletes, the rest update; its time is the version.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec, types
from tidemark.operators import changelog, ordering, quarantine, reconcile, schema_change, state
from tidemark.plans.registry import Field, TableSpec
from tidemark.sources import feed, snapshot
from tidemark.streaming.ingest import Ingest, start
from tidemark.streaming.store import LogStore

CUT = 1705276800000000000  # 2024-01-15 as a version
EVENTS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucketed(events: DataFrame, size: int = 1 << 18) -> DataFrame:
    """events with buckets of bounded size: minutes of their time, taken together."""
    return ordering.balanced(events, F.floor(_micros() / 60_000_000), size)


def _micros() -> F.Column:
    return F.unix_micros(F.col("ts").cast("timestamp"))


def _log(events: DataFrame) -> DataFrame:
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    rows = events.select(F.col("user_id").alias("id"), "event_type", "value", "props", "event_id", (_micros() * 1000).alias("_ct"), op.alias("op"))
    return changelog.from_table(rows, F.col("op"), F.col("_ct"), F.col("event_id")).drop("_ct", "event_id")


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(_table(spark, sf_dir, "events"))


CHANGES = """WITH cl AS (
  SELECT user_id AS id, event_type, value, props, event_id AS seq,
         CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
         epoch_us(ts) * 1000 AS commit_time,
         CASE event_type WHEN 'error' THEN epoch_us(ts) * 1000 ELSE 0 END AS delete_time
  FROM events),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_time DESC, seq DESC) AS rn FROM cl) WHERE rn = 1)
"""
ROW = "id, event_type, value, props, op, commit_time, delete_time, seq"
_COLUMNS = ROW.split(", ")

def _row_sql(*columns: str) -> str:
    """What codec.row_text gives."""
    return " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in columns)


_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        _SPARK[f.__name__.lstrip("_")] = f
        if sql is not None:
            _SQL[f.__name__.lstrip("_")] = sql
        return f

    return keep


@query(f"{CHANGES} SELECT {ROW} FROM last WHERE delete_time = 0")
def latest_active(spark, sf_dir):
    return state.active(_changes(spark, sf_dir), ["id"]).select(*_COLUMNS)


@query(f"{CHANGES} SELECT {ROW} FROM last WHERE delete_time <> 0")
def latest_deleted(spark, sf_dir):
    return state.deleted(_changes(spark, sf_dir), ["id"]).select(*_COLUMNS)


@query(f"{CHANGES} SELECT count(*) AS live FROM last WHERE delete_time = 0")
def live_count(spark, sf_dir):
    return state.active(_changes(spark, sf_dir), ["id"]).agg(F.count("*").alias("live"))


@query(f"{CHANGES} SELECT count(*) AS deleted FROM last WHERE delete_time <> 0")
def deleted_count(spark, sf_dir):
    return state.deleted(_changes(spark, sf_dir), ["id"]).agg(F.count("*").alias("deleted"))


@query(f"{CHANGES} SELECT count(*) AS versions, CAST(sum(CASE WHEN delete_time = 0 THEN 1 ELSE 0 END) AS BIGINT) AS live_versions, CAST(sum(CASE WHEN delete_time <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS tombstones FROM cl")
def version_stats(spark, sf_dir):
    return state.version_stats(_changes(spark, sf_dir))


@query(f"{CHANGES} SELECT op, count(*) AS versions, min(commit_time) AS first_version, max(commit_time) AS last_version FROM cl GROUP BY op")
def versions_by_op(spark, sf_dir):
    return _changes(spark, sf_dir).groupBy("op").agg(F.count("*").alias("versions"), F.min("commit_time").alias("first_version"), F.max("commit_time").alias("last_version"))


@query(f"{CHANGES} SELECT {ROW} FROM cl")
def changelog_rows(spark, sf_dir):
    return _changes(spark, sf_dir).select(*_COLUMNS)


@query(f"{CHANGES} SELECT seq, CAST(CASE WHEN delete_time <> 0 THEN 1 ELSE 0 END AS INTEGER) AS is_deleted FROM cl")
def is_deleted_flag(spark, sf_dir):
    return state.with_flag(_changes(spark, sf_dir)).select("seq", F.col("is_deleted").cast("int").alias("is_deleted"))


@query(f"{CHANGES} SELECT {ROW} FROM last")
def compact(spark, sf_dir):
    return state.compact(_changes(spark, sf_dir), ["id"], _scratch(spark)).select(*_COLUMNS)


@query(f"{CHANGES} SELECT id, seq, commit_time, lead(commit_time) OVER (PARTITION BY id ORDER BY commit_time, seq) AS valid_to, delete_time FROM cl")
def history_scd2(spark, sf_dir):
    return state.history(_changes(spark, sf_dir), ["id"]).select("id", "seq", "commit_time", "valid_to", "delete_time")


@query(f"{CHANGES}, old AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_time DESC, seq DESC) AS r2 FROM cl WHERE commit_time <= {CUT}) SELECT {ROW} FROM old WHERE r2 = 1")
def as_of(spark, sf_dir):
    return state.as_of(_changes(spark, sf_dir), ["id"], CUT).select(*_COLUMNS)


@query(f"{CHANGES} SELECT {ROW} FROM cl WHERE delete_time = 0 AND op IN ('I', 'U') AND event_type LIKE 'p%' AND props IS NOT NULL")
def log_filters(spark, sf_dir):
    return _changes(spark, sf_dir).where((F.col("delete_time") == 0) & F.col("op").isin("I", "U") & F.col("event_type").like("p%") & F.col("props").isNotNull()).select(*_COLUMNS)


SNAPSHOT = """WITH log AS (
  SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount, CAST(0 AS BIGINT) AS commit_time, CAST(0 AS BIGINT) AS delete_time, CAST(-1 AS BIGINT) AS seq FROM orders
  UNION ALL
  SELECT l_orderkey, l_linestatus, l_extendedprice, epoch_us(CAST(l_shipdate AS TIMESTAMP)), CASE WHEN l_returnflag = 'R' THEN epoch_us(CAST(l_shipdate AS TIMESTAMP)) ELSE 0 END, CAST(l_linenumber AS BIGINT) FROM lineitem)
"""


@query(f"{SNAPSHOT} SELECT id, status, amount, commit_time, delete_time, seq FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY commit_time DESC, seq DESC, amount DESC, status DESC) AS rn FROM log) WHERE rn = 1 AND delete_time = 0")
def snapshot_union_cdc(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    version = F.unix_micros(F.col("l_shipdate").cast("timestamp"))
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("amount"), version.alias("commit_time"), F.when(F.col("l_returnflag") == "R", version).otherwise(F.lit(0)).cast("long").alias("delete_time"), F.col("l_linenumber").cast("long").alias("seq"))
    return state.active(snapshot.with_changes(snapshot.as_log(orders, 0), lines), ["id"], ["seq", "amount", "status"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(spark, sf_dir):
    return snapshot.keyset_page(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 100, 50)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def offset_page(spark, sf_dir):
    return snapshot.offset_page(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 100, 50)


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 1")
def last_position(spark, sf_dir):
    return _table(spark, sf_dir, "events").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("last")).select("last.*")


@query("SELECT event_id, ts, event_type FROM events ORDER BY event_id LIMIT 100")
def queue_fifo(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", "ts", "event_type").orderBy("event_id").limit(100)


@query(f"SELECT md5({_row_sql('r_regionkey', 'r_name')}) AS k, r_name FROM region UNION ALL SELECT md5({_row_sql('n_nationkey', 'n_name', 'n_regionkey')}), n_name FROM nation")
def no_pk_key(spark, sf_dir):
    region = _table(spark, sf_dir, "region").select(codec.row_key(F.col("r_regionkey"), F.col("r_name")).alias("k"), "r_name")
    nation = _table(spark, sf_dir, "nation").select(codec.row_key(F.col("n_nationkey"), F.col("n_name"), F.col("n_regionkey")).alias("k"), F.col("n_name").alias("r_name"))
    return region.unionAll(nation)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1")
def composite_key_latest(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", F.col("l_shipdate").alias("commit_time"))
    return state.latest(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice"]).withColumnRenamed("commit_time", "l_shipdate")


@query("SELECT event_id, CAST(round(value, 2) AS DECIMAL(10, 2)) AS amount FROM events")
def type_decimal(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", codec.decode(F.round("value", 2).cast("string"), T.DecimalType(10, 2)).alias("amount"))


@query("SELECT event_id, epoch_us(date_trunc('milliseconds', ts)) AS us FROM events")
def datetime_ms(spark, sf_dir):
    text = codec.encode(F.col("ts"), T.TimestampNTZType())
    return _table(spark, sf_dir, "events").select("event_id", F.unix_micros(codec.decode(text, T.TimestampNTZType()).cast("timestamp")).alias("us"))


@query("SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events")
def iso_encode(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", codec.iso_text(F.col("ts"), T.TimestampNTZType()).alias("iso"))


@query("SELECT event_id, CASE WHEN epoch_us(ts) % 1000000 // 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(date_trunc('milliseconds', ts), '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events")
def iso_round_trip(spark, sf_dir):
    kind = T.TimestampNTZType()
    return _table(spark, sf_dir, "events").select("event_id", codec.encode(codec.decode(codec.encode(F.col("ts"), kind), kind), kind).alias("iso"))


@query("SELECT event_id, (CASE WHEN event_id % 2 = 1 AND event_id % 400000 > 0 THEN '-' ELSE '' END) || lpad(CAST((event_id % 400000) // 3600 AS VARCHAR), CAST(greatest(2, length(CAST((event_id % 400000) // 3600 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(((event_id % 400000) // 60) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((event_id % 400000) % 60 AS VARCHAR), 2, '0') AS t FROM events")
def time_text(spark, sf_dir):
    seconds = (F.col("event_id") % 400000) * F.when(F.col("event_id") % 2 == 1, -1).otherwise(1)
    return _table(spark, sf_dir, "events").select("event_id", codec.time_text(seconds).alias("t"))


NESTED = T.StructType([T.StructField("k", T.StringType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("raw", T.BinaryType()), T.StructField("at", T.ArrayType(T.DateType()))])


@query("SELECT event_id, '{\"k\":\"' || json_extract_string(props, '$.k') || '\",\"amount\":\"' || CAST(CAST(round(value, 2) AS DECIMAL(10, 2)) AS VARCHAR) || '\",\"raw\":\"' || event_type || '\",\"at\":[\"' || strftime(ts, '%Y-%m-%d') || '\"]}' AS j FROM events")
def json_field(spark, sf_dir):
    nested = F.struct(F.get_json_object("props", "$.k").alias("k"), F.round("value", 2).cast("decimal(10,2)").alias("amount"), F.encode("event_type", "utf-8").alias("raw"), F.array(F.to_date("ts")).alias("at"))
    return _table(spark, sf_dir, "events").select("event_id", codec.encode(nested, NESTED).alias("j"))


@query("SELECT doc_id, base64(encode(text)) AS b, text AS t FROM documents")
def bytes_base64(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", codec.base64_text(F.encode("text", "utf-8")).alias("b"), codec.bytes_text(F.encode("text", "utf-8")).alias("t"))


@query("SELECT DISTINCT event_type, array_to_string(list_sort(string_split(event_type, 'e')), ',') AS s FROM events")
def set_text(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_type", codec.set_text(F.split("event_type", "e")).alias("s")).distinct()


@query("SELECT event_id, 'bin.' AS prefix, event_id % 1000 AS suffix, event_id * 4 AS pos FROM events")
def position_key(spark, sf_dir):
    file = F.concat(F.lit("bin."), F.lpad((F.col("event_id") % 1000).cast("string"), 6, "0"))
    return _table(spark, sf_dir, "events").select("event_id", codec.position_key(file, F.col("event_id") * 4).alias("p")).select("event_id", "p.*")


@query("SELECT doc_id, length(text) AS chars, strlen(text) AS bytes, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || '... (truncated)' ELSE text END AS shown, replace(replace(replace(lang, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS lang FROM documents")
def text_functions(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.length("text").cast("long").alias("chars"), F.octet_length("text").cast("long").alias("bytes"), codec.shortened(F.col("text")).alias("shown"), codec.html_escape(F.col("lang")).alias("lang"))


@query("SELECT event_id, event_type || ' connection reset' AS message, true AS transient FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, event_type, false FROM events WHERE event_type <> 'error'")
def error_class(spark, sf_dir):
    message = F.when(F.col("event_type") == "error", F.concat("event_type", F.lit(" connection reset"))).otherwise(F.col("event_type"))
    return _table(spark, sf_dir, "events").select("event_id", message.alias("message"), codec.is_transient(message).alias("transient"))


@query("SELECT batch, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM (SELECT event_id, CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / 200) AS BIGINT) AS batch FROM events) GROUP BY batch")
def count_batches(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("ts", "event_id")
    return ordering.chunks(_bucketed(rows), F.col("bucket"), ["ts", "event_id"], 200).groupBy("batch").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("SELECT segment, user_id, count(*) AS n, min(event_id) AS first FROM (SELECT event_id, user_id, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM events) GROUP BY segment, user_id")
def ddl_barrier_groups(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("ts", "event_id", "user_id", "event_type")
    cut = ordering.segments(_bucketed(rows), F.col("bucket"), ["ts", "event_id"], F.col("event_type") == "error")
    return cut.groupBy("segment", "user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query("SELECT event_type, kind, count(*) AS n, min(event_id) AS first, max(event_id) AS last, string_agg(props, ',' ORDER BY ts, event_id) AS texts FROM (SELECT *, CAST(sum(new) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM (SELECT *, event_id % 2 AS kind, CASE WHEN event_type = lag(event_type) OVER (ORDER BY ts, event_id) AND event_id % 2 = lag(event_id % 2) OVER (ORDER BY ts, event_id) THEN 0 ELSE 1 END AS new FROM events)) GROUP BY island, event_type, kind")
def debug_merge(spark, sf_dir):
    """Runs of equal type and kind as one row each, with all their texts."""
    rows = _table(spark, sf_dir, "events").select("ts", "event_id", "event_type", (F.col("event_id") % 2).alias("kind"), "props")
    found = ordering.merged(_bucketed(rows), F.col("bucket"), ["ts", "event_id"], ["event_type", "kind"], F.col("props"))
    return found.select("event_type", "kind", "n", F.col("first.event_id").alias("first"), F.col("last.event_id").alias("last"), "texts")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def reconcile_missing(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile.missing(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE l_orderkey = o_orderkey AND o_orderstatus = 'F')")
def reconcile_extra(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return reconcile.extra(orders, _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"])


def _two_orders(spark, sf_dir):
    source = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    target = source.where("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return source, target


@query("SELECT o_orderkey, 'o_orderstatus' AS differs FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 AND o_orderstatus <> 'X'")
def reconcile_mismatched(spark, sf_dir):
    source, target = _two_orders(spark, sf_dir)
    return reconcile.mismatched(source, target, ["o_orderkey"], ["o_custkey", "o_orderstatus"]).select("o_orderkey", F.array_join("columns", ",").alias("differs"))


@query("SELECT count(*) AS source_rows, CAST(count_if(o_orderkey % 7 <> 0) AS BIGINT) AS target_rows, CAST(count_if(o_orderkey % 7 = 0) AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra, CAST(count_if(o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0 AND o_orderstatus <> 'X') AS BIGINT) AS mismatched FROM orders")
def reconcile_summary(spark, sf_dir):
    source, target = _two_orders(spark, sf_dir)
    return reconcile.summary(source, target, ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@query(f"SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(md5({_row_sql('o_orderkey', 'o_custkey', 'o_orderstatus')}), 1, 15) AS BIGINT)) AS VARCHAR) AS total FROM orders")
def table_checksum(spark, sf_dir):
    return reconcile.checksum(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(f"SELECT md5(string_agg(s, '' ORDER BY part)) AS checksum FROM (SELECT o_orderkey // 1000 AS part, md5(string_agg(md5({_row_sql('o_orderkey', 'o_custkey', 'o_orderstatus')}), '' ORDER BY o_orderkey)) AS s FROM orders GROUP BY part)")
def ordered_checksum(spark, sf_dir):
    return reconcile.ordered_checksum(_table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"], ["o_orderkey"], F.floor(F.col("o_orderkey") / 1000))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def event_type_counts(spark, sf_dir):
    return _table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, CAST(count_if(quality IS NULL) AS BIGINT) AS no_quality, CAST(count_if(toxic IS NULL) AS BIGINT) AS no_toxic, CAST(count_if(text = '') AS BIGINT) AS empty_text FROM documents LEFT JOIN labels USING (doc_id)")
def null_profile(spark, sf_dir):
    both = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    return both.agg(F.count("*").alias("n"), F.count_if(F.isnull("quality")).alias("no_quality"), F.count_if(F.isnull("toxic")).alias("no_toxic"), F.count_if(F.col("text") == "").alias("empty_text"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click', 'error') AND event_type NOT IN ('error')")
def table_filter(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", "event_type").where(feed.allowed(F.col("event_type"), ["view", "click", "error"], ["error"]))


@query("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def managed_tables(spark, sf_dir):
    managed = _table(spark, sf_dir, "labels").where("toxic = 0").select("doc_id")
    return _table(spark, sf_dir, "documents").select("doc_id", "source").join(managed, "doc_id", "left_semi")


@query("SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k, coalesce(TRY_CAST(event_type AS DATE), DATE '1970-01-01') AS d, coalesce(CASE WHEN event_type = 'view' THEN NULL ELSE event_type END, '') AS s FROM events")
def null_defaults(spark, sf_dir):
    def with_default(c, kind):
        return F.coalesce(codec.decode(c, kind), F.expr(types.fallback_expr(kind)))

    k = with_default(F.get_json_object("props", "$.k"), T.IntegerType())
    s = with_default(F.when(F.col("event_type") != "view", F.col("event_type")), T.StringType())
    return _table(spark, sf_dir, "events").select("event_id", k.alias("k"), with_default(F.col("event_type"), T.DateType()).alias("d"), s.alias("s"))


def _feed_rows(spark, sf_dir):
    """events as feed rows; every tenth carries a text where a number belongs."""
    text = F.when(F.col("event_id") % 10 == 0, "not-a-number").otherwise(F.col("event_id").cast("string"))
    image = F.create_map(F.lit("id"), text, F.lit("kind"), F.col("event_type"), F.lit("extra"), F.lit("dropped"))
    return _table(spark, sf_dir, "events").select(F.lit(changelog.INSERT).alias("type"), F.col("event_id").alias("seq"), F.col("event_id").alias("commit_time"), image.alias("image"))


FEED_SPEC = TableSpec("feed", (Field("id", "int", False), Field("kind", "string", False), Field("absent", "bigint", False)), ("id",))


@query("SELECT event_id AS seq, event_id AS commit_time, 'id: not int: not-a-number' AS error_reason FROM events WHERE event_id % 10 = 0")
def quarantined(spark, sf_dir):
    _, bad = quarantine.split(changelog.typed(_feed_rows(spark, sf_dir), FEED_SPEC), FEED_SPEC)
    return bad.select("seq", "commit_time", "error_reason")


@query("SELECT CAST(event_id AS INTEGER) AS id, event_type AS kind, CAST(0 AS BIGINT) AS absent, event_id AS commit_time, CAST(0 AS BIGINT) AS delete_time, event_id AS seq FROM events WHERE event_id % 10 <> 0")
def late_typing(spark, sf_dir):
    good, _ = quarantine.split(changelog.typed(_feed_rows(spark, sf_dir), FEED_SPEC), FEED_SPEC)
    return good


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'b' ELSE event_type END AS kind, CASE event_id % 3 WHEN 2 THEN NULL ELSE 'kept' END AS other FROM events")
def update_image(spark, sf_dir):
    def values(*pairs):
        return F.create_map(*(x for k, v in pairs for x in (F.lit(k), v)))

    before = values(("kind", F.lit("a")), ("other", F.lit("kept")))
    after = F.when(F.col("event_id") % 3 == 0, values(("kind", F.lit("b")))).when(F.col("event_id") % 3 == 1, values(("kind", F.col("event_type"))))
    merged = changelog.image(before, after, values(("kind", F.col("event_type"))))
    return _table(spark, sf_dir, "events").select("event_id", F.try_element_at(merged, F.lit("kind")).alias("kind"), F.try_element_at(merged, F.lit("other")).alias("other"))


@query("SELECT doc_id AS id, lang, CASE WHEN doc_id < 100 THEN 'unset' ELSE source END AS source, CAST(n_chars AS VARCHAR) AS size FROM documents")
def evolved_view(spark, sf_dir):
    """A column added with a default, one dropped, one made wider."""
    spec = TableSpec("d", (Field("id", "bigint"), Field("lang", "string"), Field("text", "string"), Field("size", "bigint")), ("id",))
    spec = spec.evolve([{"COLUMN_NAME": "source", "DATA_TYPE": "varchar", "COLUMN_TYPE": "varchar(20)", "IS_NULLABLE": "YES", "COLUMN_DEFAULT": "unset"}], at=100).hide("text").widen("size", "string")
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "text", F.col("n_chars").alias("size"), F.when(F.col("doc_id") >= 100, F.col("source")).alias("source"), F.col("doc_id").alias("commit_time"), F.lit(0).cast("long").alias("delete_time"))
    return spec.view(docs).drop("commit_time", "delete_time")


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'drop' WHEN 'view' THEN 'alter' WHEN 'click' THEN CASE event_id % 3 WHEN 0 THEN 'truncate' WHEN 1 THEN 'rename' END END AS kind, event_type = 'purchase' AS frames FROM events")
def ddl_classify(spark, sf_dir):
    """Every event as a statement, with comments before it."""
    t = F.concat(F.lit("t"), F.col("event_id"))
    kinds = {"signup": F.concat(F.lit("-- note\nCREATE TABLE IF NOT EXISTS "), t, F.lit(" (id INT)")), "error": F.concat(F.lit("/* x */ drop TABLE IF EXISTS `d`."), t), "view": F.concat(F.lit("ALTER TABLE "), t, F.lit(" ADD x INT")), "purchase": F.lit("# y\n savepoint s")}
    clicks = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("TRUNCATE "), t)).when(F.col("event_id") % 3 == 1, F.concat(F.lit("RENAME TABLE "), t, F.lit(" TO u"))).otherwise(F.lit("GRANT ALL ON x"))
    statement = F.lit(None).cast("string")
    for kind, text in kinds.items():
        statement = F.when(F.col("event_type") == kind, text).otherwise(statement)
    statement = F.coalesce(statement, clicks)
    return _table(spark, sf_dir, "events").select("event_id", schema_change.kind_column(statement).alias("kind"), schema_change.transaction_column(statement).alias("frames"))


@query("SELECT event_id, strftime(ts + INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') AS shown FROM events")
def local_time(spark, sf_dir):
    return _table(spark, sf_dir, "events").select("event_id", F.date_format(codec.local_time(F.col("ts").cast("timestamp"), "+04:00"), "yyyy-MM-dd HH:mm:ss").alias("shown"))


@query("SELECT event_id AS seq FROM events WHERE event_id % 3 <> 0 AND event_type <> 'signup'")
def lacking_images(spark, sf_dir):
    """Updates and deletes that came without the row they are about."""
    values = F.create_map(F.lit("id"), F.col("user_id").cast("string"))
    none = F.lit(None).cast("map<string,string>")
    kind = F.when(F.col("event_type") == "error", changelog.DELETE).when(F.col("event_type") == "signup", changelog.INSERT).otherwise(changelog.UPDATE)
    whole = F.col("event_id") % 3 == 0
    row = F.struct(F.when(whole & (kind != changelog.UPDATE), values).otherwise(none).alias("values"), none.alias("before_values"), F.when(whole & (kind == changelog.UPDATE), values).otherwise(none).alias("after_values"))
    return feed.full_images(_table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), kind.alias("type"), F.array(row).alias("rows"))).select("seq")


def _scratch(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{folder.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


@query(_SQL["latest_active"])
def stream_latest(spark, sf_dir):
    """events as a file stream into a log, one batch for what is there, then the live rows."""
    root = _scratch(spark)
    rows = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        _log(batch).write.mode("overwrite").parquet(f"{root}/log/batch_id={batch_id}")

    running = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    return state.active(spark.read.parquet(f"{root}/log").drop("batch_id"), ["id"]).select(*_COLUMNS)


def _envelopes(rows: DataFrame, poison: bool = False) -> DataFrame:
    """events as envelopes of the change feed; with poison, every tenth id is no number and every seventh table unknown."""
    ident = F.col("user_id").cast("string")
    table = F.lit("users")
    if poison:
        ident = F.when(F.col("event_id") % 10 == 0, "poison").otherwise(ident)
        table = F.when(F.col("event_id") % 7 == 0, "strangers").otherwise(table)
    values = F.create_map(F.lit("id"), ident, F.lit("kind"), F.col("event_type"))
    kind = F.when(F.col("event_type") == "error", changelog.DELETE).when(F.col("event_type") == "signup", changelog.INSERT).otherwise(changelog.UPDATE)
    updated = kind == changelog.UPDATE
    change = F.struct(F.when(~updated, values).alias("values"), F.when(updated, values).alias("before_values"), F.when(updated, values).alias("after_values"))
    return rows.select(F.col("event_id").alias("seq"), F.lit("bin.000001").alias("file"), F.col("event_id").alias("pos"), kind.alias("type"), _micros().alias("timestamp"), F.lit("db").alias("schema"), table.alias("table"), F.lit(None).cast("string").alias("query"), F.lit(None).cast("string").alias("columns"), F.array(change).alias("rows"))


USERS = TableSpec("users", (Field("id", "bigint", False), Field("kind", "string")), ("id",))


def _streamed(spark, sf_dir, poison: bool = False, extra: DataFrame | None = None, times: int = 1) -> LogStore:
    """A store that events were streamed into, `times` with a checkpoint of their own, after the envelopes of `extra`."""
    root = _scratch(spark)
    store = LogStore(spark, root)
    ingest = Ingest(store, [USERS], schemas=["db"])
    if extra is not None:
        ingest(extra, 0, "before")
    for i in range(times):
        rows = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        start(_envelopes(rows, poison), ingest, f"{root}/checkpoint{i}").awaitTermination()
    return store


LAST_USERS = "SELECT user_id AS id, event_type AS kind, event_id AS seq FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"


@query(LAST_USERS)
def stream_ingest(spark, sf_dir):
    """events as envelopes, streamed through the whole ingest: versions, types, quarantine, manifest, live rows."""
    store = _streamed(spark, sf_dir)
    return state.current(store.log("users"), USERS).select("id", "kind", "seq")


@query(LAST_USERS)
def stream_replayed(spark, sf_dir):
    """The same sent twice, by two checkpoints, and compacted: the live rows are the same."""
    store = _streamed(spark, sf_dir, times=2)
    store.compact("users")
    return state.current(store.log("users"), USERS).select("id", "kind", "seq")


COLUMNS = '[{"COLUMN_NAME": "id", "DATA_TYPE": "bigint", "COLUMN_TYPE": "bigint", "IS_NULLABLE": "NO", "COLUMN_DEFAULT": null}, {"COLUMN_NAME": "kind", "DATA_TYPE": "varchar", "COLUMN_TYPE": "varchar(20)", "IS_NULLABLE": "YES", "COLUMN_DEFAULT": null}]'


@query(f"SELECT 'users' AS tbl, id, kind, seq FROM ({LAST_USERS}) UNION ALL SELECT 'users_old', user_id, event_type, -1000000 + event_id FROM events WHERE event_id < 50 AND event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def stream_renames(spark, sf_dir):
    """A table renamed, another made under its name and truncated, another schema's statements: each keeps its own rows."""
    early = _envelopes(_table(spark, sf_dir, "events").where("event_id < 50 and event_type <> 'error'"))
    early = early.withColumn("seq", F.col("seq") - 1_000_000)
    sent = [(-500_000, "db", "RENAME TABLE users TO users_old", None), (-400_000, "db", "CREATE TABLE `db`.`users` (id BIGINT, kind VARCHAR(20))", COLUMNS), (-300_000, "other", "DROP TABLE users_old", None), (-200_000, "db", "TRUNCATE TABLE users", None)]
    made = [(seq, "bin.000000", 0, feed.QUERY, 0, schema, None, text, columns, []) for seq, schema, text, columns in sent]
    store = _streamed(spark, sf_dir, extra=early.unionByName(spark.createDataFrame(made, feed.SCHEMA)))
    parts = [state.current(store.log(t), store.registry()[t]).select(F.lit(t).alias("tbl"), "id", "kind", "seq") for t in ("users", "users_old")]
    return parts[0].unionByName(parts[1])


KINDS = "(SELECT CASE WHEN event_id % 7 = 0 OR event_id % 10 = 0 THEN 'quarantined' ELSE 'logged' END AS stage, CASE WHEN event_id % 7 = 0 THEN 'strangers' ELSE 'users' END AS tbl FROM events)"


@query(f"SELECT stage, tbl, count(*) AS n FROM {KINDS} GROUP BY stage, tbl")
def queue_depths(spark, sf_dir):
    return _streamed(spark, sf_dir, poison=True).depths().select("stage", F.col("table").alias("tbl"), F.col("count").alias("n"))


@query(f"SELECT tbl, count(*) AS n FROM {KINDS} GROUP BY tbl")
def row_totals(spark, sf_dir):
    return _streamed(spark, sf_dir, poison=True).totals().select(F.col("table").alias("tbl"), F.col("rows").alias("n"))


@query("SELECT event_id AS seq, CASE WHEN event_id % 7 = 0 THEN 'table isn''t registered' ELSE 'id: not bigint: poison' END AS reason FROM events WHERE event_id % 7 = 0 OR event_id % 10 = 0")
def dead_letters(spark, sf_dir):
    return _streamed(spark, sf_dir, poison=True).quarantine().select("seq", F.col("error_reason").alias("reason"))


@query("SELECT o_orderkey AS id, o_custkey, o_orderstatus, CAST(7 AS BIGINT) AS commit_time, CAST(0 AS BIGINT) AS delete_time, CAST(-1 AS BIGINT) AS seq FROM orders")
def snapshot_copy(spark, sf_dir):
    """A table found in its folder, copied in ranges of its key, and read back from the store."""
    if "orders" not in snapshot.discover(snapshot.tables_in(spark, sf_dir), None, ["lineitem"]):
        raise LookupError("orders isn't found")
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus")
    spec = TableSpec("orders", tuple(Field(f.name, f.dataType.simpleString()) for f in rows.schema), ("id",))
    store = LogStore(spark, _scratch(spark))
    path = f"{store.root}/snapshots/orders/7"
    snapshot.copied(rows, snapshot.strategy(rows.schema, ["id"]), 7, path, 1 << 22)
    store.put_base("orders", spec, path, 7)
    return store.log("orders")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
