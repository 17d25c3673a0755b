"""Change feed to versioned logs, batch by batch.

Versions follow the source's order, not the time of arrival: base + (seq - first seq) * rows an event can have +
ordinal, with a base that is set down before anything is written.  Schema statements cut a batch into intervals; which
storage a row belongs to follows from its table and its place among them, so that a batch is one write for all tables
and intervals.  Values that don't fit carry the reason; faults of the system fail the batch, which then runs again with
the same versions.  A batch is known by its query and number: a new checkpoint is a new query, and what it sends again
gets newer versions of the same rows.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import changelog, quarantine, schema_change
from tidemark.plans.registry import VERSION, Registry, TableSpec
from tidemark.sources import feed
from tidemark.streaming.store import LogStore

log = logging.getLogger(__name__)
_BEGIN, _END = -(2**63), 2**63 - 1
_INTERVALS = T.StructType([T.StructField("_table", T.StringType()), T.StructField("_from", T.LongType()), T.StructField("_to", T.LongType()), T.StructField("storage", T.StringType())])


def _columns_of(statement) -> Callable[[str], Iterable[Mapping]]:
    """Column metadata that came with a schema statement, as a JSON list."""
    return lambda table: json.loads(statement["columns"] or "[]")


class Ingest:
    """include and exclude filter tables, schemas the source's databases; on_bad is told of tables with quarantined rows."""

    def __init__(self, store: LogStore, specs: Iterable[TableSpec] = (), include=None, exclude=None, schemas=None, tombstone_on_key_change: bool = False, on_bad: Callable[[str, int], None] | None = None):
        self.store, self.include, self.exclude, self.schemas, self.on_bad = store, include, exclude, schemas, on_bad
        self.tombstone_on_key_change = tombstone_on_key_change
        self.first_specs = list(specs)

    def allowed(self, name: str) -> bool:
        return feed.allowed_name(name, self.include, self.exclude)

    def __call__(self, batch: DataFrame, batch_id: int, stream: str | None = None) -> None:
        if stream is None:
            stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        entry = self.store.last()
        if batch_id <= entry["streams"].get(stream, -1):
            log.info("batch %d of %s is done", batch_id, stream)
            return
        batch = batch.persist()
        try:
            self._run(batch, batch_id, stream, entry)
        finally:
            batch.unpersist()

    def _run(self, batch: DataFrame, batch_id: int, stream: str, entry: dict) -> None:
        streams = entry["streams"] | {stream: batch_id}
        if entry["after"] is not None:  # a snapshot holds what came up to there
            batch = batch.where(F.col("seq") > entry["after"])
        events = feed.row_events(batch, self.include, self.exclude, self.schemas)
        span = batch.agg(F.min("seq"), F.max("seq"), F.max(F.coalesce(F.size("rows"), F.lit(0)))).first()
        if span[0] is None:
            self.store.commit(streams=streams)
            return
        width = max(span[2] or 0, 0) + 1
        key = f"{stream}-{batch_id}"
        base = self.store.plan(key, max(entry["last"] + 1, time.time_ns()))
        at = (F.lit(base) + (F.col("seq") - F.lit(span[0])) * width).cast("long")

        registry, storage, hidden = Registry.from_json(entry["registry"]), dict(entry["storage"]), dict(entry["hidden_to"])
        number = entry["next_storage"]
        for spec in self.first_specs:
            if entry["n"] < 0 or spec.name not in storage and not entry["batches"]:
                registry.put(spec)
        for name in registry.specs:
            if name not in storage:
                storage[name], number = f"s{number}", number + 1
        begun = {name: (s, _BEGIN) for name, s in storage.items()}  # table: its storage and since when
        specs = {s: registry[name] for name, s in storage.items()}
        intervals: list[tuple] = []

        def end(table: str, seq: int) -> str:
            own, since = begun.pop(table)
            intervals.append((table, since, seq, own))
            specs[own] = registry[table] if table in registry else specs[own]
            return own

        for statement in feed.statements(batch).orderBy("seq").collect():  # schema statements are few
            seq, change = statement["seq"], schema_change.parse(statement["query"])
            if change.kind is None:
                log.warning("statement isn't recognised: %.200s", statement["query"])
                continue
            change = change.inside(statement["schema"], self.schemas)
            version = base + (seq - span[0]) * width
            before = {name: registry[name] for name in registry.specs}
            for action, table, new in schema_change.apply(change, registry, self.allowed, _columns_of(statement), seq):
                if action == "create" and table not in begun and table in registry:
                    begun[table], number = (f"s{number}", seq), number + 1
                    specs[begun[table][0]] = registry[table]
                elif action == "truncate" and table in begun:
                    hidden[begun[table][0]] = version
                elif action == "drop" and table in begun:
                    specs[begun[table][0]] = before[table]
                    end(table, seq)
                elif action == "rename" and table in begun:
                    own = end(table, seq)
                    specs[own] = before[table].rename(new)
                    begun[new] = (own, seq)
        for table in list(begun):
            since = begun[table]
            end(table, _END)
            begun[table] = since
        storage = {table: own for table, (own, _) in begun.items()}

        rows = changelog.exploded(events)
        if self.tombstone_on_key_change:
            for own in {s.key: s for s in specs.values()}.values():
                names = [s.name for s in specs.values() if s.key == own.key]
                rows = rows.unionByName(changelog.tombstones_on_key_change(events.where(F.col("table").isin(*names)), own))
        where = (F.col("table") == F.col("_table")) & (F.col("seq") > F.col("_from")) & (F.col("seq") < F.col("_to"))
        known = F.broadcast(batch.sparkSession.createDataFrame(intervals, _INTERVALS))  # a row a table and schema statement
        rows = rows.withColumn(VERSION, at + F.col("ordinal")).join(known, where, "left")
        used = {s for _, _, _, s in intervals}
        reason = F.when(F.col("storage").isNull(), "table isn't registered")
        for own in sorted(used):
            reason = reason.when(F.col("storage") == own, quarantine.image_reason(specs[own]))
        self.store.write(rows.withColumn("error_reason", reason).withColumn("storage", F.coalesce("storage", F.lit("unknown"))), key)
        found = self._found(key)
        last = base + (span[1] - span[0] + 1) * width
        batches = [*entry["batches"], {"key": key, "last": last, "storages": sorted({r["storage"] for r in found}), "bad": any(r["bad"] for r in found)}]
        self.store.commit(last=last, batches=batches, streams=streams, registry=registry.to_json(), storage=storage, hidden_to=hidden, next_storage=number)
        for r in found:
            if r["storage"] == "unknown":
                log.warning("%d rows of %s are set aside: the table isn't registered", r["bad"], r["table"])
            elif r["bad"] and self.on_bad is not None:
                self.on_bad(r["table"], r["bad"])

    def _found(self, key: str) -> list:
        """Rows by storage and table of the batch just written, and how many were set aside."""
        rows = self.store._journal({"batches": [{"key": key}]})
        return rows.groupBy("storage", "table").agg(F.count("error_reason").alias("bad")).collect()  # a row a table


def start(events: DataFrame, ingest: Ingest, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run ingest on a stream: every interval, or once over all that is there."""
    writer = events.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
