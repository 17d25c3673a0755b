"""python -m tidemark --config FILE: copy table snapshots, or follow a change feed, as the settings say.

Snapshots read `<source database>/<table>.parquet` under the source's database folder; the feed is a folder of JSON
envelopes.  Exit codes: 0 done, 1 the query died, 2 settings can't be read, 3 a table's snapshot failed, 4 unknown mode.
"""

from __future__ import annotations

import argparse
import logging
import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tidemark.functions import codec
from tidemark.plans import notify, settings
from tidemark.plans.registry import Field, TableSpec
from tidemark.sources import feed, snapshot
from tidemark.streaming import control
from tidemark.streaming.ingest import Ingest, start
from tidemark.streaming.store import LogStore

log = logging.getLogger("tidemark")
#: Client pages of the settings' batch_rows that one range of a snapshot takes.
PAGES = 1000


def spec_of(name: str, schema, key=None) -> TableSpec:
    fields = tuple(Field(f.name, f.dataType.simpleString(), f.nullable) for f in schema)
    return TableSpec(name, fields, tuple(key or (("id",) if "id" in schema.names else ())))


def copy_tables(spark: SparkSession, s: settings.Settings, store: LogStore, names: list[str], after: int | None = None) -> list[str]:
    """Copy tables side by side, each from where it stopped; the names of those that failed.

    All rows of a copy have one version, set down when it began; `after` is the feed's place at that time.
    """
    state, lock = settings.State(s.state_file), threading.Lock()

    def copy(name: str) -> str | None:
        own = state.table(name)
        if own["status"] == "done":
            return None
        try:
            version = state.begin(name, time.time_ns())
            rows = spark.read.parquet(f"{s.mysql.database}/{name}.parquet")
            spec = spec_of(name, rows.schema)
            path = f"{store.root}/snapshots/{name}/{version}"
            plan = snapshot.strategy(rows.schema, list(spec.key))
            snapshot.copied(rows, plan, version, path, s.migration.batch_rows * PAGES, own["last_pk"], lambda last, n: state.progress(name, n, last))
            with lock:  # the manifest is one document
                store.put_base(name, spec, path, version, after=after)
            state.progress(name, done=True)
            return None
        except Exception:
            log.exception("snapshot of %s failed", name)
            return name

    with ThreadPoolExecutor(max(1, s.migration.workers)) as pool:
        return [n for n in pool.map(copy, names) if n]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("--config", required=True)
    parser.add_argument("--once", action="store_true", help="take what is there and end")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    try:
        s = settings.read(args.config)
    except (OSError, ValueError) as e:
        log.error("settings can't be read: %s", e)
        return control.BAD_CONFIG
    if s.migration.debug:
        log.setLevel(logging.DEBUG)
    if s.migration.mode not in ("snapshot", "cdc"):
        log.error("unknown mode %s", s.migration.mode)
        return control.BAD_MODE
    spark = spark or SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    sender = notify.from_settings(s.notifications, s.environment)
    if sender:
        sender.started({"mode": s.migration.mode, "path": s.clickhouse.path}, s.migration.mode)
    store = LogStore(spark, s.clickhouse.path)
    tables = snapshot.discover(snapshot.tables_in(spark, s.mysql.database), s.mysql.include_tables, s.mysql.exclude_tables)
    state, cdc = settings.State(s.state_file), s.migration.cdc
    if s.migration.mode == "snapshot" or cdc.snapshot_before and store.last()["n"] < 0 or state.unfinished():
        after = None
        if s.migration.mode == "cdc":  # what the feed holds by now is in the snapshot
            after = state.hand_over(lambda: feed.last_position(spark, cdc.path))
        if failed := copy_tables(spark, s, store, tables, after):
            log.error("snapshots failed: %s", ", ".join(failed))
            if sender:
                sender.error("snapshot", ", ".join(failed), "tables weren't copied")
            return control.SNAPSHOT_FAILED
        if s.migration.mode == "snapshot":
            return control.OK
    tell = (lambda table, n: sender.warning("quarantine", table, f"{n} rows set aside")) if sender else None
    schemas = [os.path.basename(s.mysql.database.rstrip("/"))] if s.mysql.database else None
    ingest = Ingest(store, (), s.mysql.include_tables or None, s.mysql.exclude_tables or None, schemas, on_bad=tell)
    if sender:
        control.watch(spark, lambda query, error: sender.error("query", query, codec.first_line(error)))

    def begin(checkpoint: str, position: tuple[str, int] | None):
        events = feed.stream(spark, cdc.path, files_per_batch=cdc.files_per_batch)
        if position is not None:
            events = feed.since(events, *position)
        return start(events, ingest, checkpoint, None if args.once else f"{cdc.producer_flush_interval} seconds")

    runner = control.Controller(begin, f"{s.clickhouse.path}/checkpoint", store.reset)
    forced = control.parse_position(cdc.force_binlog_position) if cdc.force_binlog_position else None
    handed = state.get()["binlog"] if not store.last()["streams"] else None  # a checkpoint knows its own place
    if forced:
        runner.checkpoint = f"{runner.checkpoint}-{forced[0]}-{forced[1]}"
    runner.listen()
    code = runner.run(control.start_position(forced, saved=handed and (handed["file"], handed["pos"])))
    if sender:
        sender.stopped("Normal shutdown" if code == control.OK else "the query died")
    return code


if __name__ == "__main__":
    raise SystemExit(main())
