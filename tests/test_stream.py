import json

from tidemark.operators import state
from tidemark.plans.registry import Field, TableSpec
from tidemark.sources import feed
from tidemark.streaming.ingest import Ingest, start
from tidemark.streaming.store import LogStore

SPEC = TableSpec("t", (Field("id", "int", False), Field("data", "string")), ("id",))


def event(seq, kind, table="t", values=None, before=None, after=None, query=None, columns=None):
    rows = [] if query else [{"values": values, "before_values": before, "after_values": after}]
    return {"seq": seq, "file": "bin.000001", "pos": seq, "type": kind, "schema": "db", "table": table, "query": query, "columns": columns, "rows": rows}


def put(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events))


def run(spark, folder, store, checkpoint, **options):
    start(feed.stream(spark, str(folder)), Ingest(store, [SPEC], **options), str(checkpoint)).awaitTermination()


def live(store, table="t"):
    spec = store.registry()[table]
    return sorted(map(tuple, state.current(store.log(table), spec).drop("commit_time", "delete_time", "seq").collect()))


def test_changes_barriers_quarantine_and_restart(spark, tmp_path):
    W, U, D, Q = "WriteRowsEvent", "UpdateRowsEvent", "DeleteRowsEvent", "QueryEvent"
    more = json.dumps([{"COLUMN_NAME": n, "DATA_TYPE": t, "COLUMN_TYPE": t, "IS_NULLABLE": "YES", "COLUMN_DEFAULT": d} for n, t, d in (("id", "int", None), ("data", "varchar", None), ("extra", "varchar", "x"))])
    put(
        tmp_path / "feed",
        "1.json",
        [
            event(1, W, values={"id": "1", "data": "a", "unknown": "dropped"}),
            event(2, W, values={"id": "2", "data": "b"}),
            event(3, Q, query="BEGIN"),
            event(4, U, before={"id": "1", "data": "a"}, after={"data": "a2"}),
            event(5, D, values={"id": "2", "data": "b"}),
            event(6, W, values={"id": "poison", "data": "p"}),
            event(7, W, values={"id": "3", "data": None}),
            event(8, W, table="other", values={"id": "9"}),
            event(9, Q, query="ALTER TABLE t ADD extra VARCHAR(10) DEFAULT 'x'", columns=more),
            event(10, W, values={"id": "4", "data": "", "extra": "y"}),
        ],
    )
    store, told = LogStore(spark, str(tmp_path / "log")), []
    run(spark, tmp_path / "feed", store, tmp_path / "cp", on_bad=lambda t, n: told.append((t, n)))
    assert live(store) == [(1, "a2", "x"), (3, None, "x"), (4, "", "y")]
    assert told == [("t", 1)]
    assert sorted(r.table for r in store.quarantine().collect()) == ["other", "t"]
    assert store.log("t").count() == 6
    versions = [r.commit_time for r in store.log("t").orderBy("seq").collect()]
    assert versions == sorted(set(versions))
    run(spark, tmp_path / "feed", store, tmp_path / "cp")  # nothing new
    assert store.log("t").count() == 6
    run(spark, tmp_path / "feed", store, tmp_path / "cp2")  # all of it again under newer versions
    assert live(store) == [(1, "a2", "x"), (3, None, "x"), (4, "", "y")]
    assert store.log("t").count() == 12
    put(tmp_path / "feed", "2.json", [event(11, D, values={"id": "1", "data": "a2"}), event(12, Q, query="RENAME TABLE t TO u"), event(13, W, table="u", values={"id": "5", "data": "n"}), event(14, Q, query="TRUNCATE u"), event(15, W, table="u", values={"id": "6", "data": "m", "extra": "z"})])
    run(spark, tmp_path / "feed", store, tmp_path / "cp")
    assert live(store, "u") == [(6, "m", "z")]
    assert {(r.stage, r.table, r["count"]) for r in store.depths().collect()} >= {("quarantined", "t", 2), ("quarantined", "other", 2), ("logged", "u", 2)}
    assert store.totals().first()["table"] == "t"
    store.compact("u")
    assert live(store, "u") == [(6, "m", "z")] and store.log("u").count() == 1
    put(tmp_path / "feed", "3.json", [event(16, U, table="u", before={"id": "6", "data": "m", "extra": "z"}, after={"data": "m2"}), event(17, W, table="u", values={"id": "7", "data": "q"})])
    run(spark, tmp_path / "feed", store, tmp_path / "cp")
    assert live(store, "u") == [(6, "m2", "z"), (7, "q", None)]
    store.reset()
    assert store.last()["n"] == -1


COLUMNS = json.dumps([{"COLUMN_NAME": n, "DATA_TYPE": t, "COLUMN_TYPE": t, "IS_NULLABLE": "YES", "COLUMN_DEFAULT": None} for n, t in (("id", "int"), ("data", "varchar"))])


def test_a_table_made_under_an_old_name_is_another_one(spark, tmp_path):
    W, Q = "WriteRowsEvent", "QueryEvent"
    put(
        tmp_path / "feed",
        "1.json",
        [
            event(1, W, values={"id": "1", "data": "old"}),
            event(2, Q, query="RENAME TABLE t TO t_old"),
            event(3, Q, query="CREATE TABLE t (id INT, data TEXT)", columns=COLUMNS),
            event(4, W, values={"id": "2", "data": "new"}),
            event(5, Q, query="TRUNCATE t"),
            event(6, W, values={"id": "3", "data": "newer"}),
            event(7, W, table="t_old", values={"id": "4", "data": "late"}),
        ],
    )
    store = LogStore(spark, str(tmp_path / "log"))
    run(spark, tmp_path / "feed", store, tmp_path / "cp")
    assert live(store) == [(3, "newer")] and live(store, "t_old") == [(1, "old"), (4, "late")]
    put(tmp_path / "feed", "2.json", [event(8, Q, query="DROP TABLE t"), event(9, Q, query="CREATE TABLE t (id INT, data TEXT)", columns=COLUMNS), event(10, W, values={"id": "9", "data": "third"})])
    run(spark, tmp_path / "feed", store, tmp_path / "cp")
    assert live(store) == [(9, "third")] and live(store, "t_old") == [(1, "old"), (4, "late")]


def test_a_second_checkpoint_loses_nothing(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [event(1, "WriteRowsEvent", values={"id": "1", "data": "a"})])
    store = LogStore(spark, str(tmp_path / "log"))
    run(spark, tmp_path / "feed", store, tmp_path / "cp")
    put(tmp_path / "feed", "2.json", [event(2, "WriteRowsEvent", values={"id": "2", "data": "b"})])
    run(spark, tmp_path / "feed", store, tmp_path / "cp2")
    assert live(store) == [(1, "a"), (2, "b")]


def test_other_schemas_are_not_ours(spark, tmp_path):
    theirs = event(2, "WriteRowsEvent", values={"id": "2", "data": "theirs"}) | {"schema": "db2"}
    put(tmp_path / "feed", "1.json", [event(1, "WriteRowsEvent", values={"id": "1", "data": "a"}), theirs, event(3, "QueryEvent", query="DROP TABLE t") | {"schema": "db2"}, event(4, "QueryEvent", query="TRUNCATE db2.t")])
    store = LogStore(spark, str(tmp_path / "log"))
    run(spark, tmp_path / "feed", store, tmp_path / "cp", schemas=["db"])
    assert live(store) == [(1, "a")]


def test_one_write_for_all_tables(spark, tmp_path, monkeypatch):
    """The jobs of a batch don't grow with its tables and statements."""
    def jobs(name, tables):
        specs = [TableSpec(f"t{i}", SPEC.fields, ("id",)) for i in range(tables)]
        put(tmp_path / name, "1.json", [event(2 * i + 1, "WriteRowsEvent", table=f"t{i}", values={"id": str(i), "data": "x"}) for i in range(tables)] + [event(2 * i + 2, "QueryEvent", query=f"TRUNCATE t{i}") for i in range(0, tables, 2)])
        store = LogStore(spark, str(tmp_path / f"{name}-log"))
        spark.sparkContext.setJobGroup(name, name)
        Ingest(store, specs)(feed.read(spark, str(tmp_path / name)), 0, name)
        assert [store.log(f"t{i}").count() for i in range(tables)] == [i % 2 for i in range(tables)]
        found = spark.sparkContext.statusTracker().getJobIdsForGroup(name)
        return len(found) - tables

    assert abs(jobs("few", 2) - jobs("many", 12)) <= 12


def test_positions(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [event(i, "WriteRowsEvent", values={"id": str(i), "data": "x"}) for i in range(1, 9)])
    assert sorted(r.seq for r in feed.since(feed.read(spark, str(tmp_path / "feed")), "bin.000001", 6).collect()) == [6, 7, 8]
    assert feed.last_position(spark, str(tmp_path / "feed")) == {"seq": 8, "file": "bin.000001", "pos": 8}
    assert feed.last_position(spark, str(tmp_path / "nothing")) is None


def test_key_change_option(spark, tmp_path):
    put(tmp_path / "feed", "1.json", [event(1, "WriteRowsEvent", values={"id": "1", "data": "a"}), event(2, "UpdateRowsEvent", before={"id": "1", "data": "a"}, after={"id": "2", "data": "a"})])
    kept, moved = LogStore(spark, str(tmp_path / "a")), LogStore(spark, str(tmp_path / "b"))
    run(spark, tmp_path / "feed", kept, tmp_path / "cpa")
    run(spark, tmp_path / "feed", moved, tmp_path / "cpb", tombstone_on_key_change=True)
    assert live(kept) == [(1, "a"), (2, "a")]
    assert live(moved) == [(2, "a")]
