import json

import pytest

from tidemark import __main__ as main
from tidemark.operators import state
from tidemark.plans import settings
from tidemark.sources import snapshot
from tidemark.streaming.store import LogStore


@pytest.fixture
def place(spark, tmp_path):
    """A source database of three tables, and settings for it."""
    spark.range(1, 1001).selectExpr("id", "concat('n', id) name").write.parquet(str(tmp_path / "db" / "keyed.parquet"))
    spark.sql("select 'a' k, 1 v union all select 'b', 2").write.parquet(str(tmp_path / "db" / "plain.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "db" / "left_out.parquet"))
    (tmp_path / "feed").mkdir()

    def write(mode, **cdc):
        data = {"mysql": {"database": str(tmp_path / "db"), "exclude_tables": ["left_out"]}, "clickhouse": {"path": str(tmp_path / "log")}, "state_file": str(tmp_path / "state.json")}
        data["migration"] = {"mode": mode, "batch_rows": 1, "cdc": {"path": str(tmp_path / "feed")} | cdc}
        (tmp_path / "s.json").write_text(json.dumps(data))
        return ["--config", str(tmp_path / "s.json"), "--once"]

    return write


def event(seq, kind, table, **images):
    row = {"values": None, "before_values": None, "after_values": None} | images
    return json.dumps({"seq": seq, "file": "bin.000001", "pos": seq * 10, "type": kind, "schema": "db", "table": table, "query": None, "columns": None, "rows": [row]})


def live(store, table):
    return state.current(store.log(table), store.registry()[table])


def test_snapshot_of_all_tables(spark, tmp_path, place, monkeypatch):
    monkeypatch.setattr(main, "PAGES", 300)
    assert main.main(place("snapshot"), spark) == 0
    store = LogStore(spark, str(tmp_path / "log"))
    assert sorted(store.last()["storage"]) == ["keyed", "plain"]
    assert live(store, "keyed").count() == 1000 and live(store, "plain").count() == 2
    done = settings.State(str(tmp_path / "state.json"))
    assert done.table("keyed")["rows_processed"] == 1000 and done.table("keyed")["last_pk"] == 1000


def test_a_snapshot_that_broke_off_goes_on(spark, tmp_path, place, monkeypatch):
    monkeypatch.setattr(main, "PAGES", 200)
    kept, told = settings.State.progress, []

    def breaks(self, name, rows=0, last_pk=None, done=False):
        kept(self, name, rows, last_pk, done)
        told.append((name, last_pk))
        if name == "keyed" and sum(t == "keyed" for t, _ in told) == 2:
            raise RuntimeError("the power went")

    monkeypatch.setattr(settings.State, "progress", breaks)
    assert main.main(place("snapshot"), spark) == 3
    reached = settings.State(str(tmp_path / "state.json")).table("keyed")
    assert 0 < reached["last_pk"] < 1000 and reached["rows_processed"] < 1000
    monkeypatch.setattr(settings.State, "progress", kept)
    read = []
    whole = snapshot.ranges
    monkeypatch.setattr(snapshot, "ranges", lambda df, key, size, after=None: read.append(after) or whole(df, key, size, after))
    assert main.main(place("snapshot"), spark) == 0
    assert reached["last_pk"] in read
    store = LogStore(spark, str(tmp_path / "log"))
    rows = live(store, "keyed")
    assert rows.count() == rows.select("id").distinct().count() == 1000
    assert settings.State(str(tmp_path / "state.json")).table("keyed")["rows_processed"] == 1000


def test_changes_before_the_snapshot_stay_behind_it(spark, tmp_path, place):
    """What the feed held when the copy began is in the copy; what came later is applied."""
    (tmp_path / "feed" / "1.json").write_text(event(1, "UpdateRowsEvent", "keyed", before_values={"id": "5", "name": "n4"}, after_values={"name": "stale"}) + "\n")
    assert main.main(place("cdc"), spark) == 0
    store = LogStore(spark, str(tmp_path / "log"))
    assert live(store, "keyed").where("id = 5").first()["name"] == "n5"
    (tmp_path / "feed" / "2.json").write_text(event(2, "UpdateRowsEvent", "keyed", before_values={"id": "5", "name": "n5"}, after_values={"name": "later"}) + "\n" + event(3, "DeleteRowsEvent", "keyed", values={"id": "6", "name": "n6"}) + "\n")
    assert main.main(place("cdc"), spark) == 0
    assert live(store, "keyed").where("id = 5").first()["name"] == "later" and live(store, "keyed").count() == 999
    assert main.main(place("cdc", force_binlog_position="bin.000001:30"), spark) == 0  # the delete again
    assert live(store, "keyed").count() == 999 and settings.State(str(tmp_path / "state.json")).get()["binlog"] == {"file": "bin.000001", "pos": 10}


def test_exit_codes(spark, tmp_path, place):
    assert main.main(["--config", str(tmp_path / "none.json")], spark) == 2
    assert main.main(place("sideways"), spark) == 4
