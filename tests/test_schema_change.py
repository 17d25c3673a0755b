from tidemark.operators.schema_change import apply, is_transaction_control, parse, strip_comments
from tidemark.plans.registry import Registry, TableSpec


def columns(*names):
    return [{"COLUMN_NAME": n, "DATA_TYPE": "int", "COLUMN_TYPE": "int", "IS_NULLABLE": "NO", "COLUMN_DEFAULT": None} for n in names]


def test_parse():
    assert parse("CREATE TABLE IF NOT EXISTS `db`.`users` (id INT)").tables == ("users",)
    assert parse("/* cdc */\n-- skip\nALTER TABLE orders ADD COLUMN x INT").kind == "alter"
    assert parse("TRUNCATE items").tables == ("items",)
    assert parse("DROP TABLE IF EXISTS `db`.`t1`, t2;").tables == ("t1", "t2")
    assert parse("RENAME TABLE a TO b, `db`.`c` TO `db`.`d`").pairs == (("a", "b"), ("c", "d"))
    assert parse("GRANT x").kind is None and parse(None).kind is None
    assert strip_comments("-- only comment") == ""


def test_transactions():
    assert is_transaction_control("/* x */ BEGIN") and is_transaction_control("savepoint s1")
    assert not is_transaction_control("XA START 'x'")


def test_keys_and_engines():
    assert TableSpec.from_columns("t", columns("id", "k"), ["k"]).key == ("id",)
    assert TableSpec.from_columns("t", columns("a", "b"), ["b", "a"]).key == ("b", "a")
    assert TableSpec.from_columns("t", columns("a")).key == ()
    assert TableSpec.from_columns("t", columns("id"), engine="MergeTree").mode == "history"
    assert "ORDER BY (`id`, `commit_time`)" in TableSpec.from_columns("t", columns("id"), engine="MergeTree").ddl()
    spec = TableSpec.from_columns("t", columns("id"))
    assert TableSpec.from_json(spec.to_json()) == spec


def test_apply():
    registry = Registry([TableSpec.from_columns("a", columns("id"))])
    everything = lambda _: True
    apply(parse("ALTER TABLE a ADD b INT"), registry, everything, lambda _: columns("id", "b"), 7)
    assert registry["a"].names == ["id", "b"] and registry["a"].fields[1].added_at == 7
    assert apply(parse("RENAME TABLE a TO z"), registry, everything) == [("rename", "a", "z")]
    assert "z" in registry and "a" not in registry
    assert apply(parse("DROP TABLE z, q"), registry, lambda t: t == "z") == [("drop", "z", None)]
    assert "z" not in registry
