"""Table specifications: fields, key, defaults, and how they change with the source's schema."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import codec, types

VERSION, DELETED = "commit_time", "delete_time"


@dataclass(frozen=True)
class Field:
    """kind: Spark DDL type; default: Spark expression for rows older than added_at."""

    name: str
    kind: str
    nullable: bool = True
    default: str | None = None
    added_at: int = 0
    label: str = ""

    @property
    def type(self) -> T.DataType:
        return T._parse_datatype_string(self.kind)


@dataclass(frozen=True)
class TableSpec:
    """key: names of key columns, none for a key over the whole row; mode: `latest` or `history`."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    mode: str = "latest"
    hidden: tuple[str, ...] = field(default=())

    @classmethod
    def from_columns(cls, name: str, columns: Iterable[Mapping], primary_key: Iterable[str] = (), engine: str = "replacing", timezone: str | None = None, key: Iterable[str] | None = None) -> TableSpec:
        """From column metadata.  A column named id is the key, else the primary key, else the whole row."""
        columns = list(columns)
        if not columns:
            raise ValueError(f"no columns of table {name}")
        fields = tuple(_field(c, timezone) for c in columns)
        names = [f.name for f in fields]
        if key is None:
            key = ("id",) if "id" in names else tuple(primary_key)
        mode = "latest" if engine.lower().startswith("replacing") else "history"
        return cls(name, fields, tuple(key), mode)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.nullable) for f in self.fields])

    def key_columns(self) -> list[Column]:
        if self.key:
            return [F.col(types.quote(k)) for k in self.key]
        return [codec.row_key(*(F.col(types.quote(n)) for n in self.names)).alias("_row_key")]

    def evolve(self, columns: Iterable[Mapping], at: int = 0, timezone: str | None = None) -> TableSpec:
        """With the columns that aren't there yet; nothing is taken away."""
        new = tuple(replace(_field(c, timezone), added_at=at) for c in columns if _name(c) not in self.names)
        return replace(self, fields=self.fields + new) if new else self

    def hide(self, *names: str) -> TableSpec:
        """View option for dropped columns: they stay in the log and leave the view."""
        return replace(self, hidden=tuple(sorted({*self.hidden, *names})))

    def widen(self, name: str, kind: str) -> TableSpec:
        return replace(self, fields=tuple(replace(f, kind=kind) if f.name == name else f for f in self.fields))

    def rename(self, name: str) -> TableSpec:
        return replace(self, name=name)

    def ddl(self, engine: str = "", database: str | None = None) -> str:
        """The CREATE TABLE statement of a target with materialised key and flag columns."""
        lines = [f"{types.quote(f.name)} {f.label or f.kind}" for f in self.fields]
        if self.key:
            order = [types.quote(k) for k in self.key]
        else:
            text = " || '|' || ".join(f"toString({types.quote(n)})" for n in self.names)
            lines.append(f"`_row_key` UInt64 MATERIALIZED cityHash64({text})")
            order = ["`_row_key`"]
        lines += [f"`{VERSION}` UInt64", f"`{DELETED}` UInt64 DEFAULT 0", f"`is_deleted` UInt8 MATERIALIZED if({DELETED} != 0, 1, 0)"]
        kind = f"ReplacingMergeTree({VERSION})" if self.mode == "latest" else "MergeTree()"
        if self.mode != "latest":
            order.append(f"`{VERSION}`")
        name = ".".join(map(types.quote, filter(None, (database, self.name))))
        return f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(lines)}) ENGINE = {engine or kind} ORDER BY ({', '.join(order)})"

    def view(self, log: DataFrame) -> DataFrame:
        """The log under today's schema: columns added later take their default in rows of before.

        Before and after are the feed's order where the log has it: a replay gives rows newer versions, not newer places.
        """
        order, out = F.col("seq" if "seq" in log.columns else VERSION), []
        for f in self.fields:
            if f.name in self.hidden:
                continue
            if f.name not in log.columns:
                c = F.lit(None).cast(f.type)
            else:
                c = F.col(types.quote(f.name)).cast(f.type)
            if f.default is not None and f.added_at:
                c = F.when(order < f.added_at, F.coalesce(c, F.expr(f.default))).otherwise(c)
            out.append(c.alias(f.name))
        rest = [F.col(n) for n in (VERSION, DELETED, "seq") if n in log.columns]
        return log.select(*out, *rest)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> TableSpec:
        raw = json.loads(text)
        raw["fields"] = tuple(Field(**f) for f in raw["fields"])
        return cls(raw["name"], raw["fields"], tuple(raw["key"]), raw["mode"], tuple(raw["hidden"]))


def _name(column: Mapping) -> str:
    return types._text(column, "COLUMN_NAME")


def _field(column: Mapping, timezone: str | None) -> Field:
    kind = types.spark_type(column, timezone).simpleString()
    return Field(_name(column), kind, types.is_nullable(column), types.default_expr(column, timezone), 0, types.target_label(column, timezone))


class Registry:
    """Specifications by table name, and what schema statements do to them."""

    def __init__(self, specs: Iterable[TableSpec] = ()):
        self.specs = {s.name: s for s in specs}

    def __contains__(self, name: str) -> bool:
        return name in self.specs

    def __getitem__(self, name: str) -> TableSpec:
        return self.specs[name]

    def put(self, spec: TableSpec) -> None:
        self.specs[spec.name] = spec

    def drop(self, name: str) -> None:
        self.specs.pop(name, None)

    def rename(self, old: str, new: str) -> None:
        if old in self.specs:
            self.put(self.specs.pop(old).rename(new))

    def missing(self, name: str, columns: Iterable[Mapping]) -> list[str]:
        """Columns that the source has and the table has not."""
        known = set(self.specs[name].names) if name in self.specs else set()
        return [_name(c) for c in columns if _name(c) not in known]

    def to_json(self) -> str:
        return json.dumps([json.loads(s.to_json()) for s in self.specs.values()])

    @classmethod
    def from_json(cls, text: str) -> Registry:
        return cls(TableSpec.from_json(json.dumps(x)) for x in json.loads(text))
