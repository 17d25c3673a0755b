"""Schema statements: recognised and split into names on the driver, or classified as a Column."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import codec
from tidemark.plans.registry import Registry, TableSpec

log = logging.getLogger(__name__)

_COMMENT = re.compile(r"\s*(?:--[^\n]*(?:\n|\Z)|#[^\n]*(?:\n|\Z)|/\*.*?(?:\*/|\Z))", re.S)
_PART = r"(?:`(?:[^`]|``)+`|\"[^\"]+\"|[\w$]+)"
_NAME = re.compile(rf"\s*({_PART})(?:\s*\.\s*({_PART}))?", re.S)
#: How a statement of each kind begins.
HEADS = {
    "create": r"create\s+table\s+(?:if\s+not\s+exists\s+)?",
    "drop": r"drop\s+table\s+(?:if\s+exists\s+)?",
    "alter": r"alter\s+table\s+",
    "truncate": r"truncate\s+(?:table\s+)?",
    "rename": r"rename\s+table\s+",
}
#: Statements that only frame a transaction.
TRANSACTION = ("begin", "commit", "rollback", "xa start", "xa end", "xa prepare", "xa commit", "xa rollback")


@dataclass(frozen=True)
class Change:
    """kind is None for a statement that isn't recognised; pairs are (old, new) names; owners the tables' schemas, if named."""

    kind: str | None
    tables: tuple[str, ...] = ()
    pairs: tuple[tuple[str, str], ...] = ()
    owners: tuple[str | None, ...] = ()

    def inside(self, schema: str | None, schemas: Iterable[str] | None) -> Change:
        """Only the tables of those schemas; one that names none is in the statement's own."""
        if not schemas:
            return self
        kept = [i for i, owner in enumerate(self.owners) if (owner or schema) in schemas]
        return Change(self.kind, tuple(self.tables[i] for i in kept), tuple(self.pairs[i] for i in kept) if self.pairs else (), tuple(self.owners[i] for i in kept))


def strip_comments(statement: str | None) -> str:
    rest = (statement or "").strip()
    while (m := _COMMENT.match(rest)) and m.end():
        rest = rest[m.end() :].lstrip()
    return rest


def _bare(part: str) -> str:
    return part[1:-1].replace("``", "`") if part[0] in "`\"" else part


def _names(text: str) -> list[tuple[str, str | None]]:
    """(table, its schema if named) of each part."""
    found = []
    for part in text.split(";")[0].split(","):
        if m := _NAME.match(part):
            found.append((_bare(m[2] or m[1]), _bare(m[1]) if m[2] else None))
    return found


def parse(statement: str | None) -> Change:
    text = strip_comments(statement)
    for kind, head in HEADS.items():
        m = re.match(head, text, re.I)
        if m is None:
            continue
        rest = text[m.end() :]
        if kind == "rename":
            pairs, owners = [], []
            for part in rest.split(";")[0].split(","):
                old, to, new = re.split(r"(\s+to\s+)", part.strip(), maxsplit=1, flags=re.I) if re.search(r"\sto\s", part, re.I) else (part, "", "")
                if to and _names(old) and _names(new):
                    pairs.append((_names(old)[0][0], _names(new)[0][0]))
                    owners.append(_names(old)[0][1])
            return Change(kind, tuple(o for o, _ in pairs), tuple(pairs), tuple(owners))
        if kind == "drop":
            found = _names(re.sub(r"\s+(?:restrict|cascade)\s*$", "", rest.split(";")[0], flags=re.I))
            return Change(kind, tuple(t for t, _ in found), (), tuple(o for _, o in found))
        if found := _names(rest)[:1]:
            return Change(kind, (found[0][0],), (), (found[0][1],))
    return Change(None)


def is_transaction_control(statement: str | None) -> bool:
    text = strip_comments(statement).rstrip().lower()
    return text in TRANSACTION or text.startswith("savepoint")


def kind_column(statement: Column) -> Column:
    """The kind of each statement, NULL if none."""
    text = codec.strip_comments(statement)
    out = F.lit(None).cast("string")
    for kind, head in reversed(HEADS.items()):
        out = F.when(text.rlike(rf"(?is)\A{head}\S"), kind).otherwise(out)
    return out


def transaction_column(statement: Column) -> Column:
    text = F.lower(codec.strip_comments(statement))
    return text.isin(*TRANSACTION) | text.startswith("savepoint")


def apply(change: Change, registry: Registry, allowed: Callable[[str], bool], columns: Callable[[str], Iterable[Mapping]] | None = None, at: int = 0) -> list[tuple[str, str, str | None]]:
    """Change the registry; the (action, table, new name) that the stored logs must follow."""
    actions: list[tuple[str, str, str | None]] = []
    if change.kind == "rename":
        for old, new in change.pairs:
            if allowed(old):
                registry.rename(old, new)
                actions.append(("rename", old, new))
        return actions
    for table in filter(allowed, change.tables):
        if change.kind == "create" and table not in registry and columns is not None:
            if given := list(columns(table)):
                registry.put(TableSpec.from_columns(table, given))
            else:
                log.warning("no columns came with the statement that makes table %s", table)
        elif change.kind == "alter" and table in registry and columns is not None:
            registry.put(registry[table].evolve(columns(table), at))
        elif change.kind == "drop":
            registry.drop(table)
        actions.append((change.kind, table, None))
    return actions
