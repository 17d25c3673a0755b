"""Where versioned logs live: a journal of batches, typed bases of compacted tables, and a numbered manifest.

A batch is written once, whatever the number of its tables, dealt into folders by storage id; a storage id is given to
every CREATE anew, so a table never reads rows of another one that once had its name.  Everything goes through Spark or
Hadoop's file systems, so the root may be in any store Spark reaches.  A batch's folder is overwritten whole when it runs
again, and counts only once a manifest names it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import changelog, state
from tidemark.plans.registry import DELETED, VERSION, Registry, TableSpec

IMAGE = T.MapType(T.StringType(), T.StringType())
JOURNAL = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("image", IMAGE),
        T.StructField("seq", T.LongType()),
        T.StructField(VERSION, T.LongType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("storage", T.StringType()),
    ]
)
#: What a manifest holds before the first batch.
NOTHING = {"n": -1, "last": 0, "batches": [], "streams": {}, "registry": "[]", "storage": {}, "hidden_to": {}, "next_storage": 0, "bases": {}, "after": None}


class LogStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _at(self, place: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{place}" if place else self.root)
        return at, at.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, place: str) -> list[str]:
        at, fs = self._at(place)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _get(self, place: str) -> dict:
        at, fs = self._at(place)
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, place: str, document: dict) -> None:
        """Written beside and renamed, so that no reader sees half of it."""
        at, fs = self._at(place)
        beside, _ = self._at(f"{place}.new")
        stream = fs.create(beside, True)
        stream.write(bytearray(json.dumps(document).encode()))
        stream.close()
        fs.delete(at, False)
        if not fs.rename(beside, at):
            raise OSError(f"{place} can't be written")

    def last(self) -> dict:
        """The newest manifest: one small file, whatever the number of batches before."""
        names = [n for n in self._names("manifest") if n.endswith(".json")]
        return NOTHING | (self._get(f"manifest/{names[-1]}") if names else {})

    def commit(self, **changes) -> dict:
        entry = self.last() | changes
        entry["n"] += 1
        self._put(f"manifest/{entry['n']:012d}.json", entry)
        for name in self._names("manifest")[:-8]:  # readers that began with an older one may still need it
            at, fs = self._at(f"manifest/{name}")
            fs.delete(at, False)
        return entry

    def plan(self, key: str, base: int) -> int:
        """The batch's first version: a batch that runs again takes what was set the first time."""
        place = f"plans/{key}.json"
        at, fs = self._at(place)
        if fs.exists(at):
            return self._get(place)["base"]
        self._put(place, {"base": base})
        return base

    def registry(self) -> Registry:
        return Registry.from_json(self.last()["registry"])

    def write(self, rows: DataFrame, key: str) -> None:
        """One batch of journal rows, all tables in one job."""
        rows.select(*(f.name for f in JOURNAL if f.name != "batch")).write.mode("overwrite").partitionBy("storage").parquet(f"{self.root}/journal/batch={key}")

    def _journal(self, entry: dict, storage: str | None = None) -> DataFrame | None:
        """Journal rows of finished batches; only the folders of the batches that hold the table are listed."""
        keys = [b["key"] for b in entry["batches"] if storage is None or storage in b["storages"]]
        if not keys:
            return None
        rows = self.spark.read.schema(JOURNAL).option("basePath", f"{self.root}/journal").parquet(*(f"{self.root}/journal/batch={k}" for k in keys))
        return rows if storage is None else rows.where(F.col("storage") == storage)

    def log(self, table: str) -> DataFrame:
        """A table's typed log rows of finished batches, without those that a TRUNCATE hides: its base and the journal behind it."""
        entry = self.last()
        if table not in entry["storage"]:
            raise LookupError(f"no log of table {table}")
        storage, spec = entry["storage"][table], Registry.from_json(entry["registry"])[table]
        base, rows = entry["bases"].get(storage), self._journal(entry, storage)
        rows = rows if rows is not None else self.spark.createDataFrame([], JOURNAL)
        typed = changelog.typed(rows.where("error_reason is null"), spec).select(*spec.names, VERSION, DELETED, "seq")
        if base is not None:
            kept = self.spark.read.option("mergeSchema", "true").parquet(base["path"])
            have = [F.col(f"`{f.name}`").cast(f.type).alias(f.name) if f.name in kept.columns else F.lit(None).cast(f.type).alias(f.name) for f in spec.fields]
            typed = kept.select(*have, VERSION, DELETED, "seq").unionByName(typed.where(F.col(VERSION) > base["upto"]))
        hidden = entry["hidden_to"].get(storage)
        return typed.where(F.col(VERSION) > hidden) if hidden is not None else typed

    def quarantine(self) -> DataFrame:
        """Rows whose values didn't fit, with the reason and what was sent."""
        rows = self._journal(self.last())
        rows = rows if rows is not None else self.spark.createDataFrame([], JOURNAL)
        return rows.where("error_reason is not null").select("table", "seq", VERSION, "error_reason", F.to_json("image").alias("payload"))

    def depths(self) -> DataFrame:
        """(stage, table, count): rows in the journal, and those set aside."""
        rows = self._journal(self.last())
        rows = rows if rows is not None else self.spark.createDataFrame([], JOURNAL)
        return rows.groupBy(F.when(F.col("error_reason").isNull(), "logged").otherwise("quarantined").alias("stage"), "table").count()

    def totals(self) -> DataFrame:
        """(table, rows): journal rows by table, the largest first (a report)."""
        rows = self._journal(self.last())
        rows = rows if rows is not None else self.spark.createDataFrame([], JOURNAL)
        return rows.groupBy("table").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "table")

    def put_base(self, table: str, spec: TableSpec, path: str, upto: int, **changes) -> None:
        """Make the typed rows at path the base of a table; rows of the journal up to that version no longer count."""
        entry = self.last()
        registry, storage = Registry.from_json(entry["registry"]), dict(entry["storage"])
        registry.put(spec)
        number = entry["next_storage"]
        if table not in storage:
            storage[table], number = f"s{number}", number + 1
        bases = entry["bases"] | {storage[table]: {"path": path, "upto": upto}}
        live = set(storage.values())
        batches = [b for b in entry["batches"] if any(s in live and b["last"] > bases.get(s, {"upto": -1})["upto"] for s in b["storages"]) or b["bad"]]
        self.commit(registry=registry.to_json(), storage=storage, next_storage=number, bases=bases, batches=batches, last=max(entry["last"], upto), **changes)

    def compact(self, table: str) -> None:
        """Write the latest rows of a table, dealt and sorted by key, as its new base; nothing that is read is overwritten."""
        entry = self.last()
        spec = Registry.from_json(entry["registry"])[table]
        path = f"{self.root}/bases/{entry['storage'][table]}/{entry['n'] + 1}"
        state.compact(self.log(table), spec.key_columns(), path)
        self.put_base(table, spec, path, entry["last"])

    def reset(self) -> None:
        at, fs = self._at("")
        fs.delete(at, True)
