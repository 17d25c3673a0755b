"""Shared pieces: durable intermediate tables, Arrow batch plumbing, distributed connected components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the warehouse where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return path.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(docs: DataFrame) -> Column:
    """A row of documents by what it says, so that rows which share a doc_id are told apart."""
    return F.xxhash64(*(F.coalesce(docs[c].cast("string"), F.lit("\\N")) for c in ("doc_id", "text", "lang", "source"))).alias("row_key")


def batches(rows, schema: pa.Schema, size: int = 8192):
    """Turn an iterator of tuples into Arrow batches of bounded size."""
    kept = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), schema.types)], schema=schema)
            kept = []
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*kept), schema.types)], schema=schema)


#: What an operator keeps in this worker from task to task; workers outlive queries, so one operator's at a time.
_KEPT: dict = {}


def kept(key, make):
    """What make gives, kept in this worker until forget() or until another key is asked for."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """Let go of what another operator's tasks kept in this worker; for tasks that need the memory themselves."""
    _KEPT.clear()


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links i-j."""
    lab = np.arange(n)
    while len(i):
        a, b = lab[i], lab[j]
        apart = a != b
        if not apart.any():
            break
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        low = np.minimum(a, b)
        np.minimum.at(lab, a, low)
        np.minimum.at(lab, b, low)
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt
    return lab


#: Links whose components one task finds; more of them go through rounds until as few are left.
_FEW = 1 << 18


def _found(parts):
    """(node, root) of all the links (u, v) of a task."""
    ends = [np.stack([part.column(c).to_numpy() for c in range(2)]) for part in parts]
    if ends:
        names, at = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
        u, v = at.reshape(2, -1)
        root = forest(u, v, len(names))
        far = np.flatnonzero(root != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[far]), pa.array(names[root[far]])], names=["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (u, v: long) that isn't the smallest of its component; root is that smallest.

    Each round hooks every node to its smallest neighbour, follows the pointers, and goes on with the contracted
    graph, which at least halves; all of it in DataFrames, minima combined before each shuffle.  A graph of few links is
    done in one task, since every round is a dozen jobs of as many tasks as shuffles have partitions, all of which the
    driver keeps account of.  Nulls link nothing.
    """

    def contracted(e: DataFrame) -> DataFrame:
        e = e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        return durable(e.distinct())

    def over(m: DataFrame, column: str, to: DataFrame) -> DataFrame:
        nxt = to.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        return m.join(nxt, F.col(column) == F.col("_n"), "left").withColumn(column, F.coalesce("_r", column)).drop("_n", "_r")

    rounds, left = [], contracted(edges)
    while left.count() > _FEW:
        ends = left.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(left.select("v", "u"))
        hook = durable(ends.groupBy("node").agg(F.min("root").alias("root")).where("root < node"))
        for _ in range(2):
            hook = over(hook, "root", hook)
        hook = durable(hook)
        rounds.append(hook)
        left = contracted(over(over(left, "u", hook), "v", hook))
    found = durable(left.coalesce(1).mapInArrow(_found, "node long, root long"))
    for hook in reversed(rounds):  # a node that is still there after its round has the same root in both
        found = over(hook, "root", found).unionAll(found).distinct()
    return durable(found) if rounds else found
