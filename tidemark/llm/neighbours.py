"""Near-duplicate vectors by NN-descent.

Distinct vectors are the nodes.  Random-hyperplane leaves of bounded size give a first neighbour graph; rounds of
neighbours-of-neighbours joins refine it until few entries change.  A list full of links is saturated and grows.  Edges
near the threshold make candidate groups; inside a group every link is counted exactly in double precision, block by
block, so a dense group of any size needs no list as long as itself.  Samples of vectors, held against all rows,
audit the recall; more leaves are added, and if that doesn't suffice every pair of blocks is compared.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components link with nothing and are
their own component; vectors of different lengths are compared as if the shorter were padded with zeros; equal rows
link; a null vec_id has no component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Neighbours a list holds, and holds when saturated; rows of a leaf, and of one that is cut up; trees; rounds.
NEIGHBOURS, WIDE, LEAF, CROWDED, TREES, ROUNDS = 8, 32, 192, 4096, 12, 4
#: Rows of small and of large exact blocks, blocks of the small size at most, and rows compared at once.
BLOCK, LARGE_BLOCK, BLOCKS, TILE = 128, 8192, 24, 1024
#: Vectors of a kind whose links the audit counts against all rows, and the recall it asks for.
AUDIT, RECALL = 512, 0.97


def usable(rows: DataFrame, width: int) -> DataFrame:
    """(vec_id, v): the double components of usable vectors as bytes, padded to width."""
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary())])

    def run(parts):
        for part in parts:
            ids, out = [], []
            for i, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if x and None not in x:
                    v = np.zeros(width)
                    v[: len(x)] = x
                    if np.isfinite(v).all() and v.any():
                        ids.append(i)
                        out.append((v + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], schema=schema)

    return rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, v binary")


def _unit(part, column: int, width: int) -> np.ndarray:
    x = np.frombuffer(b"".join(part.column(column).to_pylist()), np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _groups(parts, columns: int):
    """Column lists of whole groups of equal first column, from sorted batches."""
    held = None
    for part in parts:
        for row in zip(*(part.column(i).to_pylist() for i in range(columns))):
            if held is not None and held[0][0] != row[0]:
                yield held
                held = None
            if held is None:
                held = [[] for _ in range(columns)]
            for x, y in zip(held, row):
                x.append(y)
    if held is not None:
        yield held


_EDGE = pa.schema([("node", pa.int64()), ("nbr", pa.int64()), ("sim", pa.float32())])


def _edges(out: list) -> pa.RecordBatch:
    n, m, s = (np.concatenate(c) for c in zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(n), pa.array(m), pa.array(s.astype(np.float32))], schema=_EDGE)


def _best(ids: np.ndarray, x: np.ndarray, k: int):
    """Each row's k best others within one group."""
    n = len(ids)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(k, n - 1)
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    return np.repeat(ids, k), ids[top].ravel(), np.take_along_axis(sims, top, 1).ravel()


def leaves(nodes: DataFrame, width: int, bits: int, trees: int, seed: int, k: int) -> DataFrame:
    """Edges inside random-hyperplane leaves; a leaf that is too large is ordered once more and cut.

    A crowded leaf is first dealt into parts by a hash that differs from tree to tree, so no task holds a dense group.
    """
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((trees, width, max(bits, 1) + 1)).astype(np.float32)

    def spread(parts):
        for part in parts:
            if not part.num_rows:
                continue
            x = _unit(part, 1, width).astype(np.float32)
            vectors = pa.array([r.tobytes() for r in x], pa.binary())
            for t in range(trees):
                y = x @ planes[t]
                code = ((y[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(x), np.int64)) + (t << 40)
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(y[:, -1].astype(np.float32)), part.column(0), vectors], names=["leaf", "at", "node", "v"])

    def join(parts):
        out, count = [], 0
        for _, _, ids, vectors in _cut_groups(parts):
            if len(ids) > 1:
                x = np.frombuffer(b"".join(vectors), np.float32).reshape(-1, width)
                out.append(_best(np.array(ids), x, k))
                count += len(out[-1][0])
                if count > 1 << 16:
                    yield _edges(out)
                    out, count = [], 0
        if out:
            yield _edges(out)

    def _cut_groups(parts):
        held = None
        for part in parts:
            for row in zip(*(part.column(i).to_pylist() for i in range(4))):
                if held is not None and (held[0][0] != row[0] or len(held[0]) >= 2 * LEAF):
                    yield held
                    held = None
                if held is None:
                    held = [[], [], [], []]
                for a, b in zip(held, row):
                    a.append(b)
        if held is not None:
            yield held

    dealt = nodes.select("node", "v").mapInArrow(spread, "leaf long, at float, node long, v binary")
    crowded = common.durable(dealt.groupBy("leaf").count().where(F.col("count") > CROWDED))
    if not crowded.isEmpty():
        dealt = dealt.join(crowded, "leaf", "left")
        part = F.pmod(F.xxhash64("leaf", "node"), F.ceil(F.col("count") / CROWDED))
        dealt = dealt.select(F.when(F.col("count").isNull(), F.col("leaf")).otherwise(F.xxhash64("leaf", part)).alias("leaf"), "at", "node", "v")
    return dealt.repartition("leaf").sortWithinPartitions("leaf", "at").mapInArrow(join, "node long, nbr long, sim float")


def _kept(edges: DataFrame, threshold: float, k: int, wide: int) -> DataFrame:
    """Each node's k best neighbours, up to `wide` where the list is full of links; a hub comes down to that many a task."""
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("sim"), "nbr"))
    most = max(k, wide)
    return edges.withColumn("_r", place).where((F.col("_r") <= most) & ((F.col("_r") <= k) | (F.col("sim") >= threshold))).drop("_r")


def descend(graph: DataFrame, nodes: DataFrame, width: int, threshold: float, k: int = NEIGHBOURS, wide: int = WIDE) -> tuple[DataFrame, int]:
    """One round: neighbours of each node, in both directions, meet; (graph, entries that are new)."""
    both = graph.select("node", "nbr", "sim").unionByName(graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "sim")).distinct()
    met = _kept(both, threshold, 2 * k, wide).select("node", "nbr")
    held = nodes.select(F.col("node").alias("nbr"), "v")
    lists = met.unionByName(nodes.select("node", F.col("node").alias("nbr"))).join(held, "nbr").select("node", "nbr", "v")

    def join(parts):
        out, count = [], 0
        for _, ids, vectors in _groups(parts, 3):
            if len(ids) > 1:
                x = np.frombuffer(b"".join(vectors), np.float64).reshape(-1, width)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
                out.append(_best(np.array(ids), x, max(3, k // 2)))
                count += len(out[-1][0])
                if count > 1 << 16:
                    yield _edges(out)
                    out, count = [], 0
        if out:
            yield _edges(out)

    found = lists.repartition("node").sortWithinPartitions("node").mapInArrow(join, "node long, nbr long, sim float")
    merged = graph.select("node", "nbr", "sim", F.lit(0).alias("new")).unionByName(found.withColumn("new", F.lit(1)))
    merged = merged.groupBy("node", "nbr").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    merged = common.durable(_kept(merged, threshold, k, wide))
    return merged, merged.where("new = 1").count()


def count_links(nodes: DataFrame, groups: DataFrame, width: int, threshold: float) -> DataFrame:
    """(node, n, low): copies of other nodes linked in its group, and the smallest of them, exactly; groups: (node, root).

    A group of m nodes is dealt into blocks; every pair of blocks is one unit of work.  Blocks grow with the group, so that
    its vectors aren't copied more often than m / LARGE_BLOCK + BLOCKS times.
    """
    members = nodes.join(groups, "node").select("root", "node", "copies", "v")
    sizes = members.groupBy("root").agg(F.ceil(F.least(F.count("*") / BLOCK, F.lit(BLOCKS) + F.count("*") / LARGE_BLOCK)).alias("blocks"))
    own = members.join(sizes, "root").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")))
    pairs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o")
    dealt = own.select("root", "b", "node", "copies", "v", pairs).select(F.struct("root", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j")).alias("unit"), "b", "node", "copies", "v")
    dealt = dealt.select(F.xxhash64("unit.root", "unit.i", "unit.j").alias("key"), F.col("unit.root").alias("root"), F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), "b", "node", "copies", "v")

    def units(parts):
        held, last = [], None
        for part in parts:
            for row in zip(*(part.column(c).to_pylist() for c in range(8))):
                if last is not None and row[:4] != last:
                    yield held
                    held = []
                last = row[:4]
                held.append(row)
        if held:
            yield held

    def run(parts):
        for rows in units(parts):
            _, _, i, j = rows[0][:4]
            x = np.frombuffer(b"".join(r[7] for r in rows), np.float64).reshape(-1, width)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            norm = np.sqrt((x * x).sum(1))
            ids, copies, block = np.array([r[5] for r in rows]), np.array([r[6] for r in rows]), np.array([r[4] for r in rows])
            a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            if not len(a) or not len(b):
                continue
            u = x / norm[:, None]
            n, low, root = np.zeros(len(rows), np.int64), np.full(len(rows), np.iinfo(np.int64).max), np.arange(len(rows))
            for p in range(0, len(a), TILE):
                for q in range(p if i == j else 0, len(b), TILE):
                    mine, theirs = a[p : p + TILE], b[q : q + TILE]
                    ok = u[mine] @ u[theirs].T >= threshold
                    if i == j and p == q:
                        np.fill_diagonal(ok, False)
                    for one, other, table in ((mine, theirs, ok), (theirs, mine, ok.T))[: 1 if i == j and p == q else 2]:
                        n[one] += table @ copies[other]
                        low[one] = np.minimum(low[one], np.where(table, ids[other], np.iinfo(np.int64).max).min(axis=1))
                    at, to = np.nonzero(ok)
                    pairs = np.unique(root[mine[at]] * len(rows) + root[theirs[to]])
                    root = common.forest(pairs // len(rows), pairs % len(rows), len(rows))[root]
            has, apart = np.flatnonzero(n), np.flatnonzero(root != np.arange(len(rows)))
            columns = ((ids[has], ids[apart]), (n[has], np.zeros(len(apart), np.int64)), (low[has], ids[root[apart]]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["node", "n", "low"])

    return dealt.repartition("key").sortWithinPartitions("key", "root", "i", "j").select("key", "root", "i", "j", "b", "node", "copies", "v").mapInArrow(run, "node long, n long, low long")


def trees_for(bits: int, threshold: float, found: float = 0.99) -> int:
    """Trees in which a pair at the threshold shares a leaf at least once with that chance, each of so many planes."""
    one = (1 - np.arccos(threshold) / np.pi) ** bits
    return TREES if one >= 1 else max(TREES, int(np.ceil(np.log(1 - found) / np.log(1 - one))))


def audit(nodes: DataFrame, linked: DataFrame, width: int, threshold: float, queries: int = AUDIT) -> float:
    """Mean share of a vector's links, counted against all rows, that were found; 1 if there are none.

    Samples are bounded: of vectors without found links, with few, and with many, each standing for all of its kind.
    The lesser mean of those that have few links and of those that have many counts, so neither hides the other.
    """
    m = F.coalesce("m", F.lit(0))
    known = nodes.join(linked.select("node", F.col("n").alias("m")), "node", "left")
    known = known.select("node", "v", m.alias("m"), F.when(m == 0, 0).when(m <= WIDE, 1).otherwise(2).alias("kind"))
    sizes = {r["kind"]: r["count"] for r in known.groupBy("kind").count().collect()}
    parts = [known.where(F.col("kind") == k).orderBy(F.xxhash64("node"), "node").limit(2 * queries if k == 0 else queries) for k in sizes]
    if not parts:
        return 1.0
    asked = parts[0]
    for x in parts[1:]:
        asked = asked.unionByName(x)
    asked = asked.toPandas()
    q = np.frombuffer(b"".join(asked["v"]), np.float64).reshape(-1, width)
    q = q / np.abs(q).max(axis=1, keepdims=True)
    q = q / np.linalg.norm(q, axis=1, keepdims=True)
    ids = asked["node"].to_numpy()
    sent = nodes.sparkSession.sparkContext.broadcast((ids, q))

    def run(parts):
        own, x = sent.value
        total = np.zeros(len(own), np.int64)
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                some = part.slice(at, 1024)
                v = _unit(some, 1, width)
                node, copies = some.column(0).to_numpy(), some.column(2).to_numpy()
                total += (((x @ v.T) >= threshold) & (own[:, None] != node[None])) @ copies
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own[has]), pa.array(total[has])], names=["node", "n"])

    truth = nodes.select("node", "v", "copies").mapInArrow(run, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    both = asked[["node", "m", "kind"]].merge(truth.toPandas(), on="node")
    share = np.minimum(both["m"], both["n"]) / both["n"]
    weight = both["kind"].map(sizes) / both["kind"].map(asked["kind"].value_counts())
    means = [np.average(share[x], weights=weight[x]) for x in (both["n"] <= WIDE, both["n"] > WIDE) if x.any()]
    return float(min(means, default=1.0))


def link(rows: DataFrame, threshold: float = 0.9, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    vectors = common.durable(usable(rows, max(width, 1)))
    width = max(width, 1)
    nodes = common.durable(vectors.where("vec_id is not null").groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    size = nodes.count()
    bits = max(0, int(np.ceil(np.log2(max(size, 1) / LEAF))))
    graph, seed = None, 7
    trees = trees_for(bits, threshold)
    for attempt in range(3):
        started = leaves(nodes, width, bits, trees << attempt, seed + attempt, NEIGHBOURS // 2)
        if graph is not None:
            started = started.unionByName(graph.select("node", "nbr", "sim"))
        graph = common.durable(_kept(started.groupBy("node", "nbr").agg(F.max("sim").alias("sim")), threshold, NEIGHBOURS, WIDE))
        for _ in range(ROUNDS):
            graph, new = descend(graph, nodes, width, threshold)
            if new <= 0.02 * NEIGHBOURS * size:
                break
        near = graph.where(F.col("sim") >= threshold - 0.02)
        found = common.components(near.select(F.col("node").alias("u"), F.col("nbr").alias("v")))
        groups = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
        exact = common.durable(count_links(nodes, groups, width, threshold).groupBy("node").agg(F.sum("n").alias("n"), F.collect_set("low").alias("lows")))
        got = audit(nodes, exact, width, threshold)
        logging.getLogger(__name__).info("recall of links: %.4f of %d vectors' links", got, AUDIT)
        if got >= recall:
            break
    else:  # every pair of blocks of all vectors
        everyone = nodes.select("node", F.lit(0).cast("long").alias("root"))
        exact = common.durable(count_links(nodes, everyone, width, threshold).groupBy("node").agg(F.sum("n").alias("n"), F.collect_set("low").alias("lows")))
    joined = common.components(exact.select(F.col("node").alias("u"), F.explode("lows").alias("v")))
    named = nodes.join(exact.select("node", "n"), "node", "left").join(joined, "node", "left")
    named = named.select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id"))
    linked = vectors.where("vec_id is not null").join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.select(F.col("vec_id").cast("long").alias("vec_id")).join(vectors.select("vec_id").where("vec_id is not null").distinct(), "vec_id", "left_anti")
    out = linked.unionByName(alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(common.table(spark, sf_dir, "embeddings"))
