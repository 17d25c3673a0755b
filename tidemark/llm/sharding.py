"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Records hash into thousands of virtual slots.  Bytes and rows are summed per slot.  The stored map of the last run, or at
first one that deals slots out evenly, is edited: slots move from the largest shards to the smallest while that evens them
out, and the next version is stored beside the ones before it.  Only slot totals (a table as long as the number of slots,
whatever the input) come to the driver.

Law `bytes`: a group of equal texts, however large, is dealt over all slots by the ids of its rows, so it can't upset it.

Defined results: a null text has size 1 and checksum 0; very long texts count in full; a null doc_id hashes like one more
value; rows that share a doc_id share a slot, are numbered in pieces, and equal ones get places of their own; ties are
places in any order; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Virtual slots, and the pieces that the rows of one are numbered in.
SLOTS, PIECES = 8192, 16


@dataclass(frozen=True)
class SlotMap:
    """shard[s] is the shard of virtual slot s."""

    version: int
    shards: int
    shard: tuple[int, ...]

    @classmethod
    def even(cls, slots: int, shards: int) -> SlotMap:
        return cls(0, shards, tuple(s % shards for s in range(slots)))

    def moved(self, to: dict[int, int], shards: int | None = None) -> SlotMap:
        shard = list(self.shard)
        for s, x in to.items():
            shard[s] = x
        return replace(self, version=self.version + 1, shards=shards or self.shards, shard=tuple(shard))

    def rebalanced(self, sizes: dict[int, int]) -> SlotMap:
        """The next version: slots leave the largest shard for the smallest while that evens them out."""
        own: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        total = [0] * self.shards
        for s, x in enumerate(self.shard):
            own[x].append((sizes.get(s, 0), s))
            total[x] += sizes.get(s, 0)
        for x in own:
            x.sort()
        moves: dict[int, int] = {}
        exchanges = 0
        for _ in range(4 * len(self.shard)):
            high, low = max(range(self.shards), key=total.__getitem__), min(range(self.shards), key=total.__getitem__)
            gap = total[high] - total[low]
            best = max(((n, s) for n, s in own[high] if 0 < n <= gap // 2), default=None)
            if best is not None:
                pair = (best, None)
            else:  # no slot fits: exchange one for a smaller one
                swaps = ((n - m, (n, s), (m, r)) for n, s in own[high] for m, r in own[low] if 0 < n - m < gap)
                found = min(swaps, key=lambda x: abs(gap - 2 * x[0]), default=None) if gap > 1 and exchanges < 64 else None
                if found is None:
                    break
                exchanges += 1
                pair = found[1:]
            give, back = pair
            for item, a, b in ((give, high, low), (back, low, high)):
                if item is not None:
                    own[a].remove(item)
                    own[b].append(item)
                    total[a] -= item[0]
                    total[b] += item[0]
                    moves[item[1]] = b
        return self.moved({s: x for s, x in moves.items() if x != self.shard[s]})

    def grown(self, sizes: dict[int, int]) -> SlotMap:
        """The next version with one shard more, which takes slots from the others and gives none."""
        target = sum(sizes.values()) // (self.shards + 1)
        total = [0] * self.shards
        own: list[list[tuple[int, int]]] = [[] for _ in range(self.shards)]
        for s, x in enumerate(self.shard):
            total[x] += sizes.get(s, 0)
            heapq.heappush(own[x], (-sizes.get(s, 0), s))
        moves, taken = {}, 0
        while taken < target:
            high = max(range(self.shards), key=total.__getitem__)
            while own[high] and taken - own[high][0][0] > target:
                heapq.heappop(own[high])  # too large for what is still to take
            if not own[high]:
                total[high] = -1
                if max(total) < 0:
                    break
                continue
            n, s = heapq.heappop(own[high])
            if n == 0:
                break
            moves[s] = self.shards
            total[high] += n
            taken -= n
        return self.moved(moves, self.shards + 1)


def store(spark: SparkSession, m: SlotMap, path: str) -> None:
    """Write a version of the map beside the others at path: version, slot, shard."""
    rows = spark.createDataFrame([(s, x) for s, x in enumerate(m.shard)], "slot int, shard int").coalesce(1)
    rows.select("*", F.lit(m.shards).alias("shards")).write.mode("overwrite").parquet(f"{path}/version={m.version}")


def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap | None:
    """One version of the stored map, the last if none is named; None if nothing is stored."""
    if not common.exists(spark, path):
        return None
    kept = spark.read.parquet(path)
    if version is None:
        version = kept.agg(F.max("version")).first()[0]
    rows = kept.where(F.col("version") == version).orderBy("slot").collect()  # as many as there are slots
    return SlotMap(version, rows[0].shards, tuple(r.shard for r in rows))


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual, piece): no text leaves its task; a piece is a part of a slot's rows."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(slots)).cast("int").alias("virtual"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PIECES)).cast("int").alias("piece"),
    )


def shard(docs: DataFrame, maps: str | None = None, shards: int = 16, slots: int = SLOTS) -> tuple[DataFrame, list[SlotMap]]:
    """Rows with shard and place, and the map before and after; its versions stand at the path `maps`, if one is given.

    Places are gapless in each shard: the row's number in a piece of its slot, behind the pieces and slots before it.
    """
    spark = docs.sparkSession
    rows = common.durable(slotted(docs, slots))  # written once, so a piece is the same in all that follows
    per_piece = common.durable(rows.groupBy("virtual", "piece").agg(F.sum("size").alias("size"), F.count("*").alias("n")))
    per_slot = per_piece.groupBy("virtual").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect()  # at most `slots` rows
    sizes, counts = {r.virtual: r.size for r in per_slot}, {r.virtual: r.n for r in per_slot}
    last = load(spark, maps) if maps else None
    if last is None or len(last.shard) != slots or last.shards > shards:
        last = SlotMap.even(slots, shards)
        if maps:
            store(spark, last, maps)
    new = last
    while new.shards < shards:
        new = new.grown(sizes)
    new = new.rebalanced(sizes)
    if maps and new.shard != last.shard:
        store(spark, new, maps)
    base, at = [], [0] * shards
    for s, x in enumerate(new.shard):
        base.append((s, x, at[x]))
        at[x] += counts.get(s, 0)
    places = spark.createDataFrame(base, "virtual int, shard int, base long").coalesce(1)
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("virtual").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = per_piece.withColumn("_e", earlier).join(F.broadcast(places), "virtual").select("virtual", "piece", "shard", (F.col("base") + F.col("_e")).alias("first"))
    number = F.row_number().over(Window.partitionBy("virtual", "piece").orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn("_n", number).join(first, ["virtual", "piece"])
    return placed.select("doc_id", "size", "text_crc32", "virtual", "shard", (F.col("first") + F.col("_n") - 1).alias("place")), [last, new]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = f"{common.shared_dir(spark)}/tidemark-slot-maps/{zlib.crc32(sf_dir.encode()):08x}"
    placed, _ = shard(common.table(spark, sf_dir, "documents"), maps)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("virtual").alias("virtual_slot"))
