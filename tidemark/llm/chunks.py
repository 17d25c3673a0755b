"""Substring dedup by content-defined chunks.

A gear rolling hash over the last 32 bytes sets chunk ends, so an insertion moves only the ends near it.  A chunk is a
repeat if its digest stands earlier (smaller doc_id, or same document and earlier place).  Short chunks are common
phrases, not passages: runs of repeated chunks count from `least` bytes on.

Defined results: a null text is empty and has no chunks; very long texts are cut block by block with the same ends; rows
that repeat a doc_id with the same text count as one document; rows that repeat it with another text are documents of
their own, in the order of a hash of their texts; rows without doc_id lose nothing; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_GEAR = np.random.default_rng(6).integers(0, 2**32, 256, dtype=np.uint32)
SMALLEST, BITS, LARGEST, LEAST = 16, 4, 256, 96
_BLOCK = 1 << 22


def gear(x: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: sum of the table's values of the last 32 bytes, each shifted by its age."""
    h, s = _GEAR[x], 1
    while s < 32:
        older = h[:-s] << np.uint32(s)
        h[s:] += older
        s *= 2
    return h


def ends(text: bytes, smallest: int = SMALLEST, bits: int = BITS, largest: int = LARGEST) -> list[int]:
    """Chunk ends: where the hash's top bits are zero, at least `smallest` and at most `largest` bytes after the last."""
    marks = []
    for at in range(0, len(text), _BLOCK):
        lead = min(at, 31)
        h = gear(np.frombuffer(text[at - lead : at + _BLOCK], np.uint8))[lead:]
        marks.append(np.flatnonzero(h >> np.uint32(32 - bits) == 0) + at + 1)
    out, last = [], 0
    for m in np.concatenate([np.empty(0, np.int64), *marks]).tolist():
        while m - last > largest:
            last += largest
            out.append(last)
        if m - last >= smallest:
            out.append(m)
            last = m
    while len(text) - last > largest:
        last += largest
        out.append(last)
    if last < len(text):
        out.append(len(text))
    return out


#: Kinds of rows: a chunk's earliest place in its batch, one that repeats it there, a document's number of chunks.
FIRST, AGAIN, TOTAL = 0, 1, 2


def chunked(docs: DataFrame) -> DataFrame:
    """(d0, d1, doc_id, sub, place, size, kind): chunks by 128-bit digest; those that a batch knows to be repeats are told so."""
    schema = pa.schema([("d0", pa.int64()), ("d1", pa.int64()), ("doc_id", pa.int64()), ("sub", pa.int64()), ("place", pa.int64()), ("size", pa.int32()), ("kind", pa.int8())])

    def run(parts):
        for part in parts:
            seen: dict[bytes, tuple[int, int, int]] = {}
            digests, rest = [], [[], [], [], [], []]

            def batch():
                x = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), *(pa.array(c, t) for c, t in zip(rest, schema.types[2:]))], schema=schema)

            for doc, sub, text in sorted(zip(*(part.column(i).to_pylist() for i in range(3)))):
                at, cuts = 0, ends(text)
                for e in cuts:
                    d = hashlib.blake2b(text[at:e], digest_size=16).digest()
                    digests.append(d)
                    first = seen.setdefault(d, (doc, sub, at)) == (doc, sub, at)
                    for column, x in zip(rest, (doc, sub, at, e - at, FIRST if first else AGAIN)):
                        column.append(x)
                    at = e
                digests.append(bytes(16))
                for column, x in zip(rest, (doc, sub, 0, len(cuts), TOTAL)):
                    column.append(x)
                if len(digests) > 1 << 17:
                    yield batch()
                    digests, rest = [], [[], [], [], [], []]
            if digests:
                yield batch()

    return keyed(docs).where("doc_id is not null").mapInArrow(run, "d0 long, d1 long, doc_id long, sub long, place long, size int, kind byte")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, sub, body): sub tells texts that share a doc_id apart."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("sub"), body.alias("body"))


def repeated_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, sub, n_chunks, runs: array<struct<s, e>>): runs of chunks, of `least` bytes at least, that stand earlier.

    One shuffle by digest: in its order, all rows of a digest but the first place are repeats.
    """

    def told(parts):
        last = None
        for part in parts:
            d0, d1, doc, sub, place, _, kind = (part.column(i).to_numpy() for i in range(7))
            n = len(d0)
            if not n:
                continue
            same = np.zeros(n, bool)
            same[1:] = (d0[1:] == d0[:-1]) & (d1[1:] == d1[:-1]) & (kind[1:] == kind[:-1])
            twin = np.zeros(n, bool)  # a repeated row isn't a repeat
            twin[1:] = (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (place[1:] == place[:-1])
            if last is not None:
                same[0] = last[:3] == (d0[0], d1[0], kind[0])
                twin[0] = last[3:] == (doc[0], sub[0], place[0])
            out = (kind != FIRST) | (same & ~twin)
            last = (d0[-1], d1[-1], kind[-1], doc[-1], sub[-1], place[-1])
            yield pa.RecordBatch.from_arrays([part.column(i).filter(pa.array(out)) for i in range(2, 7)], names=["doc_id", "sub", "place", "size", "kind"])

    # rows that only pass through are dealt by their own place, so that a common chunk makes no large task
    rows = chunked(docs).withColumn("d0", F.when(F.col("kind") == FIRST, F.col("d0")).otherwise(F.xxhash64("doc_id", "sub", "place")))
    rows = rows.repartition("d0").sortWithinPartitions("d0", "d1", "kind", "doc_id", "sub", "place")
    rows = rows.mapInArrow(told, "doc_id long, sub long, place long, size int, kind byte")
    is_total = F.col("kind") == TOTAL
    span = F.struct(F.col("place").alias("s"), (F.col("place") + F.col("size")).alias("e"))
    own = rows.groupBy("doc_id", "sub").agg(F.max(F.when(is_total, F.col("size").cast("long"))).alias("n_chunks"), F.collect_list(F.when(~is_total, span)).alias("again"))
    schema = pa.schema([("doc_id", pa.int64()), ("sub", pa.int64()), ("n_chunks", pa.int64()), ("runs", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))])

    def run(parts):
        for part in parts:
            out = []
            for again in part.column(3).to_pylist():
                runs: list[list[int]] = []
                for s, e in sorted({(x["s"], x["e"]) for x in again}):
                    if runs and runs[-1][1] == s:
                        runs[-1][1] = e
                    else:
                        runs.append([s, e])
                out.append([{"s": s, "e": e} for s, e in runs if e - s >= least])
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(out, schema.types[3])], schema=schema)

    return own.mapInArrow(run, "doc_id long, sub long, n_chunks long, runs array<struct<s: bigint, e: bigint>>")


def removal(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_bytes, n_chunks, n_removed, n_spans, spans) of each document."""
    sizes = keyed(docs).select("doc_id", "sub", F.octet_length("body").cast("long").alias("n_bytes"))
    found = sizes.join(repeated_runs(docs, least), ["doc_id", "sub"], "left")
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_chunks", F.lit(0)).cast("long").alias("n_chunks"),
        F.coalesce(gone, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("runs", F.array().cast("array<struct<s: bigint, e: bigint>>")).alias("spans"),
    )


def op6_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal(common.table(spark, sf_dir, "documents"))
