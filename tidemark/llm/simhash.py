"""SimHash near-duplicates: fingerprints, segment-popcount grid join, components.

A fingerprint is cut into 2-bit segments; the vector of their bit counts changes by at most the Hamming distance
under the Manhattan norm, so vectors farther apart than the radius can't belong to linked fingerprints.  Grid cells
over that vector bring candidates together; every candidate is then checked on the whole fingerprint.

Defined results: null or empty text, or one without words, has fingerprint zero and links like any other; very long
texts count whole, in blocks; a bit set in just half the shingles is 0; equal rows link; a null doc_id never becomes a component id unless nothing else is reachable; an empty table gives no rows;
other columns of the input are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256
_LOW = np.uint64(0xFFFFFFFF)
#: Words whose shingles are hashed at once, so that very long texts need little memory.
_BLOCK = 1 << 18
#: Parts that the rows of one group of copies are dealt into.
_SALTS = 16
#: Rows of a cell that is searched by pieces of its fingerprints; the result is the same.
_BIG = 20_000


def fingerprint(text: bytes | None, width: int, seed: int) -> int:
    """SimHash of the width-word shingles (repeats included) of text, signed 64 bits."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    counts, n = np.zeros((8, 8), np.int64), len(words) - width + 1
    for at in range(0, n, _BLOCK):
        part = words[at : at + _BLOCK + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)
        at_byte = np.bincount((h.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048)
        counts += at_byte.reshape(8, 256) @ _BITS
    return int(np.packbits(counts.ravel() * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, f0): the fingerprint of each row."""
    schema = pa.schema([("doc_id", pa.int64()), ("f0", pa.int64())])

    def run(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([fingerprint(t, width, seed) for t in part.column(1).to_pylist()], pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, f0 long")


def _counts(x: np.ndarray) -> np.ndarray:
    """Bit counts of the 2-bit segments, packed two bits each."""
    return x - ((x >> np.uint64(1)) & np.uint64(0x5555555555555555))


def near_cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) so that fingerprints within Hamming distance 3 share a cell.

    One of the two halves differs by at most 1 in Manhattan distance.  Vectors at distance 1 have sums of different
    parity: even ones go to their own cell, odd ones to theirs and those around it.
    """
    rows, cells = [], []
    for half in (0, 1):
        v = _counts((fp >> np.uint64(32 * half)) & _LOW)
        mark = np.uint64(half << 32)
        rows.append(np.arange(len(fp)))
        cells.append(v | mark)
        odd = np.flatnonzero(np.bitwise_count((fp >> np.uint64(32 * half)) & _LOW) & 1)
        w = v[odd]
        for s in range(16):
            shift = np.uint64(2 * s)
            c, one = (w >> shift) & np.uint64(3), np.uint64(1) << shift
            for can, cell in ((c < 2, w + one), (c > 0, w - one)):
                rows.append(odd[can])
                cells.append(cell[can] | mark)
    return np.concatenate(rows), np.concatenate(cells).view(np.int64)


def _small_pairs(cell: np.ndarray, fp: np.ndarray, radius: int, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within radius in the cells of 64 rows or fewer; of: the size of each row's cell."""
    small = np.flatnonzero((of > 1) & (of <= 64))
    c, f = cell[small], fp[small]
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    k = 1
    while len(small) > k:
        at = np.flatnonzero(c[k:] == c[:-k])
        if not len(at):
            break
        ok = np.bitwise_count(f[at] ^ f[at + k]) <= radius
        found.append((small[at[ok]], small[at[ok] + k]))
        k += 1
    return tuple(np.concatenate(x) for x in zip(*found))


def _linked(cell: np.ndarray, fp: np.ndarray, radius: int, deep: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within radius that connect what is linked inside each cell; cell is sorted."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[starts, len(cell)])
    i, j = _small_pairs(cell, fp, radius, np.repeat(size, size))
    found_i, found_j = [i], [j]
    for s, m in zip(starts[size > 64], size[size > 64]):
        own = fp[s : s + m]
        if deep and m > _BIG and radius <= 3:  # one of four 16-bit pieces is equal
            for piece in range(4):
                key = (own >> np.uint64(16 * piece)) & np.uint64(0xFFFF)
                order = np.argsort(key, kind="stable")
                i, j = _linked(key[order], own[order], radius, False)
                found_i.append(s + order[i])
                found_j.append(s + order[j])
            continue
        step = max(1, (1 << 22) // int(m))
        for a in range(0, int(m), step):
            i, j = np.nonzero(np.triu(np.bitwise_count(own[a : a + step, None] ^ own[None, a:]) <= radius, 1))
            root = common.forest(i, j, int(m) - a)
            i = np.flatnonzero(root != np.arange(len(root)))
            found_i.append(s + a + i)
            found_j.append(s + a + root[i])
    return np.concatenate(found_i), np.concatenate(found_j)


def link(fps: DataFrame, radius: int = 3, cells=near_cells) -> DataFrame:
    """Edges (u, v) that connect all nodes found within radius; fps: (node, f0), a row for each node.

    A cell with many fingerprints gives one edge a node, to the smallest node reachable, never all its pairs.
    """
    keys = pa.schema([("cell", pa.int64()), ("f0", pa.int64()), ("node", pa.int64())])

    def spread(parts):
        for part in parts:
            if part.num_rows:
                fp, node = part.column("f0").to_numpy(), part.column("node").to_numpy()
                rows, cell = cells(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp[rows]), pa.array(node[rows])], schema=keys)

    def edges_of(cell, fp, node):
        i, j = _linked(cell, fp.view(np.uint64), radius)
        root = common.forest(i, j, len(cell))
        i = np.flatnonzero(root != np.arange(len(root)))
        u, v = node[i], node[root[i]]
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])

    def match(parts):
        held = None
        for part in parts:
            cols = [part.column(i).to_numpy() for i in range(3)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if len(held[0]) and held[0][0] != held[0][-1] and len(held[0]) >= 1 << 16:
                cut = np.searchsorted(held[0], held[0][-1])
                yield edges_of(*(c[:cut] for c in held))
                held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield edges_of(*held)

    dealt = fps.select("f0", "node").where("node is not null").mapInArrow(spread, "cell long, f0 long, node long")
    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(match, "u long, v long")


def clusters(fps: DataFrame, radius: int = 3) -> DataFrame:
    """fps (doc_id, f0) with component_id: the smallest doc_id reachable."""
    fps = common.durable(fps)
    nodes = common.durable(fps.groupBy("f0").agg(F.min("doc_id").alias("node")))
    found = common.components(link(nodes, radius))
    named = nodes.join(found, "node", "left").select("f0", F.coalesce("root", "node").alias("component_id"))
    return fps.join(named, "f0")


def simhash_components(docs: DataFrame) -> DataFrame:
    """Three-word shingles, XXH64 with seed 42, links at 3 or fewer differing bits: all of them are found."""
    found = clusters(fingerprints(docs))
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: bytes | None, width: int) -> set[bytes]:
    words = (text or b"").lower().split()
    n = min(width, len(words))
    return set(map(b" ".join, zip(*(words[i:] for i in range(n)))))


#: Texts whose shingles are counted to learn which are common; bits of a shingle bitmap, and of the widest one; rows of an
#: exact block; rows of a list whose pairs are all met at once; lists a pair is met in that do while not all are counted.
_SAMPLE, _BITMAP, _WIDEST, _ROWS, _SHORT, _ENOUGH = 8_000, 512, 1 << 16, 2048, 8, 4
#: A pair, the lists it was met in, how many of them long, its shingles from there on beyond those needed, the lists needed.
_HITS = "u long, v long, hits int, long int, slack int, least int"


def _needed(a, b, similarity: float):
    """Shingles that sets of a and b must share at least for that Jaccard similarity."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-9).astype(np.int64)


def _whole(size, similarity: float):
    """Shingles of a set of that size that any similar set has at least."""
    return np.ceil(similarity * size - 1e-9).astype(np.int64)


def _least(a, b, similarity: float):
    """First shingles that similar sets of a and b share at least.

    The one whose first shingles end earlier in the common order shares all it shares of them with the other's first
    ones, and what comes later can only hold _whole() - 1 of those needed.
    """
    return np.maximum(1, _needed(a, b, similarity) - _whole(np.maximum(a, b), similarity) + 1)


def _set_fingerprint(hashes: np.ndarray) -> int:
    """SimHash of a set of shingles by their hashes."""
    at_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048)
    counts = at_byte.reshape(8, 256) @ _BITS
    return int(np.packbits(counts.ravel() * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _hashes(text: bytes, width: int) -> np.ndarray:
    """Distinct hashes of the shingles."""
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, shingle_set(text, width)), np.uint64)).view(np.int64)


def _bitmap(hashes: np.ndarray, bits: int = _BITMAP) -> bytes:
    """Parities of the set's members by bit: two of them differ in no more bits than the sets in members."""
    odd = np.bincount(hashes.view(np.uint64) % np.uint64(bits), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _wide(hashes: np.ndarray) -> bytes | None:
    """A bitmap of as many bits as the set has members, a power of two; none where the usual one has them."""
    bits = min(_WIDEST, 1 << max(0, len(hashes) - 1).bit_length())
    return _bitmap(hashes, bits) if bits > _BITMAP else None


def _differ(x: bytes, y: bytes) -> int:
    """Bits two bitmaps differ in, the wider one folded."""
    x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum(dtype=np.int64))


def _node(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(text.lower().split())) - (1 << 63)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(common.row_key(docs), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _common_shingles(texts: DataFrame, share: int, width: int, most: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, how many sampled texts have each) of the shingles met more than once; only speed depends on them."""

    def run(parts):
        for part in parts:
            for text in part.column(0).to_pylist():
                if _node(text) % share == 0:
                    yield pa.RecordBatch.from_arrays([pa.array(_hashes(text, width))], names=["h"])

    found = texts.select("text").mapInArrow(run, "h long").groupBy("h").count().where("count > 1")
    found = found.orderBy(F.desc("count"), "h").limit(most).toPandas().sort_values("h")
    return found["h"].to_numpy(np.int64), found["count"].to_numpy(np.int64)


def postings(texts: DataFrame, width: int, similarity: float, share: int) -> DataFrame:
    """(h, node, size, pos): the first shingles of each set, rare ones first, that sets of that similarity must share one of.

    Any order that is the same for all sets will do; the sample's counts only keep common shingles out of the lists.
    """
    sent = texts.sparkSession.sparkContext.broadcast(_common_shingles(texts, share, width))
    schema = pa.schema([("h", pa.int64()), ("node", pa.int64()), ("size", pa.int32()), ("pos", pa.int32())])

    def run(parts):
        known, often = sent.value
        met = set()
        for part in parts:
            out = []
            for text in part.column(0).to_pylist():
                node = _node(text)
                if node in met:
                    continue
                if len(met) < 1 << 18:
                    met.add(node)
                h = _hashes(text, width)
                count = np.zeros(len(h), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    count = np.where(known[at] == h, often[at], 0)
                first = len(h) - int(_whole(len(h), similarity)) + 1
                h, size = h[np.lexsort((h, count))[:first]], len(h)
                out.append((h, np.full(len(h), node), np.full(len(h), size, np.int32), np.arange(len(h), dtype=np.int32)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)

    return texts.select("text").mapInArrow(run, "h long, node long, size int, pos int")


def _units(parts, width: int, by: int):
    """The columns of each run of rows that agree in the first `by` of `width` columns; rows come sorted by them."""
    held = None

    def cut(last):
        nonlocal held
        new = np.zeros(len(held[0]), bool)
        new[0] = True
        for c in held[:by]:
            new[1:] |= c[1:] != c[:-1]
        unit = np.flatnonzero(new)
        ends = np.r_[unit[1:], len(new)]
        now, whole = held, len(unit) if last else len(unit) - 1
        held = [c[unit[-1] :] for c in now]
        for s, e in zip(unit[:whole], ends[:whole]):
            if e - s > 1:
                yield [c[s:e] for c in now]

    for part in parts:
        cols = [part.column(c).to_numpy(zero_copy_only=False) for c in range(width)]
        held = cols if held is None else [np.concatenate(c) for c in zip(held, cols)]
        if len(held[0]) >= 1 << 14:
            yield from cut(False)
    if held is not None and len(held[0]):
        yield from cut(True)


def _hits(node, size, pos, k, m, similarity: float) -> np.ndarray:
    """(u, v, slack, least) of the pairs k-m of a list's rows."""
    left = np.minimum(size[k] - pos[k], size[m] - pos[m])
    slack = left - _needed(size[k], size[m], similarity)
    return np.stack([np.maximum(node[k], node[m]), np.minimum(node[k], node[m]), slack, _least(size[k], size[m], similarity)])


def _summed(out: list[np.ndarray], long: int) -> list[pa.Array]:
    """The columns of _HITS, a row for each pair."""
    u, v, slack, least = np.concatenate(out, axis=1)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    at = np.flatnonzero(np.r_[True, (u[1:] != u[:-1]) | (v[1:] != v[:-1])])
    hits = np.diff(np.r_[at, len(u)])
    columns = [hits, hits * long, np.maximum.reduceat(slack[order], at), least[order][at]]
    return [pa.array(u[at]), pa.array(v[at]), *(pa.array(c.astype(np.int32)) for c in columns)]


def _split(lists: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(_HITS of all pairs in short lists whose sizes allow it, rows of long lists); lists: (h, node, size, pos, n)."""
    names = ["h", "u", "v", "hits", "long", "slack", "least"]

    def run(parts):
        pairs = [np.triu_indices(n, 1) for n in range(_SHORT + 1)]
        out, count = [], 0

        def short():
            columns = _summed(out, 0)
            return pa.RecordBatch.from_arrays([pa.nulls(len(columns[0]), pa.int64()), *columns], names=names)

        def near(parts):
            """The rows of short lists, many lists at once by their length."""
            for part in parts:
                h, node, size, pos, n = (part.column(c).to_numpy() for c in range(5))
                far = n > _SHORT
                if far.any():
                    none = pa.nulls(int(far.sum()), pa.int64())
                    zero = pa.array(np.zeros(far.sum(), np.int32))
                    yield None, [pa.array(h[far]), pa.array(node[far]), none, pa.array(size[far]), pa.array(pos[far]), zero, zero]
                yield part.filter(pa.array(~far)), None

        rest = None
        for part, far in near(parts):
            if far is not None:
                yield pa.RecordBatch.from_arrays(far, names=names)
                continue
            cols = [part.column(c).to_numpy() for c in range(5)]
            cols = cols if rest is None else [np.concatenate(c) for c in zip(rest, cols)]
            h, node, size, pos, n = cols
            starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, int)
            whole = starts[starts + n[starts] <= len(h)]
            done = int(whole[-1] + n[whole[-1]]) if len(whole) else 0
            rest = [c[done:] for c in cols]
            size, pos = size.astype(np.int64), pos.astype(np.int64)
            for length in range(2, _SHORT + 1):
                at = whole[n[whole] == length]
                k, m = ((at[:, None] + p).ravel() for p in pairs[length])
                few, many = np.minimum(size[k], size[m]), np.maximum(size[k], size[m])
                fit = few >= _whole(many, similarity)
                if fit.any():
                    out.append(_hits(node, size, pos, k[fit], m[fit], similarity))
                    count += int(fit.sum())
            if count >= 1 << 17:
                yield short()
                out, count = [], 0
        if out:
            yield short()

    rows = lists.select("h", "node", "size", "pos", F.col("n").cast("int").alias("n")).sortWithinPartitions("h").mapInArrow(run, "h long, " + _HITS)
    rows = common.durable(rows)
    return rows.where("h is null").drop("h"), rows.where("h is not null").select("h", F.col("u").alias("node"), F.col("hits").alias("size"), F.col("long").alias("pos"))


def _long_hits(lists: DataFrame, roots: DataFrame | None, similarity: float, every: bool) -> DataFrame:
    """_HITS of pairs of different roots in one long list that their sizes and bitmaps don't rule out.

    Without `every`, a list is dealt into blocks and each of its rows gives the nearest of such pairs only; with it, every
    pair of blocks is one unit of work, and a pair is met in each list that has both.
    """
    rows = lists.withColumn("root", F.col("node"))
    if roots is not None:
        rows = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    rows = rows.join(sizes.select("h", F.ceil(F.col("n") / _ROWS).alias("blocks")), "h").withColumn("b", F.pmod(F.xxhash64("node"), F.col("blocks")))
    if every:
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o"))
        rows = rows.withColumn("i", F.least("b", "o")).withColumn("j", F.greatest("b", "o"))
    else:
        rows = rows.withColumn("i", F.col("b")).withColumn("j", F.col("b"))

    def pairs(node, size, pos, root, bits, b, i, j):
        x, y = np.flatnonzero(b == i), np.flatnonzero(b == j)
        step = max(1, (1 << 20) // max(1, len(y)))
        for at in range(0, len(x), step):
            p = x[at : at + step]
            need = _needed(size[p, None], size[None, y], similarity)
            apart = (root[p, None] != root[None, y]) & (np.minimum(size[p, None], size[None, y]) >= need)
            far = np.zeros(apart.shape, np.int32)
            for w in range(bits.shape[1]):
                far += np.bitwise_count(bits[p, w][:, None] ^ bits[None, y, w])
            apart &= far <= size[p, None] + size[None, y] - 2 * need
            if every or len(node) <= _SHORT:
                k, m = np.nonzero(apart & (p[:, None] < y[None, :]) if i == j else apart)
            else:
                m = np.where(apart, far, 1 << 30).argmin(axis=1)
                k = np.flatnonzero(apart[np.arange(len(p)), m])
                m = m[k]
            yield _hits(node, size, pos, p[k], y[m], similarity)

    def run(parts):
        out, count = [], 0
        for _, i, j, b, node, size, pos, root, bits in _units(parts, 9, 3):
            bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(node), -1)
            for found in pairs(node, size.astype(np.int64), pos.astype(np.int64), root, bits, b, i[0], j[0]):
                if found.shape[1]:
                    out.append(found)
                    count += found.shape[1]
                if count >= 1 << 16:
                    yield pa.RecordBatch.from_arrays(_summed(out, 1), names=["u", "v", "hits", "long", "slack", "least"])
                    out, count = [], 0
        if out:
            yield pa.RecordBatch.from_arrays(_summed(out, 1), names=["u", "v", "hits", "long", "slack", "least"])

    dealt = rows.select("h", "i", "j", "b", "node", "size", "pos", "root", "bits")
    return dealt.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j").mapInArrow(run, _HITS)


def _candidates(short: DataFrame, lists: DataFrame, roots: DataFrame, similarity: float, every: bool) -> DataFrame:
    """(u, v): pairs that were met in as many lists as similar sets are, so that no text moves for a shingle shared by chance.

    Without `every`, long lists aren't counted in whole: a few lists do.  With it, every list is, and pairs that only
    short lists hold are left out, as they came before.
    """
    met = short.unionByName(_long_hits(lists, roots, similarity, every)).groupBy("u", "v")
    met = met.agg(F.sum("hits").alias("hits"), F.sum("long").alias("long"), F.max("slack").alias("slack"), F.max("least").alias("least"))
    if every:
        return met.where("slack >= 0 and hits >= least and long > 0").select("u", "v")
    return met.where(F.col("hits") >= F.least("least", F.lit(_ENOUGH))).where("slack >= 0").select("u", "v")


def _plausible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) that sizes and bitmaps don't rule out."""
    bits = F.coalesce("wide", "bits")
    a = nodes.select(F.col("node").alias("u"), F.col("size").alias("a"), bits.alias("x"))
    b = nodes.select(F.col("node").alias("v"), F.col("size").alias("b"), bits.alias("y"))

    def run(parts):
        for part in parts:
            if not part.num_rows:
                continue
            a, b = (part.column(c).to_numpy().astype(np.int64) for c in (2, 3))
            need = _needed(a, b, similarity)
            far = np.fromiter(map(_differ, part.column(4).to_pylist(), part.column(5).to_pylist()), np.int64, len(a))
            keep = pa.array((np.minimum(a, b) >= need) & (far <= a + b - 2 * need))
            yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["u", "v"])

    return pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b", "x", "y").mapInArrow(run, "u long, v long")


def _apart(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The pairs (u, v) of different roots."""
    if roots is None:
        return pairs
    for end in ("u", "v"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    return pairs.where(F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v")


def similar(edges: DataFrame, own: DataFrame, width: int, similarity: float) -> DataFrame:
    """The edges (u, v) whose texts have that Jaccard similarity of shingles, exactly; own: (node, text) of all ends."""
    a, b = own.select(F.col("node").alias("u"), F.col("text").alias("a")), own.select(F.col("node").alias("v"), F.col("text").alias("b"))

    def judge(parts):
        held, y = None, set()
        for part in parts:
            u, v, keep = part.column(0), part.column(1), []
            for k in range(part.num_rows):
                text = part.column(3)[k].as_py()
                if text != held:
                    held, y = text, shingle_set(text, width)
                x = shingle_set(part.column(2)[k].as_py(), width)
                few, many = sorted((len(x), len(y)))
                n = len(x & y) if few >= similarity * many else 0
                keep.append(n > 0 and n >= similarity * (few + many - n))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(keep), v.filter(keep)], names=["u", "v"])

    return edges.join(a, "u").join(b, "v").select("u", "v", "a", "b").mapInArrow(judge, "u long, v long")


def near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(row_key, doc_id, node, root) of the rows with words: node by the words, root for each set of linked nodes.

    First the SimHash grid brings together what differs in 3 bits at most, and every such link is verified by its exact
    similarity.  SimHash alone can't find all pairs at 0.8, so what is still apart is then joined by shingles, with a
    guarantee: two such sets share some of their first shingles, and the closer their sizes, the more.  Pairs of short
    lists, and each row's nearest in long ones, are decided before all the pairs in long lists that are still apart.
    Texts move only for pairs that were met in as many lists, and that sizes and bitmaps don't rule out.
    """
    texts = _texts(docs.where(F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")))
    schema = pa.schema([("row_key", pa.int64()), ("doc_id", pa.int64()), ("node", pa.int64()), ("f0", pa.int64()), ("size", pa.int32()), ("bits", pa.binary()), ("wide", pa.binary())])

    def run(parts):
        for part in parts:
            own = part.column(2).to_pylist()
            made = [(_node(t), _set_fingerprint(h), len(h), _bitmap(h), _wide(h)) for t in own for h in (_hashes(t, width),)]
            columns = zip(*made) if made else repeat((), 5)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(columns, schema.types[2:]))], schema=schema)

    rows = common.durable(texts.mapInArrow(run, "row_key long, doc_id long, node long, f0 long, size int, bits binary, wide binary"))
    first = (F.first(c).alias(c) for c in ("f0", "size", "bits", "wide"))
    nodes = common.durable(rows.groupBy("node").agg(F.min("row_key").alias("row_key"), *first))
    share = max(1, rows.count() // _SAMPLE)
    lists = postings(texts, width, similarity, share).repartition("h").dropDuplicates(["h", "node"])
    short, lists = _split(lists.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1"), similarity)
    lists = lists.join(nodes.select("node", "bits"), "node")
    links, roots = None, None
    for candidates in (lambda: link(nodes.select("node", "f0")).distinct(), lambda: _candidates(short, lists, roots, similarity, False), lambda: _candidates(short, lists, roots, similarity, True)):
        pairs = common.durable(_apart(candidates(), roots))  # two smaller plans, and bitmaps only move for pairs still apart
        pairs = common.durable(_plausible(pairs, nodes, similarity))
        ends = pairs.select(F.col("u").alias("node")).unionAll(pairs.select("v")).distinct()
        own = common.durable(texts.join(nodes.join(ends, "node", "left_semi").select("node", "row_key"), "row_key").select("node", "text").dropDuplicates(["node"]))
        found = common.durable(similar(pairs, own, width, similarity))
        links = found if links is None else links.unionByName(found)
        roots = common.components(links)
    return rows.select("row_key", "doc_id", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def drop_near_copies(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without all but the smallest doc_id of each group of texts linked by that Jaccard similarity of shingles.

    Texts of the same words are copies.  Rows without words stay.  Rows that share a doc_id are told apart by what they
    say; equal rows stay or go together.
    """
    rows = common.durable(near_copies(docs, width, similarity).withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")))
    first = rows.groupBy("root").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1")
    # a large group meets its first row in several tasks
    first = first.select("root", "first", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("row_key", "root"), F.lit(_SALTS)).cast("int"))
    extra = dealt.join(first, ["root", "salt"]).where("place.row_key <> first.row_key").select(F.col("row_key").alias("_tidemark_key")).distinct()
    return docs.withColumn("_tidemark_key", common.row_key(docs)).join(extra, "_tidemark_key", "left_anti").drop("_tidemark_key")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(common.table(spark, sf_dir, "documents"))
