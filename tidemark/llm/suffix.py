"""Removal of bytes covered by a 100-byte string that also starts earlier, by bucketed enhanced suffix arrays.

Every window of `least` bytes holds one chosen gram: the smallest hash, leftmost of equals.  Equal windows choose the
same gram at the same place, so the suffixes at chosen grams, bucketed by gram, hold every repeat.  Spark's sort of a
bucket by the text right of the gram is its suffix array.  A stack scan over common-prefix lengths gives the tree of
prefix intervals; within an interval a second scan, over the text left of the gram, tests left extensions.  Each node
is a maximal repeat with all of its occurrences; all but the earliest are covered.  An occurrence carries the text of
the windows that choose its gram and no more, so a bucket of m rows has at most `least` nested intervals a row.

Grams met once take part in one narrow shuffle only; the text around the others goes to the buckets and is compared byte
for byte.  Surroundings that equal earlier ones of their batch are covered without a tree, so copies come down to a row
a batch.  A gram that many different surroundings share is bucketed by longer strings around it instead (pieces).

Defined results: a null text is empty; texts under 100 bytes, very long ones and ties follow the one rule; rows that
repeat a doc_id with the same text count as one document and each loses the same; rows that repeat it with another text
are documents of their own, in the order of a hash of their texts; rows without doc_id lose nothing and cover nothing;
an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

GRAM = 32
#: Texts sampled to learn which grams many different surroundings share, how many make one hot, how many hot ones are
#: sent to the tasks, and the pieces that such a gram is cut into; one that is HOT times hotter than that, into more.
#: Results don't depend on these.
SAMPLE, HOT, MOST_HOT, PIECES, HOTTER, MORE_PIECES = 8_000, 24, 1 << 16, 4, 12, 16
#: Bytes hashed at once; longer texts go block by block.
_BLOCK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_TABLE = np.random.default_rng(9).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each gram-byte string (gram: a power of two), by doubling."""
    h, p, s = _TABLE[x], 0x9E3779B97F4A7C15, 1
    while s < gram:
        nxt = h[:-s] * np.uint64(p)
        nxt += h[s:]
        h, p, s = nxt, p * p % 2**64, 2 * s
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def chosen_grams(text: bytes, least: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, first, last): the grams that the windows of `least` bytes choose, and where those windows start."""
    found, wide = [], least - gram + 1
    for at in range(0, max(len(text) - least + 1, 0), _BLOCK):
        h = _gram_hashes(np.frombuffer(text[at : at + _BLOCK + least - 1], np.uint8), gram)
        m = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        s = 1
        while 2 * s <= wide:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if wide > s:
            m = np.minimum(m[: s - wide], m[wide - s :])
        first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        own = (m[first] & _PLACE).astype(np.int64)
        found.append((own + at, h[own], first + at, np.r_[first[1:], len(m)] - 1 + at))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    places, hashes, first, last = (np.concatenate(x) for x in zip(*found))
    new = np.r_[True, places[1:] != places[:-1]]  # a gram chosen at the ends of two blocks is one
    return places[new], hashes[new], first[new], last[np.r_[new[1:], True]]


def prefix_intervals(lcp: list[int]):
    """(length, first, last) of every interval of the common-prefix tree, inner ones before those around them."""
    stack = [(-1, 0)]
    for i, here in enumerate([*lcp, -1], 1):
        start = i - 1
        while stack[-1][0] > here:
            length, start = stack.pop()
            yield length, start, i - 1
        if stack[-1][0] < here:
            stack.append((here, start))


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "little") ^ int.from_bytes(b[:n], "little")
    return ((x & -x).bit_length() - 1) // 8 if x else n


def maximal_repeats(rights: list[bytes], lefts: list[bytes], lcp: list[int], least: int):
    """(left, right, members) of the repeats of at least `least` bytes in one bucket; members: indexes of all occurrences.

    rights are in order and lcp has their common prefixes; lefts are reversed, nearest byte first.
    """
    for right, first, last in prefix_intervals(lcp):
        members = sorted(range(first, last + 1), key=lefts.__getitem__)
        shared = [_shared(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        if right + max(shared, default=0) < least:
            continue  # no left extension is long enough
        for left, a, b in prefix_intervals(shared):
            if left + right >= least:
                yield left, right, members[a : b + 1]


def covered(rows: list[tuple], lcp: list[int], least: int):
    """(doc_id, sub, start, end) of what repeats earlier in a bucket of rows (right, reversed left, doc_id, sub, place)."""
    best = [-1] * len(rows)
    for left, right, members in maximal_repeats([r[0] for r in rows], [r[1] for r in rows], lcp, least):
        earliest = min(rows[x][2:] for x in members)
        for x in members:
            doc, sub, place = rows[x][2:]
            if left > best[x] and (doc, sub, place) != earliest:
                best[x] = left
                yield doc, sub, place - left, place + right


def groups(rows: list[tuple], lcp: list[int], least: int):
    """(length, doc_id, sub, start, group): every occurrence of every maximal repeat in a bucket; a group has one name."""
    for left, right, members in maximal_repeats([r[0] for r in rows], [r[1] for r in rows], lcp, least):
        name = xxhash.xxh3_64_intdigest(rows[members[0]][1][:left][::-1] + rows[members[0]][0][:right]) - (1 << 63)
        for doc, sub, place in sorted({rows[x][2:] for x in members}):
            yield left + right, doc, sub, place - left, name


def pieces(least: int, gram: int, n: int) -> list[tuple[int, int, int, int]]:
    """(before, behind, left, right): windows of `least` bytes around a gram's place belong to one of these pieces each.

    A window with r bytes from the place on belongs to the piece whose cuts r lies between.  All of the piece's windows
    hold `before` and `behind` bytes on the two sides of the place, and none of them more than `left` and `right`.
    """
    cuts = np.linspace(gram, least + 1, n + 1).astype(int).tolist()
    return [(least + 1 - b, a, least - a, b - 1) for a, b in zip(cuts, cuts[1:])]


def _key(text: bytes, place: int, piece: int, cut: list[tuple], gram: int) -> int:
    before, behind = cut[piece - 1][:2] if piece else (0, gram)
    return xxhash.xxh3_64_intdigest(text[place - before : place + behind], piece) - (1 << 63)


def _sampled(docs: DataFrame, least: int, gram: int) -> dict[int, bool]:
    """Keys of grams that many different surroundings share, true for the hottest, by a bounded sample of texts."""
    share = max(1, docs.count() // SAMPLE)

    def run(parts):
        for part in parts:
            for (text,) in zip(part.column(0).to_pylist()):
                places, _, first, last = (x.tolist() for x in chosen_grams(text, least, gram))
                keys = [_key(text, p, 0, [], gram) for p in places]
                around = [xxhash.xxh3_64_intdigest(text[a : b + least]) - (1 << 63) for a, b in zip(first, last)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(around, pa.int64())], names=["key", "around"])

    some = docs.where((F.octet_length("body") >= least) & (F.pmod(F.xxhash64("body"), F.lit(share)) == 0)).select("body")
    often = some.mapInArrow(run, "key long, around long").distinct().groupBy("key").count().where(F.col("count") >= HOT)
    found = often.orderBy(F.desc("count"), "key").limit(MOST_HOT).toPandas()
    return {int(k): bool(n >= HOT * HOTTER) for k, n in zip(found["key"], found["count"])}


def surroundings(docs: DataFrame, texts: DataFrame, least: int = 100, gram: int = GRAM, collapse: bool = True) -> DataFrame:
    """(key, right, left, doc_id, sub, s, e): the text around every chosen gram whose key is met twice or more.

    Needs doc_id, sub, body; texts is docs packed.  With collapse, what equals the text around an earlier gram of its batch, byte for byte, is
    told as a covered span (right is null then), so that copies come down to one row a batch.
    """
    cut = [*pieces(least, gram, PIECES), *pieces(least, gram, MORE_PIECES)]
    which = {False: range(1, PIECES + 1), True: range(PIECES + 1, PIECES + MORE_PIECES + 1)}
    anchors = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("sub", pa.int64()), ("at", pa.int64()), ("kind", pa.int8())])
    sent = docs.sparkSession.sparkContext.broadcast(_sampled(docs, least, gram))

    def read(parts):
        hot = sent.value

        def batch(keys, docs_, subs, ats):
            key, at = np.array(keys, np.int64), np.array(ats, np.int64)
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            again = np.zeros(len(key), bool)
            again[order[1:]] = same  # all but the first of a key in this batch
            many = np.zeros(len(key), bool)
            many[order[:-1]] = same
            kind = np.where(again, 2, np.where(many, 1, 0)).astype(np.int8)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs_, pa.int64()), pa.array(subs, pa.int64()), pa.array(at), pa.array(kind)], schema=anchors)

        for part in parts:
            out = [[], [], [], []]
            for doc, sub, text in sorted(set(zip(*(part.column(i).to_pylist() for i in range(3))))):
                places, _, first, last = (x.tolist() for x in chosen_grams(text, least, gram))
                for p, a, b in zip(places, first, last):
                    key = _key(text, p, 0, cut, gram)
                    at = (p << 21) | ((p - a) << 13) | ((b + least - p) << 5)
                    if key not in hot:
                        out[0].append(key)
                        out[3].append(at)
                    else:
                        for k in which[hot[key]]:
                            if cut[k - 1][0] <= p - a and cut[k - 1][1] <= b + least - p:
                                out[0].append(_key(text, p, k, cut, gram))
                                out[3].append(at | k)
                out[1] += [doc] * (len(out[0]) - len(out[1]))
                out[2] += [sub] * (len(out[0]) - len(out[2]))
                if len(out[0]) >= 1 << 18:
                    yield batch(*(out[i] for i in range(4)))
                    out = [[], [], [], []]
            if out[0]:
                yield batch(*out)

    def met(parts):
        """Sorted by key: the anchors whose key stands at two places or more."""
        held = None
        for part in _and_end(parts):
            if part is not None:
                cols = [part.column(i).to_numpy() for i in range(5)]
                held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
                if len(held[0]) < 1 << 16 or held[0][0] == held[0][-1]:
                    continue
                end = int(np.searchsorted(held[0], held[0][-1]))
            elif held is None:
                break
            else:
                end = len(held[0])
            now, held = [c[:end] for c in held], [c[end:] for c in held]
            if end:
                key, doc, sub, at, kind = now
                other = np.r_[False, (key[1:] == key[:-1]) & ((doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (at[1:] != at[:-1]))]
                ends = np.flatnonzero(np.r_[key[1:] != key[:-1], True])
                starts = np.r_[0, ends[:-1] + 1]
                twice = np.repeat(np.maximum.reduceat(other, starts), ends - starts + 1)
                ok = (kind > 0) | twice
                yield pa.RecordBatch.from_arrays([pa.array(c[ok]) for c in (doc, sub, at)], names=["doc_id", "sub", "at"])

    schema = pa.schema([("key", pa.int64()), ("right", pa.binary()), ("left", pa.binary()), ("doc_id", pa.int64()), ("sub", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

    def cut_out(parts):
        codec = pa.Codec("zstd")

        def rows(part):
            seen: dict[tuple[int, bytes, int], tuple] = {}
            columns = (part.column(n).to_pylist() for n in ("doc_id", "sub", "size", "packed", "wanted"))
            for doc, sub, size, body, wanted in sorted((r for r in zip(*columns) if r[4]), key=lambda r: r[:2]):
                text, told = codec.decompress(body, size, asbytes=True), []
                for at in sorted(wanted):
                    p, left, right, piece = at >> 21, (at >> 13) & 255, (at >> 5) & 255, at & 31
                    if piece:
                        left, right = min(left, cut[piece - 1][2]), min(right, cut[piece - 1][3])
                    key, around, own = _key(text, p, piece, cut, gram), text[p - left : p + right], (doc, sub, p)
                    if collapse and seen.setdefault((key, around, left), own) != own:
                        told.append({"s": p - left, "e": p + right})
                        continue
                    yield key, around[left:], around[:left][::-1], doc, sub, p, p
                for s, e in union(told, size):
                    yield xxhash.xxh3_64_intdigest(b"%d %d" % (sub, s)) - (1 << 63), None, None, doc, sub, s, e

        for part in parts:
            yield from common.batches(rows(part), schema)

    dealt = docs.where((F.octet_length("body") >= least) & F.col("doc_id").isNotNull()).select("doc_id", "sub", "body").mapInArrow(read, "key long, doc_id long, sub long, at long, kind byte")
    # what is known to be met again in its batch only passes through, dealt by its own place
    dealt = dealt.withColumn("key", F.when(F.col("kind") == 2, F.xxhash64("doc_id", "at")).otherwise(F.col("key")))
    again = dealt.repartition("key").sortWithinPartitions("key", "doc_id", "sub", "at").mapInArrow(met, "doc_id long, sub long, at long")
    wanted = again.groupBy("doc_id", "sub").agg(F.collect_set("at").alias("wanted"))
    # a left join, as the one with spans is: an inner one would filter nulls first and shuffle the texts again
    return texts.join(wanted.hint("shuffle_hash"), ["doc_id", "sub"], "left").mapInArrow(cut_out, "key long, right binary, left binary, doc_id long, sub long, s long, e long")


def _buckets(parts, gram: int, judge):
    """judge(rows, lcp) over the buckets of sorted surroundings; covered spans pass."""
    rows, lcp, at = [], [], None
    for part in parts:
        for key, right, left, doc, sub, s, e in zip(*(part.column(i).to_pylist() for i in range(7))):
            if right is None:
                yield doc, sub, s, e
                continue
            n = _shared(rows[-1][0], right) if rows and key == at else 0
            if n < gram:
                if lcp:
                    yield from judge(rows, lcp)
                rows, lcp, at = [], [], key
            else:
                lcp.append(n)
            rows.append((right, left, doc, sub, s))
    if lcp:
        yield from judge(rows, lcp)


def with_spans(docs: DataFrame, texts: DataFrame, least: int = 100, gram: int = GRAM) -> DataFrame:
    """texts with spans, array<struct<s, e>>: bytes covered by strings of `least` bytes that start earlier.

    docs: (doc_id, sub, body), texts: the same packed; both uses of it share one shuffle.
    """

    def scan(parts):
        schema = pa.schema([("doc_id", pa.int64()), ("sub", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])
        yield from common.batches(_buckets(parts, gram, lambda rows, lcp: covered(rows, lcp, least)), schema)

    around = surroundings(docs, texts, least, gram).repartition("key").sortWithinPartitions("key", "right")
    found = around.mapInArrow(scan, "doc_id long, sub long, s long, e long")
    spans = found.groupBy("doc_id", "sub").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    return texts.join(spans.hint("shuffle_hash"), ["doc_id", "sub"], "left")


def repeat_groups(docs: DataFrame, least: int = 100, gram: int = GRAM) -> DataFrame:
    """(grp, doc_id, start, length): all occurrences of each maximal repeat of at least `least` bytes.

    Repeats are seen inside the surroundings of one gram, so a longer one comes as overlapping groups.
    """

    def scan(parts):
        schema = pa.schema([("length", pa.int64()), ("doc_id", pa.int64()), ("sub", pa.int64()), ("start", pa.int64()), ("grp", pa.int64())])
        yield from common.batches(_buckets(parts, gram, lambda rows, lcp: groups(rows, lcp, least)), schema)

    bodies = _bodies(docs)
    around = surroundings(bodies, packed(bodies), least, gram, collapse=False).repartition("key").sortWithinPartitions("key", "right")
    found = around.mapInArrow(scan, "length long, doc_id long, sub long, start long, grp long")
    return found.select("grp", "doc_id", "start", "length").distinct()


def _and_end(parts):
    yield from parts
    yield None


def union(spans, size: int) -> list[tuple[int, int]]:
    """Maximal runs covered by spans, within 0..size."""
    runs: list[list[int]] = []
    for s, e in sorted((x["s"], min(x["e"], size)) for x in spans or ()):
        if runs and s <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e)
        elif s < e:
            runs.append([s, e])
    return [(s, e) for s, e in runs]


def kept_bytes(text: bytes, runs) -> bytes:
    at, kept = 0, []
    for s, e in runs:
        kept.append(text[at:s])
        at = e
    return b"".join([*kept, text[at:]])


def _bodies(docs: DataFrame) -> DataFrame:
    """(doc_id, sub, body): sub tells texts that share a doc_id apart, and orders them."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(body).alias("sub"), body.alias("body"))


def packed(docs: DataFrame, rest: str | None = None) -> DataFrame:
    """docs with size and packed, the compressed body, in its place: whole texts are shuffled in less space."""
    columns = ["doc_id", "sub", *([rest] if rest else [])]

    def run(parts):
        codec = pa.Codec("zstd")
        for part in parts:
            texts = part.column(0).to_pylist()
            made = [None if t is None else codec.compress(t, asbytes=True) for t in texts]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(made, pa.binary())], names=[*columns, "size", "packed"])

    own = docs.select("body", *columns)
    fields = [own.schema[c] for c in columns]
    return own.mapInArrow(run, T.StructType([*fields, T.StructField("size", T.LongType()), T.StructField("packed", T.BinaryType())]))


def removal_digests(docs: DataFrame, least: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each document."""
    bodies = _bodies(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(parts):
        codec = pa.Codec("zstd")

        def rows(part):
            for doc, size, body, own in zip(*(part.column(n).to_pylist() for n in ("doc_id", "size", "packed", "spans"))):
                text, runs = codec.decompress(body, size, asbytes=True), union(own, size)
                yield doc, size, sum(e - s for s, e in runs), len(runs), hashlib.sha256(kept_bytes(text, runs)).hexdigest()

        for part in parts:
            yield from common.batches(rows(part), schema)

    return with_spans(bodies, packed(bodies), least).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _whole_characters(text: bytes, runs):
    """Runs shrunk to whole UTF-8 characters."""
    for s, e in runs:
        while s < e and text[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(text) and text[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            yield s, e


def remove_repeats(docs: DataFrame, least: int = 100) -> DataFrame:
    """docs with the covered bytes cut out of text, at whole characters; n_chars, where there is one, is counted anew."""

    def run(parts):
        codec = pa.Codec("zstd")
        for part in parts:
            texts = []
            for size, body, own in zip(*(part.column(n).to_pylist() for n in ("size", "packed", "spans"))):
                text = None if body is None else codec.decompress(body, size, asbytes=True)
                texts.append(None if text is None else kept_bytes(text, list(_whole_characters(text, union(own, size)))).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(texts, pa.string())], names=["_row", "_kept"])

    # the whole row travels as one value, so that no column of it can clash
    own_id = [x.alias(n) for x, n in zip((docs["doc_id"].cast("long"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"))), ("doc_id", "sub"))]
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != "text")).alias("_row"), docs["text"].cast("string").cast("binary").alias("body"), *own_id)
    joined = with_spans(_bodies(docs), packed(rows, "_row"), least)
    kept = joined.mapInArrow(run, T.StructType([joined.schema["_row"], T.StructField("_kept", T.StringType())]))
    own = {"text": F.col("_kept")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("_kept").cast(docs.schema["n_chars"].dataType)
    return kept.select(*(own.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(common.table(spark, sf_dir, "documents"))
