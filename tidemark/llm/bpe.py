"""Byte-pair encoding and decoding of whole texts with a tokenizers file.

Merges come off a priority queue of (rank, place); the symbols stand in a doubly linked list, and entries whose pair
has changed since are skipped.  Decoding joins the vocabulary strings as the file's (absent) decoder does.

Letters, digits and lower case of code points that this Python's Unicode doesn't know yet are asked of the library once.

Defined results: null and empty texts have no ids; very long texts are encoded whole, and ids of very long words cost
n log n; of equal ranks the leftmost merges first; equal rows give equal rows; an empty table gives none; other columns
of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: White space as Unicode has it; str.split() also cuts at the four separators below.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Unicode takes no new code points before it.
_GROWING = "\u0370"
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Bytes that a worker remembers of chunks and of words, about, and the longest of either; the rest is encoded again.
CHUNK_BYTES, WORD_BYTES, LONGEST = 256 << 20, 64 << 20, 128


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    names = dict(zip(plain, map(chr, plain))) | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


class Encoder:
    """Encodes chunks (runs without white space); reads the pre-tokenizer's pattern, suffix, vocabulary and merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", _SPACE))
        self.letters = byte_letters()
        self.path, self.newer = path, None
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.split_space = regex.compile(f"[{_SPACE}]+")
        self.known: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def _learn_newer(self) -> None:
        """newer: code points newer than unicodedata that are letters or digits; stand_in: a code point of the same class for each one that is newer than unicodedata; lowers: their lower case."""
        from tokenizers import Tokenizer

        whole, known = Tokenizer.from_file(self.path), regex.compile(r"[\p{L}\p{N}]")
        newer = [c for c in map(chr, range(0x80, 0x110000)) if unicodedata.category(c) == "Cn" and known.match(c)]
        split, lower = whole.pre_tokenizer.pre_tokenize_str, whole.normalizer.normalize_str
        self.lowers = {ord(c): x for c in newer if (x := lower(c)) != c}
        self.stand_in = {}
        for c in newer:
            low = c.translate(self.lowers)
            self.stand_in[ord(low)] = "a" if len(split("a" + low)) == 1 else "1" if len(split(low + low)) == 2 else "~"
        self.newer = frozenset(newer) | set(map(chr, self.stand_in))

    def chunks(self, text: str):
        """Lists of chunks, and between them the ids of special tokens that the text names."""
        parts = self.split_special.split(text) if any(s in text for s in self.special) else (text,)
        for part in parts:
            if part in self.special:
                yield self.special[part]
            elif any(c in part for c in _SEPARATORS):
                yield [x for x in self.split_space.split(part) if x]
            else:
                yield part.split()

    def chunk_ids(self, chunk: str) -> list[int]:
        if chunk.isascii():
            chunk = chunk.lower()
            if chunk.isalpha():  # one word, most often met in this chunk alone
                return self.word_ids(chunk)
        else:
            chunk = "".join(map(str.lower, unicodedata.normalize("NFC", chunk)))
            if self.newer is None and max(chunk) >= _GROWING:
                self._learn_newer()
            if self.newer and not self.newer.isdisjoint(chunk):
                chunk = chunk.translate(self.lowers)
                words = [chunk[slice(*m.span())] for m in self.words.finditer(chunk.translate(self.stand_in))]
                return [x for word in words for x in self.word_ids(word)]
        ids: list[int] = []
        for word in self.words.findall(chunk):
            found = self.known.get(word)
            if found is None:
                found = tuple(self.word_ids(word))
                if len(word) <= LONGEST:
                    self.held += 200 + 4 * len(word) + 8 * len(found)
                    if self.held > WORD_BYTES:
                        self.known.clear()
                        self.held = 0
                    self.known[word] = found
            ids += found
        return ids

    def word_ids(self, word: str) -> list[int]:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.suffix
        symbol: list[int | None] = [self.vocab[x] for x in letters]
        n, merges = len(symbol), self.merges
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(m[0], i) for i in range(n - 1) if (m := merges.get((symbol[i], symbol[i + 1])))]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            if symbol[i] is None or j >= n:
                continue
            m = merges.get((symbol[i], symbol[j]))
            if m is None or m[0] != rank:  # stale: one of the two has merged since
                continue
            symbol[i], symbol[j] = m[1], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((symbol[i], symbol[k])):
                    heappush(queue, (m[0], i))
            if (h := before[i]) >= 0 and (m := merges.get((symbol[h], symbol[i]))):
                heappush(queue, (m[0], h))
        return [s for s in symbol if s is not None]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.chunks(text):
            if isinstance(part, int):
                ids.append(part)
            else:
                for chunk in part:
                    ids += self.chunk_ids(chunk)
        return ids

    def decode(self, ids) -> str:
        return " ".join(self.strings[i] for i in ids)


class Memo(dict):
    """What make gives for a chunk, remembered up to a number of bytes; long chunks are made anew; trim() between texts."""

    def __init__(self, make, most: int = CHUNK_BYTES):
        self.make, self.most, self.held = make, most, 0

    def __missing__(self, chunk):
        made = self.make(chunk)
        if len(chunk) <= LONGEST:
            self.held += 400 + 12 * len(chunk)  # what a chunk, its ids and their texts take at most, about
            self[chunk] = made
        return made

    def trim(self) -> None:
        if self.held > self.most:
            self.clear()
            self.held = 0


def encoder(path: str) -> Encoder:
    return common.kept(("encoder", path), lambda: Encoder(path))


def _digests(path: str):
    own = Encoder(path)

    def render(ids) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), own.decode(ids)

    memo = Memo(lambda chunk: render(own.chunk_ids(chunk)))

    def of(text: str | None) -> tuple[int, str, str]:
        parts: list[tuple[int, str, str]] = []
        for part in own.chunks(text or ""):
            parts += [render((part,))] if isinstance(part, int) else [memo[c] for c in part]
        memo.trim()
        n, ids, strings = zip(*parts) if parts else ((), (), ())
        return sum(n), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(" ".join(strings).encode()).hexdigest()

    return of


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of each text."""

    def run(parts):
        own = encoder(path)
        for part in parts:
            ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): what the ids of each row decode to."""

    def run(parts):
        own = encoder(path)
        for part in parts:
            texts = [own.decode(i or ()) for i in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text, encoded and decoded in one pass without a shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(parts):
        of = common.kept(("digests", path), lambda: _digests(path))
        for part in parts:
            made = [of(t) for t in part.column(1).to_pylist()]
            columns = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, schema.types[1:]))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
