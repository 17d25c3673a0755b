"""Sum-of-squares online packing of token streams into windows.

Windows that are partly filled are counted by fill level.  A document goes to the level (or a new window) that leaves
the smallest sum of squared counts; whole windows are cut off first where it is longer than one.  Each task packs
what it reads, without a shuffle.  At its end the windows still open are poured into each other, cutting documents, and
the last one is cut at powers of two, lengths that need no padding.

Defined results: a null or empty text is its end id alone; equal rows are packed each; null doc_ids are kept; an empty
table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, common


class Packer:
    """Packs (document, start, ids) pieces; full windows come out of take()."""

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.full: list[list] = []

    def level_for(self, n: int) -> int:
        """The level whose window takes n more; 0: a new one."""
        size, count = self.window, self.count
        here = count[1 : size - n + 1]
        change = 2 * (count[1 + n : size + 1] - here) + 2
        change[-1] = 1 - 2 * here[-1]  # fills the window, which is then counted nowhere
        change[here == 0] = np.iinfo(np.int64).max
        best = len(change) - 1 - int(change[::-1].argmin())  # of equals the fullest
        return best + 1 if change[best] < 2 * count[n] + 1 else 0

    def add(self, doc, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit."""
        n, step = len(ids) // 4, self.window
        for start in range(0, n - n % step, step):
            self.full.append([(doc, start, ids[4 * start : 4 * (start + step)], n)])
        rest = n % step
        if rest:
            level = self.level_for(rest)
            pieces = []
            if level:
                pieces = self.open[level].pop()
                self.count[level] -= 1
            pieces.append((doc, n - rest, ids[4 * (n - rest) :], n))
            if level + rest == step:
                self.full.append(pieces)
            else:
                self.open.setdefault(level + rest, []).append(pieces)
                self.count[level + rest] += 1

    def take(self) -> list[list]:
        done, self.full = self.full, []
        return done

    def close(self) -> list[list]:
        """Pour the emptiest open windows into the fullest; cut the last at powers of two."""
        left = [p for level in sorted(self.open, reverse=True) for p in self.open[level]]
        levels = [sum(len(x[2]) for x in p) // 4 for p in left]
        done, low, high = [], 0, len(left) - 1
        while low < high:
            room = self.window - levels[low]
            while room and low < high:
                piece = left[high].pop()
                n = len(piece[2]) // 4
                if n > room:
                    left[high].append((piece[0], piece[1], piece[2][: 4 * (n - room)], piece[3]))
                    piece, n = (piece[0], piece[1] + n - room, piece[2][4 * (n - room) :], piece[3]), room
                left[low].append(piece)
                levels[low] += n
                levels[high] -= n
                room -= n
                high -= not left[high]
            if not room:
                done.append(left[low])
                low += 1
        if low == high:
            done += powers(left[low])
        self.__init__(self.window)
        return done


def powers(pieces: list) -> list[list]:
    """Cut one window's pieces into sequences whose lengths are powers of two, largest first."""
    n, done, at = sum(len(p[2]) for p in pieces) // 4, [], 0
    queue = list(pieces)
    while n > at:
        room, own = 1 << ((n - at).bit_length() - 1), []
        at += room
        while room:
            doc, start, ids, total = queue.pop(0)
            if len(ids) // 4 > room:
                queue.insert(0, (doc, start + room, ids[4 * room :], total))
                ids = ids[: 4 * room]
            own.append((doc, start, ids, total))
            room -= len(ids) // 4
        done.append(own)
    return done


class ModelEncoder(bpe.Encoder):
    """Words not met before go to the tokenizers library's own model."""

    def __init__(self, path: str):
        super().__init__(path)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path).model

    def word_ids(self, word: str) -> list[int]:
        if not (word.isascii() and word.isalpha()):  # such letters stand for themselves
            word = "".join([self.letters[b] for b in word.encode()])
        return [t.id for t in self.model.tokenize(word)]


def token_bytes(path: str, end_id: int):
    """A function from a text to its ids and end_id as little-endian unsigned 32-bit; chunks are remembered."""
    return common.kept(("tokens", path, end_id), lambda: _token_bytes(path, end_id))


def _token_bytes(path: str, end_id: int):
    own = ModelEncoder(path)
    raw = lambda ids: array("I", ids).tobytes()
    memo, end = bpe.Memo(lambda chunk: raw(own.chunk_ids(chunk))), raw([end_id])

    def of(text: str | None) -> bytes:
        parts = []
        for part in own.chunks(text or ""):
            parts += [raw([part])] if isinstance(part, int) else [memo[c] for c in part]
        memo.trim()
        parts.append(end)
        return b"".join(parts)

    return of


def pack(docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and its ids if asked for."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(parts):
        of, packer = token_bytes(path, end_id), Packer(window)
        first, made = TaskContext.get().partitionId() << 36, 0

        def rows(sequences):
            nonlocal made
            for pieces in sequences:
                at = 0
                for doc, start, ids, total in pieces:
                    n = len(ids) // 4
                    yield (doc, start, n, zlib.crc32(ids), total, first + made, at, *([np.frombuffer(ids, "<u4").astype(np.int32)] * with_ids))
                    at += n
                made += 1

        for part in parts:
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                packer.add(doc, of(text))
            yield from common.batches(rows(packer.take()), schema)
        yield from common.batches(rows(packer.close()), schema)

    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kinds)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(common.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
