"""Language identification: word frequencies first, character n-grams for unseen words.

A known word scores its smoothed log frequency in each language; a word that no language knows scores the mean of its
longest n-grams of which any is known.  The model is fitted on a sample of labelled documents, bounded in bytes for each
language and in all, and chosen by a hash of their ids, so the same ones at every run.  Every language, word and n-gram
of the sample is in the model, which holds counts by hash, sparse over languages; its size is bounded by the sample's.
Everything is predicted from whole texts.

Defined results: a text that is null or has no letter, or a model without languages, gives `und` and score 0; very long
texts count whole; equal texts get equal predictions; ties go to the language that sorts first; rows without doc_id and
rows beyond LONGEST_TEXT aren't learned from; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Letters in a row.
WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
#: Bytes of text that a language is learned from, and all of them; a longer text than this isn't learned from.
LANGUAGE_BYTES, ALL_BYTES, LONGEST_TEXT = 8 << 20, 128 << 20, 80_000
#: Scores that a worker remembers of words; the rest is scored again.
_REMEMBERED = 1 << 22


def grams(word: str, n: int) -> list[str]:
    word = f"<{word}>"
    return [word[i : i + n] for i in range(len(word) - n + 1)]


class Table:
    """Smoothed log frequencies by language of strings, which are known by a hash; sparse rows over a common base."""

    def __init__(self, keys: np.ndarray, langs: np.ndarray, times: np.ndarray, n_languages: int):
        order = np.lexsort((langs, keys))
        keys, langs, times = keys[order], langs[order], times[order]
        self.keys, first = np.unique(keys, return_index=True)
        self.start = np.r_[first, len(keys)]
        total = np.bincount(langs, times, n_languages) + 0.5 * max(len(self.keys), 1)
        self.base = np.log(0.5 / total).astype(np.float32)
        self.langs = langs.astype(np.int32)
        self.more = (np.log((times + 0.5) / total[langs]) - self.base[langs]).astype(np.float32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it isn't known."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def rows(self, at: np.ndarray) -> np.ndarray:
        """Log frequencies by language at those places."""
        out = np.tile(self.base, (len(at), 1))
        size = self.start[at + 1] - self.start[at]
        row = np.repeat(np.arange(len(at)), size)
        own = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + self.start[at][row]
        out[row, self.langs[own]] += self.more[own]
        return out


def name(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Model:
    """tables[0] of words, tables[n] of n-grams."""

    def __init__(self, languages: list[str], tables: list[Table]):
        self.languages, self.tables = languages, tables
        self.forget()

    def __getstate__(self):
        return self.languages, self.tables

    def __setstate__(self, state):
        self.languages, self.tables = state
        self.forget()

    def forget(self) -> None:
        self.seen: dict[str, int] = {}
        self.rows = np.empty((0, len(self.languages)), np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """A row of log frequencies for each word: its own, or else the mean of its longest n-grams of which any is known."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        at = self.tables[0].find(np.fromiter(map(name, words), np.int64, len(words)))
        out[at >= 0] = self.tables[0].rows(at[at >= 0])
        left = np.flatnonzero(at < 0)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            own = [grams(words[i], n) for i in left.tolist()]
            of = np.repeat(np.arange(len(left)), [len(x) for x in own])
            at = self.tables[n].find(np.fromiter((name(g) for x in own for g in x), np.int64, len(of)))
            of, at = of[at >= 0], at[at >= 0]
            total, count = np.zeros((len(left), len(self.languages))), np.bincount(of, minlength=len(left))
            np.add.at(total, of, self.tables[n].rows(at))
            known = count > 0
            out[left[known]] = total[known] / count[known, None]
            left = left[~known]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text:
            return "und", 0.0
        counts = Counter(w for w in WORD.findall(text.lower()))
        if not any(map(str.isalpha, counts)) and not any(map(str.isalpha, text)):
            return "und", 0.0
        if len(self.seen) * len(self.languages) > _REMEMBERED:
            self.forget()
        seen = self.seen
        if new := [w for w in counts if w not in seen]:
            at = len(seen)
            if at + len(new) > len(self.rows):
                more = np.empty((max(2 * len(self.rows), at + len(new), 1 << 10), len(self.languages)), np.float32)
                more[:at] = self.rows[:at]
                self.rows = more
            seen.update(zip(new, range(at, at + len(new))))
            self.rows[at : at + len(new)] = self.scores(new)
        n = len(counts)
        own = self.rows[np.fromiter(map(seen.__getitem__, counts), np.int64, n)]
        times = np.fromiter(counts.values(), float, n)
        total = times @ own
        best = int(total.argmax())
        # how sure: the total evidence, tempered since words of a text depend on each other
        shares = np.exp((total - total[best]) / max(times.sum(), 1) ** 0.5)
        return self.languages[best], float(1 / shares.sum())


def learnable(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) != 2


def fit(docs: DataFrame, language_bytes: int = LANGUAGE_BYTES, all_bytes: int = ALL_BYTES) -> Model:
    """The model of a bounded sample of the documents that have text and lang."""
    rows = docs.where(learnable() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("langid")), F.lit(1 << 30)).alias("_at"))
    rows = rows.where(F.octet_length("text") <= LONGEST_TEXT)
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long") + 1).alias("size")).collect()  # a row a language
    languages = sorted(r["lang"] for r in sizes)
    most = min(language_bytes, all_bytes // max(len(languages), 1))
    if not languages:
        return Model([], [])
    shares = [(r["lang"], languages.index(r["lang"]), int(min(1.0, most / r["size"]) * (1 << 30))) for r in sizes]
    limits = docs.sparkSession.createDataFrame(shares, "lang string, _lang int, _most long").coalesce(1)
    sample = rows.join(F.broadcast(limits), "lang").where("_at < _most").select("_lang", "text")
    schema = pa.schema([("n", pa.int8()), ("lang", pa.int32()), ("gram", pa.int64()), ("times", pa.int64())])

    def count(parts):
        common.forget()
        kept: dict[int, Counter] = {}
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                kept.setdefault(lang, Counter()).update(WORD.findall(text.lower()))

        def rows():
            for lang, words in kept.items():
                yield from ((0, lang, name(w), n) for w, n in words.items())
                for length in range(1, LONGEST + 1):
                    part = Counter()
                    for w, n in words.items():
                        for g in grams(w, length):
                            part[g] += n
                    yield from ((length, lang, name(g), n) for g, n in part.items())

        yield from common.batches(rows(), schema, 1 << 16)

    # the sample is bounded, and so is what comes to the driver
    counted = sample.mapInArrow(count, "n byte, lang int, gram long, times long").groupBy("n", "lang", "gram").agg(F.sum("times").alias("times"))
    found = counted.toArrow()
    n, lang, gram, times = (found.column(c).to_numpy() for c in ("n", "lang", "gram", "times"))
    return Model(languages, [Table(gram[n == k], lang[n == k], times[n == k], len(languages)) for k in range(LONGEST + 1)])


def predicted(docs: DataFrame, model: Model, text: F.Column) -> F.Column:
    """(lang_pred, score) of a text as one struct; the model, of bounded size, goes to every executor."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        common.forget()
        made = [sent.value.predict(t) for t in texts.to_pylist()]
        langs, scores = zip(*made) if made else ((), ())
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return F.arrow_udf(run, "lang_pred string, score double").asNondeterministic()(text.cast("string"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""
    held_out = F.coalesce(~learnable(), F.lit(False)).alias("held_out")
    made = docs.select(F.col("doc_id").cast("long"), held_out, predicted(docs, model, docs["text"]).alias("p"))
    return made.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_known(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is told with at least that score."""
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    made = docs.select(row, predicted(docs, fit(docs), docs["text"]).alias("p"))
    return made.where((F.col("p.lang_pred") != "und") & (F.col("p.score") >= least)).select("row.*")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
