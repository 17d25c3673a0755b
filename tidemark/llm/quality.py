"""Quality rules: text statistics, then robust multivariate outliers per language and source.

Statistic vectors are transformed to tame their tails.  For each (lang, source) a minimum-covariance-determinant
estimate is made over all its rows: from several starts, concentration steps (distances, the share of smallest ones, their
mean and covariance) go down to smaller determinants; the start with the least one goes on.  A step is one grouped sum
over bins of distance, so no group is ever held in one task.  Sums are over integers, so the result doesn't depend on
the order of rows.  A group's estimate is drawn towards its language's with the weight of PRIOR rows: the same rule for
groups of every size.

Defined results: a null or empty text has no words and fails the base rules; very long texts are measured whole; null
lang or source are groups of their own; equal rows and ties get equal verdicts; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

_SPACES = [9, 10, 11, 12, 13, 32]
_SYMBOLS = list(b"#*$%&|<>")
_MARKS = [b for b in range(33, 127) if not chr(b).isalnum() and b not in b".,'\"-()"]
_UPPER = list(range(65, 91))
#: Transformed statistics: logs of words and word length, and square roots of shares.
FEATURES = ("log_words", "word_length", "symbol_share", "dup_lines", "repeat_share", "mark_share", "upper_share")
#: Features are held as multiples of 1 / UNIT.
UNIT = 1024
#: Spread that each feature has at least, as a standard deviation: below it, differences say nothing about quality.
LEAST_SPREAD = (0.9, 0.08, 0.06, 0.25, 0.12, 0.08, 0.08)
#: Share of rows that an estimate rests on, steps of all starts and of the best one, rows that a wider group's estimate
#: weighs, the covariance of that share of a normal distribution against the whole one's, and the distance beyond which a row is out.
SUPPORT, FIRST_STEPS, STEPS, PRIOR, NARROWED, CUTOFF = 0.6, 2, 2, 100, 0.65, 6.0
#: Above it repeated words are found by numbers; the result is the same.
_WIDE = 50_000


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    if len(words) <= _WIDE:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == n:
            return 0
        seen: dict = {}
        code = np.fromiter((seen.setdefault(w, i) for i, w in enumerate(windows)), np.int64, n)
    else:  # the same by numbers, for very long texts
        names: dict[bytes, int] = {}
        own = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
        pair = np.unique(own[:-1] * len(names) + own[1:], return_inverse=True)[1]
        code = np.unique(pair[:-1] * np.int64(len(names)) + own[2:], return_inverse=True)[1]
    again = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + n] |= again
    return int(covered.sum())


def measure(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the features as integers."""
    text = text or b""
    words = text.split()
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(len(text) - of[128:192].sum() - of[_SPACES].sum())
    symbols = int(of[_SYMBOLS].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    n = len(words)
    failed = n < 50 or 100 * repeats > 50 * n
    marks, upper = int(of[_MARKS].sum()), int(of[_UPPER].sum())
    per = max(chars, 1)
    x = (np.log1p(n), np.log1p(chars / max(n, 1)), (symbols / per) ** 0.5, np.log1p(dup_lines), (repeats / max(n, 1)) ** 0.5, (marks / per) ** 0.5, (upper / per) ** 0.5)
    return (n, chars, symbols, dup_lines, repeats, failed, *(round(v * UNIT) for v in x))


_KINDS = [*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), *((f, pa.int64()) for f in FEATURES)]
_DDL = ", ".join(f"{n} {'boolean' if n == 'base_failed' else 'long'}" for n, _ in _KINDS)


def _measured(texts: pa.Array) -> pa.Array:
    common.forget()
    made = [measure(t) for t in texts.to_pylist()]
    columns = zip(*made) if made else [[]] * len(_KINDS)
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _KINDS)], names=[n for n, _ in _KINDS])


def measured(text: F.Column) -> F.Column:
    """Base statistics, base_failed and features of each whole text, as one struct."""
    return F.arrow_udf(_measured, _DDL).asNondeterministic()(text.cast("binary"))  # so that it runs once a row


def _groups() -> list:
    return [F.to_json(F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))).alias("grp"), F.to_json(F.struct(F.col("lang").cast("string").alias("lang"))).alias("wide")]


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, grp, wide, base statistics, base_failed, features) of each row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), *_groups(), measured(F.col("text")).alias("m"))
    return rows.select("doc_id", "lang", "source", "grp", "wide", "m.*")


_K = len(FEATURES)
_SUMS = ["n", *(f"s{i}" for i in range(_K)), *(f"p{i}_{j}" for i in range(_K) for j in range(i + 1))]


def _moments() -> list:
    """Integer sums of features and their products, summed before the shuffle."""
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i in range(_K) for j in range(i + 1)]
    return [F.count("*").alias("n"), *sums, *products]


def _unpacked(row: dict, prefix: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and covariance from sums."""
    n = row[f"{prefix}n"]
    m = np.array([row[f"{prefix}s{i}"] for i in range(_K)], float) / n / UNIT
    c = np.empty((_K, _K))
    for i in range(_K):
        for j in range(i + 1):
            c[i, j] = c[j, i] = row[f"{prefix}p{i}_{j}"] / n / UNIT**2
    return n, m, c - np.outer(m, m)


def _drawn(own: tuple, wide: tuple) -> tuple[float, np.ndarray, np.ndarray]:
    """An estimate drawn towards a wider one's, which weighs PRIOR rows."""
    n, m, c = own
    _, wm, wc = wide
    mean = (n * m + PRIOR * wm) / (n + PRIOR)
    a, b = m - mean, wm - mean
    return n, mean, (n * (c + np.outer(a, a)) + PRIOR * (wc + np.outer(b, b))) / (n + PRIOR)


def shape(mean: np.ndarray, cov: np.ndarray) -> tuple[list, list, float]:
    """Mean, upper Cholesky factor of the inverse covariance with the least spread added, log determinant."""
    c = cov + np.diag(np.array(LEAST_SPREAD) ** 2)
    return mean.tolist(), np.linalg.cholesky(np.linalg.inv(c)).T.ravel().tolist(), float(np.linalg.slogdet(c)[1])


_ESTIMATE = "grp string, start int, mean array<double>, root array<double>, det double"


def _estimates(sums: DataFrame) -> DataFrame:
    """(grp, start, mean, root, det) from each group's sums (grp, wide, start, _SUMS)."""
    per_lang = sums.groupBy("wide", "start").agg(*(F.sum(c).alias(f"l{c}") for c in _SUMS))

    def run(frames):
        import pandas as pd

        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                _, mean, cov = _drawn(_unpacked(row, ""), _unpacked(row, "l"))
                out.append((row["grp"], row["start"], *shape(mean, cov / NARROWED)))
            yield pd.DataFrame(out, columns=["grp", "start", "mean", "root", "det"])

    return sums.join(per_lang, ["wide", "start"]).mapInPandas(run, _ESTIMATE)


def _distance(mean, root) -> F.Column:
    """Squared Mahalanobis distance of a row."""
    at = [F.col(f) / UNIT - mean[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(_K):
        part = F.lit(0.0)
        for j in range(i, _K):
            part = part + root[i * _K + j] * at[j]
        total = total + part * part
    return total


def starts(bins: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Centres and diagonal spreads to start from, by one histogram (values in order, counts) of each feature.

    Medians with their absolute deviations; medians with no spread but the least; middles of the quartiles with theirs.
    """

    def at(values, counts, share):
        return float(values[np.searchsorted(np.cumsum(counts), share * counts.sum())])

    centre, spread, middle, range_ = (np.zeros(_K) for _ in range(4))
    for i, (values, counts) in enumerate(bins):
        centre[i] = at(values, counts, 0.5)
        off = np.abs(values - centre[i])
        order = np.argsort(off, kind="stable")
        spread[i] = 1.4826 * at(off[order], counts[order], 0.5)
        low, high = at(values, counts, 0.25), at(values, counts, 0.75)
        middle[i], range_[i] = (low + high) / 2, (high - low) / 1.349
    return [(centre, spread), (centre, np.zeros(_K)), (middle, range_)]


def _starts(rows: DataFrame) -> DataFrame:
    """Several first estimates of each group, from histograms of 1/16 units."""
    values = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.floor(F.col(f) / (UNIT // 16)).cast("int").alias("bin")) for i, f in enumerate(FEATURES)))).alias("x")
    bins = rows.select("grp", values).groupBy("grp", "x.i", "x.bin").agg(F.count("*").alias("n"))

    def run(frame):
        import pandas as pd

        frame = frame.sort_values(["i", "bin"])
        held = [((x["bin"].to_numpy() + 0.5) / 16, x["n"].to_numpy()) for _, x in frame.groupby("i")]
        found = [(frame["grp"].iloc[0], k, *shape(centre, np.diag(spread**2))) for k, (centre, spread) in enumerate(starts(held))]
        return pd.DataFrame(found, columns=["grp", "start", "mean", "root", "det"])

    return bins.groupBy("grp").applyInPandas(run, _ESTIMATE)  # some thousand bins a group


def _step(rows: DataFrame, found: DataFrame) -> DataFrame:
    """A concentration step for every start of every group."""
    tried = found.groupBy("grp").agg(F.collect_list(F.struct("start", "mean", "root")).alias("tried"))  # a few
    each = rows.join(tried, "grp").select("grp", "wide", *FEATURES, F.explode("tried").alias("t"))
    each = each.select("grp", "wide", *FEATURES, F.col("t.start").alias("start"), F.floor(F.log2(_distance(F.col("t.mean"), F.col("t.root")) + 1e-6) * 16).cast("int").alias("bin"))
    bins = each.groupBy("grp", "wide", "start", "bin").agg(*_moments())

    def run(frame):
        import pandas as pd

        out = []
        for start, own in frame.groupby("start"):
            own = own.sort_values("bin")
            before = own["n"].cumsum() - own["n"]
            near = own[before < own["n"].sum() * SUPPORT]
            out.append((own["grp"].iloc[0], own["wide"].iloc[0], start, *(sum(map(int, near[c])) for c in _SUMS)))
        return pd.DataFrame(out, columns=["grp", "wide", "start", *_SUMS])

    kept = bins.groupBy("grp").applyInPandas(run, "grp string, wide string, start int, " + ", ".join(f"{c} long" for c in _SUMS))  # some hundred bins
    return _estimates(kept)


def estimate(rows: DataFrame) -> DataFrame:
    """(grp, start, mean, root, det) of each group of rows (grp, wide, features) by its least determinant."""
    found = common.durable(_starts(rows))
    for _ in range(FIRST_STEPS):
        found = common.durable(_step(rows, found))
    best = found.groupBy("grp").agg(F.min_by(F.struct("mean", "root", "det"), F.struct("det", "start")).alias("x"))
    found = common.durable(best.select("grp", F.lit(0).alias("start"), "x.*"))  # from here on all groups are pooled together
    for _ in range(STEPS):
        found = common.durable(_step(rows, found))
    return found


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics with base_failed, distance (squared) and kept; rows that fail the base rules take no part in estimates."""
    rows = common.durable(statistics(docs))
    found = estimate(rows.where("not base_failed").select("grp", "wide", *FEATURES))
    far = rows.join(found.select("grp", "mean", "root"), "grp", "left").withColumn("distance", _distance(F.col("mean"), F.col("root"))).drop("mean", "root")
    return far.withColumn("kept", _kept(F.col("base_failed"), F.col("distance"), cutoff))


def _kept(failed, distance, cutoff: float) -> F.Column:
    return ~failed & (F.coalesce(distance, F.lit(0.0)) <= cutoff**2)


def keep_good(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents that pass; all their columns.

    Texts are measured again beside the estimates rather than shuffled to their verdicts.
    """
    found = estimate(common.durable(statistics(docs).where("not base_failed").select("grp", "wide", *FEATURES)))
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    seen = docs.select(row, _groups()[0], measured(docs["text"]).alias("m")).where("not m.base_failed")
    far = seen.join(found.select("grp", "mean", "root"), "grp", "left").select("row", "mean", "root", "m.*")
    return far.where(_kept(F.col("base_failed"), _distance(F.col("mean"), F.col("root")), cutoff)).select("row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
