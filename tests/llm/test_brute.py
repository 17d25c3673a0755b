"""Operators against brute-force versions on small inputs."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, common, langid, neighbours, packing, quality, sharding, simhash, suffix

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    alphabet = ["alpha", "beta", "gamma", "delta", "pi", "rho", "été", "a", "b,"]
    base = [" ".join(rng.choice(alphabet, rng.integers(5, 300))) for _ in range(40)]
    for i in range(40):
        words = base[rng.integers(40)].split()
        words[rng.integers(len(words))] = "changed"
        base.append(" ".join(words) + ("\nsame line here\nsame line here" if i % 4 == 0 else ""))
    return base


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3, t, "en" if i % 2 else "fr", f"s{i % 3}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)


def test_fingerprints_and_components(docs, texts):
    import xxhash

    def brute(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fps = [brute(t) for t in texts]
    n = len(fps)
    i, j = np.nonzero(np.array([[bin(a ^ b).count("1") <= 3 for b in fps] for a in fps]))
    root = common.forest(i, j, n)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {k * 3: (f"{fps[k]:016x}", int(root[k]) * 3) for k in range(n)}


def test_near_cells_find_all_within_three():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 4), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    left, right = ({} for _ in range(2))
    for fp, kept in ((a, left), (b, right)):
        for row, cell in zip(*simhash.near_cells(fp)):
            kept.setdefault(row, set()).add(cell)
    assert all(left[k] & right[k] for k in range(300))


def test_big_cells_by_pieces(monkeypatch):
    rng = np.random.default_rng(17)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fp = base[rng.integers(0, 40, 1500)] ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    cell = np.zeros(1500, np.int64)
    want = common.forest(*simhash._linked(cell, fp, 3), 1500)
    monkeypatch.setattr(simhash, "_BIG", 100)
    assert (common.forest(*simhash._linked(cell, fp, 3), 1500) == want).all() and len(set(want)) < 400


def test_dense_cells():
    rng = np.random.default_rng(2)
    fp = np.uint64(2**40 - 1) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    cell = np.sort(rng.integers(0, 3, 900))
    i, j = simhash._linked(cell, fp, 3)
    assert (cell[i] == cell[j]).all() and len(np.unique(common.forest(i, j, 900))) == 3
    k, m = simhash._linked(np.zeros(900, np.int64), fp, 3)
    assert not common.forest(k, m, 900).any()


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(4)
    order = rng.permutation(200)
    edges = [(int(order[i]), int(order[i + 1])) for i in range(150)] + [(160 + 1000, 1000 + i) for i in range(160, 190)] + [(5, 5), (None, 5000)]
    found = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    chain = order[:151]
    assert all(found.get(int(x), int(x)) == chain.min() for x in chain) and all(found[x] == 1160 for x in range(1161, 1190))
    assert 5000 not in found


@pytest.mark.parametrize("few", [0, 25, common._FEW])
def test_components_by_rounds_and_in_one_task(spark, monkeypatch, few):
    monkeypatch.setattr(common, "_FEW", few)
    edges = [(i, i + 1) for i in range(-9, 30)] + [(100 + i, 140 - i) for i in range(15)] + [(1 << 62, 200), (201, 200), (7, 7), (None, 3), (3, None)]
    found = sorted((r.node, r.root) for r in common.components(spark.createDataFrame(edges * 2, "u long, v long")).collect())
    want = [(i, -9) for i in range(-8, 31)] + [(140 - i, 100 + i) for i in range(15)] + [(201, 200), (1 << 62, 200)]
    assert found == sorted(want)
    assert common.components(spark.createDataFrame([(4, 4), (None, 1)], "u long, v long")).count() == 0


def test_a_small_graph_is_few_jobs(spark):
    """What the driver keeps of jobs, tasks and plans is what it runs out of; each round is several jobs."""
    edges = common.durable(spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long"))
    spark.sparkContext.setJobGroup("small graph", "")
    found = common.components(edges)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("small graph")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6 and found.count() == 300


def test_base_statistics(docs, texts):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r in quality.judge(docs).collect():
        t = texts[r.doc_id // 3]
        w = word.findall(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if word.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)


def _mcd(groups):
    """The estimates of all groups {name: (wide, integer features)} by plain loops over rows."""
    k, floor = len(quality.FEATURES), np.diag(np.array(quality.LEAST_SPREAD) ** 2)
    values = {g: x / quality.UNIT for g, (_, x) in groups.items()}

    def drawn(a, b):
        n, m, c = a
        mean = (n * m + quality.PRIOR * b[1]) / (n + quality.PRIOR)
        spread = n * (c + np.outer(m - mean, m - mean)) + quality.PRIOR * (b[2] + np.outer(b[1] - mean, b[1] - mean))
        return n, mean, spread / (n + quality.PRIOR)

    def moments(x):
        return len(x), x.mean(0), np.cov(x.T, bias=True)

    def pooled(kept):
        out = {}
        for g, x in kept.items():
            _, m, c = drawn(moments(x), moments(np.concatenate([y for h, y in kept.items() if groups[h][0] == groups[g][0]])))
            out[g] = (m, c / quality.NARROWED + floor)
        return out

    def far(x, m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    def step(found):
        kept = {}
        for g, x in values.items():
            bins = np.floor(np.log2(far(x, *found[g]) + 1e-6) * 16)
            kept[g] = x[[(bins < b).sum() < quality.SUPPORT * len(x) for b in bins]]
        return pooled(kept)

    def at(v, share):
        return np.sort(v)[int(np.ceil(share * len(v))) - 1]

    tries = [{}, {}, {}]
    for g, x in values.items():
        coarse = (np.floor(x * 16) + 0.5) / 16
        centre, low, high = (np.array([at(coarse[:, i], q) for i in range(k)]) for q in (0.5, 0.25, 0.75))
        spread = np.array([1.4826 * at(np.abs(coarse[:, i] - centre[i]), 0.5) for i in range(k)])
        tries[0][g], tries[1][g] = (centre, np.diag(spread**2) + floor), (centre, floor)
        tries[2][g] = ((low + high) / 2, np.diag(((high - low) / 1.349) ** 2) + floor)
    for _ in range(quality.FIRST_STEPS):
        tries = [step(s) for s in tries]
    found = {g: min((s[g] for s in tries), key=lambda e: np.linalg.slogdet(e[1])[1]) for g in groups}
    for _ in range(quality.STEPS):
        found = step(found)
    return {g: far(values[g], *found[g]) for g in groups}


def test_estimates_are_the_least_determinants(spark):
    rng = np.random.default_rng(12)
    k, groups, clean = len(quality.FEATURES), {}, {}
    for g, (wide, n, share) in {"a": ("x", 400, 0.2), "b": ("x", 500, 0.35), "c": ("y", 300, 0.0), "d": ("y", 15, 0.2)}.items():
        x = np.arange(k) + rng.standard_normal((n, k)) @ (0.3 * rng.standard_normal((k, k)))
        out = rng.random(n) < share
        x[out] += 9 * rng.choice([-1, 1], k)
        groups[g], clean[g] = (wide, np.round(x * quality.UNIT).astype(int)), ~out
    rows = [(g, wide, i, *map(int, r)) for g, (wide, x) in groups.items() for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "grp string, wide string, i int, " + ", ".join(f"{f} long" for f in quality.FEATURES)).repartition(5)
    found = quality.estimate(df)
    far = df.join(found, "grp").select("grp", "i", quality._distance(F.col("mean"), F.col("root")).alias("d")).collect()
    want = _mcd(groups)
    for r in far:
        assert abs(r.d - want[r.grp][r.i]) <= 1e-6 * max(1, r.d)
    out = np.array([r.d > quality.CUTOFF**2 for r in far])
    of = np.array([clean[r.grp][r.i] for r in far])
    assert out[~of].all() and not out[of].any()


def test_narrowed_is_what_a_normal_share_has():
    x = np.random.default_rng(13).standard_normal((200_000, len(quality.FEATURES)))
    d = (x**2).sum(1)
    assert abs(x[d <= np.quantile(d, quality.SUPPORT)].var() - quality.NARROWED) < 0.01


def test_verdicts_come_from_the_estimates(docs):
    """Distances of judge() by plain algebra, and the cutoff on them."""
    rows = quality.judge(docs, 1.5).collect()
    sound = [r for r in rows if not r.base_failed]
    groups = {}
    for r in sound:
        groups.setdefault((r.lang, r.source), []).append(r)
    want = _mcd({g: (g[0], np.array([[r[f] for f in quality.FEATURES] for r in own])) for g, own in groups.items()})
    for g, own in groups.items():
        for r, d in zip(own, want[g]):
            assert abs(r.distance - d) < 1e-6 and r.kept == (d <= 1.5**2)
    assert {r.kept for r in sound} == {True, False}


def test_repeats_by_numbers_as_by_tuples(monkeypatch):
    rng = np.random.default_rng(5)
    words = [b"%d" % x for x in rng.integers(0, 12, 3000)]
    want = quality.repeated_words(words)
    monkeypatch.setattr(quality, "_WIDE", 10)
    assert quality.repeated_words(words) == want > 0


@pytest.mark.parametrize("least", [100, 40])
def test_suffix_array(docs, texts, least):
    seen, want = set(), {}
    for i, t in enumerate(texts):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - least + 1):
            if b[p : p + least] in seen:
                gone[p : p + least] = True
            seen.add(b[p : p + least])
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want[i * 3] = (len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in suffix.removal_digests(docs, least).collect()}
    assert got == want


def test_languages_by_plain_counts(spark):
    """Every language, word and n-gram counts, those met once too; scores by dictionaries of counts."""
    rng = np.random.default_rng(14)
    letters = ["abcdefgh", "efghijkl", "ijklmnopé", "mnopqrst"]
    rows = []
    for i in range(240):
        own = letters[i % 4]
        words = ["".join(rng.choice(list(own), rng.integers(1, 9))) for _ in range(rng.integers(1, 30))]
        rows.append((i, " ".join(words).title() + ", 12!", f"l{i % 4}" if i % 7 else None))
    learned = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 4 != 2 and lang]
    langs = sorted({lang for _, lang in learned})
    tables = [{} for _ in range(6)]
    for t, lang in learned:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            for n in range(6):
                for g in [w] if n == 0 else langid.grams(w, n):
                    tables[n].setdefault(g, Counter())[lang] += 1
    totals = [{x: sum(c[x] for c in t.values()) + 0.5 * len(t) for x in langs} for t in tables]

    def logs(n, g):
        return np.array([np.log((tables[n][g][x] + 0.5) / totals[n][x]) for x in langs])

    def score(w):
        if w in tables[0]:
            return logs(0, w)
        for n in range(5, 0, -1):
            if known := [logs(n, g) for g in langid.grams(w, n) if g in tables[n]]:
                return np.mean(known, axis=0)
        return np.zeros(len(langs))

    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for r in langid.predict(docs, langid.fit(docs)).collect():
        words = re.findall(r"[^\W\d_]+", rows[r.doc_id][1].lower())
        total = sum(score(w) for w in words)
        best = int(total.argmax())
        assert r.lang_pred == langs[best] and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert abs(r.score - 1 / np.exp((total - total[best]) / len(words) ** 0.5).sum()) < 1e-4


def test_the_sample_is_bounded_in_bytes_not_in_languages(spark):
    docs = spark.createDataFrame([(i, f"word{chr(97 + i % 26)} " * 50, f"l{i % 400}") for i in range(4000)], "doc_id long, text string, lang string")
    model = langid.fit(docs, all_bytes=400 * 1000)
    assert len(model.languages) == 400 and len(model.tables[0].keys) <= 26


def test_shards_and_the_next_version(spark, tmp_path):
    """Sizes near equal, places gapless; a run over more rows edits the stored map and moves few slots."""
    rng = np.random.default_rng(15)
    rows = [(int(i), "x" * int(n)) for i, n in enumerate(rng.pareto(1.6, 4000) * 60)] + [(None, "copy")] * 700 + [(5, "other")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    path = str(tmp_path / "maps")
    versions = []
    for some in (docs.where("doc_id is null or doc_id < 3000"), docs):
        placed, (last, new) = sharding.shard(some, path, 8, 512)
        got, want = placed.collect(), some.collect()
        assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in got) == sorted((r.doc_id or -1, len(r.text) + 1, zlib.crc32(r.text.encode())) for r in want)
        for s in range(8):
            assert sorted(r.place for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        assert all(new.shard[r.virtual] == r.shard for r in got)
        total = Counter()
        for r in got:
            total[r.shard] += r.size
        assert max(total.values()) - min(total.values()) <= 0.01 * sum(total.values()) / 8
        versions += [last, new]
    assert versions[1] == versions[2] and [m.version for m in versions] == [0, 1, 1, 2]
    assert sum(a != b for a, b in zip(versions[1].shard, versions[3].shard)) < 120
    assert [sharding.load(spark, path, v).shard for v in (0, 1, 2)] == [versions[i].shard for i in (0, 1, 3)]


def test_prefix_intervals():
    words = sorted(["banana", "anana", "nana", "ana", "na", "a", "band", "bandana"])
    lcp = [suffix._shared(a.encode(), b.encode()) for a, b in zip(words, words[1:])]
    for n, first, last in suffix.prefix_intervals(lcp):
        assert len({w[:n] for w in words[first : last + 1]}) == 1 and min(lcp[first:last]) == n


def test_bpe_is_the_librarys(texts):
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(PATH), bpe.encoder(PATH)
    for t in [*texts, "", "I'LL ΑΣ İſ <|endoftext|>x", "a\x1cb \x85c　d", "日本 \U0001f600‍", "é Å", "y" * 999]:
        ids = whole.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == ids and own.decode(ids) == whole.decode(ids, skip_special_tokens=False)
        assert packing.token_bytes(PATH, 2)(t) == np.array([*ids, 2], "<u4").tobytes()


def test_code_points_newer_than_pythons():
    from tokenizers import Tokenizer

    whole, own = Tokenizer.from_file(PATH), bpe.Encoder(PATH)
    points = [c for c in range(0x80, 0x110000, 7) if not 0xD800 <= c < 0xE000] + [0x208F, 0x209D, 0x1C89, 0x1C8A, 0xA7CB, 0x10D50, 0x323B0, 0x105C0]
    texts = [f"a{chr(c)}1{chr(c)}{chr(c)}x" for c in points]
    for text, found in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text) == found.ids, ascii(text)


def test_what_is_remembered_is_bounded_in_bytes(monkeypatch):
    own = bpe.Encoder(PATH)
    memo = bpe.Memo(own.chunk_ids, 50_000)
    monkeypatch.setattr(bpe, "WORD_BYTES", 50_000)
    for i in range(3000):
        chunk = f"{i:x}" * (1 + i % 60)
        assert memo[chunk] == bpe.Encoder.chunk_ids(own, chunk)
        memo.trim()
        assert memo.held <= 60_000 and own.held <= 60_000 and all(len(c) <= bpe.LONGEST for c in [*memo, *own.known])


def test_levels_are_those_of_the_least_sum_of_squares():
    rng = np.random.default_rng(16)
    packer = packing.Packer(32)
    counts = np.zeros(33, int)
    for n in rng.integers(1, 32, 3000).tolist():
        def after(level):
            c = counts.copy()
            c[level] -= level > 0
            if level + n < 32:
                c[level + n] += 1
            return int((c**2).sum())

        can = [0, *(x for x in range(1, 32 - n + 1) if counts[x])]
        level = packer.level_for(n)
        assert level in can and after(level) == min(map(after, can))
        packer.add(0, bytes(4 * n))
        counts[level] -= level > 0
        if level + n < 32:
            counts[level + n] += 1
        assert (packer.count[1:32] == counts[1:32]).all()


def test_packing(docs, texts):
    own = bpe.encoder(PATH)
    ids = {i * 3: [*own.encode(t), 2] for i, t in enumerate(texts)}
    rows = packing.pack(docs, PATH, 64).collect()
    got, sequences = {}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        got.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, own_ids in ids.items():
        at = 0
        for start, n in sorted(got[doc]):
            assert start == at
            at += n
        assert at == len(own_ids)
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64 and at & (at - 1) == 0  # full or a power of two: no padding


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((700, 24))
    x[100:160] = x[100] + 0.05 * rng.standard_normal((60, 24))
    x[200:230] = x[230:260] + 0.1 * rng.standard_normal((30, 24))
    x[300:310] = x[300]
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = y @ y.T >= 0.9
    np.fill_diagonal(links, False)
    root = common.forest(*np.nonzero(links), 700)
    rows = neighbours.link(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    assert got == {i: (int(links[i].sum()), int(root[i])) for i in range(700)}
