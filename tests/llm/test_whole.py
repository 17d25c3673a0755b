"""What a shortcut would lose: each of these fails where an operator does less than its whole job."""

import numpy as np
import pytest

from tidemark.llm import chunks, common, neighbours, simhash, suffix


def _near(docs):
    """doc_ids that go by brute force: the smallest of each group linked at 0.8 stays."""
    sets = {i: simhash.shingle_set(t.encode(), 5) for i, t in docs}
    ids = sorted(sets)
    i, j = [], []
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            n = len(x & y)
            if n and n >= 0.8 * (len(x) + len(y) - n):
                i.append(a)
                j.append(b)
    root = common.forest(np.array(i, int), np.array(j, int), len(ids))
    return {ids[k] for k in np.flatnonzero(root != np.arange(len(ids)))}


def _removed(spark, docs):
    rows = spark.createDataFrame([(i, t, "en", "a") for i, t in docs], "doc_id long, text string, lang string, source string").repartition(5)
    return {i for i, _ in docs} - {r.doc_id for r in simhash.drop_near_copies(rows).collect()}


def _edited(words, places, mark):
    words = list(words)
    for k in places:
        words[k] = f"{mark}{k}"
    return words


def test_lone_pairs_at_the_threshold(spark):
    docs = []
    for k in range(120):
        words = [f"w{k}x{n}" for n in range(304)]
        docs.append((2 * k, " ".join(words)))
        docs.append((2 * k + 1, " ".join(_edited(words, range(10, 300, 300 // (5 + k % 3)), "new"))))  # 0.79 to 0.85
    gone = _near(docs)
    assert 40 < len(gone) <= 120
    assert _removed(spark, docs) == gone


def test_texts_move_only_for_pairs_that_may_be_copies(spark, monkeypatch):
    """Long texts of like sizes that share a sentence with each other by chance; some have a copy above 0.8."""
    docs = []
    for k in range(40):
        words = [f"w{k}x{n}" for n in range(1600 + 5 * k)]
        for other in range(max(0, k - 5), min(40, k + 6)):
            low, high = sorted((k, other))
            if low < high:
                at = 100 + 40 * (other - k + 5)
                words[at : at + 30] = [f"s{low}x{high}x{n}" for n in range(30)]
        docs.append((2 * k, " ".join(words)))
        if k % 8 == 0:
            docs.append((2 * k + 1, " ".join(_edited(words, range(700, 1500, 25 + k // 8), "new"))))
    monkeypatch.setattr(simhash, "_SAMPLE", 4)  # few of the shared shingles are known as common
    moved, similar = [], simhash.similar
    monkeypatch.setattr(simhash, "similar", lambda pairs, *rest: (moved.append(pairs.count()), similar(pairs, *rest))[1])
    gone = _near(docs)
    assert _removed(spark, docs) == gone and len(gone) == 5
    assert sum(moved) <= 2 * len(gone)


@pytest.mark.parametrize("n", [1, 40, 700, 5000])
def test_bounds_of_similar_sets_hold(n):
    """Sets at 0.8 and above share as many first shingles as the bound says, and differ in no more bits than it says."""
    rng = np.random.default_rng(n)
    for _ in range(40):
        own = rng.integers(-(1 << 62), 1 << 62, 2 * n)
        more, less = rng.integers(0, n // 5 + 1, 2)
        a, b = np.unique(own[:n]), np.unique(own[less : n + more])
        shared = len(np.intersect1d(a, b))
        if shared < 0.8 * (len(a) + len(b) - shared):
            continue
        first = [x[: len(x) - int(simhash._whole(len(x), 0.8)) + 1] for x in (a, b)]
        assert len(np.intersect1d(*first)) >= simhash._least(len(a), len(b), 0.8)
        x, y = (simhash._wide(h) or simhash._bitmap(h) for h in (a, b))
        assert simhash._differ(x, y) <= len(a) + len(b) - 2 * shared


@pytest.mark.parametrize("block", [2048, 16])
def test_pairs_inside_families_under_the_threshold(spark, monkeypatch, block):
    """Texts on one template, 0.76 among each other; each has one copy above 0.8 that no nearer text may hide."""
    monkeypatch.setattr(simhash, "_ROWS", block)
    rng = np.random.default_rng(8)
    base = [f"t{n}" for n in range(300)]
    docs = []
    for k in range(100):
        own = _edited(base, range(0, 8), f"own{k}_")
        for half in (0, 1):
            at = 25 + 5 * int(rng.integers(0, 50))
            docs.append((2 * k + half, " ".join(_edited(own, range(at, at + 10), f"half{k}_{half}_"))))
    gone = _near(docs)
    assert gone and _removed(spark, docs) == gone


def test_texts_that_share_a_doc_id(spark):
    """Only the near copy goes, not the other text under its id."""
    words = [f"w{n}" for n in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(_edited(words, [50], "new"))), (2, " ".join(f"other{n}" for n in range(100)))]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    assert {r.text for r in simhash.drop_near_copies(docs).collect()} == {rows[0][1], rows[2][1]}


def test_the_audit_sees_lone_pairs_beside_a_dense_group(spark):
    rng = np.random.default_rng(4)
    dense = np.ones(32) + 0.01 * rng.standard_normal((300, 32))
    lone = np.repeat(rng.standard_normal((60, 32)), 2, axis=0) + 0.01 * rng.standard_normal((120, 32))
    rows = [(k, bytearray(v.tobytes()), 1) for k, v in enumerate(np.r_[dense, lone])]
    nodes = spark.createDataFrame(rows, "node long, v binary, copies long")
    linked = spark.createDataFrame([(k, 299) for k in range(300)], "node long, n long")
    assert neighbours.audit(nodes, linked, 32, 0.9) < 0.5
    whole = linked.union(spark.createDataFrame([(k, 1) for k in range(300, 420)], "node long, n long"))
    assert neighbours.audit(nodes, whole, 32, 0.9) == 1


def test_trees_grow_with_the_planes():
    for bits in (0, 8, 13, 18):
        assert 1 - (1 - (1 - np.arccos(0.9) / np.pi) ** bits) ** neighbours.trees_for(bits, 0.9) >= 0.99


def test_all_pairs_are_compared_when_the_audit_never_holds(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "audit", lambda *a: 0.0)
    monkeypatch.setattr(neighbours, "leaves", lambda nodes, *a: nodes.selectExpr("node", "node nbr", "cast(0 as float) sim").where("false"))
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    got = neighbours.link(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def _under_one_id(spark):
    """(1, A), (2, A), (2, B), (3, A + B): only what stands earlier goes, whatever the ids."""
    rng = np.random.default_rng(6)
    a, b = (" ".join(f"{w}{rng.integers(10**6)}" for w in ("alpha beta gamma delta " * 15).split()) for _ in range(2))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, a + " " + b), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return a, b, docs.repartition(3)


def test_repeats_under_one_doc_id(spark):
    a, b, docs = _under_one_id(spark)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix.removal_digests(docs).collect())
    both = len(a) + 1 + len(b)
    assert got == sorted([(0, len(a), 0), (1, len(a), 0), (2, len(a), len(a)), (2, len(b), 0), (2, len(b), 0), (3, both, both - 1)])
    assert sorted(r.text for r in suffix.remove_repeats(docs).where("doc_id = 2").collect()) == sorted(["", b, b])


def test_chunks_under_one_doc_id(spark):
    a, b, docs = _under_one_id(spark)
    of = {(r.doc_id, r.n_bytes): r.n_removed for r in chunks.removal(docs).where("doc_id < 3").collect()}
    assert of[1, len(a)] == of[2, len(b)] == 0 and of[2, len(a)] == len(a)


@pytest.mark.parametrize("hot", [1, 3, 10**6])
def test_grams_split_by_their_surroundings(spark, monkeypatch, hot):
    """A line in every text: whether its grams are hot or not, the same bytes go."""
    import hashlib

    monkeypatch.setattr(suffix, "HOT", hot)
    rng = np.random.default_rng(7)
    line = "this very line of seventy letters or more stands in each of the documents here"
    texts = []
    for k in range(60):
        own = " ".join(f"w{rng.integers(10**7)}" for _ in range(60))
        cut = int(rng.integers(0, 400))
        texts.append(own[:cut] + line + (line[::-1] + texts[k // 2][-80:] if k % 3 else "") + own[cut:])
    seen, want = set(), {}
    for i, t in enumerate(texts):
        x = t.encode()
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - 99):
            if x[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(x[p : p + 100])
        want[i] = (int(gone.sum()), hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix.removal_digests(docs).collect()} == want
    found = suffix.repeat_groups(docs).collect()
    of = {}
    for r in found:
        of.setdefault((r.grp, r.length), []).append((r.doc_id, r.start))
    assert of and all(len(places) > 1 for places in of.values())
    for (_, n), places in of.items():
        assert len({texts[d][s : s + n] for d, s in places}) == 1 and n >= 100
        string = texts[places[0][0]][places[0][1] : places[0][1] + n]
        every = {(d, s) for d, t in enumerate(texts) for s in range(len(t)) if t.startswith(string, s)}
        assert set(places) == every


@pytest.mark.parametrize("small", [True, False])
def test_dense_groups_in_tiles_and_crowded_leaves(spark, monkeypatch, small):
    """A third of all vectors in one group, whatever the sizes of blocks, tiles and leaves."""
    if small:
        for name, value in (("BLOCK", 8), ("LARGE_BLOCK", 64), ("BLOCKS", 3), ("TILE", 7), ("CROWDED", 40)):
            monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(31)
    x = rng.standard_normal((600, 16))
    x[:200] = x[0] + 0.12 * rng.standard_normal((200, 16))
    x[300:330] = x[330:360] + 0.05 * rng.standard_normal((30, 16))
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = y @ y.T >= 0.9
    np.fill_diagonal(links, False)
    root = common.forest(*np.nonzero(links), 600)
    rows = neighbours.link(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in rows} == {i: (int(links[i].sum()), int(root[i])) for i in range(600)}
