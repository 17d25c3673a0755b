"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chunks, html_text, langid, neighbours, packing, quality, sharding, simhash, suffix

PATH = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the house of my old friend stands near a river and we walk there every day in summer with dogs".split()


def prose(seed, n=80):
    rng = np.random.default_rng(seed)
    return " ".join(f"{rng.choice(WORDS)}{rng.integers(10**6)}" if i % 3 else str(rng.choice(WORDS)) for i in range(n)) + "."


ROWS = [
    (1, prose(1), "en", "a", 5),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \n\t ", "de", "b", 4),
    (5, prose(1), "en", "a", 5),
    (5, prose(1), "en", "a", 5),
    (None, prose(6), None, "a", 5),
    (7, "x" * 200_000, "en", "a", 5),
    (8, "word " * 60_000, "en", "a", 5),
    (9, "İstanbul café \U0001f600 <|endoftext|> " + prose(9), "fr", "b", 5),
    (10, prose(10) + " " + prose(1, 40), "en", "b", 5),
    (-3, "1234 !!!", "en", "b", 5),
]
EXTRA = ["spans", "row_key", "_row", "node", "f0", "body", "virtual", "kept", "size", "_id", "key"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("*", *(F.lit("clash").alias(c) for c in EXTRA)).repartition(3, "text").persist()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def by_id(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))


def test_simhash(docs, none):
    rows = by_id(simhash.simhash_components(docs))
    assert len(rows) == len(ROWS) and not simhash.simhash_components(none).collect()
    of = {r["doc_id"]: r for r in rows}
    assert of[5]["component_id"] == 1 and of[1]["fingerprint"] == of[5]["fingerprint"]
    assert {of[i]["fingerprint"] for i in (2, 3, 4)} == {"0" * 16} and {of[i]["component_id"] for i in (2, 3, 4)} == {2}


def test_quality(docs, none):
    rows = by_id(quality.judge(docs))
    assert len(rows) == len(ROWS) and not quality.judge(none).collect()
    of = {r["doc_id"]: r for r in rows}
    assert of[2]["n_words"] == 0 and of[2]["base_failed"] and not of[2]["kept"]
    assert of[8]["n_repeat_words"] == of[8]["n_words"] == 60_000 and of[8]["base_failed"]
    assert of[7]["n_words"] == 1 and not of[1]["base_failed"]


def test_sharding(docs, none):
    placed, maps = sharding.shard(docs, None, 3, 64)
    rows = by_id(placed)
    assert len(rows) == len(ROWS) and [m.version for m in maps] == [0, 1]
    for s in range(3):
        places = sorted(r["place"] for r in rows if r["shard"] == s)
        assert places == list(range(len(places)))
    of = {r["doc_id"]: r for r in rows}
    assert (of[2]["size"], of[2]["text_crc32"]) == (1, 0) and of[1]["text_crc32"] == zlib.crc32(ROWS[0][1].encode())
    assert not sharding.shard(none, None, 3, 64)[0].collect()


def test_slot_map(spark, tmp_path):
    rng = np.random.default_rng(0)
    sizes = {s: int(x) for s, x in enumerate(rng.pareto(1.5, 512) * 1000 + 1)}
    m = sharding.SlotMap.even(512, 8).rebalanced(sizes)
    total = np.bincount(m.shard, [sizes[s] for s in range(512)])
    assert total.max() - total.min() <= max(2, 0.001 * total.mean()) or total.max() == max(sizes.values())
    g = m.grown(sizes)
    assert all(a == b or b == 8 for a, b in zip(m.shard, g.shard)) and g.version == m.version + 1
    assert sharding.load(spark, str(tmp_path / "maps")) is None
    for x in (m, g):
        sharding.store(spark, x, str(tmp_path / "maps"))
    assert sharding.load(spark, str(tmp_path / "maps")) == g and sharding.load(spark, str(tmp_path / "maps"), m.version) == m


def test_language(docs, none):
    model = langid.fit(docs)
    rows = by_id(langid.predict(docs, model))
    assert len(rows) == len(ROWS)
    of = {r["doc_id"]: r for r in rows}
    assert {of[i]["lang_pred"] for i in (2, 3, 4, -3)} == {"und"} and of[1]["lang_pred"] == of[5]["lang_pred"]
    assert all(0 <= r["score"] <= 1 for r in rows) and of[1]["held_out"] == (zlib.crc32(b"1") % 4 == 2)
    empty = langid.fit(none)
    assert {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}


def test_chunks(docs, none):
    rows = by_id(chunks.removal(docs))
    assert len(rows) == len(ROWS) and not chunks.removal(none).collect()
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["n_removed"] == 0 and of[5]["n_removed"] == of[5]["n_bytes"] and of[2]["n_bytes"] == of[2]["n_chunks"] == 0
    assert of[10]["n_removed"] > 150


def test_suffix_array(docs, none):
    rows = by_id(suffix.removal_digests(docs))
    assert len(rows) == len(ROWS) and not suffix.removal_digests(none).collect()
    of = {r["doc_id"]: r for r in rows}
    assert of[1]["n_removed"] == 0 and of[5]["n_removed"] == of[5]["n_bytes"]
    assert of[7]["n_bytes"] - of[7]["n_removed"] == 1 and of[8]["n_bytes"] - of[8]["n_removed"] == 5
    assert of[None]["n_removed"] == 0


def test_bpe_and_packing(docs, none):
    assert not bpe.round_trip_digests(none, PATH).collect() and not packing.pack(none, PATH).collect()
    of = {r["doc_id"]: r for r in by_id(bpe.round_trip_digests(docs, PATH))}
    assert of[2]["n_tokens"] == of[3]["n_tokens"] == 0 and of[2]["ids_sha256"] == of[4]["ids_sha256"]
    rows = packing.pack(docs, PATH, with_ids=True).collect()
    assert sum(r.length for r in rows if r.doc_id == 8) == of[8]["n_tokens"] + 1
    assert sum(r.length for r in rows if r.doc_id == 2) == 1


def test_decode_gives_the_vocabulary_strings(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    encoded = bpe.encode(docs, PATH)
    want = {(r.doc_id, whole.decode(r.ids, skip_special_tokens=False)) for r in encoded.collect()}
    assert {(r.doc_id, r.text) for r in bpe.decode(encoded, PATH).collect()} == want


def test_html(spark):
    page = "<html><body class='has-menu'><nav>menu</nav><article><h1>A &amp; b</h1><p>Text,  here.<p>More<br>of it &#233;.<div class='ad'>buy</div><form>x</form></article><div id=comments><p>nice, very nice.</div><footer>f</footer></body></html>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "<script>1</script>"), (5, "u", "<p>" * 3000 + "deep, text."), (6, "u", "<" * 10000), (6, "u", page)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(1))
    of = {r.page_id: r for r in html_text.extract(pages).collect()}
    assert of[1].text == "A & b\n\nText, here.\n\nMore of it é." and of[1].n_chars == len(of[1].text)
    assert of[2].text == of[3].text == of[None].text == "" and of[5].text == "deep, text."
    assert not html_text.extract(pages.where("false")).collect()


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (11, [1.0, 0.1]), (11, [1.0, 0.1]), (None, [1.0, 0.0]), (13, [1e300, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash")).withColumn("v", F.lit(1))
    got = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in neighbours.link(vectors).collect())
    linked = {1: 5, 2: 5, 10: 5, 11: 5, 13: 5}
    assert got == sorted([(-1, 0, None, False), *((i, linked.get(i, 0), 1 if i in linked else i, i == 1 or i not in linked) for i, _ in rows if i is not None)])
    assert not neighbours.link(vectors.where("false")).collect()


def test_pipeline_stages(spark, docs, none):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert out.count() <= len(ROWS)
        assert stage(spark, none, "").count() == 0
    cut = {r.doc_id: r.text for r in suffix.remove_repeats(docs).collect()}
    assert cut[5] == "" and cut[2] is None and cut[1] == ROWS[0][1]
    kept = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert kept == {1, 2, 3, 4, None, 7, 8, 9, 10, -3}
