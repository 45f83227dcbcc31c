"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staymill.llm import catalog, decontaminate, jaccard, langid, linededup, lm, mixture, quality, sampling, topk, toxicity, wavelet

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ("h", "label", "score", "rejected", "rate", "copy", "shuffle_key", "node", "text_hash", "has_letter", "part", "cdf", "c0", "held_out")
LONG = " ".join(f"word{i % 997} tail{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The first line of this text\nand another line of words here", "en", "a", 1),
    (1, "The first line of this text\nand another line of words here", "en", "a", 1),
    (2, "The first line of this text\nand another line of words here", "en", None, 1),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (None, "Ein Text ohne Nummer und ohne Quelle", "de", None, 9),
    (5, "   \n\t \n", "de", "b", 5),
    (6, "12 + 34 = 46 !!!", None, "b", 5),
    (7, "x", "fr", "c", 1),
    (8, LONG, "en", "c", len(LONG)),
    (9, "Ünïcödé — “quotes” 　 é x", "fr", "c", 3),
    (10, "Der die das und ein Text auf Deutsch mit vielen Worten", "de", "a", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in EXTRA}).repartition(3).persist()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame([(1, "word1 tail1 word2 tail2"), (None, "Ein Text ohne"), (3, None), (4, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_samples_fill_their_bounds(spark):
    copies = [("rare", f"text {i % 5}") for i in range(5000)] + [("often", f"text {i}") for i in range(5000)]
    got = sampling.sample_by_class(spark.createDataFrame(copies, "label string, text string"), 10, 1000).collect()
    assert sorted(r.text for r in got if r.label == "rare") == [f"text {i}" for i in range(5)]
    assert sum(r.label == "often" for r in got) == 10 and {r.n for r in got} == {5000}

    texts = {f"l{k}": [f"{k:02d}{i:02d}" + "x" * size for i, size in enumerate([6] * 20 + [91, 500])] for k in range(20)}
    texts["large"] = ["y" * 500, "z" * 600]
    rows = [(label, t) for label, ts in texts.items() for t in ts]
    got = sampling.sample_by_class(spark.createDataFrame(rows, "label string, text string"), 50, 100).collect()
    for label, ts in texts.items():
        taken = {r.text for r in got if r.label == label}
        left = 100 - sum(map(len, taken))
        assert len(taken) == 1 if label == "large" else left >= 0 and all(len(t) > left for t in ts if t not in taken)


LABELS = "doc_id long, toxic int, quality int"


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [9.0, 9.0]), (7, [-2.0]), (8, []), (20, [0.5, -0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = [tuple(r) for r in topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 4096), (0, 2, 2, 4096), (0, 3, 20, 2048), (20, 1, 0, 2048), (20, 2, 1, 0), (20, 3, 2, 0)]
    assert topk.top_k(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 20 == 0).count() == 0


def test_language(docs, nothing):
    got = langid.identify(docs, F.lit(True), ["doc_id", "text", "score"], prefix="p_").collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert 0 <= r.p_score <= 1 and r.score == "clash"
        silent = not any(ch.isalpha() for ch in r.text or "")
        assert (r.p_lang_pred == "und") == silent and (not silent or r.p_rejected)
    assert langid.identify(nothing, F.lit(True), ["text"]).count() == 0
    unlearned = langid.identify(docs, F.lit(False), ["text"]).collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in unlearned} == {("und", 0.0, True)}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 0), (1, 0, 1), (10, 0, 1), (7, 0, 1), (None, 1, 0), (8, None, None), (3, 1, 1)]])
def test_toxicity_and_quality(spark, docs, nothing, labels):
    known = spark.createDataFrame(labels, LABELS)
    held = F.col("doc_id") % 2 == 5
    for df, n in ((docs, len(ROWS)), (nothing, 0)):
        got = toxicity.classify(df, known, F.coalesce(held, F.lit(False))).collect()
        assert len(got) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
        got = quality.rate(df, known.select("doc_id", F.col("quality").alias("grade")), F.coalesce(held, F.lit(False))).collect()
        assert len(got) == n and all(0 <= r.tail <= 1 and r.selected == (r.tail >= 0.5) for r in got)


def test_line_dedup(docs, nothing):
    got = linededup.dedup_lines(docs).collect()
    assert len(got) == len(ROWS) and linededup.dedup_lines(nothing).count() == 0
    assert {r.text for r in got if r.doc_id == 1} == {ROWS[0][1]} and [r.text for r in got if r.doc_id == 2] == [""]
    assert [(r.text, r.n_lines) for r in got if r.doc_id == 3] == [(None, 0)]
    assert [r.n_removed for r in got if r.doc_id is None] == [0]


def test_decontaminate(spark, docs, nothing, folder):
    tests = spark.read.parquet(f"{folder}/benchmark.parquet")
    index = decontaminate.build_index(docs)
    got = decontaminate.digest(decontaminate.match(index, tests, near=8)).collect()
    assert len(got) == len(ROWS)
    hits = {r.doc_id: (r.n_hit > 0, r.n_items) for r in got}
    assert hits[None] == (True, 0) and hits[8][0] and hits[8][1] == 1 and not hits[1][0] and not hits[3][0]
    assert decontaminate.match(index, tests.limit(0)).where("size(hit) > 0").count() == 0
    assert decontaminate.match(decontaminate.build_index(nothing), tests).count() == 0


def test_lm(docs, nothing):
    got = lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(ROWS) and all(r.n_known == r.n_tokens for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    unlearned = lm.score(docs, F.lit(True)).collect()
    assert all(r.score == 0 and r.train_tokens == 0 and r.n_known == 0 for r in unlearned)
    assert lm.score(nothing, F.lit(False)).count() == 0


def test_mixture(docs, nothing):
    rates = mixture.source_rates(docs)
    assert {r.source for r in rates.collect()} == {"a", "b", "c", None}
    got = mixture.replicate(docs, rates)
    assert set(got.columns) == set(docs.columns)
    assert mixture.replicate(docs, mixture.source_rates(docs, {"a": 1.0})).where("source is null or source <> 'a'").count() == 0
    assert mixture.replicate(nothing, mixture.source_rates(nothing)).count() == 0


def test_jaccard(docs, nothing):
    got = jaccard.similar_groups(docs).collect()
    assert len(got) == len(ROWS)
    assert {(r.doc_id, r.component_id) for r in got} >= {(1, 1), (2, 1), (3, 3), (4, 4), (8, 8), (None, None)}
    assert {r.doc_id: r.n_shingles for r in got if r.doc_id in (3, 4, 5, 7)} == {3: 0, 4: 0, 5: 0, 7: 1}
    assert jaccard.similar_groups(nothing).count() == 0


def test_token_shards(docs, nothing):
    got = wavelet.read_documents(wavelet.token_shards(docs, catalog.tokenizer_path(), shard_tokens=50)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and {r.n_tokens for r in got if r.doc_id in (3, 4)} == {1}
    assert wavelet.read_documents(wavelet.token_shards(nothing, catalog.tokenizer_path())).count() == 0


def test_stages(spark, docs, nothing, folder):
    for name, stage in corpus_pipeline.STAGES:
        for df in (docs, nothing):
            got = stage(spark, df, folder)
            rows = got.collect()
            if name != "token_ids":
                assert set(got.columns) == set(docs.columns if df is docs else nothing.columns), name
            if df is nothing:
                assert rows == []
            elif name == "language":
                assert {r.doc_id for r in rows} == {None, 1, 2, 7, 8, 9, 10}
            elif name == "near_duplicates":
                assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10]
            elif name == "benchmark_passages":
                assert sorted(r.doc_id for r in rows if r.doc_id is not None) == [1, 1, 2, 3, 4, 5, 6, 7, 9, 10] and None not in {r.doc_id for r in rows}
            elif name == "token_ids":
                assert len(rows) == len(ROWS)


def test_repeated_rows_without_id_beside_a_numbered_near_copy(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text + " end"), (None, text + " end"), (1, text), (None, "another text of its own that is here twice"), (None, "another text of its own that is here twice")]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, rows[3][1]), (1, text)]
