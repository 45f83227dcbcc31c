"""Text patterns as Spark runs them: the same results as the plain ones, without trying a long class on every letter."""

import time

from pyspark.sql import functions as F

from staymill.functions import text as TX


def _plain_clean(c):
    out = F.lower(c)
    for pattern in (TX.URL, TX.MENTION, TX.NOT_KEPT):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, TX.BLANKS, " "))


def _plain_tokens(c):
    return F.filter(F.split(c, TX.BLANKS), lambda t: F.length(t) >= 1)


def test_same_as_the_plain_patterns(spark):
    texts = ["", " ", "\x85\xa0a　b", "@x http://y z", "ÁÉ ñ!!\t\t x\x1cy", "@httpx a", "日本語 " * 20_000, "a" + " " * 100_000 + "😀" * 50_000 + "b é", "http", "  @@a  ", "x\x0b\x0cy", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = rows.select(TX.clean_text(F.col("text")).alias("c"), TX.tokens(F.col("text")).alias("t")).collect()
    want = rows.select(_plain_clean(F.col("text")).alias("c"), _plain_tokens(F.col("text")).alias("t")).collect()
    assert got == want


def test_letters_are_passed_over_quickly(spark):
    rows = spark.range(400, numPartitions=4).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("palabras, letras y más "), 1000)).alias("text")).cache()
    rows.count()

    def seconds(c):
        begun = time.perf_counter()
        rows.agg(F.max(F.xxhash64(c))).collect()
        return time.perf_counter() - begun

    for c in (_plain_clean, TX.clean_text):
        rows.limit(40).agg(F.max(c(F.col("text")))).collect()  # warm
    assert min(seconds(TX.clean_text(F.col("text"))) for _ in range(3)) * 2 < min(seconds(_plain_clean(F.col("text"))) for _ in range(3))


def test_word_vectors_hold_no_vocabulary_on_the_driver(spark, monkeypatch):
    """Three topics: words of one topic end up nearer to each other; chunks of any size know every word; nothing is collected."""
    import numpy as np
    from pyspark.ml.feature import Word2Vec
    from pyspark.sql.classic.dataframe import DataFrame

    from staymill.operators import skipgram
    from staymill.operators import text as X

    def refuse(*_, **__):
        raise AssertionError("the vocabulary would come to the driver")

    rng = np.random.default_rng(5)
    rows = [([f"w{t}x{i}" for i in rng.integers(0, 12, 40)],) for t in rng.integers(0, 3, 1500)] + [([f"alone{i}"],) for i in range(50)] + [([],), (None,)]
    df = spark.createDataFrame(rows, "tokens array<string>")
    with monkeypatch.context() as m:
        m.setattr(Word2Vec, "_fit", refuse)
        m.setattr(DataFrame, "collect", refuse)
        m.setattr(DataFrame, "toPandas", refuse)
        plain = X.word_vectors(X.fit_word2vec(df, partitions=2))
        small = skipgram.fit(df, "tokens", 10, 1, 42, 3, chunk_words=150).table
        frequent = X.word_vectors(X.fit_word2vec(df, min_count=2, partitions=2))
    got = {r["token"]: np.array(r["vector"]) for r in plain.collect()}
    assert len(got) == 36 + 50 and all(len(v) == 10 and np.isfinite(v).all() for v in got.values())
    assert {r["token"] for r in small.collect()} == set(got)
    assert {r["token"] for r in frequent.collect()} == {t for t in got if t.startswith("w")}
    names = sorted(t for t in got if t.startswith("w"))
    vectors = np.array([got[t] for t in names])
    vectors -= vectors.mean(axis=0)  # what all words share after one pass
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    topic = np.array([t.split("x")[0] for t in names])
    alike, same = unit @ unit.T, topic[:, None] == topic
    assert alike[same].mean() > alike[~same].mean() + 0.5
