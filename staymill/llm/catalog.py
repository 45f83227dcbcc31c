"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymill.llm import collocations, decontaminate, html, langid, linededup, lm, merkle, mixture, quality, toxicity
from staymill.llm.jaccard import similar_groups
from staymill.llm.topk import top_k
from staymill.llm.wavelet import read_documents, token_shards

#: Folder-independent name of the tokenizer; its file is looked up where the vocabularies are installed.
TOKENIZER = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_remainder(modulus: int):
    """crc32 of doc_id as text; a missing id counts as ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


@_register(
    "op1_topk",
    """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, 1 + len(q.e))]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
)
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=20, scale=64, every_row=True)


@_register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), held_out=id_remainder(5) == 0)


@_register("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: 0 poor, 1 good but toxic, 2 good; a document is selected from grade 1 on."""
    grade = F.when(F.col("quality") == 0, 0).otherwise(2 - F.coalesce("toxic", F.lit(0)))
    ratings = read(spark, sf_dir, "labels").where("quality is not null").select("doc_id", grade.alias("grade"))
    return quality.rate(read(spark, sf_dir, "documents"), ratings, held_out=id_remainder(5) == 0, at_least=1)


@_register("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", id_remainder(4) == 2)
    found = langid.identify(docs, learnable=~F.col("held_out"), keep=["doc_id", "held_out", "text"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@_register("op5_line_dedup", linededup.SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(read(spark, sf_dir, "documents"))


@_register("op8_mixture", mixture.SQL)
def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    mixed = mixture.replicate(docs, mixture.source_rates(docs))
    return mixed.select("doc_id", "source", "text", F.round("rate", 9).alias("rate"), "copy", "shuffle_key")


@_register(
    "op6_decontaminate",
    r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, fold),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, fold),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, 2 + greatest(len(w) - 10, 0))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
grams AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM places),
found AS (SELECT row, i, g.n, item_id FROM grams g JOIN windows USING (n, phrase)),
marked AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
named AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (row) LEFT JOIN named USING (row)
""",
)
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(read(spark, sf_dir, "documents"))
    found = decontaminate.match(index, read(spark, sf_dir, "benchmark"), window=10)
    return decontaminate.digest(found).drop("n_near_items", "near_items_sha256")


@_register("op6_decontaminate_near")
def op6_decontaminate_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6_decontaminate, and the items of which a window's words stand within 16 words in any order."""
    index = decontaminate.build_index(read(spark, sf_dir, "documents"))
    return decontaminate.digest(decontaminate.match(index, read(spark, sf_dir, "benchmark"), window=10, near=16))


@_register("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"), held_out=id_remainder(5) == 1)


@_register("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(read(spark, sf_dir, "documents"), n=4, num=85, den=100).select("doc_id", "n_shingles", "component_id")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_register("op10_token_ids")
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(token_shards(read(spark, sf_dir, "documents"), tokenizer_path()))


@_register("op11_collocations", collocations.SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(spark, sf_dir, "documents"), max_words=3, min_count=10, keep_share=50, top=2000)


@_register("op12_html_extract")
def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


@_register("op13_merkle_manifest", merkle.SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a leaf, 16 to a node; texts whose id's checksum 5 divides are tampered with by lower-casing A-Z."""
    docs = read(spark, sf_dir, "documents")
    changed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    tampered = F.when(changed, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    return merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], group="source", order="doc_id", tampered={"text": tampered})
