"""Corpus pipeline: language, near duplicates, benchmark passages, source mixture, token shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs
of the next one. All but the last keep the columns of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staymill.functions.session import materialise
from staymill.llm import catalog, decontaminate, jaccard, langid, mixture, wavelet
from staymill.llm.joins import if_few

SEGMENTS = 4  # of the index, some megabytes each, handed to Python at once


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts far from every known language go, and so do texts without letters."""
    found = langid.identify(docs, learnable=catalog.id_remainder(4) != 2, keep=docs.columns, prefix="_language_")
    return found.where(~F.col("_language_rejected")).select(docs.columns)


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of `docs` that `keys` does not name, by text_hash and, where it has one, doc_id.

    The keys are broadcast when they have been counted to be few, so that no text is shuffled; else they are joined."""
    keys = if_few(keys.withColumnsRenamed({c: f"_{c}" for c in keys.columns}), "keys")
    same = F.xxhash64("text") == F.col("_text_hash")
    if "_doc_id" in keys.columns:
        same &= F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    return docs.join(keys, same, "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest doc_id (then text hash). Texts without words stay."""
    groups = materialise(jaccard.similar_groups(docs, n=5, num=80, den=100), "groups").where("label is not null")
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_hash")
    first = groups.groupBy("label").agg(F.min(rank).alias("first"))
    gone = groups.join(first, "label").where(rank != F.col("first")).select("doc_id", "text_hash").distinct()
    # The same document on several rows: take its rows away as well and put one back.
    repeated = groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    left = gone.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"))
    named = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash"))
    again = materialise(repeated.join(left, named, "left_anti"), "again")
    kept = without(docs, gone.unionByName(again.select("doc_id", "text_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_text_hash"))
    once = docs.join(again.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash")), same, "left_semi")
    return kept.unionByName(once.dropDuplicates(["doc_id", "text"]))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    index = decontaminate.build_index(docs.select(F.xxhash64("text").alias("doc_id"), "text"))
    found = decontaminate.match(index, catalog.read(spark, sf_dir, "benchmark"), window=10)
    hit = found.where(F.size("hit") > 0).select(F.col("doc_id").alias("text_hash")).distinct()
    return without(docs, materialise(hit, "hit", batch_rows=SEGMENTS))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, so that all sources weigh alike, in a global random order."""
    return mixture.replicate(docs, mixture.source_rates(docs)).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each copy's token ids, read back from the shards."""
    return wavelet.read_documents(wavelet.token_shards(docs, catalog.tokenizer_path()))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("source_mixture", source_mixture),
    ("token_ids", token_ids),
]

#: Centroids and tokenizer ids cannot be said in SQL; tests/llm checks every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return materialise(stage(spark, docs, sf_dir), name)
