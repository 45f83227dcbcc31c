"""Bounded, repeatable samples of labelled texts for fitting classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise
from staymill.llm.joins import if_few

BROADCAST_CLASSES = 100_000


def _take(pdf: pd.DataFrame, rows: int, size: int) -> pd.DataFrame:
    """Rows in the order of their hash, each if it fits what is left of both bounds; a single row always."""
    pdf = pdf.sort_values("h", ignore_index=True)
    kept, left = [], size
    for i, b in enumerate(pdf["bytes"].tolist()):
        if len(kept) < rows and (b <= left or len(pdf) == 1):
            kept.append(i)
            left -= b
    return pdf.loc[kept, ["label", "h", "n"]]


def sample_by_class(rows: DataFrame, rows_per_class: int, bytes_per_class: int, labels: DataFrame | None = None) -> DataFrame:
    """(label, text, n): distinct texts of each label in the order of a hash, each that still fits both bounds.

    `rows` has (label, text), or (doc_id, text) with `labels` (doc_id, label) beside it: these are joined to hashes and
    sizes, never to texts, and the few chosen texts are fetched by a second scan.
    `n` is the number of all rows of the label. Labels and texts must not be null. Copies of a text count once. A text
    larger than the byte bound is taken only if its label has no smaller one, and then alone. Texts that do not fit what
    is left of the bytes are passed by. Only the hashes below a label's share, found by a count of its distinct texts that
    fit, are looked at: three times as many as are wanted, or all there are."""
    keyed = rows.withColumns({"h": F.xxhash64("text"), "bytes": F.octet_length("text")}).drop("text")
    if labels is not None:
        keyed = keyed.join(labels, "doc_id")
    distinct = keyed.groupBy("label", "h").agg(F.count(F.lit(1)).alias("copies"), F.min("bytes").alias("bytes"))
    distinct = materialise(distinct, "distinct")
    fits = F.col("bytes") <= bytes_per_class
    counts = distinct.groupBy("label").agg(F.sum("copies").alias("n"), F.count_if(fits).alias("fitting"), F.min("h").alias("first"))
    counts = if_few(counts, "classes", BROADCAST_CLASSES)
    share = F.shiftrightunsigned("h", 33) / F.lit(float(1 << 31))
    near = fits & (share * F.col("fitting") < 3 * rows_per_class) | (F.col("fitting") == 0) & (F.col("h") == F.col("first"))
    near = distinct.join(counts, "label").where(near).select("label", "h", "bytes", "n")
    kind = keyed.schema["label"].dataType.simpleString()
    chosen = near.groupBy("label").applyInPandas(lambda pdf: _take(pdf, rows_per_class, bytes_per_class), f"label {kind}, h long, n long")
    chosen = if_few(chosen, "chosen")
    texts = rows.select("text", F.xxhash64("text").alias("h"))
    return texts.join(chosen, "h").dropDuplicates(["label", "h"]).select("label", "text", "n")
