"""Mixing sources to target weights by Poisson replication.

A source with share `weight` of an output of `total` documents repeats each of its n documents weight * total / n times
on average. The number of copies of a document is a Poisson variable with that mean, found by inverting the
distribution at a number in [0, 1) seeded by the document's id: copies = how many values of the distribution function
do not exceed it. Each document is exploded by its count and the copies are put in a global random order.

Scale: documents never meet by source; the table of one row per source is joined to them, broadcast when its rows have
been counted to be few. The only shuffle of texts is the global one, on a key hashed from id and copy, so it is even.

Defined cases: a null source is a source of its own; a document without id counts as id 0; rows with equal ids get equal
counts; empty and null texts are documents like others; sources without a target get none when targets are given,
and an equal share when they are not. All columns are kept, and the three added here replace columns of the same name."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.functions.hashing import mix, mix_sql
from staymill.functions.session import materialise

SEED = 8
BROADCAST_SOURCES = 100_000
_STEPS = 2147483647.0


def _distribution(rate: Column) -> Column:
    """Values of the Poisson distribution function at 0, 1, ... as far as they can be told from 1."""
    reach = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    # log p(k) = k log(rate) - rate - log(k!), summed from k = 0 on; a rate of 0 gives the single value 1.
    def step(acc: Column, k: Column) -> Column:
        log_p = F.when(k == 0, -rate).otherwise(acc["log_p"] + F.log(rate) - F.log(k.cast("double")))
        total = acc["total"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    start = F.struct(F.lit(0.0).alias("log_p"), F.lit(0.0).alias("total"), F.array().cast("array<double>").alias("cdf"))
    return F.when(rate <= 0, F.array(F.lit(1.0))).otherwise(F.aggregate(F.sequence(F.lit(0), reach), start, step, lambda acc: acc["cdf"]))


def source_rates(docs: DataFrame, targets: dict[str | None, float] | None = None, total: int | None = None) -> DataFrame:
    """(source, n, rate, cdf), one row per source. `targets`: relative weights; none: equal. `total`: documents wanted; none: as many as given."""
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    if targets is None:
        weighed = n.withColumn("w", F.lit(1.0))
    else:
        weight = F.lit(0.0)
        for name, w in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
        weighed = n.withColumn("w", weight)
    weighed = materialise(weighed, "sources")
    sums = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    wanted, weights = float(total if total is not None else sums["n"] or 0), sums["w"] or 1.0
    rate = F.col("w") / F.lit(weights) * F.lit(wanted) / F.col("n")
    return weighed.withColumn("rate", rate).select("source", "n", "rate", _distribution(F.col("rate")).alias("cdf"))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """All columns of `docs` and `rate`, `copy` (from 0) and `shuffle_key`, in the global order of the key."""
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0))
    plain = docs.drop("rate", "copy", "shuffle_key")
    joined = plain.join(rates.select(F.col("source").alias("_mix_source"), "rate", F.col("cdf").alias("_mix_cdf")), F.col("source").eqNullSafe(F.col("_mix_source")))
    u = mix(key, seed) / F.lit(_STEPS)
    copies = F.size(F.filter("_mix_cdf", lambda p: p <= u))
    rows = joined.withColumn("_mix_n", copies).where("_mix_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_mix_n") - 1)))
    keyed = rows.withColumn("shuffle_key", mix(key * 1009 + F.col("copy"), seed + 1)).drop("_mix_source", "_mix_cdf", "_mix_n")
    return keyed.repartitionByRange("shuffle_key", "doc_id", "copy").sortWithinPartitions("shuffle_key", "doc_id", "copy")


SQL = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (SELECT source, 1.0::DOUBLE / (SELECT count(*) FROM n) * (SELECT sum(n) FROM n)::DOUBLE / n AS rate FROM n),
steps AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rates),
p AS (SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM steps),
cdf AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
counted AS (SELECT d.doc_id, d.source, d.text, any_value(c.rate) AS rate, count(*) FILTER (WHERE c.c <= {mix_sql('d.doc_id', SEED)} / {_STEPS}::DOUBLE) AS copies
            FROM documents d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY d.doc_id, d.source, d.text),
rows AS (SELECT *, unnest(range(0, copies)) AS copy FROM counted)
SELECT doc_id, source, text, round(rate, 9) AS rate, CAST(copy AS INTEGER) AS copy, CAST({mix_sql('(doc_id * 1009 + copy)', SEED + 1)} AS BIGINT) AS shuffle_key FROM rows
"""


def poisson_quantile(rate: float, u: float) -> int:
    """The same inversion for one number, for tests."""
    k, total = 0, math.exp(-rate)
    while total <= u and k < 10_000:
        k += 1
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k
