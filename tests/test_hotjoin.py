"""Lookup joins in which one key holds nine tenths of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staymill.operators.features import rare_apply
from staymill.plans.hotjoin import heavy_keys, lookup_join
from staymill.schema import RARE_OTHER


@pytest.fixture
def shuffled(spark):
    """Joins shuffle both sides, and nothing mends skew at run time."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _big(spark):
    """40,000 rows: 90 % of one key, 2 % without a key, the rest over 500 keys of which 400 are known."""
    key = "case when id % 100 < 90 then 'hot' when id % 100 < 92 then null else concat('k', id % 500) end"
    return spark.range(40_000).selectExpr("id", f"{key} as key")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_one_key_of_ninety_percent(shuffled, how):
    big = _big(shuffled)
    table = shuffled.range(400).selectExpr("concat('k', id) as key", "id as value").unionByName(shuffled.sql("select 'hot' as key, -1L as value"))
    got = lookup_join(big, table, ["key"], ["id"], how, slice_rows=100)
    plain = big.join(table, "key", how)
    assert got.columns == ["id", "key", "value"]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(got.columns).collect()))
    rows = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert len(rows) == 8 and rows[-1] <= 2 * np.median(rows)
    worst = max(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    assert worst > 30_000


def test_rows_without_key_spread(shuffled):
    big = shuffled.range(8000).selectExpr("id", "cast(null as string) as key")
    got = lookup_join(big, shuffled.sql("select 'a' as key, 1 as value"), ["key"], ["id"], "left")
    rows = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(rows) == 8000 and max(rows) < 2000 and got.where("value is not null").count() == 0


def test_repeated_rows_of_the_table_and_empty_sides(shuffled):
    big = shuffled.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", None)], "id int, k1 string, k2 string")
    table = shuffled.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", None, 3)], "k1 string, k2 string, v int")
    for rows in (1, 100):
        got = lookup_join(big, table, ["k1", "k2"], ["id"], "left", slice_rows=rows).collect()
        assert sorted((r["id"], r["v"] or 0) for r in got) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 0)]
    assert heavy_keys(big, ["k1"], 1).collect()[0].asDict() == {"_h0": "a", "_slices": 2}
    assert lookup_join(big.limit(0), table, ["k1", "k2"], ["id"]).count() == 0
    assert lookup_join(big, table.limit(0), ["k1", "k2"], ["id"], "left").count() == 3
    with pytest.raises(ValueError):
        lookup_join(big, table, ["k1"], ["id"], "full")


def test_rare_apply_of_a_hot_value(shuffled):
    big = _big(shuffled).withColumn("value", F.lit(7))
    keep = shuffled.sql("select 'key' as variable, 'hot' as value")
    got = rare_apply(big, keep, ["key"], {"key": "none"})
    assert got.columns == ["id", "key", "value"]
    assert {r["key"]: r["count"] for r in got.groupBy("key").count().collect()} == {"hot": 36_000, "none": 800, RARE_OTHER: 3_200}
