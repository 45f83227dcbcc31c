from pyspark.sql import functions as F

from staymill import schema as S
from staymill.operators import clean as C
from staymill.operators import profile as P
from staymill.operators import split as SP


def test_clean_rules(raw_like):
    out = C.clean(raw_like)
    assert not set(S.LEAKAGE_COLUMNS) & set(out.columns)
    assert {r["booking_id"] for r in raw_like.collect()} - {r["booking_id"] for r in out.collect()} == {3, 4, 5}
    audit = C.clean_audit(raw_like).first()
    assert (audit["no_guests"], audit["no_nights"], audit["bad_adr"], audit["removed"], audit["left"]) == (1, 1, 1, 3, 19)


def test_null_rate_is_kept_and_missing_columns_are_tolerated(spark):
    df = spark.createDataFrame([(1, None), (2, -1.0), (3, 5400.0), (4, 0.0)], "booking_id bigint, adr double")
    assert [r["booking_id"] for r in C.clean(df).orderBy("booking_id").collect()] == [1, 4]
    assert C.clean_audit(spark.createDataFrame([], "adr double")).first()["removed_share"] is None


def test_contract(raw_like):
    bad = raw_like.withColumn("lead_time", F.when(F.col("booking_id") == 0, -5).otherwise(F.col("lead_time"))).drop("meal")
    v = {r["booking_id"]: r["violations"] for r in C.validate_contract(bad).collect()}
    assert v[0] == ["missing:meal", "range:lead_time"] and v[1] == ["missing:meal"]
    filled = C.payload_cast(bad)
    assert {r["meal"] for r in filled.collect()} == {"BB"}


def test_split_is_exact_disjoint_and_repeatable(raw_like):
    a = SP.split_stratified(raw_like)
    b = SP.split_stratified(raw_like.orderBy(F.desc("booking_id")).repartition(5))
    pick = lambda df: {r["booking_id"]: r["split"] for r in df.collect()}
    assert pick(a) == pick(b)
    assert sum(v == "test" for v in pick(a).values()) == 5  # ceil(22 / 5)


def test_split_edges(spark):
    one = spark.createDataFrame([(i, 1) for i in range(10)], "booking_id bigint, is_canceled int")
    assert SP.split_stratified(one).where("split = 'test'").count() == 2
    assert SP.split_stratified(one.limit(0)).count() == 0
    assert SP.sample_n(one, 99).count() == 10


def test_split_with_equal_hashes(spark):
    """Keys that differ by a multiple of the hash prime may share a hash; the cut then goes by key."""
    p = 2147483647
    df = spark.range(4000).select(F.col("id").alias("booking_id"), F.lit(0).alias("is_canceled"))
    cut = SP.hash_cuts(df, lambda c: {0: 1234}, "is_canceled", "booking_id", 42)[0]
    h = SP.mix("booking_id", 42)
    assert df.where((h < cut[0]) | ((h == cut[0]) & (F.col("booking_id") <= cut[1]))).count() == 1234
    same = spark.range(50).select(F.lit(7).alias("c"), F.lit(5).cast("bigint").alias("k"))
    assert same.select(SP.mix("k", 1)).distinct().count() == 1 and p > 0


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "City", 10), (0, "City", 20), (1, "Resort", 5), (0, "Resort", 400), (1, "City", 7), (0, None, 8)], "is_canceled int, hotel string, lead_time int")
    rates = [(r["value"], round(r["rate"], 4), r["n"]) for r in P.rate_by(df, "hotel").collect()]
    assert rates == [("City", 0.6667, 3), ("Resort", 0.5, 2)]
    assert [(r["label"], r["n"], r["percent"]) for r in P.class_balance(df).collect()] == [("No cancelada", 3, 50.0), ("Cancelada", 3, 50.0)]
    bands = [r["band"] for r in P.rate_lead_band(df).collect()]
    assert bands == ["0-7", "8-30", "365+"]
    assert P.duplicate_rows(df.unionByName(df)).first()["duplicates"] == 6
    empty = df.limit(0)
    assert P.class_balance(empty).count() == 0 and P.histogram(empty, "lead_time", 4).count() == 0
