import shutil

import pytest
from pyspark.ml import Pipeline, PipelineModel

from staymill.operators import encode as E
from staymill.operators import features as FT
from staymill.sources import csv as IO


def test_builder(spark):
    df = spark.createDataFrame([("no_company", "9", 3, 1, None), ("40", None, 2, 0, 1.0)], "company string, agent string, stays_in_week_nights int, stays_in_weekend_nights int, children double")
    rows = FT.FeatureBuilder().transform(df).collect()
    assert [r["has_company"] for r in rows] == [0, 1] and [r["has_agent"] for r in rows] == [1, 0]
    assert [r["noches"] for r in rows] == [4, 2] and [r["children"] for r in rows] == [0, 1]
    assert [r["company"] for r in rows] == [None, "40"]
    bare = FT.FeatureBuilder().transform(df.select("children")).first()
    assert (bare["has_company"], bare["has_agent"]) == (0, 0)


def test_numeric_ids(spark):
    df = spark.createDataFrame([(9.0,), (9.5,), (None,), (float("nan"),)], "agent double")
    assert [r["agent"] for r in FT.FeatureBuilder().transform(df).collect()] == ["9", "9.5", None, None]


@pytest.fixture(scope="module")
def graded(spark):
    rows = [("risky", 1)] * 300 + [("safe", 0)] * 300 + [("mid", i % 2) for i in range(300)] + [("tiny", 1)] * 5 + [(None, 1)] * 3
    return spark.createDataFrame(rows, "agent string, is_canceled int")


def test_grouper(graded):
    model = FT.RareCategoryGrouper(columns=["agent"]).fit(graded)
    assert model.kept == {"agent": ["risky", "safe"]}
    got = {r["agent"] for r in model.transform(graded).collect()}
    assert got == {"risky", "safe", "Otros", "Desconocido"}
    assert FT.RareCategoryGrouper(columns=["agent"], target="").fit(graded).kept == {"agent": ["mid", "risky", "safe", "tiny"]}
    assert FT.RareCategoryGrouper(columns=["agent"], minN=1000).fit(graded).kept == {"agent": []}


def test_grouper_with_joined_keep_table(graded, monkeypatch):
    want = sorted(r["agent"] for r in FT.RareCategoryGrouper(columns=["agent"]).fit(graded).transform(graded).collect())
    monkeypatch.setattr(FT, "INLINE_KEEP", 0)
    assert sorted(r["agent"] for r in FT.RareCategoryGrouper(columns=["agent"]).fit(graded).transform(graded).collect()) == want
    monkeypatch.setattr(FT, "SMALL_STATE_ROWS", 1)
    model = FT.RareCategoryGrouper(columns=["agent"]).fit(graded)
    assert model.getOrDefault("keepPath")
    assert sorted(r["agent"] for r in model.transform(graded).collect()) == want


def test_scalers_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    out = Pipeline(stages=[E.MedianImputer(columns=["x"]), E.StandardScaler(columns=["x", "c"])]).fit(df).transform(df).collect()
    assert [round(r["x"], 6) for r in out] == [-1.224745, 1.224745, 0.0] and {r["c"] for r in out} == {0.0}
    assert {r["c"] for r in E.MinMaxScaler(columns=["c"]).fit(df).transform(df).collect()} == {0.0}


def test_preprocessor_saves_loads_and_meets_unseen_values(spark, raw_like, tmp_path):
    model = E.preprocessor().fit(raw_like)
    model.write().save(str(tmp_path / "pre"))
    again = PipelineModel.load(str(tmp_path / "pre"))
    odd = raw_like.replace("City Hotel", "Boat", ["hotel"])
    a, b = model.transform(odd).select("features").collect(), again.transform(odd).select("features").collect()
    assert a == b and len(a) == 22
    names = E.feature_names(model.transform(raw_like))
    assert names[:2] == ["lead_time", "arrival_date_week_number"] and "hotel_City Hotel" in names and "country_Desconocido" in names
    hotel = [i for i, n in enumerate(names) if n.startswith("hotel_")]
    boat = [r["features"].toArray()[hotel].sum() for r in a]
    assert boat.count(0.0) == 21 and boat.count(1.0) == 1


def test_all_null_column(spark, raw_like):
    from pyspark.sql import functions as F

    holed = raw_like.withColumn("adr", F.lit(None).cast("double")).withColumn("country", F.lit(None).cast("string"))
    assert E.preprocessor().fit(holed).transform(holed).count() == 22


def test_csv_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text('booking_id,lead_time,agent,company,hotel\n1,3.0,NULL,"",City\n2,x,NaN,none,"a, ""b"""\n3,7,9,n/a,NA\n')
    rows = IO.load_raw(spark, str(tmp_path / "a.csv")).collect()
    assert [r["lead_time"] for r in rows] == [3, None, 7]
    assert [r["agent"] for r in rows] == [None, None, "9"]
    assert [r["company"] for r in rows] == [None, "none", None]
    assert [r["hotel"] for r in rows] == ["City", 'a, "b"', None]


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("booking_id,adults,babies\n1,2,0\n")
    (tmp_path / "b.csv").write_text("booking_id,babies,adults\n2,3,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        IO.load_raw(spark, str(tmp_path)).collect()
    assert IO.load_raw(spark, str(tmp_path / "b.csv")).first().asDict() == {"booking_id": 2, "babies": 3, "adults": 9}


def test_saved_model_keeps_a_long_list(spark, raw_like, tmp_path, monkeypatch):
    monkeypatch.setattr(FT, "SMALL_STATE_ROWS", 1)
    model = FT.RareCategoryGrouper(columns=["country", "agent"], target="").fit(raw_like)
    want = sorted(map(str, model.transform(raw_like).select("country", "agent").collect()))
    model.save(str(tmp_path / "model"))
    shutil.rmtree(model.getOrDefault("keepPath").removeprefix("file:"))
    again = FT.RareCategoryModel.load(str(tmp_path / "model"))
    assert sorted(map(str, again.transform(raw_like).select("country", "agent").collect())) == want


def test_categories_are_reduced_once_per_fit(spark, raw_like, monkeypatch):
    """The passes of medians, deviations and levels read written rows; the fitted stages are those of a plain pipeline."""
    plain = Pipeline(stages=E.preprocess_stages()).fit(raw_like)
    scans = []
    quantiles = E.exact_quantiles
    monkeypatch.setattr(E, "exact_quantiles", lambda df, *a: scans.append(df.inputFiles()) or quantiles(df, *a))
    model, rows = E.fit_stages(E.preprocess_stages(), raw_like)
    assert scans and all("reduced-" in f for f in scans[0])
    wanted = plain.transform(raw_like).select("booking_id", "features").collect()
    for got in (rows, model.transform(raw_like), E.preprocessor().fit(raw_like).transform(raw_like)):
        assert sorted(map(str, got.select("booking_id", "features").collect())) == sorted(map(str, wanted))
        assert E.feature_names(got) == E.feature_names(plain.transform(raw_like))
