"""Sums per slot over sparse, dense and missing vectors."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staymill.functions.vectors import rows_of, slot_sums


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(0)
    x = np.where(rng.random((60, 7)) < 0.4, rng.normal(size=(60, 7)), 0.0)
    made = [Vectors.dense(r) if i % 3 else Vectors.sparse(7, [(int(j), float(r[j])) for j in np.flatnonzero(r)]) for i, r in enumerate(x)]
    made[5], x[5] = None, 0.0
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", VectorUDT()), T.StructField("f", T.DoubleType())])
    return spark.createDataFrame([(i, v, float(i)) for i, v in enumerate(made)], schema).repartition(4), x


def test_slot_sums(mixed):
    df, x = mixed
    got = slot_sums(df, "v", lambda r, b: {"g": r.back(np.asarray(b.column("f"))), "n": r.back(np.ones(len(r)))}, ["g", "n"], F.col("f"))
    assert np.allclose(got["g"], x.T @ np.arange(60)) and np.allclose(got["n"], x.sum(axis=0))


def test_dot_and_block(mixed):
    df, x = mixed
    table = df.where("v is not null").select("k", F.unwrap_udt("v").alias("v")).orderBy("k").toArrow()
    rows, w, x = rows_of(table.column("v")), np.arange(7.0), np.delete(x, 5, axis=0)
    assert len(rows) == 59 and rows.width == 7 and np.allclose(rows.dot(w), x @ w)
    pick = np.array([3, 5, 40, 41])
    matrix, slots = rows.block(pick)
    full = np.zeros((4, 7))
    full[:, slots] = matrix
    assert np.allclose(full, x[pick])


def test_stationary_without_a_row_per_slot(spark, small):
    """The check of the gradient reads vectors by their filled slots: its result has one row and its plan explodes nothing."""
    from staymill.catalog import QUERIES

    out = QUERIES["logreg_stationary"](spark, small)
    assert out.first()["weights"] and "Generate" not in out._jdf.queryExecution().toString()


def test_width_and_filled_of_wide_vectors(spark):
    """A sparse vector gives the few values it holds; as a dense array it would have 20,000."""
    from pyspark.ml.linalg import Vectors

    from staymill.functions.vectors import width_and_filled

    df = spark.createDataFrame([(0, Vectors.sparse(20_000, [3, 700], [1.5, 2.0])), (1, Vectors.dense([1.0, 0.0, 4.0])), (2, Vectors.sparse(5, [], []))], ["k", "v"])
    width, filled = width_and_filled("v")
    got = df.select("k", width.alias("w"), filled.alias("f")).orderBy("k").collect()
    assert [(r["w"], list(r["f"])) for r in got] == [(20_000, [1.5, 2.0]), (3, [1.0, 0.0, 4.0]), (5, [])]
