import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from staymill.operators import models as M
from staymill.operators.tree import Tree


def _rows(spark, n=2500, levels=40, parts=3):
    """Three numeric slots, one of many values, and a one-hot group; every third vector is dense."""
    rng = np.random.default_rng(8)
    made = []
    for i in range(n):
        level = int(rng.integers(0, levels + 1))
        x = {0: float(rng.integers(-3, 4)), 1: float(np.round(rng.normal(), 4)), 2: float(rng.integers(0, 3))}
        if level < levels:
            x[3 + level] = 1.0
        y = float(x[0] + 2 * (level % 4 == 1) + x[1] + rng.normal() > 0.5)
        v = Vectors.sparse(levels + 4, {k: a for k, a in x.items() if a})
        made.append((i, y, 1.0 + i % 3, Vectors.dense(v.toArray()) if i % 3 == 0 else v))
    return spark.createDataFrame(made, ["booking_id", "label", "weight", "features"]).repartition(parts, "booking_id")


def _p(model, df):
    return np.array([r["p"] for r in model.transform(df).orderBy("booking_id").select(vector_to_array("probability")[1].alias("p")).collect()])


@pytest.mark.parametrize("local", [50, 700, 50_000])
@pytest.mark.parametrize("criterion,weight,depth,least", [("gini", None, 8, 5), ("entropy", None, 30, 20), ("gini", "weight", 6, 1)])
def test_tree_equals_spark(spark, criterion, weight, depth, least, local):
    df = _rows(spark)
    inner = DecisionTreeClassifier(**M._IO, **M._TREE, maxDepth=depth, minInstancesPerNode=least, impurity=criterion)
    inner = inner.setWeightCol(weight) if weight else inner
    ours, theirs = Tree(inner, local).fit(df), inner.fit(df)
    assert np.allclose(_p(ours, df), _p(theirs, df)) and ours.numNodes == theirs.numNodes and ours.depth == theirs.depth
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())


def test_rows_are_kept_by_filled_slots(spark, monkeypatch):
    """A vector of 200,000 slots costs what it fills, on either way of growing."""
    df = spark.createDataFrame([(i, float(i % 2), Vectors.sparse(200_000, {i % 2: 1.0, 7 + i % 1000: 1.0})) for i in range(2000)], ["booking_id", "label", "features"])
    for local in (100, 50_000):
        model = Tree(DecisionTreeClassifier(**M._IO, **M._TREE, maxDepth=3), local).fit(df)
        assert model.numNodes == 3 and model.numFeatures == 200_000 and set(_p(model, df)) == {0.0, 1.0}


def test_no_rows_and_other_labels(spark):
    df = _rows(spark, 20)
    for bad in (df.where("false"), df.withColumn("label", df.label + 1)):
        with pytest.raises(ValueError):
            M.tree().fit(bad)
    leaf = M.tree(min_leaf=50).fit(df)
    assert leaf.numNodes == 1
