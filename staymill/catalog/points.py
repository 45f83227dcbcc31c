"""Neighbours, clusters and projections."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array

from staymill.catalog.base import F, mix_sql, query, table
from staymill.functions.session import materialise
from staymill.operators import cluster as K
from staymill.operators import neighbours as N
from staymill.operators import project as PR
from staymill.operators import split as SP

_SPLIT = f"CASE WHEN {mix_sql('vec_id', 42)} < 429496729 THEN 'test' ELSE 'train' END"
_VEC = f"vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, {_SPLIT} AS split FROM embeddings)"
_TOP = f"""WITH {_VEC}, near AS (SELECT q.vec_id, t.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, t.e), t.vec_id) AS r
FROM vec q JOIN vec t ON q.split = 'test' AND t.split = 'train' QUALIFY r <= 5)"""
EPS, MIN_SAMPLES = 1.15, 5


def _sides(s, d):
    df = SP.split_random(table(s, d, "embeddings"), key="vec_id")
    return df.where("split = 'test'"), df.where("split = 'train'")


query("knn_classify", "vec_id:i prediction:i", f"""{_TOP}, votes AS (SELECT vec_id, label, count(*) AS n FROM near GROUP BY 1, 2)
SELECT vec_id, label AS prediction FROM votes QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""")(
    lambda s, d: N.knn_classify(*_sides(s, d), 5, "vec_id", "embedding", "label"))
query("knn_regress", "vec_id:i prediction:d", f"{_TOP} SELECT vec_id, avg(label) AS prediction FROM near GROUP BY 1")(
    lambda s, d: N.knn_regress(*_sides(s, d), 5, "vec_id", "embedding", "label"))
query("silhouette_exact", "vec_id:i label:i silhouette:d", f"""WITH {_VEC},
m AS (SELECT q.vec_id, q.label, t.label AS o, sum(list_distance(q.e, t.e)) AS s, count(*) AS n FROM vec q JOIN vec t ON true GROUP BY 1, 2, 3),
r AS (SELECT vec_id, label, max(n) FILTER (WHERE o = label) AS n, max(CASE WHEN n > 1 THEN s / (n - 1) END) FILTER (WHERE o = label) AS a, min(s / n) FILTER (WHERE o <> label) AS b FROM m GROUP BY 1, 2)
SELECT vec_id, label, CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM r""")(
    lambda s, d: K.silhouette_exact(table(s, d, "embeddings"), "vec_id", "embedding", ["label"]).withColumnRenamed("cluster", "label"))
query("dbscan_core", "vec_id:i neighbours:i core:b", f"""WITH {_VEC}
SELECT q.vec_id, count(*) AS neighbours, count(*) >= {MIN_SAMPLES} AS core FROM vec q JOIN vec t ON list_distance(q.e, t.e) <= {EPS} GROUP BY 1""")(
    lambda s, d: K.dbscan_core(table(s, d, "embeddings"), "vec_id", "embedding", EPS, MIN_SAMPLES))
query("dbscan_labels", "vec_id:i label:i core:b", f"""WITH RECURSIVE {_VEC},
links AS (SELECT q.vec_id AS a, t.vec_id AS b FROM vec q JOIN vec t ON list_distance(q.e, t.e) <= {EPS}),
core AS (SELECT a FROM links GROUP BY a HAVING count(*) >= {MIN_SAMPLES}),
edges AS (SELECT l.a, l.b FROM links l JOIN core x ON l.a = x.a JOIN core y ON l.b = y.a),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
lab AS (SELECT a, min(b) AS label FROM reach GROUP BY a),
loose AS (SELECT l.a, min(lab.label) AS label FROM links l JOIN lab ON l.b = lab.a WHERE l.a NOT IN (SELECT a FROM core) GROUP BY l.a)
SELECT v.vec_id, coalesce(lab.label, loose.label, -1) AS label, lab.a IS NOT NULL AS core FROM vec v LEFT JOIN lab ON v.vec_id = lab.a LEFT JOIN loose ON v.vec_id = loose.a""")(lambda s, d: K.dbscan(table(s, d, "embeddings"), "vec_id", "embedding", EPS, MIN_SAMPLES))


def _scaled(s, d):
    return materialise(PR.scaled_vectors(table(s, d, "embeddings"), "embedding"), "scaled")


@query("kmeans", "vec_id:i cluster:i")
def kmeans(s, d):
    df = _scaled(s, d)
    return K.fit_kmeans(df, 3, "scaled").transform(df)


@query("kmeans_nearest", "vec_id:i nearest:b", "SELECT vec_id, true AS nearest FROM embeddings")
def kmeans_nearest(s, d):
    """Of every vector, whether no other centre is nearer than that of its cluster."""
    df = _scaled(s, d)
    model = K.fit_kmeans(df, 3, "scaled")

    def squares(centre):
        return F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, x: a + x)

    far = F.array(*[squares(c) for c in model.clusterCenters()])
    rows = model.transform(df).withColumn("v", vector_to_array("scaled")).select("vec_id", "cluster", far.alias("far"))
    return rows.select("vec_id", (F.element_at("far", F.col("cluster") + 1) <= F.array_min("far") + 1e-9).alias("nearest"))


@query("elbow", "k:i inertia:d")
def elbow(s, d):
    return K.elbow(_scaled(s, d), "scaled")


@query("silhouette_by_k", "k:i silhouette:d")
def silhouette_by_k(s, d):
    """Mean Euclidean silhouette of the k-means clusters for k = 2..10; all distances are formed once."""
    df = _scaled(s, d)
    for k in range(2, 11):
        df = K.fit_kmeans(df, k, "scaled").transform(df).withColumnRenamed("cluster", f"k{k}")
    rows = K.silhouette_exact(df.withColumn("v", vector_to_array("scaled")), "vec_id", "v", [f"k{k}" for k in range(2, 11)])
    return rows.groupBy(F.substring("labelling", 2, 2).cast("int").alias("k")).agg(F.avg("silhouette").alias("silhouette"))


_SCALED = """parts AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
scaled AS (SELECT vec_id, label, i, (x - avg(x) OVER (PARTITION BY i)) / stddev_samp(x) OVER (PARTITION BY i) AS z FROM parts)"""


@query("silhouette_fast", "silhouette:d", f"""WITH {_SCALED},
v AS (SELECT vec_id, label, list(z ORDER BY i) AS e FROM scaled GROUP BY 1, 2),
m AS (SELECT q.vec_id, q.label, t.label AS o, sum(list_distance(q.e, t.e) ** 2) AS s, count(*) AS n FROM v q JOIN v t ON true GROUP BY 1, 2, 3),
r AS (SELECT vec_id, max(n) FILTER (WHERE o = label) AS n, max(CASE WHEN n > 1 THEN s / (n - 1) END) FILTER (WHERE o = label) AS a, min(s / n) FILTER (WHERE o <> label) AS b FROM m GROUP BY 1)
SELECT avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM r""")
def silhouette_fast(s, d):
    df = _scaled(s, d)
    return s.createDataFrame([(float(K.silhouette_fast(df, "scaled", "label")),)], "silhouette double")


query("pca", "component:i explained:d cumulative:d")(lambda s, d: (lambda df: PR.explained(PR.fit_pca(df, 64), s))(_scaled(s, d)))
query("pca_threshold", "components:i")(lambda s, d: (lambda df: PR.components_for(PR.explained(PR.fit_pca(df, 64), s)))(_scaled(s, d)))


@query("pca_traces", "components:i total:d squares:d", f"""WITH {_SCALED},
c AS (SELECT p.i, q.i AS j, sum(p.z * q.z) AS s FROM scaled p JOIN scaled q ON p.vec_id = q.vec_id GROUP BY 1, 2)
SELECT count(*) FILTER (WHERE i = j) AS components, 1 AS total, sum(s * s) / sum(s) FILTER (WHERE i = j) ** 2 AS squares FROM c""")
def pca_traces(s, d):
    """Sums of the explained shares and of their squares: both follow from the correlations without any eigenvector."""
    e = F.col("explained")
    return PR.explained(PR.fit_pca(_scaled(s, d), 64), s).agg(F.count(F.lit(1)).alias("components"), F.sum(e).alias("total"), F.sum(e * e).alias("squares"))
