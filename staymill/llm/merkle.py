"""Merkle manifest of a dataset, and the climb of every leaf from its own run to the root.

A row is a leaf: SHA-256 over its fields. The leaves of a group stand in order; every `ARITY` consecutive nodes become
one node of the next level until one is left, the subroot; the subroots in order of their groups become the root in the
same way. Hashes are concatenated as lower-case hex texts.

The built levels are written as node rows, each with its parent's key and the hashes it was made of. A recursive query
then climbs from the nodes right above the runs of leaves: per step it joins the parent and appends the siblings to the
way. The leaves of up to ARITY runs share a way; each run is joined to it once, puts its own siblings first and folds the
(possibly tampered) hash of every leaf along it.

Scale: positions come from a range partition and one small row per partition and group, so a group of any size is spread
over many tasks. Only hashes and ids are shuffled, and those of the leaves not once per level. Nodes near the root are on the way of every leaf: each is laid down
once per `BLOCK` consecutive leaves that it covers, and a way looks in its own block, so no join key meets more
than BLOCK / ARITY rows. Levels grow with the logarithm of the largest group.

Defined cases: a null field counts as `-`; null groups and null order values come first; rows of a group with equal order
values are ordered by their leaf. Repeated rows are leaves of their own. An empty table has no rows. Columns that are not
named are not read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staymill.functions.session import materialise

ARITY = 16
BLOCK = 1 << 16  # leaves that share one copy of a node
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(values: Sequence[Column]) -> Column:
    """Digest of the values, each as `-` if null, else its length in bytes, a colon and the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in (c.cast("string") for c in values)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _positions(df: DataFrame, order: Sequence[str], group: str, totals: Sequence[str] = ()) -> DataFrame:
    """`df` with `pos`, the place of a row in its group, `n`, the size of the group, `place`, its place in the table, and
    `tree`, the number of its group from 1. `order` begins with the group."""
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    at = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()), "placed").withColumn("_part", F.shiftright("_at", 33))
    # One row per partition and group; partitions hold the order, so groups are numbered through their heads.
    heads = materialise(at.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")), "heads")
    parts = heads.groupBy("_part").agg(F.sum("_n").alias("_rows"), F.max(F.struct(F.col(group).isNotNull(), F.col(group))).alias("_last"),
                                       F.min(F.struct(F.col(group).isNotNull(), F.col(group))).alias("_head"), F.count(F.lit(1)).alias("_groups"))
    line = Window.orderBy("_part")  # one row per partition of the table
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce((F.lag("_last").over(line) == F.col("_head")).cast("long"), F.lit(0))
    parts = parts.withColumn("_goes_on", goes_on)
    offsets = parts.select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        (F.coalesce(F.sum(F.col("_groups") - F.col("_goes_on")).over(before), F.lit(0)) - F.col("_goes_on")).alias("_groups_before"),
    )
    inside = Window.partitionBy("_part").orderBy("_first")
    own = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = heads.join(offsets, F.col("_part") == F.col("_p")).withColumn("tree", F.row_number().over(inside) + F.col("_groups_before"))
    numbered = numbered.withColumns({
        "_before": F.coalesce(F.sum("_n").over(own), F.lit(0)), "n": F.sum("_n").over(Window.partitionBy("tree")),
    }).select("tree", "n", F.col("_part").alias("_p"), F.col(group).alias("_g"), "_before", "_first", "_rows_before")
    joined = at.join(numbered, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    place = F.col("_rows_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return joined.select(*df.columns, "tree", "n", (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"), place.alias("place"))


def _text(hashes: Column) -> Column:
    return F.array_join(hashes, "")


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _leaf_text(leaves: Column) -> Column:
    return F.array_join(F.transform(leaves, _hex), "")


def _linked(nodes: DataFrame, groups: int) -> DataFrame:
    """Node rows with the key of their parent: the next level of their tree, or from a subroot the top tree 0."""
    last = F.col("size") == 1
    top = (F.col("tree") > 0) & F.lit(groups > 1)
    at = F.when(last, F.col("tree") - 1).otherwise(F.col("pos"))
    return nodes.withColumns({
        "is_subroot": last & (F.col("tree") > 0),
        "up_tree": F.when(~last, F.col("tree")).when(top, F.lit(0)).cast("long"),
        "up_level": F.when(~last, F.col("level") + 1).when(top, F.lit(1)).cast("int"),
        "up_pos": F.when(~last | top, F.floor(at / ARITY)).cast("long"),
        "seat": F.when(~last | top, at % ARITY).cast("int"),
    })


def _next_level(nodes: DataFrame, level: int) -> DataFrame:
    """The parents of the nodes of trees that have several of them."""
    child = F.struct("pos", "digest")
    grouped = nodes.where("size > 1").groupBy("tree", "size", F.floor(F.col("pos") / ARITY).alias("up")).agg(
        F.array_sort(F.collect_list(child)).getField("digest").alias("children"), F.min("low").alias("low"), F.max("high").alias("high"))
    return grouped.select(
        "tree", F.lit(level).alias("level"), F.col("up").cast("long").alias("pos"), F.ceil(F.col("size") / ARITY).cast("long").alias("size"),
        F.sha2(_text(F.col("children")), 256).alias("digest"), "children", "low", "high",
    )


_NODE = ["tree", "level", "pos", "size", "digest", "children", "low", "high"]


def build(leaves: DataFrame, group: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(runs, nodes) from `leaves` (order, group, leaf, ...): the lowest nodes with their leaves as `items`, and all nodes above.

    Both carry their own key, digest and the key of their parent."""
    placed = _positions(leaves, [group, order, "leaf"], group)
    item = F.struct("pos", *[c for c in leaves.columns if c != group])
    runs = placed.groupBy("tree", "n", F.floor(F.col("pos") / ARITY).cast("long").alias("run")).agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.min("place").alias("low"))
    # A lone leaf is its group's subroot as it is.
    digest = F.when(F.col("n") == 1, _hex(F.col("items")[0]["leaf"])).otherwise(F.sha2(_leaf_text(F.col("items")["leaf"]), 256))
    runs = materialise(runs.select(
        "tree", F.lit(1).alias("level"), F.col("run").alias("pos"), F.ceil(F.col("n") / ARITY).cast("long").alias("size"), digest.alias("digest"),
        F.lit(None).cast("array<string>").alias("children"), "low", F.col("low").alias("high"), "items"), "runs")
    largest, groups = runs.agg(F.coalesce(F.max("size"), F.lit(0)), F.coalesce(F.max("tree"), F.lit(0))).first()
    current, levels = runs.select(_NODE), []
    subroots = [current]
    level = 1
    while largest > 1:
        level += 1
        current = materialise(_next_level(current, level), "nodes")
        levels.append(current)
        subroots.append(current)
        largest = -(-largest // ARITY)
    if groups > 1:
        ends = reduce(DataFrame.unionByName, subroots).where("size = 1")
        current = ends.select(F.lit(0).cast("long").alias("tree"), F.lit(0).alias("level"), (F.col("tree") - 1).alias("pos"),
                              F.lit(groups).cast("long").alias("size"), "digest", F.lit(None).cast("array<string>").alias("children"), "low", "high")
        size, level = groups, 0
        while size > 1:
            level += 1
            current = materialise(_next_level(current, level), "nodes")
            levels.append(current)
            size = -(-size // ARITY)
    nodes = reduce(DataFrame.unionByName, levels) if levels else current.where("false").select(_NODE)
    return _linked(runs, groups), _linked(nodes, groups)


_CLIMB = """
WITH RECURSIVE climb (tree, level, pos, seats, steps, subroot, digest, block, up_tree, up_level, up_pos, seat) MAX RECURSION LEVEL 1000 AS (
  SELECT tree, level, pos, children, CAST(array() AS array<struct<left: binary, right: binary>>), CASE WHEN is_subroot THEN digest END, digest,
         floor(low / {block}), up_tree, up_level, up_pos, seat
  FROM {nodes} WHERE level = CASE WHEN tree = 0 THEN 1 ELSE 2 END
  UNION ALL
  SELECT c.tree, c.level, c.pos, c.seats,
         concat(c.steps, array(struct(unhex(array_join(slice(n.children, 1, c.seat), '')) AS left,
                                      unhex(array_join(slice(n.children, c.seat + 2, {arity}), '')) AS right))),
         coalesce(c.subroot, CASE WHEN n.is_subroot THEN n.digest END), n.digest, c.block, n.up_tree, n.up_level, n.up_pos, n.seat
  FROM climb c JOIN {copies} n ON c.up_tree = n.tree AND c.up_level = n.level AND c.up_pos = n.pos AND c.block = n.block)
SELECT tree AS c_tree, level AS c_level, pos AS c_pos, seats, steps, subroot AS c_subroot, digest AS c_root FROM climb WHERE up_tree IS NULL
"""


def climb(runs: DataFrame, nodes: DataFrame, order: str) -> DataFrame:
    """(items, path, subroot, digest) per run at the root: folded hashes of its leaves, siblings above it, subroot and root."""
    spark: SparkSession = runs.sparkSession
    covered = F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK))
    copies = materialise(nodes.withColumn("block", F.explode(covered)).drop("size", "low", "high"), "copies")
    key = "spark.sql.cteRecursionRowLimit"
    limit = spark.conf.get(key, None)
    spark.conf.set(key, "-1")  # the number of rows is that of the nodes above the runs times the levels
    try:
        ways = materialise(spark.sql(_CLIMB, nodes=nodes, copies=copies, block=BLOCK, arity=ARITY), "climbed")
    finally:
        spark.conf.unset(key) if limit is None else spark.conf.set(key, limit)
    hashes = F.col("items")["leaf"]
    own = lambda i, k: F.when((F.col("size") == 1) & (F.size("items") == 1), i["tampered"]).otherwise(
        F.unhex(F.sha2(F.concat(_leaf_text(F.slice(hashes, F.lit(1), k)), _hex(i["tampered"]), _leaf_text(F.slice(hashes, k + 2, F.lit(ARITY)))), 256)))
    onward = lambda h, s: F.unhex(F.sha2(F.concat(_hex(s["left"]), _hex(h), _hex(s["right"])), 256))
    item = lambda i, k: F.struct(i[order].alias("id"), i["leaf"].alias("leaf"), F.aggregate("way", own(i, k), onward).alias("folded"))
    # The first step is that of the run itself; its parent has climbed the others. A lone run has no way to go.
    step = F.struct(F.unhex(_text(F.slice("seats", F.lit(1), F.col("seat")))).alias("left"),
                    F.unhex(_text(F.slice("seats", F.col("seat") + 2, F.lit(ARITY)))).alias("right"))
    led = runs.join(ways, (F.col("up_tree") == F.col("c_tree")) & (F.col("up_level") == F.col("c_level")) & (F.col("up_pos") == F.col("c_pos")), "left")
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    led = led.withColumn("way", F.when(F.col("steps").isNull(), none).otherwise(F.concat(F.array(step), "steps")))
    path = F.aggregate("way", F.lit(b""), lambda acc, s: F.concat(acc, s["left"], s["right"]))
    return led.select(
        F.transform("items", item).alias("items"), path.alias("path"),
        F.coalesce(F.when(F.col("is_subroot"), F.col("digest")), F.col("c_subroot")).alias("subroot"), F.coalesce("c_root", "digest").alias("digest"))


def manifest(docs: DataFrame, fields: Sequence[str], group: str, order: str, tampered: Mapping[str, Column]) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of `docs`.

    `tampered` gives the changed value of some fields; a climb starts from the leaf of the changed row and meets the
    original siblings, so exactly the rows that changed are not verified."""
    leaves = materialise(docs.select(
        F.col(order), F.col(group).cast("string").alias(group), leaf_hash([F.col(c) for c in fields]).alias("leaf"),
        leaf_hash([tampered.get(c, F.col(c)) for c in fields]).alias("tampered")), "leaves")
    ended = materialise(climb(*build(leaves, group, order), order), "folded")
    hashes = F.col("items")["leaf"]
    others = F.concat(_leaf_text(F.slice(hashes, F.lit(1), F.col("k"))), _leaf_text(F.slice(hashes, F.col("k") + 2, F.lit(ARITY))))
    folded = _hex(F.col("item.folded"))
    rows = ended.select("items", "path", "subroot", "digest", F.posexplode("items").alias("k", "item"))
    return rows.select(
        F.col("item.id").alias(order), _hex(F.col("item.leaf")).alias("leaf"), "subroot", F.col("digest").alias("root"),
        F.sha2(F.concat(others, _hex(F.col("path"))), 256).alias("proof_sha256"), folded.alias("folded_root"),
        (folded == F.col("digest")).alias("verified"))


# --- The same in DuckDB ----------------------------------------------------------


def _sql_field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_STEP = "xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))"
_CRC = f"""CASE WHEN doc_id IS NULL THEN 0 ELSE xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])), lambda a, b: {_STEP})) END"""

SQL = f"""
WITH RECURSIVE
d AS (SELECT row_number() OVER () AS row, *, CASE WHEN {_CRC} % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END AS changed FROM documents),
hashed AS (SELECT row, doc_id, source, {_sql_leaf('text')} AS leaf, {_sql_leaf('changed')} AS tampered FROM d),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree FROM hashed),
low AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM ranked
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM low WHERE n > 1 GROUP BY tree, level, pos // 16, n),
high AS (
  SELECT CAST(0 AS BIGINT) AS tree, 0 AS level, tree - 1 AS pos, count(*) OVER () AS n, h FROM low WHERE n = 1
  UNION ALL
  SELECT tree, level + 1, pos // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY tree, level, pos // 16, n),
nodes AS (SELECT * FROM low UNION ALL SELECT * FROM high),
runs AS (SELECT tree, level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM nodes WHERE n > 1 GROUP BY 1, 2, 3),
links AS (
  SELECT v.tree, v.level, v.pos, hs, v.pos % 16 AS seat, v.tree AS up_tree, v.level + 1 AS up_level, v.pos // 16 AS up_pos
  FROM nodes v JOIN runs r ON r.tree = v.tree AND r.level = v.level AND r.run = v.pos // 16 WHERE n > 1
  UNION ALL
  SELECT v.tree, v.level, v.pos, hs, (v.tree - 1) % 16, 0, 1, (v.tree - 1) // 16
  FROM nodes v JOIN runs r ON r.tree = 0 AND r.level = 0 AND r.run = (v.tree - 1) // 16 WHERE n = 1 AND v.tree > 0),
climb AS (
  SELECT row, 0 AS step, tree, level, pos, tampered AS f, '' AS proof FROM (SELECT *, 0 AS level FROM ranked)
  UNION ALL
  SELECT row, step + 1, up_tree, up_level, up_pos, sha256(array_to_string(hs[:seat], '') || f || array_to_string(hs[seat + 2:], '')),
         proof || array_to_string(hs[:seat], '') || array_to_string(hs[seat + 2:], '')
  FROM climb c JOIN links l ON c.tree = l.tree AND c.level = l.level AND c.pos = l.pos),
ended AS (SELECT row, arg_max(f, step) AS folded_root, arg_max(proof, step) AS proof FROM climb GROUP BY 1)
SELECT doc_id, leaf, s.h AS subroot, t.h AS root, sha256(proof) AS proof_sha256, folded_root, folded_root = t.h AS verified
FROM ranked JOIN ended USING (row) JOIN (SELECT tree, h FROM low WHERE n = 1) s USING (tree), (SELECT h FROM high WHERE n = 1) t
"""
