"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line goes if an earlier line (by doc_id, then place) equals it or lies within one edit of it: a character put in,
taken out or replaced. Lines shorter than `min_chars` go only if they are equal. Empty lines always stay.

Two lines one edit apart share a deletion variant: a replaced character leaves the same rest at the same place in both;
a line with one character more turns into the shorter line. So lines emit their variants as hashed keys: with the place
of the character taken out for replacements, where all lines that meet are one edit apart and only the earliest of them
is compared with the others; without it for the shorter line and its extensions. Pairs are verified with the edit
distance of the whole lines.

One edit leaves all but one of `PIECES` pieces of a line as they are, cut for the length of the shorter partner. Lines
that share such a rest with no other line have no partner and emit nothing; the others emit the variants of the piece
left out only, under the key of the rest. This loses no pair and keeps a long line from emitting a variant of its
whole length for every character.

Scale: equal lines are reduced to one row before the shuffle; a frequent line, rest or variant is counted by partial
sums, and joined back through joins that can split a hot key. Tables of candidates and of removed places are counted,
and broadcast while they are few, so that neither lines nor texts are shuffled for them.

Defined cases: null texts are kept as they are and have no lines; rows with equal ids are put in order by a hash of the
text, and rows equal in both are one document; a text without line feeds is one line; other columns are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import materialise
from staymill.llm.joins import if_few

PIECES = 4
MIN_CHARS = 20
_POINT = "struct<doc_id:bigint,h:bigint,line:int>"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line, s, k1, k2): the lines that are not empty, with a 128-bit identity."""
    split = docs.select("doc_id", F.xxhash64("text").alias("h"), F.posexplode(F.split("text", "\n")).alias("line", "s"))
    return split.where("s <> ''").withColumn("k1", F.xxhash64("s")).withColumn("k2", F.xxhash64(F.lit(17), "s"))


def _window(n: Column, piece: Column | int) -> tuple[Column, Column]:
    """(characters before, characters in) what key `piece` of a line of n characters leaves out.

    Keys 0 to PIECES - 1 take the line as the shorter partner or an equally long one, the others as the longer one."""
    piece = piece if isinstance(piece, Column) else F.lit(piece)
    longer = (piece >= PIECES).cast("int")
    j, m = piece % PIECES, (n - longer).cast("bigint")
    before = F.floor(m * j / PIECES).cast("int")
    return before, F.floor(m * (j + 1) / PIECES).cast("int") - before + longer


def _rest_keys(s: Column, n: Column) -> Column:
    keys = []
    for piece in range(2 * PIECES):
        before, inside = _window(n, piece)
        keys.append(F.xxhash64(n - piece // PIECES, F.lit(piece % PIECES), F.substring(s, F.lit(1), before), F.substring(s, before + inside + 1, n)))
    return F.array(*keys)


def near_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(lines, gone): distinct lines (k1, k2, first), and the distinct lines (k1, k2) that an earlier near line removes."""
    lines = _lines(docs)
    point = F.struct("doc_id", "h", "line").cast(_POINT)
    n = F.char_length("s")
    # Distinct lines carry the keys of their rests instead of their text.
    keyed = lines.select("k1", "k2", point.alias("point"), F.when(n >= min_chars, _rest_keys(F.col("s"), n)).alias("rests"))
    distinct = materialise(keyed.groupBy("k1", "k2").agg(F.min("point").alias("first"), F.any_value("rests").alias("rests")), "lines")

    rest = distinct.select("k1", "k2", "first", F.posexplode("rests").alias("piece", "rest"))
    shared = rest.groupBy("rest").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("rest")
    spans = materialise(rest.join(if_few(shared, "rests"), "rest"), "spans")
    ids = if_few(spans.select("k1", "k2").distinct(), "ids")
    texts = materialise(lines.select("k1", "k2", "s").join(ids, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]), "candidates")

    before, inside = _window(F.char_length("s"), F.col("piece"))
    windows = spans.join(texts, ["k1", "k2"]).select("k1", "k2", "first", "rest", (F.col("piece") >= PIECES).alias("longer"), F.substring(F.col("s"), before + 1, inside).alias("w"))
    places = windows.where("w <> ''").select("*", F.explode(F.sequence(F.lit(1), F.char_length("w"))).alias("i"))
    variant = F.xxhash64("rest", F.substring(F.col("w"), F.lit(1), F.col("i") - 1), F.lit("\n"), F.substring(F.col("w"), F.col("i") + 1, F.char_length("w")))
    whole = F.xxhash64("rest", F.concat(F.substring(F.col("w"), F.lit(1), F.col("i") - 1), F.substring(F.col("w"), F.col("i") + 1, F.char_length("w"))))

    who = F.struct("first", "k1", "k2")
    # Replaced characters: each line with the earliest of its variant, place and rest.
    same = places.where(~F.col("longer")).select(who.alias("x"), F.xxhash64(variant, "i").alias("v"))
    earliest = same.groupBy("v").agg(F.min("x").alias("y"), F.count(F.lit(1)).alias("m")).where("m > 1").select("v", "y")
    replaced = same.join(earliest, "v").select("x", "y")
    # A character more: the shorter line with each of its extensions.
    short = windows.where(~F.col("longer")).select(who.alias("y"), F.xxhash64("rest", "w").alias("v"))
    extended = places.where("longer").select(who.alias("x"), whole.alias("v")).join(short, "v").select("x", "y")
    pairs = replaced.unionByName(extended).where("x <> y").select(F.greatest("x", "y").alias("late"), F.least("x", "y").alias("early"))
    pairs = pairs.select(F.struct("late.k1", "late.k2").alias("late"), F.struct("early.k1", "early.k2").alias("early")).distinct()
    text = texts.select(F.struct("k1", "k2").alias("id"), "s")
    joined = pairs.join(text.select(F.col("id").alias("late"), "s"), "late").join(text.select(F.col("id").alias("early"), F.col("s").alias("t")), "early")
    gone = joined.where(F.levenshtein("s", "t", 1) >= 0).select("late.k1", "late.k2").distinct()
    return distinct.select("k1", "k2", "first"), materialise(gone, "gone")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, text, n_lines, n_removed) of every row: the text without its removed lines; n_lines counts all lines."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    distinct, gone = near_lines(docs, min_chars)
    fate = distinct.join(gone.withColumn("gone", F.lit(True)), ["k1", "k2"], "left")
    point = F.struct("doc_id", "h", "line").cast(_POINT)
    each = _lines(docs).select("doc_id", "h", "line", "k1", "k2", point.alias("point")).join(fate, ["k1", "k2"])
    drop = each.where(F.col("gone") | (F.col("point") > F.col("first"))).select("doc_id", "h", "line").distinct()
    # Removed places as bit masks of 64 lines, so that a text with many lines is filtered in one pass.
    mask = drop.groupBy("doc_id", "h", F.shiftright("line", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, line & 63))").alias("bits"), F.count(F.lit(1)).alias("n"))
    found = mask.groupBy("doc_id", "h").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"), F.max("word").alias("top"), F.sum("n").alias("n_removed"))
    masks = found.select(
        F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "n_removed",
        F.transform(F.sequence(F.lit(0), F.col("top")), lambda w: F.coalesce(F.try_element_at("words", w), F.lit(0).cast("bigint"))).alias("mask"),
    )
    keyed = docs.withColumn("h", F.xxhash64("text"))
    joined = keyed.join(if_few(masks, "masks"), keyed["doc_id"].eqNullSafe(F.col("_id")) & (keyed["h"] == F.col("_h")), "left")
    lines = F.split("text", "\n")
    word = lambda i: F.coalesce(F.get("mask", F.shiftright(i, 6)), F.lit(0).cast("bigint"))
    stays = lambda s, i: F.getbit(word(i), i % 64) == 0
    text = F.when(F.col("mask").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    count = F.coalesce(F.size(lines), F.lit(0))
    return joined.select("doc_id", text.alias("text"), F.when(F.col("text").isNull(), 0).otherwise(count).cast("bigint").alias("n_lines"), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"))


SQL = f"""
WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents),
f AS (SELECT s, min({{'doc_id': doc_id, 'line': line}}) AS first FROM l WHERE s <> '' GROUP BY s),
v AS (SELECT s, first, unnest(range(1, length(s) + 1)) AS i FROM f WHERE length(s) >= {MIN_CHARS}),
d AS (SELECT s, first, i, s[:i - 1] || s[i + 1:] AS r FROM v),
e AS (SELECT r, i, min(first) AS first FROM d GROUP BY r, i),
gone AS (
  SELECT d.s FROM d JOIN e USING (r, i) WHERE e.first < d.first
  UNION SELECT d.s FROM d JOIN f ON d.r = f.s WHERE f.first < d.first AND length(f.s) >= {MIN_CHARS}
  UNION SELECT f.s FROM d JOIN f ON d.r = f.s WHERE d.first < f.first AND length(f.s) >= {MIN_CHARS}),
kept AS (
  SELECT l.doc_id, l.line, l.s FROM l LEFT JOIN f ON l.s = f.s LEFT JOIN gone g ON g.s = l.s
  WHERE l.s = '' OR (g.s IS NULL AND f.first = {{'doc_id': l.doc_id, 'line': l.line}})),
t AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY line) AS text, count(*) AS n FROM kept GROUP BY doc_id)
SELECT doc_id, CASE WHEN o.text IS NULL THEN NULL ELSE coalesce(t.text, '') END AS text,
       CAST(coalesce(len(string_split(o.text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(string_split(o.text, chr(10))), 0) - coalesce(n, 0) AS BIGINT) AS n_removed
FROM documents o LEFT JOIN t USING (doc_id)
"""
