"""Exact Jaccard self-join of word n-gram sets with PartEnum signatures, and its connected groups.

Sets are put into bands of sizes so that two sets that can link lie in the same or in neighbouring bands. For a band
the domain of n-gram hashes is cut into partitions. Two sets that link differ in at most k features, k following from
their sizes, hence in at most k partitions. Each set enumerates k + 1 of its projections: those with the most
features, ties by content. Of two linking sets take the one whose last enumerated projection ranks higher: one of its
k + 1 projections is the same in the other set, which enumerates it too, as it ranks high enough. The poorest
projections, which unrelated sets share by chance, are left out.

Empty partitions are projections as well, of the lowest rank. The argument can end in one of them only if both sets
have no more than k partitions with features. Such sets do not enumerate what is empty, which says nothing about them,
but the features of their prefix: of a set of a features at least o are in any partner, so the first a - o + 1
by hash hold the first common one, in both sets. So linking sets always share a signature.

Equal sets are one node from the start. A signature held by several nodes makes a group. Groups are never expanded
into pairs: every node is compared with one representative of each of its groups; what is then connected needs no
further comparison. Only for groups that then still hold several components are sets brought together, in blocks of
bounded size; there, nodes of different components that the triangle inequality of the Jaccard distance does not tell
apart are compared, and one link per node and component is passed on.

Scale: signatures are counted in hashed parts of bounded size. A map task sends on one holder per signature; if it
has more holders itself it passes them by, so the most frequent signature costs each part one entry per map task.
Texts are read for the signatures and once more for the sets of nodes in groups.

Sets are told apart by 64-bit hashes of their n-grams. A text with fewer words than n is one n-gram.

Defined cases: texts that are null or without words have no set and link with nothing; rows with equal ids are
separate documents; other columns are not read; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staymill.functions.session import TEXT_ROWS, materialise
from staymill.llm.words import SPACED, chunks, mix, runs, split_words, text_buffer
from staymill.plans.components import connected_components

PART_ENTRIES = 2_000_000  # signatures in a part
FLUSH_ENTRIES = 1_000_000  # signatures a map task gathers before it sends them on
BLOCK_NODES = 512  # nodes of a group that are compared at once with as many
FILTER_BITS = 27  # size of the filter of nodes whose sets are wanted: 16 MB, whatever their number


def shingle_sets(chunk: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text of the chunk."""
    words = split_words(*text_buffer(chunk.column("text")), SPACED)
    h, bounds = words.hash, words.bounds.tolist()
    factor = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * j + 3, 2**64)) for j in range(n)]
    if len(h) >= n:
        grams = mix(sum((h[j : len(h) - n + 1 + j] * factor[j] for j in range(1, n)), h[: len(h) - n + 1] * factor[0]) + np.uint64(n))
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(mix(np.array([sum(int(x) * int(f) for x, f in zip(h[a:b], factor)) + b - a & (1 << 64) - 1], np.uint64)))
        else:
            out.append(h[:0])
    return out


def node_of(grams: np.ndarray) -> int:
    """Hash of a set, as a signed 64-bit integer."""
    return int(mix(np.array([mix(grams).sum(dtype=np.uint64) + np.uint64(len(grams))], np.uint64)).view(np.int64)[0])


class Bands:
    """Bands of set sizes for the threshold num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.high = [0]  # high[i]: the largest size in band i; bands count from 1

    def reach(self, size: np.ndarray) -> np.ndarray:
        """Largest size that a set can link with."""
        return size * self.den // self.num

    def differ(self, total: np.ndarray) -> np.ndarray:
        """Most features in which two linking sets with `total` features together can differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def spare(self, size: np.ndarray) -> np.ndarray:
        """Most features of a set that a linking set can lack."""
        return size * (self.den - self.num) // self.den

    def of(self, sizes: np.ndarray) -> np.ndarray:
        while self.high[-1] < int(sizes.max(initial=0)):
            self.high.append((self.high[-1] + 1) * self.den // self.num)
        return np.searchsorted(np.array(self.high), sizes)


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(index of the set, signature) for every enumerated projection."""
    size = np.array([len(s) for s in sets], np.int64)
    if not size.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    spread, top = mix(flat), flat >> np.uint64(32)
    band = bands.of(size)
    high = np.array(bands.high + [0])
    found = []
    for upper in (0, 1):  # partners in the own band or below it; partners in the next band
        cell = band + upper
        widest = np.where(cell < len(bands.high), high[np.minimum(cell, len(bands.high))], (high[band] + 1) * bands.den // bands.num)
        k = bands.differ(size + (bands.reach(size) if upper else np.minimum(bands.reach(size), widest)))
        partitions = ((bands.differ(2 * widest) + 1) * 5 + 3) // 4  # a quarter more than any set of the cell enumerates
        part = (top * partitions[owner].astype(np.uint64)) >> np.uint64(32)
        place = runs((owner.astype(np.uint64) << np.uint64(32)) | part)  # sets are sorted, so partitions are runs
        count = np.diff(np.append(place, len(flat)))
        who = owner[place]
        content = mix(np.add.reduceat(spread, place) + mix((cell[who].astype(np.uint64) << np.uint64(32)) | part[place]))
        rank = (np.minimum(count, 4095) ^ 4095).astype(np.uint64) << np.uint64(32) | (content >> np.uint64(32))
        key = (who.astype(np.uint64) << np.uint64(44)) | rank
        order = np.argsort(key)
        first = np.searchsorted(who, np.arange(len(sets)))  # `who` ascends
        have = np.bincount(who, minlength=len(sets))
        last = key[order][np.minimum(first + np.minimum(k, have - 1), len(key) - 1)]  # each set's last enumerated rank
        take = (key <= last[who]) & (k[who] > 0)  # sets that may not differ at all are one node already
        found.append((who[take], content[take]))
        nth = np.arange(len(flat)) - (np.cumsum(size) - size)[owner]
        few = ((have <= k) & (k > 0))[owner] & (nth <= bands.spare(size)[owner])
        found.append((owner[few], mix(spread[few] + mix((cell[owner[few]].astype(np.uint64) << np.uint64(32)) | np.uint64(0xFFFFFFFF)))))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _blocks(batches: Iterator[pa.RecordBatch], n: int, bands: Bands, parts: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    seen: set[int] = set()
    entries = turn = 0

    def row(part: int, through: bool, sig: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": [part], "through": [through], "sig": [sig.tobytes()], "node": [node.tobytes()]})

    def send() -> Iterator[pa.RecordBatch]:
        nonlocal held, entries, turn
        sig, node = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        held, entries = [], 0
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        place = runs(sig)
        count = np.diff(np.append(place, len(sig)))
        several = np.repeat(count > 1, count)
        if several.any():
            turn += 1
            yield row(turn * 7919 % parts, True, sig[several], node[several])
        sig, node = sig[place], node[place]
        cuts = np.searchsorted(sig, np.array([p * 2**64 // parts for p in range(1, parts)], np.uint64))
        for p, (s, d) in enumerate(zip(np.split(sig, cuts), np.split(node, cuts))):
            if len(s):
                yield row(p, False, s, d)

    for chunk in chunks(batches):
        fresh = []
        nodes = []
        for s in shingle_sets(chunk, n):
            if len(s) and (node := node_of(s)) not in seen:
                seen.add(node)
                fresh.append(s)
                nodes.append(node)
        who, sig = signatures(fresh, bands)
        if len(who):
            held.append((sig, np.array(nodes, np.int64)[who]))
            entries += len(sig)
        if entries >= FLUSH_ENTRIES:
            yield from send()
            seen.clear()
    if held:
        yield from send()


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Signatures of a part that several nodes hold, with these nodes, and what map tasks passed by."""
    sig = np.concatenate([np.frombuffer(b, np.uint64) for b, t in zip(pdf["sig"], pdf["through"]) if not t] or [np.zeros(0, np.uint64)])
    node = np.concatenate([np.frombuffer(b, np.int64) for b, t in zip(pdf["node"], pdf["through"]) if not t] or [np.zeros(0, np.int64)])
    order = np.argsort(sig)
    sig, node = sig[order], node[order]
    place = runs(sig)
    count = np.diff(np.append(place, len(sig)))
    # A signature met by several map tasks, unless all of them met the same node.
    low, high = (np.minimum.reduceat(node, place), np.maximum.reduceat(node, place)) if len(sig) else (node, node)
    keep = np.repeat((count > 1) & (low < high), count)
    past = [(np.frombuffer(s, np.uint64), np.frombuffer(d, np.int64)) for s, d, t in zip(pdf["sig"], pdf["node"], pdf["through"]) if t]
    out = pd.DataFrame({"sig": np.concatenate([sig[keep], *(p[0] for p in past)]).view(np.int64), "node": np.concatenate([node[keep], *(p[1] for p in past)])})
    return out.drop_duplicates()


def _slot(node: np.ndarray) -> np.ndarray:
    return node.view(np.uint64) >> np.uint64(64 - FILTER_BITS)


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """Bitmap of the leading bits of the nodes; collected as words, of which there are 2^21 at most."""
    slot = F.shiftrightunsigned("node", 64 - FILTER_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(node, {64 - FILTER_BITS}) & 63 as int))")
    words = nodes.select(F.shiftright(slot, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def _rows(batches: Iterator[pa.RecordBatch], n: int, wanted) -> Iterator[pa.RecordBatch]:
    bitmap, sent = wanted.value, set()
    for chunk in chunks(batches):
        sets = shingle_sets(chunk, n)
        nodes = np.array([node_of(s) if len(s) else 0 for s in sets], np.int64)
        slot = _slot(nodes)
        inside = (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)
        grams: list[bytes | None] = []
        for node, s, yes in zip(nodes.tolist(), sets, inside.tolist()):
            send = bool(yes) and len(s) > 0 and node not in sent
            if send:
                sent.add(node)
            grams.append(s.tobytes() if send else None)
        if len(sent) > 100_000:
            sent.clear()
        sizes = np.array([len(s) for s in sets], np.int64)
        yield pa.RecordBatch.from_pydict({
            "doc_id": chunk.column("doc_id"), "text_hash": chunk.column("text_hash"), "n_shingles": pa.array(sizes), "node": pa.array(nodes, mask=sizes == 0), "grams": pa.array(grams, pa.binary()),
        })


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        linked, apart = [], []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if len(s) > len(t):
                s, t = t, s
            both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            union = len(s) + len(t) - both
            linked.append(den * both >= num * union)
            apart.append(1 - both / union)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "linked": pa.array(linked, pa.bool_()), "apart": pa.array(apart, pa.float64())})


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, linked, apart) of pairs of nodes, from their whole sets; written to the shared folder."""
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialise(joined.mapInArrow(lambda it: _compare(it, num, den), "a long, b long, linked boolean, apart double"), "compared")


def _between(key: tuple, pdf: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links between members of two blocks (or of one) with different labels; one for each member and label is enough."""
    pdf = pdf.sort_values("node")
    node, label, apart, own = (pdf[c].to_numpy() for c in ("node", "label", "apart", "own"))
    sets = [np.frombuffer(g, np.uint64) for g in pdf["grams"]]
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    kinds, count = np.unique(label, return_counts=True)
    most = kinds[count.argmax()]  # its members are met from the other side
    links = []
    for u in np.flatnonzero(label != most):
        able = (label != label[u]) & (np.abs(apart - apart[u]) <= 1 - num / den + 1e-9) & (size * num <= size[u] * den) & (size[u] * num <= size * den)
        if key[1] != key[2]:
            able &= own != own[u]
        if not able.any():
            continue
        low, high = np.searchsorted(flat, sets[u], "left"), np.searchsorted(flat, sets[u], "right")
        width = high - low
        at = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(width.sum())
        both = np.bincount(owner[at], minlength=len(sets))
        hit = np.flatnonzero(able & (den * both >= num * (size + size[u] - both)))
        _, one = np.unique(label[hit], return_index=True)
        links += [(min(node[u], node[v]), max(node[u], node[v])) for v in hit[one]]
    return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def similar_groups(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, text_hash, label) of every row: links are den * |x and y| >= num * |x or y|.

    `label` names the component even where ids repeat; it is null for texts without words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    spark, bands = docs.sparkSession, Bands(num, den)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(12, size // 16 // PART_ENTRIES)  # about one signature for 20 bytes of text
    blocks = docs.mapInArrow(lambda it: _blocks(it, n, bands, parts), "part long, through boolean, sig binary, node binary")
    members = materialise(blocks.groupBy("part").applyInPandas(_shared, "sig long, node long").distinct(), "members", batch_rows=TEXT_ROWS)

    # One group for each distinct set of holders; a group of two is its pair.
    groups = members.groupBy("sig").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("h"))
    groups = materialise(groups.where("n > 1").groupBy("a", "b", "n", "h").agg(F.min("sig").alias("sig")), "groups")
    large = materialise(members.join(groups.where("n > 2").select("sig", F.col("a").alias("rep")), "sig"), "large")
    wanted = spark.sparkContext.broadcast(_node_filter(members.select("node")))
    rows = materialise(docs.mapInArrow(lambda it: _rows(it, n, wanted), "doc_id long, text_hash long, n_shingles long, node long, grams binary"), "rows", batch_rows=TEXT_ROWS)
    sets = materialise(rows.where(F.col("grams").isNotNull()).select("node", "n_shingles", "grams").dropDuplicates(["node"]), "sets")

    star = large.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    tested = _verify(groups.where("n = 2").select("a", "b").unionByName(star).distinct(), sets, num, den)
    # Once more with another representative, for nodes that the first one has not brought to the same neighbour.
    links = tested.where("linked").select("a", "b")
    lowest = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    now = materialise(_labelled(large, lowest), "labelled")
    order = F.xxhash64("node")
    other = now.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max_by(F.struct("node", "label"), order).alias("r"))
    more = now.join(other.where("low < high").select("sig", "r"), "sig").where(F.col("label") != F.col("r.label"))
    more = more.select(F.least("node", "r.node").alias("a"), F.greatest("node", "r.node").alias("b")).distinct()
    tested = tested.unionByName(_verify(more.join(tested, ["a", "b"], "left_anti"), sets, num, den))
    labels = connected_components(tested.where("linked").select("a", "b"))

    # Whatever is left: groups that hold several components, by representative, in blocks that are compared with each other.
    now = _labelled(large, labels).select("rep", "node", "label").distinct()
    open_ = now.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    blocks = F.ceil(F.col("n") / BLOCK_NODES).cast("int")
    far = tested.select(F.col("a").alias("rep"), F.col("b").alias("node"), "apart")
    side = now.join(open_.select("rep", blocks.alias("blocks")), "rep").join(far, ["rep", "node"], "left").join(sets, "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    spread = side.select("rep", "node", "label", F.coalesce("apart", F.lit(0.0)).alias("apart"), "grams", own.alias("own"), F.inline(cells))
    rest = materialise(spread.groupBy("rep", "i", "j").applyInPandas(lambda key, pdf: _between(key, pdf, num, den), "a long, b long"), "rest")
    if not rest.isEmpty():
        labels = connected_components(tested.where("linked").select("a", "b").unionByName(rest))

    held = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "text_hash", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = held.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    linked = held.join(lowest, "label").select("doc_id", "n_shingles", "component_id", "text_hash", "label")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.lit(None).cast("long").alias("label"))
    return linked.unionByName(alone)
