"""Queries that SQL cannot say, against plain Python on the smallest tables; accuracy on held-out documents for classifiers."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staymill.functions.hashing import mix
from staymill.llm import catalog, decontaminate, jaccard, linededup, mixture, topk, wavelet

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


@pytest.fixture(scope="module")
def docs(small):
    return pq.read_table(f"{small}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def labels(small):
    return {r["doc_id"]: r for r in pq.read_table(f"{small}/labels.parquet").to_pylist()}


def groups(texts, n, num, den):
    """Component (smallest id) of each id by comparing all pairs that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    holders, shared = defaultdict(list), Counter()
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for held in holders.values():
        shared.update((a, b) for k, a in enumerate(held) for b in held[k + 1 :])
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), c in shared.items():
        if den * c >= num * (len(sets[a]) + len(sets[b]) - c):
            a, b = sorted((root(a), root(b)))
            up[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def test_jaccard_join(spark, small, docs):
    want = groups({d["doc_id"]: d["text"] for d in docs}, 4, 85, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in catalog.QUERIES["op9_jaccard_join"](spark, small).collect()}
    assert got == want and any(c != i for i, (_, c) in want.items())


def test_jaccard_join_many_near_copies(spark):
    """A large group around the threshold, where links among members are missing, and sets of every small size."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(120):
        w = list(base)
        for k in rng.choice(60, rng.integers(0, 3), replace=False):
            w[k] = f"x{rng.integers(0, 6)}"
        texts[i] = " ".join(w)
    for i in range(120, 200):
        texts[i] = " ".join(f"s{rng.integers(0, 3)}" for _ in range(rng.integers(0, 14)))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    for n, num in ((4, 85), (2, 80), (1, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(df, n, num, 100).collect()}
        assert got == groups(texts, n, num, 100)


@pytest.mark.parametrize("num", [80, 85])
def test_linking_sets_share_a_signature(num):
    """100,000 pairs of small sets that differ in as many features as the threshold allows, or in fewer."""
    rng = np.random.default_rng(num)
    bands, missed, linking = jaccard.Bands(num, 100), 0, 0
    for _ in range(10):
        pairs = []
        for size, own, other in zip(rng.integers(4, 17, 10_000), rng.integers(0, 3, 10_000), rng.integers(0, 4, 10_000)):
            grams = rng.integers(0, 2**64, size + own + other, dtype=np.uint64)
            if 100 * size >= num * (size + own + other) and own + other:
                pairs.append((np.sort(grams[: size + own]), np.sort(np.delete(grams, np.s_[size : size + own]))))
        who, sig = jaccard.signatures([s for pair in pairs for s in pair], bands)
        left, right = (np.unique(np.rec.fromarrays([who[who % 2 == i] // 2, sig[who % 2 == i]])) for i in (0, 1))
        shared = np.unique(np.intersect1d(left, right)["f0"])
        missed += len(pairs) - len(shared)
        linking += len(pairs)
    assert linking > 10_000 and missed == 0


def test_lm_scores(spark, small, docs):
    tokens = {d["doc_id"]: [*words(d["text"]), "</s>"] for d in docs}
    train = [i for i in tokens if remainder(i, 5) != 1]
    count = Counter(w for i in train for w in tokens[i])
    pairs = Counter(p for i in train for p in zip(["<s>", *tokens[i]], tokens[i]))
    history, kinds, met = Counter(), defaultdict(Counter), Counter()
    for (h, w), c in pairs.items():
        history[h] += c
        kinds[h][min(c, 3)] += 1
        met[w] += 1

    def discounts(values):
        n = Counter(min(v, 5) for v in values)
        y = n[1] / (n[1] + 2 * n[2])
        return [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]

    high, low = discounts(pairs.values()), discounts(met.values())
    of = Counter(min(v, 3) for v in met.values())
    rest = sum(low[k] * of[k] for k in (1, 2, 3)) / len(pairs)
    n, v = sum(count.values()), len(count)

    def p(h, w):
        p1 = max(met[w] - low[min(met[w], 3)], 0) / len(pairs) + rest / (v + 1)
        if not history[h]:
            return p1
        c = pairs[h, w]
        return (max(c - high[min(c, 3)], 0) + sum(high[k] * kinds[h][k] for k in (1, 2, 3)) * p1) / history[h]

    rows = catalog.QUERIES["op7_lm_score"](spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        t = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(r.doc_id, 5) == 1, len(t), sum(count[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))
        assert r.score == pytest.approx(sum(math.log10(p(h, w)) for h, w in zip(["<s>", *t], t)))


def test_token_ids(spark, small, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(catalog.tokenizer_path())
    at, want = 0, []
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = np.array([*tok.encode(d["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((d["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r) for r in catalog.QUERIES["op10_token_ids"](spark, small).orderBy("doc_id").collect()] == want


def test_encoder_cuts_like_the_tokenizer():
    import pyarrow as pa

    from staymill.llm.words import text_buffer

    enc = wavelet.Encoder(catalog.tokenizer_path())
    texts = ["a\t  b  c\n\n d's it's (foo)! x'tis 12.5, ñandú— “q” 　x", "", "<|endoftext|> hi  ", "   ", "é's ÷5 a×b ² ½x... foo's\n\n\n  bar\r\n baz don't'll 7's.", " ", "᠎ a  b", "A,b;C  'd\n'e f'"]
    want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # new units, then known ones
        assert [x.tolist() for x in enc.encode(*text_buffer(pa.array(texts)))] == want


@pytest.mark.parametrize("n,top", [(1, 1), (63, 2), (1000, 7), (5000, 60_000)])
def test_wavelet_matrix(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint16)
    m = wavelet.WaveletMatrix.build(ids, np.array([5]), np.ones(1, bool), np.array([0, n]))
    m = wavelet.WaveletMatrix.from_bytes(m.to_bytes())
    assert (m.decode() == ids).all() and m.doc_ids.tolist() == [5]
    for i in {0, n // 2, n - 1}:
        token, places = int(ids[i]), np.flatnonzero(ids == ids[i])
        assert m.access(i) == token and m.rank(token, i) == (places < i).sum() and m.count(token) == len(places)
        assert [m.select(token, k) for k in range(min(5, len(places)))] == places[:5].tolist() and m.select(token, len(places)) == -1
    assert m.count(70_000) == 0 == m.count(-1)


def test_top_k_against_numpy(spark):
    rng = np.random.default_rng(3)
    m = rng.integers(-300, 300, (700, 9)) / 64
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<double>")
    index, _ = topk.build_index(topk.quantise(df, "vec_id", "embedding"), block_rows=100)
    assert index.count() == 7
    q = np.floor(64 * m).astype(int)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=9).collect()}
    for i in range(0, 700, 50):
        best = sorted((-int(q[i] @ q[j]), j) for j in range(700) if j != i)[:9]
        assert [got[i, k + 1] for k in range(9)] == [(j, -s) for s, j in best]


def test_line_edits(spark):
    line = "the quick brown fox jumps over the lazy dog again"
    edits = {2: line.replace("quick", "quack"), 3: line + "s", 4: line[:10] + line[11:], 5: line.replace("lazy", "mazes"), 6: line.replace("fox jumps", "jumps fox"), 7: "Über" + line, 8: "Úber" + line}
    df = spark.createDataFrame([(1, f"{line}\n\nshort 1"), *edits.items(), (9, "short 2")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert got == {1: f"{line}\n\nshort 1", 2: "", 3: "", 4: "", 5: edits[5], 6: edits[6], 7: edits[7], 8: "", 9: "short 2"}


def test_proximity(spark):
    far = " ".join(f"f{i}" for i in range(30))
    df = spark.createDataFrame([(1, "gamma beta x alpha"), (2, f"alpha {far} beta gamma"), (3, "alpha beta"), (4, "gamma"), (5, "x alpha beta gamma")], "doc_id long, text string").coalesce(1)
    tests = spark.createDataFrame([(7, "Alpha-beta GAMMA")], "item_id long, text string")
    got = {r.doc_id: (r["items"], r.near_items, r.hit) for r in decontaminate.match(decontaminate.build_index(df), tests, near=5).collect()}
    assert got == {1: ([], [7], []), 2: ([], [], []), 3: ([], [], []), 4: ([], [], []), 5: ([7], [7], [1, 2, 3])}


def test_near_items(spark, small, docs, tmp_path):
    """Every document by brute force; besides the given ones some with passages reordered and stretched by other words."""
    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{small}/benchmark.parquet").to_pylist()]
    rng, rows = np.random.default_rng(6), [(d["doc_id"], d["text"]) for d in docs[:150]]
    for k, (_, text) in enumerate(items):
        w = cut(text)[:10]
        w = [w[i] for i in rng.permutation(len(w))]
        at = int(rng.integers(1, len(w)))
        rows.append((10_000_000 + k, " ".join(["before", *w[:at], *["between"] * int(rng.integers(0, 9)), *w[at:], "after"])))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    windows = {(i, frozenset(w[a : a + 10])) for i, t in items if (w := cut(t)) for a in range(max(1, len(w) - 9))}
    want, near = {}, Counter()
    for doc, text in rows:
        w = cut(text)
        spans = [set(w[a : a + 16]) for a in range(max(1, len(w) - 15))]
        whole = set(w)
        found = sorted({str(i) for i, terms in windows if terms <= whole and any(terms <= s for s in spans)})
        want[doc] = (len(found), hashlib.sha256(",".join(found).encode()).hexdigest())
        near[len(found) > 0] += doc >= 10_000_000
    got = {r.doc_id: (r.n_near_items, r.near_items_sha256) for r in catalog.QUERIES["op6_decontaminate_near"](spark, str(tmp_path)).collect()}
    assert got == want and near[True] > 5 and near[False] > 5


def test_poisson_counts(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "big").otherwise(F.lit("small")).alias("source"), F.lit("t").alias("text"))
    rates = mixture.source_rates(df, {"big": 3.0, "small": 1.0})
    rate = {r.source: r.rate for r in rates.collect()}
    assert rate == {"big": 2.25, "small": 0.375}
    got = Counter(r.doc_id for r in mixture.replicate(df, rates).collect())
    for r in df.select("doc_id", "source", (mix("doc_id", mixture.SEED) / 2147483647.0).alias("u")).collect():
        assert got[r.doc_id] == mixture.poisson_quantile(rate[r.source], r.u)
    assert sum(got.values()) == pytest.approx(3000, rel=0.1)


def test_held_out_accuracy(spark, small, docs, labels):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    found = [r for r in catalog.QUERIES["op4_language"](spark, small).collect() if r.held_out]
    assert {r.doc_id for r in found} == {i for i in lang if remainder(i, 4) == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.95
    rated = [r for r in catalog.QUERIES["op3_quality"](spark, small).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.selected == (labels[r.doc_id]["quality"] == 1) for r in rated]) > 0.8
    scored = [r for r in catalog.QUERIES["op2_toxicity"](spark, small).collect() if r.doc_id in labels]
    toxic = [r.score for r in scored if labels[r.doc_id]["toxic"]]
    clean = [r.score for r in scored if not labels[r.doc_id]["toxic"]]
    assert np.mean(np.array(toxic)[:, None] > np.array(clean)[None, :]) > 0.8


def test_pipeline(spark, small, docs):
    kept = spark.read.parquet(f"{small}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, small).persist()
        seen.append(sorted(r.doc_id for r in kept.select("doc_id").collect()))
        if name == "near_duplicates":
            of = groups({d["doc_id"]: d["text"] for d in docs if d["doc_id"] in set(seen[0])}, 5, 80, 100)
            assert seen[1] == sorted(i for i, (_, c) in of.items() if c == i)
        elif name == "benchmark_passages":
            item = {r.doc_id for r in decontaminate.digest(decontaminate.match(decontaminate.build_index(spark.read.parquet(f"{small}/documents.parquet")), catalog.read(spark, small, "benchmark"))).where("contaminated").collect()}
            assert seen[2] == [i for i in seen[1] if i not in item] and len(seen[2]) < len(seen[1])
    assert seen[4] == seen[3] and set(seen[3]) <= set(seen[2]) and len(seen[0]) >= len(docs) - 2
    rows = corpus_pipeline.run(spark, small)
    assert rows.count() == len(seen[4])


def test_top_k_of_wide_components_and_repeated_ids(spark):
    """Components up to the ends of 64 bits and ids on several rows, against Python's integers."""
    rng = np.random.default_rng(11)
    sizes = [1.0, 1e3, 2e6, 1e12, 1e17]
    rows = [(int(rng.integers(0, 60)), [float(x) for x in rng.normal(size=4) * sizes[i % 5]]) for i in range(150)]
    rows += [(70, [1.0, 2.0, 3.0, 4.0])] * 40 + [(0, [2e6, 0.0]), (1, [2e6, 0.0]), (80, [3.0, 0.0]), (80, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cut = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    whole = [(i, [cut(math.floor(64 * x)) for x in v]) for i, v in rows]
    want = defaultdict(list)
    for q, a in whole:
        if q % 20 == 0:
            want[q] += [(-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q]
    flat = [(q, n + 1, i, cut(-s)) for q, found in want.items() for n, (s, i) in enumerate(sorted(found)[:30])]
    got = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=30, every_row=True)
    assert sorted(tuple(r) for r in got.collect()) == sorted(flat)
