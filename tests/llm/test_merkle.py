"""The manifest against a plain recursive version: groups of any size, ties, nulls, repeated rows, small blocks."""

import hashlib

import pytest
from pyspark.sql import functions as F

from staymill.llm import merkle

SCHEMA = "doc_id long, source string, text string, tree int, pos string"
FIELDS = ["doc_id", "source", "text"]


def _h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _leaf(values):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _above(hashes):
    """Levels of a tree, from the given hashes to its single node."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def _brute(rows):
    groups = {}
    for doc_id, source, text in rows:
        leaf, tampered = _leaf([doc_id, source, text]), _leaf([doc_id, source, text and text.translate(str.maketrans(merkle.UPPER, merkle.LOWER))])
        groups.setdefault((source is not None, source or ""), []).append(((doc_id is not None, doc_id or 0), leaf, tampered, doc_id))
    order = sorted(groups, key=lambda g: (g[0], g[1].encode()))
    trees = [_above([r[1] for r in sorted(groups[g], key=lambda r: r[:2])]) for g in order]
    top = _above([t[-1][0] for t in trees])
    out = []
    for t, g in enumerate(order):
        for place, (_, leaf, folded, doc_id) in enumerate(sorted(groups[g], key=lambda r: r[:2])):
            proof, at = "", place
            for levels, at in ((trees[t], place), (top, t)):
                for level in levels[:-1]:
                    run, seat = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    left, right = "".join(run[:seat]), "".join(run[seat + 1 :])
                    proof, folded, at = proof + left + right, _h(left + folded + right), at // 16
            out.append((doc_id, leaf, trees[t][-1][0], top[-1][0], _h(proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def _run(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(5)
    got = merkle.manifest(docs, FIELDS, "source", "doc_id", {"text": F.translate("text", merkle.UPPER, merkle.LOWER)})
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def _rows(sizes):
    return [(i * 7 % 1000, s, f"Text {i}" if i % 3 else f"text {i}") for s, n in sizes.items() for i in range(n)]


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17}, {"a": 300}, {"a": 1, "b": 1}, {None: 18, "": 2, "é": 1, "z": 33}, {f"s{i:03d}": 1 + i % 3 for i in range(40)},
])
def test_equals_the_plain_version(spark, sizes):
    assert _run(spark, _rows(sizes)) == _brute(_rows(sizes))


def test_nodes_are_laid_down_per_block(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 32)  # the nodes near the root get many copies
    rows = _rows({"a": 290, "b": 3, "c": 40})
    assert _run(spark, rows) == _brute(rows)


def test_nulls_ties_repeats_long_texts(spark):
    rows = [(None, None, None), (None, None, None), (1, "a", "X"), (1, "a", "X"), (1, "a", "Y"), (2, "a", ""), (3, "b", "Ä" * 300_000), (None, "a", "Q")] * 3
    assert _run(spark, rows) == _brute(rows)


def test_an_empty_table_has_no_rows(spark):
    assert _run(spark, []) == []


def test_the_climb_carries_no_leaves(spark, monkeypatch):
    """One way per node above the runs, not one row with all hashes per run and level."""
    written, plain = {}, merkle.materialise
    monkeypatch.setattr(merkle, "materialise", lambda df, name: written.setdefault((name, len(written)) if name in written else name, plain(df, name)))
    rows = _rows({"a": 600, "b": 3, "c": 40})
    assert _run(spark, rows) == _brute(rows)
    assert "items" not in written["climbed"].columns
    assert written["climbed"].count() <= 3 + 1 + 1  # 600 / 256, 40 / 256, the top
