"""Memory of text scans: rows handed to Python at once, and the units a token worker keeps."""

import pyarrow as pa
import pytest

from staymill.functions.session import materialise
from staymill.llm import catalog, decontaminate, jaccard, wavelet
from staymill.llm.words import text_buffer

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_are_bounded_and_the_setting_comes_back(spark):
    def counted(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    before = spark.conf.get(KEY)
    sizes = spark.range(5000).coalesce(1).mapInArrow(counted, "n long")
    assert max(r["n"] for r in materialise(sizes, "sizes", batch_rows=700).collect()) == 700
    with pytest.raises(Exception):
        materialise(spark.range(3).selectExpr("raise_error('x')"), "sizes", batch_rows=7)
    assert spark.conf.get(KEY) == before


@pytest.mark.parametrize("scan", [decontaminate.build_index, jaccard.similar_groups, lambda d: wavelet.token_shards(d, catalog.tokenizer_path())])
def test_text_scans_take_few_rows_at_once(spark, monkeypatch, scan):
    seen = []
    for module, name in ((decontaminate, "materialise"), (jaccard, "materialise"), (wavelet, "arrow_rows")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, plain=plain, **k: (seen.append(k.get("batch_rows", a[1])), plain(*a, **k))[1])
    scan(spark.createDataFrame([(i, f"one two three four five six {i}") for i in range(5)], "doc_id long, text string"))
    assert 1000 in seen


def test_the_next_task_knows_the_units_of_the_last(monkeypatch):
    monkeypatch.setattr(wavelet, "_kept", {})
    calls, plain = [], wavelet.Encoder._encode
    monkeypatch.setattr(wavelet.Encoder, "_encode", lambda self, texts: (calls.append(len(texts)), plain(self, texts))[1])
    texts = text_buffer(pa.array(["one two, three", "two (four)"]))
    got = [[x.tolist() for x in wavelet.Encoder(catalog.tokenizer_path()).encode(*texts)] for _ in range(2)]
    assert got[0] == got[1] and len(calls) == 1


def test_units_are_bounded_and_ids_stay_right(monkeypatch):
    monkeypatch.setattr(wavelet, "_kept", {})
    monkeypatch.setattr(wavelet, "CACHE_UNITS", 20)
    monkeypatch.setattr(wavelet, "LONG_UNIT", 4)
    enc = wavelet.Encoder(catalog.tokenizer_path())
    for k in range(12):
        texts = [f"common word{k} and{k * 7} {'x' * 40 * k}, {i}" for i in range(5)] + ["", "é! a\tb"]
        want = [e.ids for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [x.tolist() for x in enc.encode(*text_buffer(pa.array(texts)))] == want
    enc.units.shrink()
    assert len(enc.units.keys) == len(enc.units.uses) == len(enc.units.first) - 1 <= 20
    assert enc.units.first[-1] == len(enc.units.flat)


def test_bytes_that_are_no_utf8():
    import numpy as np

    raw = np.frombuffer(b"abc \xff\xfe def, \xc3", np.uint8)
    enc = wavelet.Encoder(catalog.tokenizer_path())
    whole = enc.encode(raw, np.array([0, len(raw)]))[0].tolist()
    assert whole == enc.tokenizer.encode(raw.tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids


def test_postings_are_written_with_the_denser_codec(spark, small):
    from pathlib import Path

    import pyarrow.parquet as pq

    index = decontaminate.build_index(catalog.read(spark, small, "documents"))
    files = [Path(f.removeprefix("file://")) for f in index.inputFiles()]
    chunks = [pq.ParquetFile(f).metadata.row_group(0).column(c) for f in files if pq.ParquetFile(f).num_row_groups for c in range(7)]
    assert {c.compression for c in chunks} == {"ZSTD"}
