"""Word hashes: no structural collisions, no dependence on blocks, bounded memory."""

import tracemalloc

import numpy as np

from staymill.llm import words as W


def _thue_morse(bits, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(1 << bits))


def test_thue_morse_words_differ():
    for bits in (10, 12):
        assert W.hash_word(_thue_morse(bits, "a", "b")) != W.hash_word(_thue_morse(bits, "b", "a"))


def test_equal_spans_hash_alike_wherever_they_lie(monkeypatch):
    data = np.frombuffer(b"xx" + b"Word" * 50 + b"yy" + b"word" * 50, np.uint8)
    start, end = np.array([2, 204, 0, 2, 2]), np.array([202, 404, 2, 2, 201])
    whole = W.hash_spans(data, start, end)
    assert whole[0] == whole[1] and len(set(whole.tolist())) == 4
    assert W.hash_spans(data, start, end, fold=False)[0] != W.hash_spans(data, start, end, fold=False)[1]
    monkeypatch.setattr(W, "_BLOCK", 7)
    assert (W.hash_spans(data, start, end) == whole).all()


def test_permuted_bytes_differ():
    rng = np.random.default_rng(1)
    seen = {bytes(rng.permutation(np.frombuffer(b"aabbccddee", np.uint8))) for _ in range(20000)}
    assert len({W.hash_word(w.decode()) for w in seen}) == len(seen)


def test_a_long_text_needs_little_memory():
    data = np.frombuffer(b"some words of a text " * 400_000, np.uint8)  # 8 MB
    tracemalloc.start()
    W.split_words(data, np.array([0, len(data)]), W.SPACED)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * len(data)
