"""Hashes of words in byte streams."""

import numpy as np
import pytest

from quillbar.llm import common


@pytest.mark.parametrize("stretch", [1, 7, 1 << 16])
def test_equal_words_hash_alike_wherever_they_stand(monkeypatch, stretch):
    monkeypatch.setattr(common, "STRETCH", stretch)
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 100, rng.integers(0, 9)).astype(np.uint8)) for _ in range(500)] + [b"x" * 300, b"\xc3\xa9", b""]
    stream = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    hashes = common.word_hashes(stream, ends)
    known = {}
    for word, value in zip(words, hashes.tolist()):
        assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    monkeypatch.setattr(common, "STRETCH", 1 << 16)
    assert (hashes == common.word_hashes(stream, ends)).all()
    assert len(common.word_hashes(stream[:0], ends[:0])) == 0


def test_words_joined():
    assert common.words_joined(" Ab\tC\x0b\x0cd\r\nÉ ".encode()) == "ab c d É".encode() and common.words_joined(None) == b""
