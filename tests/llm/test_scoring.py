"""Context-tree weighting and the word model against plain Python that codes symbol by symbol."""

import math
import re
import zlib
from collections import Counter

import pytest

from quillbar.llm import scoring

TEXTS = ["the cat sat on the mat", "the cat sat on the hat", None, "", "The  Cat\tsat\n on", "ünïcode wörds 😀 the cat", "the the the the", "a",
         "mat hat cat sat the", "zzz qqq", " \n ", "the cat sat on the mat", "x" * 300 + " the end"] * 3


class Tree:
    """Counts per (context, bits so far), trained on symbol strings; probabilities by the recursion as written."""

    def __init__(self, depth):
        self.depth, self.n, self.kids, self.memo = depth, {}, {}, {}

    def add(self, context, symbol):
        for j in range(8):
            node, bit = (1 << j) | (symbol >> (8 - j)), symbol >> (7 - j) & 1
            for d in range(self.depth + 1):
                c = context[self.depth - d:]
                self.n.setdefault((c, node), [0, 0])[bit] += 1
                if d:
                    self.kids.setdefault((c[1:], node), set()).add((c, node))

    def log_kt(self, key):
        a, b = self.n.get(key, (0, 0))
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    def log_pw(self, key):
        if key not in self.memo:
            kt = self.log_kt(key)
            if len(key[0]) < self.depth:
                rest = sum(self.log_pw(k) for k in self.kids.get(key, ()))
                kt = max(kt, rest) + math.log1p(math.exp(-abs(kt - rest))) - math.log(2)
            self.memo[key] = kt
        return self.memo[key]

    def log_p(self, context, symbol):
        out = 0.0
        for j in range(8):
            node, bit = (1 << j) | (symbol >> (8 - j)), symbol >> (7 - j) & 1
            p = None
            for d in range(self.depth, -1, -1):
                key = (context[self.depth - d:], node)
                if key not in self.n and d:
                    continue
                counts = self.n.get(key, (0, 0))
                own = (counts[bit] + .5) / (sum(counts) + 1)
                w = math.exp(self.log_kt(key) - math.log(2) - self.log_pw(key)) if d < self.depth else 1.0
                p = own if p is None else w * own + (1 - w) * p
            out += math.log(p)
        return out


def expected(rows):
    depth = scoring.DEPTH
    held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows]
    words = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    tree, counts, tokens, ends = Tree(depth), Counter(), 0, 0
    strings = [" ".join(w).encode() + b"\xff" for w in words]
    for h, w, s in zip(held, words, strings):
        if not h:
            counts.update(w), counts.update(["\xff end"])
            tokens += len(w) + 1
            padded = b"\xff" * depth + s
            for k in range(len(s)):
                tree.add(padded[k:k + depth], s[k])
    out = []
    for (i, _), h, w, s in zip(rows, held, words, strings):
        every = [*w, "\xff end"]
        base = sum(math.log10((counts[x] + 1) / (tokens + len(counts) + 1)) for x in every)
        padded = b"\xff" * depth + s
        ln = sum(tree.log_p(padded[k:k + depth], s[k]) for k in range(len(s)))
        out.append((i, h, len(every), sum(counts[x] > 0 for x in every), tokens, base, ln / math.log(10)))
    return out


def compare(spark, rows, **settings):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted([tuple(r)[:7] for r in scoring.score(df).collect()], key=str)
    want = sorted(expected(rows), key=str)
    assert len(got) == len(want)
    got.sort(key=lambda r: (str(r[0]), r[2], round(r[6], 4))), want.sort(key=lambda r: (str(r[0]), r[2], round(r[6], 4)))
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-6, abs=1e-6)


def test_scores_match_symbol_by_symbol(spark):
    compare(spark, [*enumerate(TEXTS), (None, "the cat"), (4, "repeated id"), (4, "repeated id")])


@pytest.mark.parametrize("long_root", [1, 256])
def test_many_blocks(spark, monkeypatch, long_root):
    """A block per document, merged two at a time in several rounds, below contexts of two or three bytes, a few pairs at a time."""
    for name, size in (("GROUP_BLOCKS", 2), ("BLOCK_BYTES", 0), ("SLICE", 3), ("LONG_ROOT_BLOCKS", long_root)):
        monkeypatch.setattr(scoring, name, size)
    compare(spark, [*enumerate(TEXTS)][:20])


def test_slices_hold_whole_subtrees(monkeypatch):
    import numpy as np

    keys = np.sort(np.random.default_rng(3).integers(-2**63, 2**63 - 1, 500) >> 50 << 50)
    shift = 8 * (scoring.DEPTH - 1)
    for size in (1, 7, 100, 1000):
        monkeypatch.setattr(scoring, "SLICE", size)
        cuts = [*scoring._slices(keys, 2)]
        assert [a for a, _ in cuts] == [0, *[b for _, b in cuts[:-1]]] and cuts[-1][1] == len(keys)
        assert all(keys[a - 1] >> shift != keys[a] >> shift for a, _ in cuts[1:])
        assert size < 1000 or len(cuts) == 1


def test_small_blocks_and_pieces(spark, monkeypatch):
    """Cuts inside documents and chunks change nothing."""
    for name, size in (("PIECE_BYTES", 7), ("CHUNK_BYTES", 16)):
        monkeypatch.setattr(scoring, name, size)
    text = [t.encode() if t else b"" for t in TEXTS]
    for t in text:
        s = scoring.words_joined(t) + b"\xff"
        assert b"".join(scoring._cut(s)) == s
    leads, bodies = [b"\xff" * scoring.DEPTH] * len(text), [scoring.words_joined(t) + b"\xff" for t in text]
    small = [sorted(k.tolist()) for _, k, _, _ in scoring._chunks(leads, bodies)]
    monkeypatch.setattr(scoring, "CHUNK_BYTES", 1 << 20)
    large = [sorted(k.tolist()) for _, k, _, _ in scoring._chunks(leads, bodies)]
    assert sorted(sum(small, [])) == sorted(sum(large, []))


def test_all_held_out_and_empty(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    compare(spark, [(i, "some text") for i in held])
    assert scoring.score(spark.createDataFrame([], "doc_id bigint, text string, extra int")).count() == 0


@pytest.mark.parametrize("root", [2, 3])
def test_probabilities_add_up(monkeypatch, root):
    """Over all next bytes after a context, the tree's probabilities sum to one."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    letters = [97 + rng.integers(0, k, 300) for k in (2, 3, 3, 3, *[2] * (scoring.DEPTH - 4), 6)]
    keys, n = np.unique(sum(x.astype(np.int64) << 8 * (scoring.DEPTH - i) for i, x in enumerate(letters)), return_counts=True)
    context = int(keys[5]) >> 8
    every = np.union1d(keys, (context << 8) | np.arange(256))
    counts = np.where(np.isin(every, keys), n[np.searchsorted(keys, np.minimum(every, keys[-1]))], 0)
    frame = pd.DataFrame({"id": [0], "part": [0], "n": [len(every)], "keys": [scoring._pack_keys(every)], "counts": [scoring._pack(counts)]})
    monkeypatch.setattr(scoring, "SLICE", 50)
    roots = pd.concat(scoring._roots(iter([frame]), root))
    byte = [group for _, group in roots.groupby((roots.key.to_numpy() >> 8 * root) & 255)]
    ones = scoring._to_none(pd.concat([scoring._to_one(rows, root) for rows in byte]))
    out = scoring._log_probabilities(frame, pd.concat([scoring._top(rows, ones, root) for rows in byte]), root)
    value = scoring._unpack(out["values"].iloc[0], len(every), np.float32)
    assert np.exp(value[every // 256 == context].astype(float)).sum() == pytest.approx(1.0, abs=1e-6)


def test_packed_arrays():
    import numpy as np

    rng = np.random.default_rng(2)
    for keys in (np.sort(rng.integers(-2**63, 2**63 - 1, 1000)), np.arange(5), np.zeros(0, np.int64)):
        assert (scoring._unpack_keys(scoring._pack_keys(keys), len(keys)) == keys).all()
    values = rng.normal(size=77).astype(np.float32)
    assert (scoring._unpack(scoring._pack(values), 77, np.float32) == values).all()
