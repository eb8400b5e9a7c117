"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quillbar.llm import collocations


def brute(rows, least, longest=4, first=2000, percent=80):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        rows = []
        often = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longer = defaultdict(int)
        for p in often:
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    longer[p[s:s + m]] = max(longer[p[s:s + m]], f[p])
        for p in often:
            a = f[p]
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not longer[p] or 100 * longer[p] < percent * a:
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, sizes[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:first])]
    return Counter(out)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{int(rng.expovariate(0.05))}" for _ in range(300)] + ["New", "york", "É", "über", "x"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.choice([0, 1, 3, 40, 120])):
            words.append(rng.choice(["New York city hall", "as well as", "in order to", rng.choice(vocabulary), rng.choice(vocabulary), rng.choice(vocabulary)]))
            words.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ! ", "\x0b"]))
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(words)))
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", " \t\n.;"), ("fr", "seul"), ("long", "a b c d e " * 4000), ("long", "q" * 100_000)]


@pytest.mark.parametrize("seed,least,capacity,chunk", [(1, 30, 1 << 20, 8 << 20), (2, 5, 60, 2000), (3, 12, 7, 500)])
def test_matches_plain_counts(spark, monkeypatch, seed, least, capacity, chunk):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", chunk)
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'x' AS phrase", "1 AS a", "2 AS part").repartition(5)
    got = Counter(tuple(r) for r in collocations.collocations(df, least=least, capacity=capacity, first=50).collect())
    assert got == brute(rows, least, first=50)


def test_several_passes(spark, monkeypatch):
    rows = corpus(9, 150)
    monkeypatch.setattr(collocations, "SURVIVORS_A_PASS", 40)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert Counter(tuple(r) for r in collocations.collocations(df, least=4).collect()) == brute(rows, 4)


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@pytest.mark.parametrize("capacity", [3, 50, 400])
def test_every_frequent_key_survives(capacity):
    rng = np.random.default_rng(capacity)
    keys = np.r_[rng.integers(0, 5000, 30_000), np.repeat(rng.integers(0, 5000, 40), 60)].astype(np.uint32)
    rng.shuffle(keys)
    summary = collocations.Summary(capacity, 30)
    for part in np.array_split(keys, 50):
        summary.add(*np.unique(part, return_counts=True))
    kept, (all_keys, counts) = set(summary.survivors().tolist()), np.unique(keys, return_counts=True)
    assert set(all_keys[counts >= 30].tolist()) <= kept and summary.error < 30


def test_large_counts_stay_exact(spark):
    """The score's product passes 64 bits."""
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([("en", "a b", big, big, 1)], "lang string, phrase string, a bigint, l bigint, r bigint")
    assert df.selectExpr(collocations.SCORE + " AS s").first().s == 2000000 * big // (big + 1)
