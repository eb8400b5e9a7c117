"""Runs by basic factors against the definition, word by word."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from quillbar.llm import periodic, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, times=4):
    """Every maximal stretch per period, without those that a smaller period explains."""
    n, out, known = len(words), [], {}
    for q in range(1, n // times + 1):
        start = None
        for j in range(n - q + 1):
            if j < n - q and words[j] == words[j + q]:
                start = j if start is None else start
            elif start is not None:
                length = j - start + q
                if length >= max(least, times * q) and not any(q % p == 0 and a <= start and start + length <= a + m for a, m, p in out):
                    out.append((start, length, q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def row_of(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(6))
def test_factor_runs_match_the_definition(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        words = rng.choices("abc"[:rng.choice([1, 2, 3])], k=rng.choice([0, 1, 5, 6, 7, 30, 80]))
        for _ in range(rng.choice([0, 1, 2])):
            root = rng.choices("abcd", k=rng.randint(1, 13))
            at = rng.randint(0, len(words))
            words[at:at] = (root * 9)[:rng.randint(3 * len(root), 8 * len(root))]
        texts.append(words)
    counts, runs, of = periodic.chunk_runs([" ".join(t).encode() for t in texts], 6, 4)
    assert counts.tolist() == [len(t) for t in texts]
    for i, words in enumerate(texts):
        assert list(map(tuple, runs[of == i].tolist())) == brute(words), words


def test_three_periods_and_no_fewer():
    codes = np.array([1, 2, 3, 1, 2, 3, 1, 2, 3, 9], np.uint64)
    assert periodic.factor_runs(codes, 10, 1, 3).tolist() == [[0, 9, 3]]
    with pytest.raises(ValueError):
        periodic.factor_runs(codes, 10, 1, 2)


def test_query_on_the_smallest_table_and_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    short = [(r.doc_id, r.text) for r in docs.collect() if len((r.text or "").split()) <= 1500]
    odd = [(90_000 + i, t) for i, t in enumerate([None, "", " \t\n\x0b", "a", "x " * 50, "A a " * 9, "é ü\x0bé ü  " * 8, "a b c " * 2 + "a", "w" * 200_000, "ab ab  ab\nab ab ab"])]
    odd += [(i, "one two three four five six seven " * 12) for i in range(91_000, 91_040)] + [(None, "y y y y y y y"), (7, "dup"), (7, "dup")]
    odd += [(99_999, " ".join("pqrst"[i % 5] for i in range(30_000)))]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(short + odd, "doc_id bigint, text string").selectExpr("*", "'x' AS runs", "1 AS start", "text AS collapsed").write.parquet(path)
    got = queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = sorted((tuple(r[n] for n in names) for r in got), key=str)
    whole = [r for r in rows if r[0] != 99_999]
    assert whole == sorted((row_of(*x) for x in short + odd[:-1]), key=str)
    long = next(r for r in rows if r[0] == 99_999)
    assert long[1] >= 1 and long[3] >= 20_000


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert periodic.find_runs(none).count() == 0 and periodic.find_runs(none).columns == ["doc_id", "n_words", "runs", "collapsed"]
