"""The M-tree against all products."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillbar.llm import mtree

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, every=50, k=5):
    """(query id, rank, id, score) by the definition; rows are told apart by their place."""
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, a) in enumerate(whole):
        if q is None or q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for j, (i, b) in enumerate(whole) if j != at]
        out += [(q, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def found(df):
    return Counter((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("seed,block", [(1, 4096), (2, 200), (3, 90)])
def test_matches_all_products(spark, seed, block):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(9)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(900)]
    rows += [(900 + i, list(rows[3][1])) for i in range(300)]  # copies of one vector, queries among them
    rows += [(1250, [0.0] * 12), (1300, None), (1350, [1.0, None] * 6), (1400, [math.nan] * 12), (1450, [math.inf] + [0.0] * 11), (1500, []), (1550, [2.0, -1.0]),
             (None, rows[3][1]), (None, [3.0] * 12), (1600, rows[5][1]), (1600, rows[5][1]), (-50, rows[7][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).selectExpr("*", "1 AS rank", "2 AS uid", "label AS pivot").repartition(4)
    assert found(mtree.top_k(df, F.col("vec_id") % 50 == 0, block=block)) == brute(rows)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 0), (7, [0.5, 0.5], 0), (100, None, 0)], SCHEMA)
    assert found(mtree.top_k(df, F.col("vec_id") % 50 == 0)) == Counter([(0, 1, 7, 256 * 128 + 512 * 128)])
    assert mtree.top_k(df.limit(0), F.lit(True)).count() == 0
    one = df.filter("vec_id = 0")
    assert mtree.top_k(one, F.lit(True)).count() == 0


def test_large_numbers(spark):
    rows = [(i, [float(2**20 + i), float(i * 2**10), -float(2**18)]) for i in range(60)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert found(mtree.top_k(df, F.col("vec_id") % 50 == 0, block=16)) == brute(rows)
    with pytest.raises(ValueError):
        mtree.top_k(spark.createDataFrame([(0, [1e30], 0), (1, [1.0], 0)], SCHEMA), F.lit(True))


def test_stored_distances_spare_products(monkeypatch):
    """Of well separated clusters a query multiplies with few objects only, and still finds the best."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-5000, 5000, (40, 8))
    vectors = (centres[rng.integers(0, 40, 4000)] + rng.integers(-40, 40, (4000, 8))).astype(np.int32)
    space = mtree.Space(8, int(np.abs(vectors).max()), int((vectors.astype(np.int64) ** 2).sum(1).max()))
    ids = np.arange(4000)
    tree = mtree.build(space, vectors, ids, np.zeros(4000, np.int64), ids, vectors[0], 5)
    done, products = [0], space.products
    monkeypatch.setattr(space, "products", lambda a, b: done.__setitem__(0, done[0] + len(a) * len(b)) or products(a, b))
    total = 0
    for q in range(0, 4000, 400):
        best = mtree.search(space, tree, vectors[q:q + 1], ids[q:q + 1], np.array([-np.inf]), 5)
        score = vectors.astype(np.int64) @ vectors[q].astype(np.int64)
        want = [i for i in np.lexsort((ids, -score)) if i != q][:5]
        assert best.rows[4].tolist() == want
        total += 4000
    assert done[0] < total / 2
