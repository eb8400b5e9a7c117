"""Exact top-k by inner product with an M-tree whose subtrees are spread over the cluster.

Inner products are no metric, so every vector x gets one more component, sqrt(M - x.x), where M is the largest squared length. All objects
then have the same length, and a query q, with 0 there, has distance d(q, x)^2 = q.q + M - 2 q.x: the nearest objects are those of the
highest products. Products are exact integers; distances only decide what is passed over, with a margin for rounding.

1. ``PIVOTS`` routing objects at most, drawn from a bounded sample, are the root. Each row goes to the nearest one; the rows of a routing
   object are cut into blocks of about ``BLOCK`` rows, and each block becomes a subtree in one task: nodes of ``PAGE`` entries, each with
   its covering radius and the distance to its parent. Equal vectors share an entry that lists the first k + 1 of them: no more can rank.
2. Each query first searches the subtree that it lies in, so it leaves with a k-th best score.
3. With that score it goes to the subtrees whose routing object and covering radius can still hold a better one, and searches there.
   The queries of a block travel and search together: the node with the nearest bound comes first, each query drops out of a node
   as soon as its own bound says so, and stored parent distances spare products with entries that cannot rank.
4. The best k of what the subtrees found are the answer.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillbar.llm.common import Scratch

BLOCK, PAGE = 4096, 64
SAMPLE, PIVOTS = 8192, 1024  # rows that the root's routing objects are drawn from, and their number at most
TOGETHER = 256  # queries that search together
SPREAD = 64  # groups of queries that one task holds beside a subtree
_HIT = "quid bigint, query_id bigint, score bigint, vec_id bigint, uid bigint"


class Space:
    """Products and distances of integer vectors, all padded to ``dim`` components; ``top`` is the largest squared length."""

    def __init__(self, dim: int, largest: int, top: int):
        self.dim, self.top = max(1, dim), top
        bound = self.dim * largest * largest
        if bound >= 2**62:
            raise ValueError("scores of these vectors pass 64 bits")
        # Whole numbers below 2^53 multiply and add up exactly as doubles.
        self.kind, self.stored = np.float64 if bound < 2**53 else np.int64, np.int32 if largest < 2**31 else np.int64

    def matrix(self, column: pa.Array) -> np.ndarray:
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        out = np.zeros((len(column), self.dim), self.stored)
        out[np.arange(self.dim) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
        return out

    def products(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.astype(self.kind) @ b.astype(self.kind).T

    def squares(self, a: np.ndarray) -> np.ndarray:
        wide = a.astype(self.kind)
        return (wide * wide).sum(1)

    def rest(self, a: np.ndarray) -> np.ndarray:
        """The added component."""
        return np.sqrt(np.maximum(self.top - self.squares(a), 0).astype(np.float64))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances of objects."""
        near = self.products(a, b) + self.rest(a)[:, None] * self.rest(b)
        return np.sqrt(np.maximum(2.0 * (self.top - near), 0.0))

    def to_queries(self, squares: np.ndarray, products: np.ndarray) -> np.ndarray:
        """Distances of queries to objects."""
        return np.sqrt(np.maximum((squares[:, None] + self.top) - 2.0 * products, 0.0))

    def reachable(self, squares: np.ndarray, distance: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Whether an object at ``distance`` or farther can score ``best`` or more."""
        total = squares + float(self.top)
        return (total - np.maximum(distance, 0.0) ** 2) / 2 + 1e-9 * total + 0.01 >= best


def build(space: Space, vectors: np.ndarray, ids: np.ndarray, null: np.ndarray, uids: np.ndarray, root: np.ndarray, k: int) -> dict:
    """A subtree over the rows: distinct vectors, the first k + 1 rows of each (null ids last), nodes. ``root`` is its routing object.

    A node is (leaf?, entries, distances to the node's routing object, covering radii, child nodes).
    """
    objects, of = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((uids, ids, null, of := of.ravel()))
    start = np.searchsorted(of[order], np.arange(len(objects)))
    first = order[np.arange(len(order)) - start[of[order]] <= k]
    rng, nodes = np.random.default_rng(11), []

    def node(members: np.ndarray, routing: np.ndarray) -> int:
        parent = space.between(objects[members], routing[None])[:, 0]
        if len(members) <= PAGE:
            nodes.append((True, members, parent, None, None))
            return len(nodes) - 1
        fan = min(PAGE, -(-len(members) // (PAGE // 2)))
        chosen = rng.permutation(len(members))[:fan]
        away = space.between(objects[members], objects[members[chosen]])
        nearest = away.argmin(1)
        if np.bincount(nearest).max() > 0.9 * len(members):
            nearest = np.arange(len(members)) % fan  # nearly all at one routing object: any equal split is as good
        used = np.unique(nearest)
        radii = np.array([away[nearest == c, c].max() for c in used])
        children = np.array([node(members[nearest == c], objects[members[chosen[c]]]) for c in used])
        entries = members[chosen[used]]
        nodes.append((False, entries, parent[chosen[used]], radii, children))
        return len(nodes) - 1

    top = node(np.arange(len(objects)), root)
    radius = float(space.between(objects, root[None]).max())
    return {"objects": objects, "start": np.searchsorted(of[first], np.arange(len(objects) + 1)), "ids": ids[first], "null": null[first],
            "uids": uids[first], "nodes": nodes, "top": top, "root": root, "radius": radius}


class Best:
    """The best k rows of each of some queries so far: highest score, then smallest id (null last), then smallest row number."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.rows = [np.zeros(0, np.int64) for _ in range(5)]  # query, score, null?, id, row number

    def add(self, *new: np.ndarray) -> None:
        query, score, null, ids, uids = [np.concatenate(x) for x in zip(self.rows, new, strict=True)]
        order = np.lexsort((uids, ids, null, -score, query))
        ordered = query[order]
        place = np.arange(len(order)) - np.searchsorted(ordered, ordered)
        kept = order[place < self.k]
        self.rows = [x[kept] for x in (query, score, null, ids, uids)]
        full = order[place == self.k - 1]
        self.floor[query[full]] = np.maximum(self.floor[query[full]], score[full])


def search(space: Space, tree: dict, queries: np.ndarray, quids: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """Rows of the subtree that are among the best ``k`` of each query and score ``floor`` or more; a query's own row is not."""
    objects, squares = tree["objects"], space.squares(queries)
    best, ties = Best(len(queries), k, floor), count()
    from_root = space.to_queries(squares, space.products(queries, tree["root"][None]))[:, 0]
    everyone = np.arange(len(queries))
    heap = [(0.0, next(ties), tree["top"], everyone, from_root - tree["radius"], from_root)]
    while heap:
        _, _, at, who, bound, parent = heapq.heappop(heap)
        live = space.reachable(squares[who], bound, best.floor[who])
        if not live.any():
            continue
        who, parent = who[live], parent[live]
        leaf, entries, away, radii, children = tree["nodes"][at]
        # What the distances to the parent say, before any product with the entries themselves.
        apart = np.abs(parent[:, None] - away)
        wanted = space.reachable(squares[who][:, None], apart if leaf else apart - radii, best.floor[who][:, None])
        columns = np.flatnonzero(wanted.any(0))
        if not len(columns):
            continue
        scores = space.products(queries[who], objects[entries[columns]])
        wanted = wanted[:, columns]
        if leaf:
            row, column = np.nonzero(wanted & (scores >= best.floor[who][:, None]))
            entry = entries[columns[column]]
            times = tree["start"][entry + 1] - tree["start"][entry]
            member = np.repeat(tree["start"][entry + 1] - np.cumsum(times), times) + np.arange(times.sum())
            query = np.repeat(who[row], times)
            other = tree["uids"][member] != quids[query]
            member, query = member[other], query[other]
            score = np.repeat(scores[row, column].astype(np.int64), times)[other]
            best.add(query, score, tree["null"][member], tree["ids"][member], tree["uids"][member])
            continue
        distance = space.to_queries(squares[who], scores)
        for c, column in enumerate(columns):
            to = wanted[:, c]
            low = distance[to, c] - radii[column]
            heapq.heappush(heap, (float(low.min()), next(ties), int(children[column]), who[to], low, distance[to, c]))
    return best


def _hits(best: Best, quids: np.ndarray, query_ids: np.ndarray) -> list[pa.Array]:
    query, score, null, ids, uids = best.rows
    return [pa.array(quids[query]), pa.array(query_ids[query]), pa.array(score), pa.array(ids, mask=null.astype(bool)), pa.array(uids)]


def _numbered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False), null.astype(np.int64)


def _nearest(batches: Iterator[pa.RecordBatch], space: Space, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 2048):
            part = batch.slice(at, 2048)
            pivot = space.between(space.matrix(part.column("v")), pivots).argmin(1)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(pivot.astype(np.int32))], [*part.schema.names, "pivot"])


def _subtree(key: tuple, table: pa.Table, space: Space, pivots: np.ndarray, k: int) -> pa.Table:
    """The subtree of a block, with its own queries beside it."""
    table = table.combine_chunks()
    column = lambda c: table.column(c).combine_chunks()
    vectors, uids = space.matrix(column("v")), column("uid").to_numpy()
    ids, null = _numbered(column("vec_id"))
    pivot, block = (x.as_py() for x in key)
    tree = build(space, vectors, ids, null, uids, pivots[pivot].astype(space.stored), k)
    asks = column("asks").to_numpy(zero_copy_only=False).astype(bool)
    own = pickle.dumps((vectors[asks], uids[asks], ids[asks], null[asks]))
    return pa.table([pa.array([pivot], pa.int32()), pa.array([block], pa.int32()), pa.array([tree["radius"]]),
                     pa.array([pickle.dumps(tree)], pa.binary()), pa.array([own], pa.binary())], ["pivot", "block", "radius", "tree", "own"])


def _seeded(batches: Iterator[pa.RecordBatch], space: Space, k: int) -> Iterator[pa.RecordBatch]:
    """The queries of each block with their k-th best score there, some at a time, and what they found."""
    hit = pa.struct([(x.split()[0], pa.int64()) for x in _HIT.split(", ")])
    for batch in batches:
        for pivot, block, tree, own in zip(*(batch.column(c) for c in ("pivot", "block", "tree", "own")), strict=True):
            vectors, uids, ids, null = pickle.loads(own.as_py())
            tree = pickle.loads(tree.as_py()) if len(uids) else None
            for part, at in enumerate(range(0, len(uids), TOGETHER)):
                some = slice(at, at + TOGETHER)
                best = search(space, tree, vectors[some], uids[some], np.full(len(uids[some]), -np.inf), k)
                found = pa.StructArray.from_arrays(_hits(best, uids[some], ids[some]), fields=list(hit))
                asked = pickle.dumps((vectors[some], uids[some], ids[some], best.floor))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pivot.as_py()], pa.int32()), pa.array([block.as_py()], pa.int32()), pa.array([part], pa.int32()), pa.array([asked], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)], ["pivot", "block", "part", "queries", "hits"])


def _routed(batches: Iterator[pa.RecordBatch], space: Space, pivots: np.ndarray, radii: np.ndarray, blocks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per group of queries and subtree that can hold something for them: those queries. The subtree they come from is done."""
    for batch in batches:
        for pivot, block, part, asked in zip(*(batch.column(c).to_pylist() for c in ("pivot", "block", "part", "queries")), strict=True):
            vectors, uids, ids, floor = pickle.loads(asked)
            squares = space.squares(vectors)
            low = space.to_queries(squares, space.products(vectors, pivots)) - radii
            wanted = space.reachable(squares[:, None], low, floor[:, None])
            for p in np.flatnonzero(wanted.any(0)).tolist():
                to = wanted[:, p]
                blob = pickle.dumps((vectors[to], uids[to], ids[to], floor[to]))
                there = [b for b in range(blocks[p]) if (p, b) != (pivot, block)]
                n = len(there)
                yield pa.RecordBatch.from_arrays([pa.array([p] * n, pa.int32()), pa.array(there, pa.int32()), pa.array([hash((pivot, block, part)) & 0x7FFFFFFF] * n, pa.int32()),
                                                  pa.array([blob] * n, pa.binary())], ["pivot", "block", "code", "queries"])


def _searched(trees: pa.Table, asked: pa.Table, space: Space, k: int) -> pa.Table:
    out = []
    if len(trees) and len(asked):
        tree = pickle.loads(trees.column("tree")[0].as_py())
        for blob in asked.column("queries"):
            vectors, uids, ids, floor = pickle.loads(blob.as_py())
            out.append(_hits(search(space, tree, vectors, uids, floor, k), uids, ids))
    names = [c.split()[0] for c in _HIT.split(", ")]
    if not out:
        return pa.table([pa.array([], pa.int64())] * len(names), names)
    return pa.table([pa.concat_arrays([x[i] for x in out]) for i in range(len(names))], names)


def whole_vectors(vectors: DataFrame, asks: Column, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``vec_id, v, asks``: floor(``scale`` * component) per component; vectors null or with a null or non-finite component are left out."""
    x = F.col(embedding)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = F.transform(x, lambda c: F.floor(scale * c.cast("double")).cast("bigint"))
    return vectors.filter(x.isNotNull() & ~bad).select(F.col(vec_id).cast("bigint").alias("vec_id"), v.alias("v"),
                                                       (F.coalesce(asks, F.lit(False)) & F.col(vec_id).isNotNull()).alias("asks"))


def top_k(vectors: DataFrame, asks: Column, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256,
          block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` where ``asks`` holds, the ``k`` other rows of the highest integer inner product.

    Components become floor(``scale`` * x). Equal scores rank by the smaller ``vec_id``, a null one last. Rows with equal ids are
    rows of their own: each that asks is answered, and finds the others. A null id never asks. Vectors that are null or hold a null or
    non-finite component take no part; shorter vectors count as filled up with zeros. Scores that could pass 62 bits are refused with a
    ValueError. With ``k`` rows or fewer all are returned. Other columns are ignored. Empty input: empty result.
    """
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "mtree")
    rows = scratch.save(whole_vectors(vectors, asks, vec_id, embedding, scale).withColumn("uid", F.monotonically_increasing_id()), "rows")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    exact = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.max(most).alias("most"), F.max(length).alias("length"),
                     F.max(F.when(length < 2.0**62, exact)).alias("top")).first()
    space = Space(facts["dim"] or 0, facts["most"] or 0, facts["top"] or 0)

    wanted = min(PIVOTS, max(1, -(-facts["n"] // block)))
    sample = rows.sample(min(1.0, 4 * SAMPLE / max(1, facts["n"])), 5).select("v").distinct().limit(SAMPLE).collect() if wanted > 1 else []
    pivots = np.zeros((max(1, min(wanted, len(sample))), space.dim), np.int64)
    for i, place in enumerate(np.random.default_rng(3).permutation(len(sample))[:wanted]):
        pivots[i, :len(sample[place].v)] = sample[place].v

    dealt = scratch.save(rows.mapInArrow(lambda b: _nearest(b, space, pivots), "vec_id bigint, v array<bigint>, asks boolean, uid bigint, pivot int"), "dealt")
    scratch.drop(rows)
    sizes = {r["pivot"]: -(-r["n"] // block) for r in dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = np.array([sizes.get(p, 0) for p in range(len(pivots))])
    of = F.pmod(F.xxhash64("uid"), F.get(F.lit(blocks.tolist()), F.col("pivot"))).cast("int")
    build_one = lambda key, table: _subtree(key, table, space, pivots, k)
    trees = scratch.save(dealt.withColumn("block", of).groupBy("pivot", "block").applyInArrow(build_one, "pivot int, block int, radius double, tree binary, own binary"), "trees")
    scratch.drop(dealt)

    seeds = scratch.save(trees.select("pivot", "block", "tree", "own").mapInArrow(
        lambda b: _seeded(b, space, k), f"pivot int, block int, part int, queries binary, hits array<struct<{_HIT.replace(' ', ':').replace(',:', ',')}>>"), "seeds")
    radii = np.full(len(pivots), -np.inf)
    for r in trees.groupBy("pivot").agg(F.max("radius").alias("radius")).collect():
        radii[r["pivot"]] = r["radius"]
    salts = max(1, -(-seeds.count() // SPREAD))
    routed = seeds.select("pivot", "block", "part", "queries").mapInArrow(
        lambda b: _routed(b, space, pivots, radii, blocks), "pivot int, block int, code int, queries binary").withColumn("salt", F.pmod("code", F.lit(salts)))
    copies = trees.select("pivot", "block", "tree", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    key = ["pivot", "block", "salt"]
    more = copies.groupBy(*key).cogroup(routed.groupBy(*key)).applyInArrow(lambda a, b: _searched(a, b, space, k), _HIT)
    found = seeds.select(F.inline("hits")).unionByName(more)
    order = Window.partitionBy("quid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
