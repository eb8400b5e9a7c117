"""Near-duplicate groups against all pairs of full shingle sets."""

import random

import pytest

from quillbar.llm import neardup

WORDS = [f"w{i}" for i in range(3000)]


def words_of(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    rows, common = [], " ".join(rng.choices(WORDS, k=60))
    for _ in range(groups):
        base = rng.choices(WORDS, k=rng.choice([3, 6, 20, 80, 300]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                at = rng.randrange(len(text))
                text[at:at + 1] = rng.choice([[], [rng.choice(WORDS)], [text[at], rng.choice(WORDS)]])
            rows.append(" ".join(text))
        if rng.random() < 0.3:
            rows.append(" ".join(rng.choices(WORDS, k=100)) + " " + common)
    # A chain: each text near the next, the ends far apart.
    text = rng.choices(WORDS, k=200)
    for k in range(12):
        rows.append(" ".join(text))
        text[k * 15: k * 15 + 4] = rng.choices(WORDS, k=4)
    rng.shuffle(rows)
    return [*enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_all_pairs(spark, seed):
    rows = corpus(seed)
    n = len(rows)
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \n"), (n + 4, "A b"), (n + 5, "a\tB"), (n + 6, rows[0][1].upper()), (n + 6, "other"), (None, "a b"), (None, "nobody")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df).collect()], key=str)
    want = [(d, n, c, d == c) for d, n, c, _ in expected(rows)]
    assert got == sorted(want, key=str)


def test_estimate_is_close(spark):
    import numpy as np
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    number = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    rows = []
    for n in (60, 700, 9000):
        a = number(n)
        for share in (0.0, 0.3, 0.75, 1.0):
            common = int(n * 2 * share / (1 + share))
            b = np.concatenate([a[:common], number(n - common)])
            rows.append((n, common / (2 * n - common), *[neardup.signature(np.unique(x)).tolist() for x in (a, b)]))
    df = spark.createDataFrame(rows, "n int, share double, a array<bigint>, b array<bigint>")
    value, _ = neardup.estimate(F.col("a"), F.col("b"))
    for r in df.select("n", "share", value.alias("e"), neardup.likely(F.col("a"), F.col("b")).alias("near")).collect():
        assert abs(r.share - r.e) < 0.07 and (r.near or r.share < 0.75) and not (r.near and r.share < 0.45)


def test_keep_one(spark):
    text = " ".join(WORDS[:40])
    rows = [(3, text, 1), (1, text + " more", 2), (1, text + " more", 2), (2, "", 3), (4, "", 4), (5, None, 5), (6, "quite other words in here", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, tag int")
    assert sorted(r.doc_id for r in neardup.keep_one(df).collect()) == [1, 2, 4, 5, 6]
    assert neardup.keep_one(df).columns == df.columns
    assert neardup.keep_one(df.limit(0)).count() == 0


def test_large_bucket_of_chains_and_cliques(spark):
    """Copies that share most of a text: some near each other but far from the bucket's ends, some just below the limit."""
    rng = random.Random(8)
    base = rng.choices(WORDS, k=160)
    rows = []
    for centre in range(4):
        own = list(base)
        for at in range(centre, 160, 23):
            own[at] = f"c{centre}x{at}"
        for _ in range(45):
            text = list(own)
            for at in rng.sample(range(160), rng.choice([0, 1, 2, 3])):
                text[at] = rng.choice(WORDS)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    rows = [*enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df).collect())
    assert got == sorted(expected(rows))


def test_rounds_leave_settled_buckets_alone(spark, monkeypatch):
    """Many texts share half of their words, so that their buckets stay open without a link; some others link in later rounds only."""
    from quillbar.llm.common import Scratch

    rng = random.Random(5)
    common, base = rng.choices(WORDS, k=60), [f"b{k}" for k in range(150)]
    rows = [" ".join([*common, *[f"own{i}x{k}" for k in range(30)]]) for i in range(600)]
    # Texts with four changed words link with that one alone that has none, and few of them meet it as a bucket's first or last.
    for i in range(123):
        text = list(base)
        for at in rng.sample(range(2, 148, 6), 4 if i else 0):
            text[at] = f"e{i}x{at}"
        rows.append(" ".join([*text, f"end{i}"]))
    rng.shuffle(rows)
    rows, saved, plain = [*enumerate(rows)], [], Scratch.save

    def save(self, df, name):
        out = plain(self, df, name)
        if name == "open":
            saved.append(out.count())
        return out

    monkeypatch.setattr(Scratch, "save", save)
    monkeypatch.setattr(neardup, "LARGE_BUCKET", 8)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.groups(df).collect())
    assert got == sorted(expected(rows))
    assert saved[1] <= saved[0] / 4, saved


def test_later_links_do_not_bring_back_the_earlier_ones(spark, monkeypatch):
    """Components of later rounds come from the new links alone, and are those of all links together."""
    from quillbar.llm import graph
    from quillbar.llm.common import Scratch

    rng, scratch = random.Random(4), Scratch(spark, "graph")
    pairs = lambda low, high, n: [(a, b) for a, b in ((rng.randrange(low, high), rng.randrange(low, high)) for _ in range(n)) if a != b]
    first, later = pairs(0, 300, 120), [*pairs(0, 330, 12), (400, 401), (402, 401), (5, 400)]
    of = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint")
    whole = graph.components(of(first + later), scratch)
    asked, plain = [], graph.components
    monkeypatch.setattr(graph, "components", lambda links, s: asked.append(links.count()) or plain(links, s))
    found = graph.merged(plain(of(first), scratch), of(later), scratch)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert asked == [len(later)]
