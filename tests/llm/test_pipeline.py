"""Every stage of the pipeline against plain Python over the smallest documents with hard rows added."""

import os
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import corpus_pipeline  # noqa: E402
from quillbar.llm import language, pii  # noqa: E402
from test_decontaminate import plain_distance  # noqa: E402
from test_neardup import shingles  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, the input first."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "src0", 0), (9002, "", "en", None, 0), (9003, "12 34 !!", None, None, 8), (None, "the and of that with on a of no id at all", "en", None, 41)]
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    now, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    out.append(now.collect())
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        out.append(now.collect())
    return spark, folder, out


def ids(rows):
    return Counter(r.doc_id for r in rows)


def test_language(stages):
    spark, folder, (docs, kept, *_) = stages
    held = lambda r: zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 3 == 1
    model = language.train(spark.createDataFrame([(r.text, r.lang) for r in docs if r.lang and not held(r)], "text string, lang string"))
    want = []
    for r in docs:
        words = [m.group() for m in language._WORD.finditer((r.text or "").lower())]
        if words:
            scores = model.scores(words)
            share = Counter()
            for w, k in zip(words, language.viterbi(scores, language.np.array([len(words)]))):
                share[k] += len(w)
            if max(share.values()) >= 0.5 * sum(share.values()):
                want.append(r)
    assert ids(kept) == ids(want) and len(kept) > 0.95 * len(docs) - 4
    assert not {9001, 9002, 9003} & set(ids(kept)) and kept[0].__fields__ == docs[0].__fields__


def test_near_dedup(stages):
    _, _, (_, before, kept, *_) = stages
    sets = [shingles(r.text) for r in before]
    index = {}
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)
    parent = list(range(len(before)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in index[x] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(before):
        groups.setdefault(find(i), []).append(r.doc_id)
    assert ids(kept) == Counter(min(g, key=lambda d: (d is None, d)) for g in groups.values())


def test_decontamination(stages):
    spark, folder, (_, _, before, kept, *_) = stages
    split = lambda t: re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t)).split(" ")
    items = [[w for w in split(r.text) if w] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    items = [w for w in items if len(w) >= 8]
    leaked = set()
    for r in before:
        words = [w for w in split(r.text) if w]
        for item in items:
            allowed = int(0.2 * len(item))
            if sum((Counter(item) - Counter(words)).values()) <= allowed and plain_distance(item, words) <= allowed:
                leaked.add(r.doc_id)
    assert leaked and set(ids(kept)) == set(ids(before)) - leaked


def test_redaction(stages):
    spark, _, (_, _, _, before, after, _) = stages
    model = pii.fit(spark.createDataFrame([(r.text,) for r in before], "text string"))
    want = Counter((r.doc_id, pii.masked(r.text, [x for part in pii.spans_of(r.text, model) for x in part])) for r in before)
    assert Counter((r.doc_id, r.text) for r in after) == want
    assert all(r.n_chars == len(r.text) for r in after) and any("[EMAIL]" in r.text or "[CARD]" in r.text for r in after)


def test_mixing(stages):
    _, _, (*_, before, after) = stages
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before}
    total, per = sum(size.values()), Counter()
    for r in before:
        per[r.source] += size[r.doc_id]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(per, key=lambda s: (s is None, s or "")))}
    capped, level = set(), 0
    while True:
        level = (1.5 * total - sum(2 * per[s] for s in capped)) / sum(w for s, w in weights.items() if s not in capped)
        over = {s for s in per if s not in capped and weights[s] * level > 2 * per[s]}
        if not over:
            break
        capped |= over
    taken, largest = Counter(), Counter()
    for r in after:
        assert r.size == size[r.doc_id] and r.taken == r.copies * r.size and 1 <= r.copies <= 2
        target = 2 * per[r.source] if r.source in capped else weights[r.source] * level
        assert r.target == pytest.approx(target) and r.source_size == per[r.source]
        taken[r.source] += r.taken
        largest[r.source] = target
    biggest = Counter()
    for r in before:
        biggest[r.source] = max(biggest[r.source], size[r.doc_id])
    for s, target in largest.items():
        assert abs(taken[s] - target) <= biggest[s]


def test_run_gives_the_last_stage(stages):
    spark, folder, out = stages
    got = corpus_pipeline.run(spark, folder).collect()
    assert Counter(map(str, got)) == Counter(map(str, out[-1]))
