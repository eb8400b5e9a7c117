"""Benchmark items against every position of every document, recall under edits, odd inputs."""

import random

import numpy as np

from quillbar.llm import decontaminate as dc

RNG = random.Random(4)
COMMON = ["the", "of", "and", "to", "in", "is"]
RARE = [f"word{i}" for i in range(5000)]


def prose(n):
    return [RNG.choice(COMMON) if RNG.random() < 0.4 else RNG.choice(RARE) for _ in range(n)]


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        at = RNG.randrange(len(words))
        kind = RNG.randrange(3)
        words[at:at + 1] = [[], [RNG.choice(RARE)], [words[at], RNG.choice(RARE)]][kind]
    return words


def plain_distance(item, words):
    """Smallest number of word edits to any span of ``words``."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(words, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def case(edit_share, n_docs=60):
    items = [(i, " ".join(prose(RNG.choice([9, 16, 25, 40, 60])))) for i in range(20)]
    docs, planted = [], set()
    for d in range(n_docs):
        words = prose(RNG.choice([30, 200]))
        if d % 2:
            i, text = RNG.choice(items)
            words += edited(text.split(), int(edit_share * len(text.split()))) + prose(20)
            planted.add((d, i))
        docs.append((d, " ".join(words)))
    return items, docs, planted


def run(spark, items, docs):
    found = dc.find(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(2), spark.createDataFrame(items, "item_id bigint, text string"))
    return {(r.doc_id, r.item_id): r for r in found.collect()}


def test_matches_every_position(spark):
    for share, least in ((0.0, 1.0), (0.1, 0.93)):
        items, docs, planted = case(share)
        got = run(spark, items, docs)
        texts, wanted = dict(docs), dict(items)
        truth = {(d, i) for d, t in docs for i, x in items if plain_distance(x.split(), t.split()) <= int(dc.EDITS * len(x.split()))}
        assert planted <= truth and set(got) <= truth
        assert len(set(got) & truth) >= least * len(truth)
        for (d, i), r in got.items():
            span = texts[d][r.start:r.end].split()
            assert plain_distance(wanted[i].split(), span) == r.edits
            assert share or r.edits == 0


def test_no_match_is_missed_at_the_limit():
    for n in (9, 15, 40, 100, 200):
        items = [(i, prose(n)) for i in range(12)]
        index = dc.Index([(i, " ".join(w)) for i, w in items])
        docs = [prose(20) + edited(w, int(dc.EDITS * n)) + prose(20) for _, w in items for _ in range(2)]
        got = {(d, index.ids[k]): edits for d, k, edits, *_ in dc.matches(index, [" ".join(w).encode() for w in docs])}
        for d, words in enumerate(docs):
            least = plain_distance(items[d // 2][1], words)
            assert least <= int(dc.EDITS * n) and got[d, d // 2] == least


def test_the_walks_alone_find_nine_of_ten():
    """With all the edits allowed, before the pieces are asked; the pieces find the rest (the test above)."""
    found = total = 0
    for n in (9, 15, 20, 30, 40, 60, 100, 200):
        items = [(i, prose(n)) for i in range(60)]
        index = dc.Index([(i, " ".join(w)) for i, w in items])
        hits = 0
        for k, (_, w) in enumerate(items):
            words = dc.item_words(" ".join(prose(20) + edited(w, int(dc.EDITS * n)) + prose(20)))
            hits += k in set(index.candidates(words)[1].tolist())
        assert hits >= 0.8 * len(items), n
        found, total = found + hits, total + len(items)
    assert found >= 0.9 * total


def test_short_items_and_scripts_without_blanks(spark):
    chinese, thai = "今天天气很好我们一起去公园散步吧", "วันนี้อากาศดีมาก"
    items = [(1, "forty two"), (2, "rare"), (3, chinese), (4, thai), (5, "two six four nine ten"), (6, "东西")]
    other = chinese[:6] + "坏" + chinese[7:]
    docs = [(1, "The answer is Forty, two!"), (2, "forty and two; rarely"), (3, f"他说{chinese}。abc"), (4, f"x{other}y"), (5, f"คำ {thai}ครับ"), (6, "two six four nine eleven"),
            (7, "A RARE thing: two six. Four nine ten"), (8, "东 西 é東西")]
    got = run(spark, items, docs)
    assert set(got) == {(1, 1), (3, 3), (4, 3), (5, 4), (7, 2), (7, 5), (8, 6)}
    assert (got[3, 3].start, got[3, 3].end, got[3, 3].edits) == (2, 2 + len(chinese), 0) and got[4, 3].edits == 1
    df, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(r.doc_id for r in dc.clean(df, bench).collect()) == [1, 2, 6, 7, 8]
    assert sorted(r.doc_id for r in dc.clean(df, bench, least_words=1).collect()) == [2, 6]


def test_a_chunk_without_candidates():
    index = dc.Index([(1, " ".join(prose(40)))])
    assert list(dc.matches(index, [b"nothing here", b"", b"at all"])) == [] and list(dc.matches(index, [b"", b" . "])) == []


def test_every_fifth_word_edited(spark):
    """The walks' worst case: no long stretch is left as it was."""
    item = [f"item{i}" for i in range(200)]
    words = [f"other{i}" if i % 5 == 2 else w for i, w in enumerate(item)]
    assert run(spark, [(1, " ".join(item))], [(1, " ".join(prose(40) + words + prose(40))), (2, " ".join(words[:150]))]).keys() == {(1, 1)}


def test_walks_of_windows_equal_walks_of_items():
    words = np.array([RNG.getrandbits(64) for _ in range(200)], np.uint64)
    index = dc.Index([(7, "a b c d e f g h i j k l m n o p q r s t")])
    item = index.words[0]
    at, which = index.candidates(np.concatenate([words, item, words[:50]]))
    assert (200 in at.tolist()) and set(which.tolist()) == {0}


def test_case_and_punctuation_and_long_text(spark):
    items = [(1, "ünïque one, two three; four FIVE six seven (eight) nine ten?")]
    filler = " ".join(prose(30_000))
    docs = [(1, "x 😀 ünïque ONE two... three four five -- six seven eight nine TEN and so on"), (2, filler + " " + items[0][1]), (3, filler), (2, None), (None, items[0][1]), (4, "")]
    got = run(spark, items, docs)
    assert set(got) == {(1, 1), (2, 1), (None, 1)}
    assert (got[2, 1].start, got[2, 1].end) == (len(filler) + 1, len(filler) + len(items[0][1])) and got[1, 1].start == 4


def test_clean_and_empty(spark):
    items, docs, planted = case(0.0, 20)
    df = spark.createDataFrame([(d, t, 1.0) for d, t in [*docs, (99, None), (99, None), (None, "")]], "doc_id bigint, text string, item_id double")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (52, "the of")], "item_id bigint, text string")
    left = dc.clean(df, bench)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted([str(d) for d, _ in docs if d % 2 == 0] + ["99", "99", "None"])
    assert dc.find(df, bench.limit(0)).count() == 0 and dc.find(df.limit(0), bench).count() == 0
    assert dc.clean(df, bench.limit(0)).count() == df.count()
