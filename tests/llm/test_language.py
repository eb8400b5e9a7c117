"""Language spans: the path against all paths, held-out accuracy, mixed and odd texts."""

import itertools
import os

import numpy as np
import pytest

from quillbar.llm import language

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 0, 5, 1, 4])
    scores = rng.normal(size=(lengths.sum(), 3)) * 4
    got, at = language.viterbi(scores, lengths, 2.5), 0
    for n in lengths:
        own = scores[at: at + n]
        value = lambda p: sum(own[i, x] for i, x in enumerate(p)) - 2.5 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert value(tuple(got[at: at + n])) == pytest.approx(value(best))
        at += n


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF.rpartition('/')[0]}/sf0.01/documents.parquet")
    out = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    known = [r for r in out if r.lang_pred != "und"]
    assert len(known) > 250 and np.mean([r.lang == r.lang_pred for r in known]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_spans_of_mixed_text(spark):
    en = "the quick brown fox jumps over the lazy dog and then the other dog runs away from the house "
    de = "der schnelle braune fuchs springt über den faulen hund und dann läuft der andere hund weg vom haus "
    ru = "быстрая лиса прыгает через ленивую собаку и потом другая собака убегает из дома "
    train = spark.createDataFrame([(en * 3, "en"), (de * 3, "de"), (ru * 3, "ru"), ("ignored", None), (None, "en")], "text string, lang string")
    model = language.train(train)
    assert model.langs == ["de", "en", "ru"]
    rows = [(1, "😀 " + en + de), (2, "12 34 !?"), (3, None), (4, ""), (5, en), (5, en), (None, ru), (6, en * 2000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string")
    out = {(r.doc_id, r.lang_pred): r for r in language.label(df, model, ["doc_id"]).collect()}
    mixed = [r for (i, _), r in out.items() if i == 1][0]
    assert [s.lang for s in mixed.spans] == ["en", "de"] and mixed.spans[0].start == 2 and mixed.spans[1].start == 2 + len(en)
    assert {(2, "und"), (3, "und"), (4, "und"), (5, "en"), (None, "ru"), (6, "en")} <= set(out)
    assert out[5, "en"].score == 1.0 and out[2, "und"].score == 0.0
    assert language.label(df, model, ["doc_id"]).count() == len(rows)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id bigint, text string, lang string")
    assert [r.lang_pred for r in language.identify(df).collect()] == ["und"]
    assert language.identify(df.limit(0)).count() == 0
