"""Fixed patterns against the patterns as written, accepted candidates, redaction, and the trees on known functions."""

import hashlib
import itertools
import os
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillbar.llm import pii, queries
from quillbar.llm.boosting import Boosted

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


HARD = ["", "a@b.c", "a@@b.c.d x@y", "a@b.c@d.e", "..@a-.b- +1 (234) 555-1234", "1.2.3.4.5.6.7.8", "1.2.3.256 1.2.3.4", "0001.2.3.004", "4111 1111-1111 1111 4111111111111112",
        "+12345678 +123456789 ++1 23456789", "😀 a@b.co 😀1.1.1.1", "9" * 5000, "1 2 3 4 5 6 7 8 9 0 1 2", "a" * 3000 + "@x.y", "+1" + " " * 500, "x@a.b.c@d.e f@g"]


@pytest.mark.parametrize("text", HARD)
def test_fixed_patterns(text):
    assert sorted((k, s, e) for k, s, e, ok in pii.shaped(text) if ok) == sorted(plain(text))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@+- ()29é", max_size=40))
def test_fixed_patterns_on_any_text(text):
    assert sorted((k, s, e) for k, s, e, ok in pii.shaped(text) if ok) == sorted(plain(text))


def test_long_runs_end():
    import time

    for text in ("1" * 200_000 + ".", "a" * 200_000 + "@", "+1" + "(" * 200_000, "@" * 100_000, " at " * 50_000, "a at b. " * 25_000):
        start = time.perf_counter()
        assert not [k for k, _, _, ok in pii.shaped(text) if ok]
        assert time.perf_counter() - start < 5
    octets = "1." * 100_000
    assert [x for x in pii.shaped(octets) if x[3]] == [(1, at, at + 7, True) for at in range(0, 200_000 - 7, 8)]


def test_query_base(spark):
    rows = queries.QUERIES["op6_pii"](spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        base = sorted(plain(texts[r.doc_id]), key=lambda x: (x[1], x[0]))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for k, _, _ in base) for i in range(4))
        told = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(","))


def corpus():
    rng = np.random.default_rng(5)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))

    def card():
        head = number(15)
        return next(head + str(d) for d in range(10) if luhn(head + str(d)))

    out = []
    for i in range(400):
        out += [f"call +1 (555) 555-{number(4)} now", f"pay {card()} or {number(16)}", f"host 10.{number(2)}.1.{rng.integers(1, 250)} and 300.1.2.{number(3)}", f"mail u{number(3)}@x{i}.org year {number(4)}"]
    return [(i, t) for i, t in enumerate(out)]


def test_candidates_are_accepted_and_redacted(spark):
    df = spark.createDataFrame(corpus(), "doc_id bigint, text string")
    model = pii.fit(df)
    assert model.trees and min(model.thresholds) < 1
    assert pii.spans_of("pay 4111.1111.1111.1111 here", model)[1] == [(2, 4, 23)]
    assert pii.spans_of("plain words 12 and 2024", model) == ([], [])
    odd = spark.createDataFrame([(1, "mail a@b.org, +1 (555) 555-1234.", 1.5), (1, "mail a@b.org, +1 (555) 555-1234.", 1.5), (None, None, None), (2, "", 0.0)], "found int, text string, spans double")
    rows = pii.redact(odd, model).collect()
    assert sorted(str(r.text) for r in rows) == ["", "None", "mail [EMAIL], [PHONE].", "mail [EMAIL], [PHONE]."]
    assert pii.redact(odd.limit(0), model).count() == 0 and pii.fit(odd.limit(0)).trees is None
    assert {len(r.found) for r in pii.find(odd.withColumnRenamed("found", "k"), model, ["k"]).collect()} == {0, 2}


def test_loose_emails_in_any_spelling(spark):
    for form in ("john{at}example.com", "john at example.com", "john(AT)example(Dot)com", "John [At] Example DOT org"):
        assert [(k, *s) for k, *s in pii.candidates("see " + form) if k == 0] == [(0, 4, 4 + len(form))]
    prose = [(5000 + i, f"we looked at home{i % 9}. Then it rained") for i in range(300)]
    names = [(6000 + i, f"mail {a}{b}@{b}{c}.com now") for i, (a, b, c) in enumerate(itertools.product(["jo", "anna", "m", "peter", "li", "susan"], ["smith", "hn", "lee", "x"], ["corp", "ample", "net"] * 5))]
    model = pii.fit(spark.createDataFrame(corpus() + names + prose, "doc_id bigint, text string"))
    assert pii.spans_of("mail john{at}example.com now", model)[1] == [(0, 5, 24)]
    assert pii.spans_of("mail john at example.com now", model)[1] == [(0, 5, 24)]
    assert pii.spans_of("they stayed at home. Then it rained", model)[1] == []


SPELLINGS = ["john at example dot com", "bob [at] mail [dot] example [dot] net", "jane(at)example(dot)org", "john{at}example.com", "of.78 at mail3 dot example dot com",
             "4111.1111.1111.1111", "ann.lee (AT) corp (DOT) net"]
CLEAN = ["they stayed at home. Then it rained", "we met at noon.Later we left", "on 2024-01-15 and 2023.12.31", "order 12345678 shipped", "look at this. Nothing there", "1,234,567 of 7,654,321",
         "pages 100-200, 300-400", "section 1.2.3.4444"]


@pytest.mark.parametrize("folder", ["sf0.1"])
def test_the_model_of_the_tables_adds_spellings(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    model = pii.fit(docs)
    assert model.trees and max(model.thresholds) < 1.5
    missed = [t for t in SPELLINGS if [(s, e) for _, s, e in pii.spans_of("see " + t + " now", model)[1]] != [(4, 4 + len(t))]]
    assert not missed
    assert pii.spans_of("see 4111.1111.1111.1111 now", model)[1] == [(2, 4, 23)]
    assert not [t for t in CLEAN if pii.spans_of(t, model)[1]]


def test_a_small_table_switches_no_kind_off(spark):
    rows = [(i, t) for i, (_, t) in enumerate(corpus()[:24])]
    model = pii.fit(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert model.trees and max(model.thresholds) < 1.5


def test_a_bounded_sample_keeps_every_kind(spark):
    df = spark.createDataFrame(corpus() * 3, "doc_id bigint, text string").withColumn("doc_id", F.monotonically_increasing_id())
    whole, part = pii.fit(df), pii.fit(df, sample_rows=600)
    assert [t < 1 for t in part.thresholds] == [t < 1 for t in whole.thresholds] and max(part.thresholds[1:]) < 1
    # Copies of one vector are drawn one by one, and stand for all of their kind and label.
    texts = ["call +1 (555) 555-1234 now"] * 2000 + ["mail a@b.org or +1234"] * 20
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    one, two = (pii.sampled(pii.labelled(r), 200) for r in (rows, rows.repartition(7)))
    counts = {(r.kind, r.y): r["count"] for r in pii.labelled(rows).groupBy("kind", "y").count().collect()}
    groups = one.groupby(["kind", "y"])
    assert groups.weight.sum().round(6).to_dict() == counts and counts[3, True] >= 2000
    assert len(one) == 200 and all(n == counts[g] or n >= 200 // len(counts) for g, n in groups.size().items())
    assert one[["kind", "y", "text", "place", "weight"]].values.tolist() == two[["kind", "y", "text", "place", "weight"]].values.tolist()


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = Boosted().fit(x[:3000], y[:3000])
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_the_model_counts_every_candidate(spark, monkeypatch):
    """More candidates than a sample held: each stands in the scores that the thresholds come from, and none is drawn."""
    docs = spark.createDataFrame(corpus() * 6, "doc_id bigint, text string").withColumn("doc_id", F.monotonically_increasing_id())
    scores, fitted = [], pii._fitted
    monkeypatch.setattr(pii, "_fitted", lambda *a: scores.append(fitted(*a)) or scores[-1])
    monkeypatch.setattr(pii, "sampled", lambda *a: pytest.fail("a sample is drawn"))
    pii.fit(docs)
    labelled = pii.labelled(docs)
    assert scores[0].weight.sum() == labelled.count() > 20_000
    assert scores[0].good.sum() == labelled.filter("y").count()


def test_tasks_grow_the_trees_of_the_driver(spark):
    df = spark.createDataFrame(corpus()[:160], "doc_id bigint, text string").repartition(3)
    here, there = pii.fit(df), pii.fit(df, local_cells=0)
    assert np.allclose(here.thresholds, there.thresholds)
    x = np.array([pii.features(t, c) for _, t in corpus()[:400] for c in pii.candidates(t)])
    assert np.allclose(here.trees.probability(x), there.trees.probability(x))
