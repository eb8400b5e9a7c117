"""Document quality rules as a short-circuit cascade. DataFrame functions only."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import BLANK, WORD, Scratch, computed_once, let, whole

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def _repeated(windows: Column, n: int) -> Column:
    """Words covered by windows of ``n`` words that occur twice or more. ``windows``: one hash per window, in order.

    Equal hashes become neighbours by sorting (hash, place); the places that remain, sorted, cover min(n, gap) words each.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(s: Column) -> Column:
        same = lambda i: F.get(s, i)["h"]
        return F.filter(s, lambda e, i: ((i > 0) & (same(i - 1) == e["h"])) | F.coalesce(same(i + 1) == e["h"], F.lit(False)))

    places = let(placed, lambda s: F.sort_array(F.transform(twins(s), lambda e: e["i"])))
    covered = let(places, lambda p: F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(p, i + 1) - x, F.lit(n)))), F.lit(0), lambda a, x: a + x))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered)


def repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words in windows of ``n`` words found twice or more in the array, the first included."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])))
    return F.when(F.size(words) <= n, F.lit(0)).otherwise(let(windows, lambda w: _repeated(w, n)))


def word_array(text: str | Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORD), F.lit(0))


def text_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all bigint); null text counts as empty."""
    body = whole(text)
    worded = F.filter(F.split(body, "\n", -1), lambda line: F.rlike(line, F.lit(WORD)))
    facts = let(word_array(text), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r")))
    lines = let(worded, lambda a: F.size(a) - F.size(F.array_distinct(a)))
    out = computed_once(docs, _facts=facts)
    return out.select(
        *docs.columns,
        F.col("_facts.n").cast("bigint").alias("n_words"),
        (F.length(body) - F.regexp_count(body, F.lit(BLANK))).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        lines.cast("bigint").alias("n_dup_lines"),
        F.col("_facts.r").cast("bigint").alias("n_repeat_words"),
    )


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a document to reject; null counts as false."""

    name: str
    fails: Column


def _share(count: Column, of: Column, limit: float) -> Column:
    return count > limit * of


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules over the text alone. A text without words fails the first; each of the others passes it."""
    body = whole(text)
    count = lambda pattern: F.regexp_count(body, F.lit(pattern))
    length = F.length(body)
    lines = F.split(body, "\n", -1)
    letters = length - F.length(F.regexp_replace(body, r"\p{L}+", ""))
    # What a text must hold to fail is asked before anything is counted.
    holds = lambda pattern: F.rlike(body, F.lit(pattern))
    return [
        Rule("no_words", ~F.rlike(body, F.lit(WORD))),
        Rule("few_letters", letters < 0.5 * (length - count(BLANK))),
        Rule("symbols", holds(SYMBOLS) & _share(count(SYMBOLS), count(WORD), 0.2)),
        Rule("long_words", holds(r"[^\x20\x09-\x0D]{41}") & (length - count(BLANK) > 40 * count(WORD))),
        Rule("repeated_lines", let(F.filter(lines, lambda x: F.rlike(x, F.lit(WORD))), lambda a: (
            F.size(a) >= 4) & (F.size(a) - F.size(F.array_distinct(a)) > 0.5 * F.size(a)))),
        Rule("shouting", (length >= 100) & (count(r"\p{Lu}") > 0.7 * letters)),
        Rule("exclaiming", body.contains("!") & (count(r"!") > 0.5 * count(WORD))),
        Rule("ellipsis_lines", let(lines, lambda a: (F.size(a) >= 4) & (
            F.size(F.filter(a, lambda x: F.rlike(x, F.lit(r"(?:\.\.\.|…)\s*$")))) > 0.5 * F.size(a)))),
    ]


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = 500, seed: int = 7) -> list[Rule]:
    """Rules by rejections per second, measured on a sample of about ``sample_rows`` rows.

    Each rule runs alone over the sample, once to warm up and once timed. The order only decides how much is computed: a
    document is kept if no rule fails, whatever the order.
    """
    total = docs.count()
    if not total:
        return list(rules)
    scratch = Scratch(docs.sparkSession, "quality")
    # Drawn by as many tasks as read the table; only the rows drawn come together in one.
    drawn = scratch.save(docs.sample(min(1.0, sample_rows / total), seed), "sample")
    sample = drawn.coalesce(1)
    empty, rates = sample.count(), []
    for rule in rules:
        for _ in range(2):
            start = time.perf_counter()
            failed = sample.filter(rule.fails).count()
            cost = time.perf_counter() - start
        rates.append((failed + 0.5) / (empty + 1) / max(cost, 1e-6))
    scratch.drop(drawn)
    return [rule for _, rule in sorted(zip(rates, rules, strict=True), key=lambda x: (-x[0], x[1].name))]


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that fails, else null. Later rules are not evaluated for a document once one fails."""
    chain = None
    for rule in rules:
        chain = F.when(rule.fails, F.lit(rule.name)) if chain is None else chain.when(rule.fails, F.lit(rule.name))
    return F.lit(None).cast("string") if chain is None else chain


def judge(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", sample_rows: int = 500) -> DataFrame:
    """``docs`` with ``rejected_by`` (a failing rule's name, null for a document to keep).

    Empty and null texts fail ``no_words``; ties and repeated rows are judged alike; a text of any length is judged whole; an existing
    ``rejected_by`` is replaced. Empty input: empty result.
    """
    rules = ordered(docs, standard_rules(text) if rules is None else rules, sample_rows)
    return docs.drop("rejected_by").select("*", cascade(rules).alias("rejected_by"))
