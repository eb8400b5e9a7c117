"""The registered queries of this folder, over whole tables, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.llm import chat, collocations, decontaminate, language, linededup, mixing, mtree, neardup, periodic, pii, quality, scoring, secrets
from quillbar.llm.common import table
from quillbar.llm.sql import CHAT_SQL, MIXING_SQL, PHRASE_SQL, TOP_K_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, the SQL that gives the same rows."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def _joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def span_digest(found: Column, base_kinds: list[str], base: Column) -> list[Column]:
    """n_<kind> of the base spans, base_sha256 and spans, from arrays of spans in order."""
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint")
    counts = [of(k).alias(f"n_{k}") for k in base_kinds]
    return [*counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(found).alias("spans")]


@query("op1_context_tree_score")
def op1_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(documents(spark, sf_dir))


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose units, with the spans that go and the documents that keep them."""
    spans = F.concat_ws(",", F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"])))
    found = linededup.duplicates(documents(spark, sf_dir)).filter("n_removed > 0")
    return found.select("doc_id", "n_units", "n_removed", "first_docs", "removed_chars", spans.alias("removed"))


@query("op3_minhash_near_dedup")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@query("op4_cgk_decontamination")
def op4_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(documents(spark, sf_dir))
    spans = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["lang"], s["start"], s["end"])))
    return found.select("doc_id", "held_out", "lang_pred", "score", spans.alias("spans"))


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find(docs, pii.fit(docs), ["doc_id"])
    return found.select("doc_id", *span_digest(F.col("found"), pii.KINDS, F.filter("found", lambda s: s["base"])))


@query("op7_collapse_conversations", CHAT_SQL)
def op7_collapse_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse(table(spark, sf_dir, "conversations"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings_by_path(documents(spark, sf_dir), path="doc_id", content="text")
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("found", lambda s: s["kind"].isin(kinds))
    return found.select(F.col("path").alias("doc_id"), *span_digest(F.col("found"), kinds, base))


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = quality.ordered(docs, quality.standard_rules())
    facts = quality.text_features(docs)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = F.when(failed, False).otherwise(quality.cascade(rules).isNull())
    return facts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), passes.alias("kept"))


@query("op10_mix_sources", MIXING_SQL)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs, appetite=mixing.by_length(F.col("size"))).select("doc_id", "size", "source_size", "target", "taken")


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(documents(spark, sf_dir), text=periodic.with_planted_runs())
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("most"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.withColumn("longest", longest).withColumn("length", -F.col("longest.most"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "longest.start", "length", "longest.period",
                        F.expr("1000 * length div longest.period").alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op12_mtree_top_k", TOP_K_SQL)
def op12_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op13_phrase_collocations", PHRASE_SQL)
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
