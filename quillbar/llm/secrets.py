"""Secret scans over every version of every blob, each content scanned once per rule version. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import Scratch, computed_once, let, whole


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose group ``group`` has at least ``least`` characters.

    ``hint`` is a cheaper pattern that every match contains; texts without it are passed over.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    hint: str | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = [
    SecretRule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               12, 1, r"(?i:passw|secret|token|api_?key)"),
    SecretRule("access", r"AKIA[A-Z0-9]+", 18, hint="AKIA"),
    SecretRule("hex", r"[0-9a-f]{16,}", 16),
]
# Formats that issuers publish for their keys.
MORE_RULES = [
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    SecretRule("code_host", r"\bgh[pousr]_[A-Za-z0-9]{36,}", hint="gh[pousr]_"),
    SecretRule("chat", r"\bxox[abprs]-[A-Za-z0-9-]{10,}", hint="xox[abprs]-"),
    SecretRule("maps", r"\bAIza[0-9A-Za-z_-]{35}", hint="AIza"),
    SecretRule("payment", r"\b[sr]k_(?:live|test)_[0-9A-Za-z]{16,}", hint="k_(?:live|test)_"),
    SecretRule("signed_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hint=r"\.eyJ"),
    SecretRule("url_login", r"://[^\s/:@]{1,64}:([^\s/:@]{6,})@", 6, 1, hint="://"),
]
RULES = BASE_RULES + MORE_RULES


def spans(text: Column, rule: SecretRule, place: int) -> Column:
    """Leftmost matches that do not overlap, those too short dropped: array of (start, place, kind, end) in code points.

    ``split`` gives the pieces between the matches, so running sums of lengths give the offsets.
    """
    kind = "array<struct<start:int,place:int,kind:string,end:int>>"

    def located(pieces: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        sized = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
        both = F.zip_with(F.slice(pieces, 1, F.size(pieces) - 1), F.arrays_zip(found.alias("m"), sized.alias("g")),
                          lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m["m"]).alias("len"), F.length(m["g"]).alias("size")))
        start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

        def step(a: Column, m: Column) -> Column:
            begin = a["at"] + m["gap"]
            here = F.struct(begin.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), (begin + m["len"]).alias("end"))
            return F.struct((begin + m["len"]).alias("at"), F.when(
                m["size"] >= rule.least, F.concat(a["out"], F.array(here))).otherwise(a["out"]).alias("out"))

        return F.aggregate(both, start, step, lambda a: a["out"])

    hint = F.rlike(text, F.lit(rule.hint or rule.pattern))
    return F.when(hint, let(F.split(text, rule.pattern, -1), located)).otherwise(F.expr(f"cast(array() as {kind})"))


def blob_versions(versions: DataFrame, path: str, content: str) -> DataFrame:
    """(``path``, ``blob_id``, ``content``): the content address of each version; null content is the empty content."""
    body = whole(content)
    return versions.select(F.col(path).alias("path"), F.sha2(body.cast("binary"), 256).alias("blob_id"), body.alias("content"))


def unseen_blobs(blobs: DataFrame, rules: list[SecretRule], ledger: DataFrame | None) -> DataFrame:
    """One row per blob with something left to scan: (``blob_id``, ``content``, ``n_paths``, ``seen``: rule keys already done).

    Equal contents are combined before the shuffle, so a blob with many paths ships once per task.
    """
    distinct = blobs.groupBy("blob_id").agg(F.first("content").alias("content"), F.count(F.lit(1)).alias("n_paths"))
    none = F.expr("cast(array() as array<string>)")
    if ledger is None:
        return distinct.select("*", none.alias("seen"))
    done = ledger.filter(F.col("rule_key").isin([r.key for r in rules])).groupBy("blob_id").agg(F.collect_set("rule_key").alias("seen"))
    return distinct.join(done, "blob_id", "left").select("blob_id", "content", "n_paths", F.coalesce("seen", none).alias("seen")).filter(
        F.size("seen") < len(rules))


def scan(versions: DataFrame, rules: list[SecretRule] | None = None, ledger: DataFrame | None = None, path: str = "path",
         content: str = "content") -> DataFrame:
    """New ledger rows: (``blob_id``, ``rule_key``, ``kind``, ``found``: array of (start, end)), one per blob and rule version that
    ``ledger`` does not have, those without findings included. Append them to the ledger for the next scan. Null contents are empty, texts
    of any length are scanned whole, repeated contents once. Empty input: empty result.
    """
    rules = RULES if rules is None else rules
    todo = unseen_blobs(blob_versions(versions, path, content), rules, ledger)
    return _ledger_rows(scanned(todo, rules), rules)


def scanned(todo: DataFrame, rules: list[SecretRule]) -> DataFrame:
    """(``blob_id``, ``n_paths``, ``seen``, ``found``: all spans of the rules not seen, by start, then by the order of the rules)."""
    each = [F.when(F.array_contains("seen", r.key), F.expr("cast(array() as array<struct<start:int,place:int,kind:string,end:int>>)")).otherwise(
        spans(F.col("content"), r, i)) for i, r in enumerate(rules)]
    return computed_once(todo, found=F.array_sort(F.concat(*each))).drop("content")


def _ledger_rows(found: DataFrame, rules: list[SecretRule]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(r.key).alias("rule_key"), F.lit(r.kind).alias("kind")) for r in rules])
    return found.select("blob_id", "seen", "found", F.inline(rows)).filter(~F.array_contains("seen", F.col("rule_key"))).select(
        "blob_id", "rule_key", "kind",
        F.expr("transform(filter(found, x -> x.kind = kind), x -> struct(x.start as start, x.end as end))").alias("found"))


def findings(versions: DataFrame, ledger: DataFrame, rules: list[SecretRule] | None = None, path: str = "path", content: str = "content",
             salts: int = 16) -> DataFrame:
    """(``path``, ``blob_id``, ``found``): every version with the spans that ``ledger`` has for its content under ``rules``, an empty array
    where there are none.

    Only blobs with findings are joined back. Their rows are narrow and repeated ``salts`` times, so that the paths of one
    blob are spread over as many tasks. Repeated rows each come back; null paths stay. Rows of the ledger for other contents or
    rule versions do not count. Empty input: empty result.
    """
    rules = RULES if rules is None else rules
    spans_type = "array<struct<start:int,place:int,kind:string,end:int>>"
    place = F.element_at(F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))]), F.col("rule_key"))
    told = ledger.filter(F.col("rule_key").isin([r.key for r in rules]) & (F.size("found") > 0)).select(
        "blob_id", F.transform("found", lambda s: F.struct(s["start"].alias("start"), place.alias("place"), F.col("kind"), s["end"].alias("end"))).alias("found"))
    # As many rows to a blob as there are rules.
    per = told.distinct().groupBy("blob_id").agg(F.array_sort(F.flatten(F.collect_list("found"))).cast(spans_type).alias("found"))
    per = per.select("blob_id", "found", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    paths = blob_versions(versions, path, content).select("path", "blob_id", F.pmod(F.xxhash64("path"), F.lit(salts)).cast("int").alias("salt"))
    joined = paths.join(per, ["blob_id", "salt"], "left")
    return joined.select("path", "blob_id", F.coalesce("found", F.expr(f"cast(array() as {spans_type})")).alias("found"))


def findings_by_path(versions: DataFrame, rules: list[SecretRule] | None = None, path: str = "path", content: str = "content",
                     salts: int = 16, ledger: DataFrame | None = None) -> DataFrame:
    """(``path``, ``blob_id``, ``found``) as in ``findings``, from ``ledger`` and a scan of what it does not have yet.

    The unseen (blob, rule version) pairs are scanned and written down as new ledger rows in the shared scratch folder; all paths then get
    their spans from the ledger and these rows, paths new to a known blob included. Null contents are empty, a text of any length is
    scanned whole. Without a ledger, or with an empty one, every blob is new.
    """
    rules = RULES if rules is None else rules
    new = Scratch(versions.sparkSession, "secrets").save(scan(versions, rules, ledger, path, content), "ledger")
    return findings(versions, new if ledger is None else ledger.select(*new.columns).unionByName(new), rules, path, content, salts)
