"""Personal data: fixed patterns, and candidates that boosted trees accept.

Generators propose spans generously and may overlap. Candidates in the shape of a fixed pattern carry a label: whether the pattern's check
passed. What passes is also written in other spellings, right and wrong ones, whose candidates are labelled by what they were made
from; dates and prose with an "at" are wrong rows. A boosted model of format and context learns from all of these, counted by equal
features; per kind, the lowest threshold that is precise enough on rows that the trees did not learn from decides which other
candidates are taken. What the fixed patterns find always stays.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.boosting import Boosted, Part, binned, grow
from quillbar.llm.common import Scratch

KINDS = ["email", "ip", "card", "phone"]
LOCAL_CELLS = 50_000  # distinct binned rows that the driver fits on by itself; tasks sum up more of them
PRECISION = 0.98
Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The runs of digits are possessive and start at their first digit: the same matches in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = {
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:\x20?[\[({]?\.[\])}]?\x20?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9](?:[\x20./_-]?[0-9]){11,18}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])"),
}
# A loose e-mail by its "at", which other spellings of it may overlap, and what follows.
_AT = re.compile(r"(?=(\(at\)|\[at\]|\{at\}| at ))", re.I | re.A)
_LOOSE_DOMAIN = re.compile(r" ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\{dot\}| dot |\.) ?[A-Za-z0-9-]{2,63})+", re.I | re.A)
_FORMS = [(" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", "."), ("{at}", "."), (" (AT) ", " (DOT) ")]
_PROSE_AT = re.compile(r"(?<![A-Za-z0-9])([A-Za-z]{1,30}) at ([A-Za-z]{1,30})[ ,;]{1,2}([A-Za-z]{2,30})(?![A-Za-z0-9@])")
_DATE = re.compile(r"(?<![0-9])(?:19|20)[0-9]{2}([-./])[0-9]{2}\1[0-9]{2}(?![0-9])")
_MARKED_AT, _SPELLED_DOT = re.compile(r"[(\[{]at[)\]}]", re.I), re.compile(r"[(\[{]dot[)\]}]| dot ", re.I)
# Common last parts of domains that are no English words.
_TLDS = frozenset("com org net edu gov mil info biz io dev eu uk de fr es ch nl se fi pl ru cn jp au ca br mx".split())
_CUES = [re.compile(p, re.I) for p in (r"mail|contact|write", r"\bip\b|host|server|address", r"card|visa|credit|pay|account", r"phone|tel|call|mobile|fax")]


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each match has one @: the run before it, back to the last match, and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def shaped(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, passed): leftmost matches of each fixed pattern, and whether its check passes."""
    if "@" in text:
        for start, end in _emails(text):
            yield 0, start, end, True
    for m in _IP.finditer(text):
        parts = m[0].split(".")
        yield 1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
    for m in _CARD.finditer(text):
        digits = _only_digits(m[0])
        yield 2, *m.span(), 12 <= len(digits) <= 19 and passes_luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield 3, *m.span(), 9 <= len(_only_digits(m[0])) <= 15


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    """Up to 64 characters, an "at" and a domain with dots, both in any spelling and case; leftmost, without overlaps."""
    end = 0
    for m in _AT.finditer(text):
        last = m.start() - 1 if text[m.start() - 1:m.start()] == " " else m.start()
        start = last
        while start > max(end, last - 64) and text[start - 1] in _LOCAL:
            start -= 1
        domain = _LOOSE_DOMAIN.match(text, m.end(1)) if end <= start < last else None
        if domain:
            end = domain.end()
            yield start, end


def _plain(part: str, code: int) -> str:
    """A part of an address without digits and marks, so that no label hangs on them; made up of letters by ``code`` if nothing is left."""
    left = re.sub("[^A-Za-z]", "", part)
    return left if len(left) > 1 else "".join(chr(ord("a") + (code >> 5 * i) % 26) for i in range(4))


def variants(kind: int, body: str) -> list[tuple[str, bool]]:
    """Other spellings of what a fixed pattern found, with their label: loose ones of the same data, and ones that its check refuses."""
    code = zlib.crc32(body.encode("utf-8", "surrogatepass"))
    if kind == 0:
        local, domain = body.split("@", 1)
        (at, dot), (at2, dot2) = _FORMS[code % len(_FORMS)], _FORMS[code // 8 % len(_FORMS)]
        labels = domain.split(".")
        short = [*(_plain(x, code) for x in labels[:-1]), labels[-1]][-2 - code % 2:]
        return [(local + at + domain.replace(".", dot), True), (_plain(local, code) + at2 + dot2.join(short), True), (_plain(local, code) + at + dot.join(short), True)]
    if kind == 1:
        parts, dot = body.split("."), ("[.]", " . ", "(.)", ". ")[code % 4]
        return [(dot.join(parts), True), (dot.join([str(300 + code % 600), *parts[1:]]), False)]
    digits = _only_digits(body)
    if kind == 2:
        mark, groups = ".-/ _"[code % 5], lambda d: [d[i:i + 4] for i in range(0, len(d), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + code % 8) % 10)
        return [(mark.join(groups(digits)), True), (mark.join(groups(wrong)), False)]
    mark = " .-/"[code % 4]
    return [("00" * (code % 2) + mark.join([digits[:3], digits[3:6], digits[6:]])[:20], True), (digits[:8], False), (mark.join([digits[:3], digits[3:7]]), False)]


def _labels(text: str) -> Iterator[tuple[int, int, list[float], bool]]:
    """(kind, place, features, label) of training candidates: those in the shape of a fixed pattern by its check; the candidates that other
    spellings of them bring forth, which are right if they are of that kind and cover the spelling; dates as no phones; and
    prose with an "at" before a full stop, with and without the blank, as no e-mails."""
    for kind, start, end, ok in shaped(text):
        yield kind, start, features(text, (kind, start, end)), ok
        if not ok or end - start > 128:
            continue
        for i, (body, right) in enumerate(variants(kind, text[start:end])):
            before = text[max(0, start - 64):start]
            other, low = before + body + " " + text[end:end + 1], len(before)
            for k, a, b in candidates(other):
                if a < low + len(body) and b > low:
                    whole = a <= low and b >= low + len(body)
                    yield k, -1 - 8 * start - i, features(other, (k, a, b)), right and k == kind and whole
    for m in _DATE.finditer(text):
        yield 3, m.start(), features(text, (3, *m.span())), False
    for start, end in _loose_emails(text):
        if ". " in text[start:end]:
            yield 0, start, features(text, (0, start, end)), False
    for m in _PROSE_AT.finditer(text):
        before = text[max(0, m.start() - 40):m.start()]
        for i, stop in enumerate((". ", ".")):
            other = f"{before}{m[1]} at {m[2]}{stop}{m[3].capitalize() if i == 0 else m[3]} "
            yield 0, -1 - 8 * m.start() - 5 - i, features(other, (0, len(before), len(other) - 1)), False


def candidates(text: str) -> Iterator[Span]:
    """Spans proposed beyond the fixed patterns; they may overlap each other and those."""
    for start, end in _loose_emails(text):
        yield 0, start, end
    for kind in (1, 2, 3):
        for m in _LOOSE[KINDS[kind]].finditer(text):
            yield kind, *m.span()


def features(text: str, span: Span) -> list[float]:
    """Format of the span and what is around it."""
    kind, start, end = span
    body, before = text[start:end], text[max(0, start - 40):start]
    digits = _only_digits(body)
    groups = re.findall(r"[0-9]+", body)
    left, right = text[start - 1:start], text[end:end + 1]
    side = lambda c: 0.0 if not c or c.isspace() else 2.0 if c.isalnum() else 1.0
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        min(len(digits), 64), min(len(body), 128), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        *(float(min(8, body.count(c))) for c in " -.()/"), float("+" in body), float("@" in body),
        float(sum(c.isalpha() for c in body) / len(body)), float(len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        float(12 <= len(digits) <= 19 and passes_luhn(digits)), float(len(set(digits)) <= 2),
        side(left), side(right), float(left in ("$", "€", "£", "#", "v")), *(float(bool(c.search(before))) for c in _CUES),
        float(". " in body), float(bool(_MARKED_AT.search(body))), float(bool(_SPELLED_DOT.search(body))),
        float(re.split(r"[^A-Za-z]", body)[-1].lower() in _TLDS), float(bool(re.search(r"\. ?[A-Z][a-z]", body))),
    ]


@dataclass
class Model:
    trees: Boosted | None = None
    thresholds: list[float] = field(default_factory=lambda: [2.0] * len(KINDS))

    def accepted(self, text: str, base: list[Span]) -> list[Span]:
        """Candidates over their kind's threshold, best first, that overlap neither a fixed match nor a better candidate."""
        found = list(dict.fromkeys(candidates(text))) if self.trees else []
        taken, out = [(s, e) for _, s, e in base], []
        found = [c for c in found if not any(c[1] < e and s < c[2] for s, e in taken)] if len(taken) < 64 else _clear_of(found, taken)
        if not found:
            return []
        p = self.trees.probability(np.array([features(text, c) for c in found]))
        order = sorted((-v, c) for v, c in zip(p, found, strict=True) if v >= self.thresholds[c[0]])
        for _, c in order:
            if not any(c[1] < e and s < c[2] for _, s, e in out):
                out.append(c)
        return out


def _clear_of(found: list[Span], taken: list[tuple[int, int]]) -> list[Span]:
    """Those that overlap none of many spans."""
    starts, reach = np.array(sorted(taken)).T
    reach = np.maximum.accumulate(reach)
    at = np.searchsorted(starts, [c[2] for c in found]) - 1
    return [c for c, k in zip(found, at, strict=True) if k < 0 or reach[k] <= c[1]]


def spans_of(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """(fixed matches, further spans) of one text."""
    base = [(k, s, e) for k, s, e, ok in shaped(text) if ok]
    return base, model.accepted(text, base)


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.bool_()]
    for batch in batches:
        out: list[list] = [[] for _ in kinds]
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for values in ((row, *found) for found in _labels(text)):
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["row", "kind", "start", "x", "y"])


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row, kind, start, x, y`` of each training candidate (``_labels``); ``row`` is a hash of its document with all columns."""
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    some = docs.select(F.xxhash64(*hashed).alias("row"), F.col(text).alias("text")).filter(F.col("text").rlike("(?i)[0-9@]|[\\[({ ]at[\\])} ]"))
    rows = some.mapInArrow(_training_rows, "row bigint, kind int, start int, x array<double>, y boolean")
    return Scratch(docs.sparkSession, "pii").save(rows, "candidates")


def _quotas(counts: dict[tuple[int, bool], int], bound: int) -> dict[tuple[int, bool], int]:
    """Rows of each group, ``bound`` in all: small groups whole, the others the same number each."""
    out = {}
    for k, group in enumerate(sorted(counts, key=lambda g: (counts[g], g))):
        out[group] = min(counts[group], (bound - sum(out.values())) // (len(counts) - k))
    return out


def sampled(rows: DataFrame, sample_rows: int) -> pd.DataFrame:
    """``kind, x, y, weight``: all labelled candidates, or of each kind and label those with the smallest hashes of row, kind and start. A row
    stands for ``weight`` candidates."""
    counts = {(r.kind, r.y): r.n for r in rows.groupBy("kind", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = counts if sum(counts.values()) <= sample_rows else _quotas(counts, sample_rows)
    place = F.pmod(F.xxhash64("row", "kind", "start"), F.lit(1 << 40))
    limit = F.lit(1 << 40)
    for (kind, y), n in counts.items():
        # Some more than the quota, as the number below a limit varies; the surplus goes below.
        share = min(1.0, (quotas[kind, y] + 6 * quotas[kind, y] ** 0.5) / n)
        limit = F.when((F.col("kind") == kind) & (F.col("y") == y), int(share * (1 << 40))).otherwise(limit)
    table = rows.select("kind", "y", "x", place.alias("place")).filter(F.col("place") < limit).toPandas()
    table["text"] = [str(list(v)) for v in table.x]
    table = table.sort_values(["kind", "y", "place", "text"])  # the same rows whatever their order
    groups = table.groupby(["kind", "y"])
    table = table[groups.cumcount() < [quotas[g] for g in zip(table.kind, table.y, strict=True)]].copy()
    taken = table.groupby(["kind", "y"]).x.transform("size")
    table["weight"] = [counts[g] for g in zip(table.kind, table.y, strict=True)] / taken
    return table.sort_values(["text", "y", "place"])


FOLDS = 3
LEAST_OF_A_KIND = 10
BALANCED_ROWS = 20_000  # groups weigh alike for the edges of the bins beyond this number of candidates
STEPS = 10_000  # scores that differ by less count as one for the thresholds


def _threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray, precision: float) -> float:
    """The lowest score, a half at least, above which ``precision`` of the rows are right; 2 if there is none."""
    order = np.argsort(-p, kind="stable")
    good = np.flatnonzero(np.cumsum((y * weight)[order]) >= precision * np.cumsum(weight[order]))
    return max(0.5, float(p[order][good[-1]])) if len(good) else 2.0


def _edges(cells: DataFrame, counts: dict[tuple[int, bool], float], bins: int) -> list[np.ndarray]:
    """Quantiles of each feature over all candidates, by counts per value. In large tables each kind and label weighs up to the same, so that a
    frequent one does not take all bins. Values are rounded here, so that there are few of them."""
    quotas = _quotas(counts, BALANCED_ROWS) if sum(counts.values()) > BALANCED_ROWS else counts
    value = F.round(F.least("value", F.lit(4096.0)) * 1024) / 1024
    each = cells.select("kind", "y", "weight", F.posexplode("x").alias("feature", "value")).groupBy("kind", "y", "feature", value.alias("value"))
    table = each.agg(F.sum("weight").alias("weight")).toPandas()
    table["weight"] *= [quotas[g] / counts[g] for g in zip(table.kind, table.y, strict=True)]
    out = []
    for _, one in table.groupby("feature"):
        one = one.groupby("value").weight.sum()  # in order of the values
        reached = one.to_numpy().cumsum()
        places = np.searchsorted(reached, np.linspace(0, 1, bins + 1)[1:-1] * reached[-1])
        out.append(np.unique(one.index.to_numpy()[np.minimum(places, len(one) - 1)]))
    return out


def _into_bins(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
        bins = pa.array([row.tobytes() for row in binned(x, edges)] if len(batch) else [], pa.binary())
        yield pa.RecordBatch.from_arrays([bins, *[batch.column(c) for c in ("kind", "y", "fold", "weight")]], ["bins", "kind", "y", "fold", "weight"])


def _part(table: pd.DataFrame) -> Part:
    """Cells as rows of the models: one per fold without its rows, then one with all."""
    bins = np.frombuffer(b"".join(table.bins), np.uint8).reshape(len(table), -1)
    weight, fold = table.weight.to_numpy(), table.fold.to_numpy()
    return Part(bins, table.y.to_numpy(dtype=float), np.stack([*(weight * (fold != f) for f in range(FOLDS)), weight]))


def _level_sums(parts: Iterator[pd.DataFrame], models: list[Boosted], level: int) -> Iterator[pd.DataFrame]:
    total = 0
    for table in parts:
        if len(table):
            total = total + _part(table).sums(models, level)
    if not isinstance(total, int):
        yield pd.DataFrame({"place": np.arange(total.size), "value": total.ravel()})


def _scores(table: pd.DataFrame, part: Part, models: list[Boosted]) -> pd.DataFrame:
    """``kind, step, good, weight, p``: sums by the step of the score that the model without the row's fold gives; ``p`` is the least score."""
    p = np.choose(table.fold.to_numpy(), [part.score(f, models[f]) for f in range(FOLDS)])
    rows = pd.DataFrame({"kind": table.kind.to_numpy(), "step": np.floor(p * STEPS).astype(int), "good": table.weight.to_numpy() * table.y.to_numpy(), "weight": table.weight.to_numpy(), "p": p})
    return rows.groupby(["kind", "step"], as_index=False).agg({"good": "sum", "weight": "sum", "p": "min"})


def _fitted(cells: DataFrame, models: list[Boosted], local_cells: int) -> pd.DataFrame:
    """Grows the models and gives the ``_scores`` of all cells. Few cells come to the driver; more stay where they are, and only sums come."""
    table = cells.limit(local_cells + 1).toPandas()
    if len(table) <= local_cells:
        table = table.sort_values(["bins", "kind", "y", "fold"])
        part = _part(table)
        grow(models, part.sums)
        return _scores(table, part, models)

    def sums(models: list[Boosted], level: int) -> np.ndarray:
        parts = cells.mapInPandas(lambda parts: _level_sums(parts, models, level), "place bigint, value double")
        found = parts.groupBy("place").agg(F.sum("value").alias("value")).toPandas().sort_values("place")
        n_features = len(models[0].edges)
        return found.value.to_numpy().reshape(len(models), 2, 1 << level, n_features, models[0].bins)

    grow(models, sums)
    scored = cells.mapInPandas(lambda parts: (_scores(t, _part(t), models) for t in parts if len(t)), "kind int, step bigint, good double, weight double, p double")
    return scored.groupBy("kind", "step").agg(F.sum("good").alias("good"), F.sum("weight").alias("weight"), F.min("p").alias("p")).toPandas()


def fit(docs: DataFrame, text: str = "text", sample_rows: int | None = None, precision: float = PRECISION, local_cells: int = LOCAL_CELLS) -> Model:
    """Fitted on all labelled candidates of all documents; with ``sample_rows`` on a weighted sample of them (``sampled``).

    Candidates with the same features and label count as one row with their number as its weight, and the trees need sums per node and
    bin only, so nothing grows with the table but the tasks. Thresholds come from the scores of each row by trees that did not learn
    from it. A kind with under ``LEAST_OF_A_KIND`` right rows takes the threshold of all kinds together, so a small table switches
    no kind off. No model without right and wrong rows, as in an empty table.
    """
    spark, found = docs.sparkSession, labelled(docs, text)
    rows = found.select("kind", "y", "x", F.pmod(F.xxhash64("row", "kind", "start"), F.lit(1 << 40)).alias("place"), F.lit(1.0).alias("weight"))
    if sample_rows is not None:
        drawn = sampled(found, sample_rows)
        listed = [(int(k), bool(y), [float(v) for v in x], int(at), float(w)) for k, y, x, at, w in drawn[["kind", "y", "x", "place", "weight"]].itertuples(index=False)]
        rows = spark.createDataFrame(listed, "kind int, y boolean, x array<double>, place bigint, weight double")
    scratch = Scratch(spark, "pii-cells")
    cells = rows.groupBy("kind", "y", "x", (F.col("place") % FOLDS).cast("int").alias("fold")).agg(F.sum("weight").alias("weight"))
    cells = scratch.save(cells, "vectors")
    counted = cells.groupBy("kind", "y", "fold").agg(F.sum("weight").alias("n")).toPandas()
    if counted.y.nunique() < 2:
        return Model()
    counts = {(int(k), bool(y)): float(n) for (k, y), n in counted.groupby(["kind", "y"]).n.sum().items()}
    models = [Boosted() for _ in range(FOLDS + 1)]
    edges = _edges(cells, counts, models[0].bins)
    for f, model in enumerate(models):
        kept = counted[counted.fold != f]
        model.begin(edges, float(kept.n[kept.y].sum()), float(kept.n.sum()))
    kept = cells.mapInArrow(lambda batches: _into_bins(batches, edges), "bins binary, kind int, y boolean, fold int, weight double")
    kept = scratch.save(kept.groupBy("bins", "kind", "y", "fold").agg(F.sum("weight").alias("weight")), "cells")
    steps = _fitted(kept, models, local_cells)
    lowest = lambda t: _threshold(t.p.to_numpy(), (t.good / t.weight).to_numpy(), t.weight.to_numpy(), precision)
    every = steps.groupby("step", as_index=False).agg({"good": "sum", "weight": "sum", "p": "min"})
    own = [steps[steps.kind == k] for k in range(len(KINDS))]
    return Model(models[FOLDS], [lowest(t if t.good.sum() >= LEAST_OF_A_KIND else every) for t in own])


def _found(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
    for batch in batches:
        out = []
        for text in batch.column("text").to_pylist():
            base, more = spans_of(text or "", model)
            every = sorted([(s, k, e, True) for k, s, e in base] + [(s, k, e, False) for k, s, e in more])
            out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in every])
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, kind)], [*names, "found"])


def find(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``found`` (array of kind, start, end, base) per row, by start, then kind. Null texts have none; offsets are code points,
    end exclusive. Repeated rows come back each; empty input gives no rows."""
    rows = docs.select(*[F.col(k) for k in keys], F.col(text).alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    return rows.mapInArrow(lambda b: _found(b, model), ", ".join([*fields, "found array<struct<kind:string,start:int,end:int,base:boolean>>"]))


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with each run of overlapping spans replaced by the name of its first kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redacted(batches: Iterator[pa.RecordBatch], model: Model, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        place = batch.schema.get_field_index(text)
        texts = [t if t is None else masked(t, [x for part in spans_of(t, model) for x in part]) for t in batch.column(place).to_pylist()]
        yield batch.set_column(place, text, pa.array(texts, batch.schema.field(place).type))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced; null stays null, all other columns and rows stay."""
    redacting: Callable = lambda batches: _redacted(batches, model, text)
    return docs.mapInArrow(redacting, docs.schema)
