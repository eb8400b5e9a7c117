"""Spans of one language in mixed text: script ranges, scores per word, Viterbi with a switching penalty.

A word is a run of letters. Its script, from the Unicode range of its first letter, leaves the languages that were seen in that
script. Their scores are naive Bayes over the word's byte 1- to 3-grams (with its borders), hashed into a table of fixed size. A
path pays ``PENALTY`` per change of language, so short foreign words stay in the span around them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import held_out, mixed

SLOTS = 1 << 16  # hashed n-grams
PENALTY = 6.0
SMOOTH = 0.5
CHUNK_WORDS = 1 << 16  # distinct words of a language that a task counts before it turns them into n-grams
RUN_CHARS, RUN_TEXTS = 2 << 20, 512  # of text that is labelled together
# First code points of script ranges (Unicode blocks), with the script that starts there.
RANGES = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
          (0x0900, "indic"), (0x0E00, "thai"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
          (0x2000, "other"), (0x3040, "kana"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xFF21, "latin"),
          (0xFF66, "kana"), (0x10000, "other"), (0x20000, "han")]
SCRIPTS = sorted({name for _, name in RANGES})
_STARTS, _SCRIPT_AT = [a for a, _ in RANGES], [SCRIPTS.index(s) for _, s in RANGES]
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def script_of(word: str) -> int:
    return _SCRIPT_AT[bisect_right(_STARTS, ord(word[0])) - 1]


def gram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the byte 1- to 3-grams of all words together, and the word of each."""
    encoded = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    stream = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), [len(e) for e in encoded])
    slots, owners = [], []
    for n in (1, 2, 3):
        if len(stream) < n:
            continue
        key = np.full(len(stream) - n + 1, n, np.uint64)
        for k in range(n):
            key = (key << np.uint64(8)) | stream[k: len(stream) - n + 1 + k]
        inside = owner[: len(owner) - n + 1] == owner[n - 1:]
        slots.append((mixed(key[inside]) % np.uint64(SLOTS)).astype(np.int64))
        owners.append(owner[: len(owner) - n + 1][inside])
    return (np.concatenate(slots), np.concatenate(owners)) if slots else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language: (slot, count) of its n-grams and, above the slots, of its words by script. One row per pair and task."""
    seen: dict[str, dict[str, int]] = {}
    out: dict[str, np.ndarray] = {}

    def spill(lang: str) -> None:
        words = seen.pop(lang)
        slots, owner = gram_slots(list(words))
        weight = np.fromiter(words.values(), np.int64, len(words))
        total = out.setdefault(lang, np.zeros(SLOTS + len(SCRIPTS), np.int64))
        total[:SLOTS] += np.bincount(slots, weight[owner], minlength=SLOTS).astype(np.int64)
        for w, n in words.items():
            total[SLOTS + script_of(w)] += n

    for batch in batches:
        for lang, text in ((x["lang"], x["text"]) for at in range(0, batch.num_rows, RUN_TEXTS) for x in batch.slice(at, RUN_TEXTS).to_pylist()):
            words = seen.setdefault(lang, {})
            for w in _WORD.findall((text or "").lower()):
                words[w] = words.get(w, 0) + 1
            if len(words) > CHUNK_WORDS:
                spill(lang)
    for lang in list(seen):
        spill(lang)
    for lang, total in out.items():
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slots)), pa.array(slots.astype(np.int32)), pa.array(total[slots])], ["lang", "slot", "n"])


class Model:
    """Languages, log probabilities per (slot, language), and which languages each script leaves."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        grams = counts[:SLOTS] + SMOOTH
        self.table = np.log(grams / grams.sum(0)).astype(np.float32)
        scripts = counts[SLOTS:]
        share = scripts / np.maximum(1, scripts.sum(0))
        # A script that a language uses for under one word in a thousand is a loan there. Unknown scripts leave all languages.
        allowed = share >= 0.001
        allowed[~allowed.any(1)] = True
        self.bar = np.where(allowed, 0.0, -1e6).astype(np.float32)

    def scores(self, words: list[str]) -> np.ndarray:
        """One row per word. A mean over its n-grams times the root of their number, so that long words do not outvote."""
        slots, owner = gram_slots(words)
        n = np.bincount(owner, minlength=len(words))
        out = np.stack([np.bincount(owner, self.table[slots, k], minlength=len(words)) for k in range(self.table.shape[1])], 1)
        out = out / np.sqrt(np.maximum(1, n))[:, None]
        return out + self.bar[[script_of(w) for w in words]] if len(words) else out


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Counts over all labelled rows. What reaches the driver is one row per slot and language: at most 65,552 times the languages."""
    rows = labelled.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInArrow(_counts, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    table = counts.toPandas()
    langs = sorted(table.lang.unique())
    matrix = np.zeros((SLOTS + len(SCRIPTS), max(1, len(langs))))
    matrix[table.slot.to_numpy(dtype=int), [langs.index(x) for x in table.lang]] = table.n
    return Model(langs, matrix)


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best label of each word. ``scores``: rows of the words of all texts in turn; ``lengths``: words per text.

    All texts advance together, longest first, one word a step; a text that has ended drops out.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
    back = np.zeros(scores.shape, np.int16)
    best = np.zeros((len(lengths), scores.shape[1]))
    lanes = np.arange(scores.shape[1], dtype=np.int16)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    for t in range(longest):
        n, at = active[t], starts[: active[t]] + t
        if t:
            top = best[:n].argmax(1)
            change = best[np.arange(n), top][:, None] - penalty
            stay = best[:n] >= change
            back[at] = np.where(stay, lanes, top[:, None].astype(np.int16))
            best[:n] = np.where(stay, best[:n], change)
        best[:n] += scores[at]
    labels = np.zeros(len(scores), np.int16)
    current = best.argmax(1)
    for t in range(longest - 1, -1, -1):
        n, at = active[t], starts[: active[t]] + t
        labels[at] = current[:n]
        current[:n] = back[at, current[:n]]
    return labels


def _runs_of(texts: list[str | None], least: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (size < least or stop == at):
            size += len(texts[stop] or "")
            stop += 1
        yield at, stop
        at = stop


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
    for whole_batch in (batch.slice(at, RUN_TEXTS) for batch in batches for at in range(0, batch.num_rows, RUN_TEXTS)):
        every = whole_batch.column("text").to_pylist()
        for first, stop in _runs_of(every, RUN_CHARS):
            found = [[(m.group(), *m.span()) for m in _WORD.finditer(t.lower() if len(t.lower()) == len(t) else t)] if t else [] for t in every[first:stop]]
            index: dict[str, int] = {}
            ids = np.fromiter((index.setdefault(w, len(index)) for words in found for w, _, _ in words), np.int64)
            lengths = np.array([len(words) for words in found], np.int64)
            per_word = model.scores(list(index))
            labels = viterbi(per_word[ids], lengths) if len(ids) and model.langs else np.zeros(0, np.int16)
            preds, values, spans, at = [], [], [], 0
            for words in found:
                own = labels[at: at + len(words)]
                if not len(own):
                    preds.append("und"), values.append(0.0), spans.append([])
                    at += len(words)
                    continue
                at += len(words)
                letters = np.array([b - a for _, a, b in words])
                share = np.bincount(own, letters, minlength=len(model.langs)) / letters.sum()
                preds.append(model.langs[int(share.argmax())]), values.append(float(share.max()))
                cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                ends = np.r_[cuts[1:], len(own)] - 1
                spans.append([{"start": words[a][1], "end": words[b][2], "lang": model.langs[own[a]]} for a, b in zip(cuts, ends, strict=True)])
            keys = [whole_batch.column(c).slice(first, stop - first) for c in whole_batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(preds, pa.string()), pa.array(values, pa.float64()), pa.array(spans, kind)],
                                             [*[c for c in whole_batch.schema.names if c != "text"], "lang_pred", "score", "spans"])


def label(docs: DataFrame, model: Model, keys: list[str], text: str = "text") -> DataFrame:
    """``keys``, ``lang_pred``, ``score`` and ``spans`` (start, end in code points, lang) per row of ``docs``.

    ``lang_pred`` has the largest share of the letters in its spans, ``score`` is that share. Null texts, texts without a letter and, with
    an untrained model, all texts give ``und``, score 0 and no spans. Equal texts get equal labels; empty input gives no rows.
    """
    rows = docs.select(*[F.col(k) for k in keys], F.col(text).alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*fields, "lang_pred string", "score double", "spans array<struct<start:int,end:int,lang:string>>"])
    return rows.mapInArrow(lambda batches: _predict(batches, model), schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, fold: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, spans``: learned from the rows whose crc32(doc_id as text) mod ``folds`` is not ``fold``."""
    marked = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, folds, fold).alias("held_out"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = train(marked.filter(~F.col("held_out")))
    return label(marked, model, ["doc_id", "held_out"])


def _confident(batches: Iterator[pa.RecordBatch], model: Model, text: str, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(text))], ["text"])
        for part in _predict(iter([texts]), model):
            known = [p != "und" and s >= least for p, s in zip(part.column("lang_pred").to_pylist(), part.column("score").to_pylist(), strict=True)]
            yield batch.slice(0, len(known)).filter(pa.array(known, pa.bool_()))
            batch = batch.slice(len(known))


def confident(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language holds at least ``least`` of the letters, all columns as they are; ``und`` goes."""
    return docs.mapInArrow(lambda batches: _confident(batches, model, text, least), docs.schema)
