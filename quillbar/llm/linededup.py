"""Remove lines, sentences and stretches that an earlier ranked document already has, by digests of normalised units.

The units of a text do not overlap. A line is cut at the ends of sentences, and inside a sentence by content: at each word whose hash, with that
of the word before, is the least of its neighbourhood within the sentence, so that the cuts of a passage that starts and ends inside longer
sentences fall between the same words in every copy. A unit of enough words is known by its own words. A shorter one is known by the shortest run of
units of its line with enough words that starts with it, else that ends with it, else by its line, and by its place in there: it is a
repeat only where its neighbours repeat with it. So each unit has one digest, equal digests mean equal words, and of the units with one digest
the first one in the document with the smallest id stays, whole: no other digest can remove it. All others go. Lines with fewer words than a sentence
needs are one unit, very short lines none. Words compare in lower case whatever blanks are between them; scripts without blanks count by
characters. Spans are code point offsets into the original text, end exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import Scratch, mixed, powers, span_hashes

# Shorter units repeat by chance.
LINE_WORDS = 5
SENTENCE_WORDS = 8
NEIGHBOURS = 6  # words on each side among which a cut has the least hash
# Characters of text that are cut at a time; a longer line is cut by itself.
STRETCH = 1 << 20
# Scripts without blanks: each character is a token, and so many quarters of a word. Punctuation of full width counts nothing.
_WORD = 4
_UNSPACED = [(2, 0x3040, 0x30FF), (2, 0x3400, 0x4DBF), (2, 0x4E00, 0x9FFF), (2, 0xF900, 0xFAFF), (2, 0x20000, 0x3FFFF),
             (1, 0x0E00, 0x0EFF), (1, 0x1000, 0x109F), (1, 0x1780, 0x17FF),
             (0, 0x3001, 0x303F), (0, 0xFF01, 0xFF0F), (0, 0xFF1A, 0xFF20), (0, 0xFF5B, 0xFF65)]
_ENDERS = np.array([ord(c) for c in ".!?。！？｡"], np.uint32)
_BLANK = np.array([chr(c).isspace() for c in range(0x3001)])
_PAIR, _PLACE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_PAIR_INVERSE = np.uint64(pow(int(_PAIR), -1, 2**64))
UNIT = "uid bigint, doc_id bigint, tag bigint, n_chars int, start int, stop int, reach int, again boolean, d1 bigint, d2 bigint"
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]


def _tokens(text: str) -> tuple[np.ndarray, ...]:
    """Starts, ends, quarters of words, whether it ends a sentence, hash and line of each token."""
    # The only letter whose small form is longer.
    text = text.replace("İ", "i").lower()
    stream = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if text.isascii():
        codes, at = stream, None
        quarters = None
        blank = _BLANK[codes]
        edge = np.concatenate([[True], blank, [True]])
        opens, closes = ~blank & edge[:-2], ~blank & edge[2:]
    else:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.append(np.flatnonzero((stream & 0xC0) != 0x80), len(stream))
        blank = _BLANK[np.minimum(codes, 0x3000)] & (codes <= 0x3000)
        quarters = np.full(len(codes), _WORD, np.int8)
        for quarter, low, high in _UNSPACED:
            quarters[(codes >= low) & (codes <= high)] = quarter
        edge = np.concatenate([[True], blank | (quarters < _WORD), [True]])
        opens, closes = ~blank & (edge[:-2] | edge[1:-1]), ~blank & (edge[2:] | edge[1:-1])
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    weights = np.full(len(starts), _WORD, np.int64) if quarters is None else quarters[starts].astype(np.int64)
    hashes = span_hashes(stream, starts, ends) if at is None else span_hashes(stream, at[starts], at[ends])
    return starts, ends, weights, np.isin(codes[ends - 1], _ENDERS), hashes, np.searchsorted(np.flatnonzero(codes == 10), starts)


def _first_of_each(labels: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ones(min(1, len(labels)), bool), labels[1:] != labels[:-1]])


def units(text: str, line_words: int = LINE_WORDS, sentence_words: int = SENTENCE_WORDS) -> tuple[np.ndarray, ...]:
    """Start and stop of each unit, without the blanks around it, where the next unit of its line starts, and its digest in two halves."""
    starts, ends, weights, closing, hashes, line = _tokens(text)
    n, need = len(starts), _WORD * sentence_words
    if not n:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    lines = _first_of_each(line)
    cuts = lines.copy()
    cuts[1:] |= closing[:-1] & (weights[1:] > 0)
    width = 2 * NEIGHBOURS + 1
    if n > width:
        sentence = np.cumsum(cuts)
        pairs = mixed(hashes[1:] * _PAIR + hashes[:-1])
        least = np.lib.stride_tricks.sliding_window_view(pairs, width).min(1)
        inside = sentence[:-width] == sentence[width:]
        cuts[NEIGHBOURS + 1:n - NEIGHBOURS] |= (pairs[NEIGHBOURS:len(pairs) - NEIGHBOURS] == least) & inside
    so_far = np.concatenate([[0], np.cumsum(weights)])
    of_line = np.cumsum(lines) - 1
    line_at = np.flatnonzero(lines)
    line_end = np.append(line_at[1:], n)
    in_line = so_far[line_end] - so_far[line_at]
    first = np.flatnonzero(lines | cuts & (in_line >= need)[of_line])
    last = np.append(first[1:], n)
    home = of_line[first]

    # The run each unit is known by.
    onward = np.searchsorted(so_far[last], so_far[first] + need)
    fits = np.minimum(onward, len(first) - 1)
    ahead = (onward < len(first)) & (home[fits] == home)
    back = np.searchsorted(so_far[first], so_far[last] - need, "right") - 1
    behind = (back >= 0) & (home[np.maximum(back, 0)] == home)
    run_at = np.where(ahead, first, np.where(behind, first[np.maximum(back, 0)], line_at[home]))
    run_end = np.where(ahead, last[fits], np.where(behind, last, line_end[home]))
    place = mixed(((run_end - run_at) * 3 + (first - run_at) * 5).astype(np.uint64) * _PLACE + (last - first).astype(np.uint64))
    digests = []
    for values in (hashes, mixed(hashes ^ _PLACE)):
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(_PAIR, n), out=total[1:])
        digests.append(mixed((total[run_end] - total[run_at]) * powers(_PAIR_INVERSE, n)[run_at] + place))
    stop = ends[last - 1]
    reach = np.where(np.append(home[1:] == home[:-1], False), np.append(starts[first[1:]], 0), stop)
    counts = in_line[home] >= _WORD * line_words
    return tuple(x[counts] for x in (starts[first], stop, reach, *digests))


def _stretches(texts: list[str]) -> Iterator[tuple[int, int, str]]:
    """(number of the text, offset, part), cut at line ends into parts of STRETCH characters; a longer line stays whole."""
    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = len(text) if len(text) - at <= STRETCH else text.find("\n", at + STRETCH) + 1 or len(text)
            yield k, at, text[at:stop]
            at = stop


def _units_of(texts: list[str], line_words: int, sentence_words: int) -> tuple[np.ndarray, ...]:
    """The number of its text and ``units`` of each unit of all texts, in order; offsets into its own text."""
    found, held, size = [], [], 0

    def cut():
        lengths = np.array([len(part) + 1 for _, _, part in held])
        begins = np.cumsum(lengths) - lengths
        start, stop, reach, d1, d2 = units("\n".join(part for _, _, part in held), line_words, sentence_words)
        which = np.searchsorted(begins, start, "right") - 1
        shift = (np.array([at for _, at, _ in held]) - begins)[which]
        found.append((np.array([k for k, _, _ in held])[which], start + shift, stop + shift, reach + shift, d1, d2))

    for part in _stretches(texts):
        held.append(part)
        size += len(part[2])
        if size >= STRETCH:
            cut()
            held, size = [], 0
    if held:
        cut()
    if not found:
        return tuple(np.zeros(0, kind) for kind in (np.int64,) * 4 + (np.uint64,) * 2)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _units(batches: Iterator[pa.RecordBatch], line_words: int, sentence_words: int) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 33
    names = [c.split()[0] for c in UNIT.split(", ")]
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n, doc_id = len(texts), batch.column("doc_id")
        nothing = [pa.nulls(n, kind) for kind in _KINDS[4:]]
        columns = [pa.array(np.arange(uid, uid + n)), doc_id, batch.column("tag"), pa.array([len(t) for t in texts], pa.int32()), *nothing]
        yield pa.RecordBatch.from_arrays(columns, names)
        which, start, stop, reach, d1, d2 = _units_of(texts, line_words, sentence_words)
        order = np.lexsort((start, d2, d1, which))
        same = [x[order][1:] == x[order][:-1] for x in (which, d1, d2)]
        again = np.zeros(len(which), bool)
        again[order[1:]] = same[0] & same[1] & same[2]
        units_n = len(which)
        columns = [pa.array(uid + which), doc_id.take(pa.array(which)), pa.nulls(units_n, pa.int64()), pa.nulls(units_n, pa.int32()),
                   *[pa.array(x.astype(np.int32)) for x in (start, stop, reach)], pa.array(again), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names)
        uid += n


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans (start, stop, reach) as few (start, stop): what lies up to a span's reach are blanks, which go where both sides go."""
    out: list[tuple[int, int]] = []
    far = -1
    for start, stop, reach in sorted(spans):
        if start <= far:
            out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
        far = reach
    return out


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    for batch in batches:
        gone, kept, chars = [], [], []
        for n, spans in zip(batch.column("n_chars").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            out = merged([(s["start"], s["stop"], s["reach"]) for s in spans])
            edges = [0, *(x for s in out for x in s), n]
            rest = [(a, b) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b]
            gone.append([{"start": a, "stop": b} for a, b in out])
            kept.append([{"start": a, "stop": b} for a, b in rest])
            chars.append(sum(b - a for a, b in out))
        same = [batch.column(c) for c in ("doc_id", "tag", "n_units", "n_removed", "first_docs")]
        yield pa.RecordBatch.from_arrays([*same, pa.array(chars, pa.int64()), pa.array(gone, kind), pa.array(kept, kind)],
                                         ["doc_id", "tag", "n_units", "n_removed", "first_docs", "removed_chars", "removed", "kept"])


def duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", line_words: int = LINE_WORDS,
               sentence_words: int = SENTENCE_WORDS) -> DataFrame:
    """``doc_id, tag, n_units, n_removed, first_docs, removed_chars, removed, kept`` per row of ``docs``.

    ``removed`` and ``kept`` are arrays of (start, stop) that together make up the text; ``first_docs`` are the documents that keep the
    removed units; ``tag`` is xxhash64 of the text. Null and empty texts
    have no units. Null ids rank after all others and equal among themselves: their units go only where a document with an id
    has them too. Rows with equal ids rank equal. Other columns are ignored. Empty input: empty result.
    Very long texts are worked off line by line, some STRETCH characters at a time; only a single longer line is held as a whole.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))
    found = scratch.save(rows.mapInArrow(lambda batches: _units(batches, line_words, sentence_words), UNIT), "units")
    spans = found.filter(F.col("start").isNotNull())
    # Map tasks combine equal digests, so a line that a third of all documents have is one row per task.
    first = spans.groupBy("d1", "d2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times")
    first = scratch.save(first, "first")
    extra = spans.join(first, ["d1", "d2"]).filter(F.col("again") | ~F.col("doc_id").eqNullSafe(F.col("first")))
    removed = extra.groupBy("uid").agg(F.collect_list(F.struct("start", "stop", "reach")).alias("spans"), F.array_sort(F.collect_set("first")).alias("first_docs"))
    counts = found.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.max("tag").alias("tag"), F.max("n_chars").alias("n_chars"), F.count("start").alias("n_units"))
    none = F.expr("cast(array() as array<struct<start:int,stop:int,reach:int>>)")
    per = counts.join(removed, "uid", "left").select("doc_id", "tag", "n_chars", "n_units", F.coalesce("spans", none).alias("spans"),
                                                          F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs"))
    per = per.select("*", F.size("spans").cast("bigint").alias("n_removed"))
    span = "array<struct<start:int,stop:int>>"
    return per.mapInArrow(_finished, f"doc_id bigint, tag bigint, n_units bigint, n_removed bigint, first_docs array<bigint>, removed_chars bigint, removed {span}, kept {span}")


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``docs`` with the repeated units cut out of ``text`` and ``kept_spans``, the original offsets of what is left."""
    spans = duplicates(docs, doc_id, text, **limits).select(F.col("doc_id").alias("_d"), F.col("tag").alias("_t"), F.col("kept").alias("kept_spans"))
    spans = spans.dropDuplicates(["_d", "_t"])
    tagged = docs.drop("kept_spans").select("*", F.xxhash64(F.col(text)).alias("_tag"))
    joined = tagged.join(spans, F.col(doc_id).cast("bigint").eqNullSafe(F.col("_d")) & (F.col("_tag") == F.col("_t")), "left")
    left = F.concat_ws("", F.transform("kept_spans", lambda s: F.substring(F.col(text), s["start"] + 1, s["stop"] - s["start"])))
    cut = F.when(F.col(text).isNotNull(), left).alias(text)
    return joined.select(*[cut if c == text else c for c in docs.columns if c != "kept_spans"], "kept_spans")
