"""Runs: stretches of a word sequence that repeat with a period, found with a dictionary of basic factors.

A run has smallest period q, at least ``times`` * q words, and no neighbouring word extends it. The basic factors are the stretches of
1, 2, 4, ... words. Per length:

1. Every place has the name of the factor that starts there; a name of twice the length is a pair of names. A factor that occurs
   once makes every longer factor around it occur once, so only places whose factor recurs go on to the next length.
2. The successor of a place is the next place with the same name. Where the successors of consecutive places lie equally far, the
   occurrences form arithmetic progressions, and their distance is the proposed period. With factors of L words only distances above
   L / 2 and up to L count, so each period is proposed at one length.
3. A stretch of m such places proposes the run of m - 1 + L + q words from its first place. The factor before or behind the stretch would
   have the same successor if the run went on, so the proposal is extended as far as it goes, and no run is proposed twice. The
   distance is the smallest period: a smaller one would divide it, and the factor would recur earlier.

Documents are worked off together, some megabytes at a time. The names of the first length carry the number of the document, so a stretch
over the border of two documents occurs once. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import let, mixed, word_hashes
from quillbar.llm.quality import word_array

LEAST, TIMES = 6, 4
CHUNK_BYTES = 4 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _ranks(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the names (equal ones by place), which of them equals the one before it, and the rank of each name."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    same = np.r_[False, ordered[1:] == ordered[:-1]]
    ranks = np.empty(len(names), np.int64)
    ranks[order] = np.cumsum(~same)
    return order, same, ranks


def factor_runs(codes: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(start, length, period) of every run in ``codes``, as rows by start, then period. No sequence in it has more than ``longest`` places."""
    if times < 3:
        raise ValueError("runs of under three periods are not proposed")
    at, names, size, found = np.arange(len(codes)), codes, 1, [np.zeros((0, 3), np.int64)]
    while len(at) and times * (size // 2 + 1) <= longest:
        order, same, ranks = _ranks(names)
        later, earlier = order[same], order[np.flatnonzero(same) - 1]
        gap = np.zeros(len(at), np.int64)
        gap[earlier] = at[later] - at[earlier]
        near = np.flatnonzero((gap > size // 2) & (gap <= size))
        if len(near):
            place, period = at[near], gap[near]
            first = np.flatnonzero(np.r_[True, (np.diff(place) != 1) | (np.diff(period) != 0)])
            place, period = place[first], period[first]
            length = np.diff(np.r_[first, len(near)]) - 1 + size + period
            long = length >= np.maximum(least, times * period)
            found.append(np.stack([place, length, period], 1)[long])
        recurs = gap > 0
        recurs[later] = True
        at, ranks = at[recurs], ranks[recurs]
        half = np.searchsorted(at, at + size)
        half[half == len(at)] = 0
        both = at[half] == at + size if len(at) else half
        at, names = at[both.astype(bool)], (ranks * (len(codes) + 1) + ranks[half])[both.astype(bool)]
        size *= 2
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _chunks(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    """The texts as words with one space between them, some megabytes at a time."""
    chunk, size = [], 0
    for text in texts:
        chunk.append(b" ".join((text or b"").split()))
        size += len(chunk[-1]) + 1
        if size > CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def chunk_runs(bodies: list[bytes], least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, runs of all texts with starts counted within their text, and the text of each run."""
    stream = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    ends = np.flatnonzero((stream == 32) | (stream == 10))
    filled = np.diff(ends, prepend=-1) > 1
    text = np.searchsorted(np.flatnonzero(stream == 10), ends)[filled]
    counts = np.bincount(text, minlength=len(bodies))
    codes = mixed(word_hashes(stream, ends)[filled] + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    runs = factor_runs(codes, int(counts.max(initial=0)), least, times)
    of = text[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    runs[:, 0] -= (np.cumsum(counts) - counts)[of]
    return counts, runs, of


def collapsed(body: bytes, runs: np.ndarray) -> bytes:
    """The words without those that a run contains after its first period."""
    words = body.split(b" ")
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([w for w, depth in zip(words, np.cumsum(edges[:-1]).tolist(), strict=True) if not depth])


def _found(batches: Iterator[pa.RecordBatch], least: int, times: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for bodies in _chunks(batch.column("text").cast(pa.binary()).to_pylist()):
            counts, runs, of = chunk_runs(bodies, least, times)
            per = np.bincount(of, minlength=len(bodies))
            stops = np.cumsum(per)
            for i in np.flatnonzero(per).tolist():
                bodies[i] = collapsed(bodies[i], runs[stops[i] - per[i]: stops[i]])
            flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in range(3)], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, stops].astype(np.int32)), flat)
            text = pc.cast(pa.array(bodies, pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(bodies)), pa.array(counts), lists, text],
                                             ["doc_id", "n_words", "runs", "collapsed"])
            at += len(bodies)


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str | Column = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row of ``docs``.

    ``runs`` holds (start, length, period) in words, numbered from 0, by start, then period: every stretch with smallest period q and
    max(``least``, ``times`` * q) words or more that cannot be extended; ``times`` is 3 at least. ``collapsed`` is the words with one space
    between them, without those that a run contains after its first period.

    Null and blank texts have no words and no runs, and collapse to the empty text. Repeated rows and null ids come back each. A text of
    any length is read whole; a worker holds some ten numbers per word of it. Other columns are ignored. Empty input: empty result.
    """
    body = F.col(text) if isinstance(text, str) else text
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("text"))
    return rows.mapInArrow(lambda batches: _found(batches, least, times), f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def with_planted_runs(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text of each document, that of every tenth with a run planted at its end, as the id's CRC-32 says; a null id plants none."""
    code = F.crc32(F.col(doc_id).cast("bigint").cast("string").cast("binary"))
    g = F.floor(code / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        place = let(F.struct(a.alias("a"), p.alias("p")), lambda s: F.array_join(F.transform(
            words, lambda w, i: F.when(i < s["a"], w).otherwise(F.get(words, s["a"] + (i - s["a"]) % s["p"]))), " "))
        return F.when(n > 0, place).otherwise(F.lit(""))

    return F.when(code % 10 == 0, let(word_array(text), planted)).otherwise(F.col(text))
