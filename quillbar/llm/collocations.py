"""Phrases that occur together more often than their parts: frequent n-grams by mergeable Misra-Gries summaries, then exact counts.

1. Every n-gram of one to ``longest`` words, with its language, has a 64-bit hash. The hashes fall into partitions by their upper half; inside
   a partition the lower half is the key. Map tasks sum equal keys of some megabytes of text and ship packed arrays.
2. One task per partition merges the arrays into a Misra-Gries summary: beyond its capacity, the count of the first key that finds no
   room is taken off all. What was taken off in total is the error, at most mass / capacity; capacities exceed mass / threshold, and a
   summary whose error would still reach the threshold grows instead. So every n-gram with ``least`` occurrences survives. n-grams
   that share a key survive together, which costs a count in the next pass and no result.
3. The survivors, as bits in a map of ``MOST_BITS`` at most, go to all tasks. A second pass counts the n-grams that the map lets
   through exactly, by their text. With more survivors than a map serves, the partitions are worked off in several such passes.
4. Cuts, scores and the test against longer phrases are joins on the exact counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillbar.llm.common import Scratch, mixed, word_hashes

CHUNK_BYTES = 2 << 20
CAPACITY = 1 << 19  # counters of a summary; partitions are made for half of the mass that this serves
LEAST_PARTITIONS = 64
MOST_BITS = 1 << 28  # 32 MB
PAGES = 64  # of the bit map, put together in as many tasks
SURVIVORS_A_PASS = 1 << 26
# The ends of pieces become line feeds, tabs spaces.
_BLANKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
# Exact also where the product passes 64 bits.
SCORE = "cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _stretches(texts: list[bytes | None], langs: list[str]) -> Iterator[tuple[bytes, list[tuple[str, int]]]]:
    """Some megabytes of text at a time, with the language and length of each part. Long texts are cut between pieces."""
    parts, owners, size = [], [], 0
    for text, lang in zip(texts, langs, strict=True):
        body, at = (text or b"").lower().translate(_BLANKS) + b"\n", 0
        while at < len(body):
            stop = body.find(b"\n", at + CHUNK_BYTES) + 1 or len(body)
            parts.append(body[at:stop])
            owners.append((lang, stop - at))
            size += stop - at
            at = stop
            if size >= CHUNK_BYTES:
                yield b"".join(parts), owners
                parts, owners, size = [], [], 0
    if parts:
        yield b"".join(parts), owners


class Grams:
    """The n-grams of a stretch: one entry per occurrence, with its hash, first word and length."""

    def __init__(self, body: bytes, owners: list[tuple[str, int]], longest: int):
        stream = np.frombuffer(body, np.uint8)
        blank = (stream == 32) | (stream == 10)
        after = np.r_[True, blank[:-1]]
        starts = np.flatnonzero(~blank & after)
        piece = np.cumsum(stream == 10, dtype=np.int32)[starts]
        self.langs = sorted({lang for lang, _ in owners})
        number = {lang: i for i, lang in enumerate(self.langs)}
        owner = np.searchsorted(np.cumsum([n for _, n in owners]), starts, "right")
        self.lang = np.array([number[lang] for lang, _ in owners], np.int32)[owner] if len(starts) else np.zeros(0, np.int32)
        # One blank behind each word, so that a phrase is one slice.
        self.stream = stream[~blank | ~after]
        self.ends = np.flatnonzero((self.stream == 32) | (self.stream == 10))
        words = word_hashes(self.stream, self.ends)
        codes = np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for x in self.langs], np.uint64)
        step = mixed(words + codes[self.lang]) if len(words) else words
        hashes, firsts = [step], [np.arange(len(words), dtype=np.int32)]
        for n in range(2, longest + 1):
            if len(words) < n:
                break
            step = mixed(step[:-1] * _STEP + words[n - 1:])
            whole = np.flatnonzero(piece[n - 1:] == piece[:len(piece) - n + 1]).astype(np.int32)
            hashes.append(step[whole])
            firsts.append(whole)
        self.sizes = np.repeat(np.arange(1, len(hashes) + 1, dtype=np.int8), [len(h) for h in hashes])
        self.hashes, self.firsts = np.concatenate(hashes), np.concatenate(firsts)

    def texts(self, which: np.ndarray) -> pa.Array:
        first, last = self.firsts[which], self.firsts[which] + self.sizes[which] - 1
        starts = np.where(first > 0, self.ends[first - 1] + 1, 0)
        body = self.stream.tobytes()
        phrases = [body[a:b] for a, b in zip(starts.tolist(), self.ends[last].tolist(), strict=True)]
        return pc.cast(pa.array(phrases, pa.binary()), options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def parts_of(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The partition of each hash, which grows with the hash, and its key there."""
    return (hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32), hashes.astype(np.uint32)


def places(part: np.ndarray | int, keys: np.ndarray, bits: int) -> np.ndarray:
    """The bit of each key in a map of ``bits`` bits, a power of two."""
    return mixed((np.uint64(part) if isinstance(part, int) else part) << np.uint64(32) | keys.astype(np.uint64)) & np.uint64(bits - 1)


def _texts_of(batch: pa.RecordBatch) -> tuple[list[bytes | None], list[str]]:
    return batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()


def _summed(batches: Iterator[pa.RecordBatch], parts: int, longest: int) -> Iterator[pa.RecordBatch]:
    """Per partition and stretch: the keys met once, the others, and their counts, as packed arrays."""
    for batch in batches:
        for stretch in _stretches(*_texts_of(batch)):
            hashes, counts = np.unique(Grams(*stretch, longest).hashes, return_counts=True)
            part, keys = parts_of(hashes, parts)
            edges = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
            once, rows = counts == 1, []
            for p in np.flatnonzero(np.diff(edges)).tolist():
                own = slice(edges[p], edges[p + 1])
                single, k, c = once[own], keys[own], counts[own]
                rows.append((p, k[single].tobytes(), k[~single].tobytes(), c[~single].astype(np.uint32).tobytes()))
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]], ["part", "once", "often", "times"])


class Summary:
    """A Misra-Gries summary of keys. ``error`` is what each count may lack; it stays under ``least``."""

    def __init__(self, capacity: int, least: int):
        self.capacity, self.least, self.error = capacity, least, 0
        self.keys, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.n_waiting += len(keys)
        if self.n_waiting > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        self.waiting, self.n_waiting = [], 0
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
        while len(self.keys) > self.capacity:
            off = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            if self.error + off >= self.least:
                self.capacity *= 2
                continue
            self.error += off
            left = self.counts > off
            self.keys, self.counts = self.keys[left], self.counts[left] - off

    def survivors(self) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + self.error >= self.least]


def _surviving(batches: Iterator[pa.RecordBatch], capacity: int, least: int) -> Iterator[pa.RecordBatch]:
    summary, part = Summary(capacity, least), None
    for batch in batches:
        for p, once, often, times in zip(*(batch.column(c).to_pylist() for c in ("part", "once", "often", "times")), strict=True):
            part, single = p, np.frombuffer(once, np.uint32)
            summary.add(single, np.ones(len(single), np.int64))
            summary.add(np.frombuffer(often, np.uint32), np.frombuffer(times, np.uint32).astype(np.int64))
    keys = summary.survivors()
    if len(keys):
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([keys.tobytes()], pa.binary())], ["part", "n", "keys"])


def _bits_by_page(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    width = bits // PAGES
    for batch in batches:
        for part, keys in zip(batch.column("part").to_pylist(), batch.column("keys").to_pylist(), strict=True):
            at = np.sort(places(part, np.frombuffer(keys, np.uint32), bits))
            edges = np.searchsorted(at, np.arange(PAGES + 1, dtype=np.uint64) * np.uint64(width))
            pages = np.flatnonzero(np.diff(edges)).tolist()
            cut = [(at[edges[p]: edges[p + 1]] - np.uint64(p * width)).astype(np.uint32).tobytes() for p in pages]
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int32()), pa.array(cut, pa.binary())], ["page", "at"])


def _page(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    width, page = bits // PAGES, None
    flags = np.zeros(width, np.uint8)
    for batch in batches:
        page = batch.column("page")[0].as_py()
        for at in batch.column("at").to_pylist():
            flags[np.frombuffer(at, np.uint32)] = 1
    yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["page", "bits"])


def bit_map(survivors: DataFrame, bits: int) -> bytes:
    """The map of the survivors' bits, ``bits`` / 8 bytes; put together in tasks, one page each."""
    pages = survivors.mapInArrow(lambda b: _bits_by_page(b, bits), "page int, at binary").groupBy("page")
    out, width = bytearray(bits // 8), bits // PAGES // 8

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _page(batches, bits)

    for row in pages.applyInArrow(put, "page int, bits binary").toLocalIterator():
        out[row["page"] * width: (row["page"] + 1) * width] = row["bits"]
    return bytes(out)


def _counted(batches: Iterator[pa.RecordBatch], parts: int, longest: int, known: Broadcast, bits: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Occurrences per stretch of the n-grams that the map lets through, from the partitions ``low`` to ``high``; a null phrase counts the words."""
    flags = np.frombuffer(known.value, np.uint8)
    for batch in batches:
        for stretch in _stretches(*_texts_of(batch)):
            grams = Grams(*stretch, longest)
            part, keys = parts_of(grams.hashes, parts)
            at = places(part, keys, bits)
            met = (flags[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
            passed = np.flatnonzero((met == 1) & (part >= low) & (part < high))
            del part, keys, at, met
            _, first, counts = np.unique(grams.hashes[passed], return_index=True, return_counts=True)
            which = passed[first]
            langs = pa.array(grams.langs, pa.string())
            columns = [langs.take(pa.array(grams.lang[grams.firsts[which]])), grams.texts(which), pa.array(counts)]
            if low == 0:
                n = np.bincount(grams.lang, minlength=len(grams.langs))
                columns = [pa.concat_arrays(x) for x in zip(columns, [langs, pa.nulls(len(n), pa.string()), pa.array(n)], strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "a"])


def frequent(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, capacity: int = CAPACITY) -> DataFrame:
    """``lang, phrase, a``: every phrase of one to ``longest`` words with ``least`` occurrences in its language; a null phrase has the number of words."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    # A word and its blank are two bytes at least, so this many n-grams at most.
    mass = longest * ((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2 + 1)
    parts = max(LEAST_PARTITIONS, -(-2 * mass // (capacity * least)))

    def surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _surviving(batches, capacity, least)

    summed = rows.mapInArrow(lambda b: _summed(b, parts, longest), "part int, once binary, often binary, times binary")
    survivors = scratch.save(summed.groupBy("part").applyInArrow(surviving, "part int, n bigint, keys binary"), "survivors")
    n = survivors.agg(F.sum("n")).first()[0] or 0
    passes = max(1, -(-n // SURVIVORS_A_PASS))
    bits = min(MOST_BITS, 1 << max(16, (64 * -(-n // passes)).bit_length()))
    counted = None
    for i in range(passes):
        low, high = i * parts // passes, (i + 1) * parts // passes
        known = docs.sparkSession.sparkContext.broadcast(bit_map(survivors.filter((F.col("part") >= low) & (F.col("part") < high)), bits))
        some = rows.mapInArrow(lambda b, known=known, low=low, high=high: _counted(b, parts, longest, known, bits, low, high), "lang string, phrase string, a bigint")
        some = some.groupBy("lang", "phrase").agg(F.sum("a").alias("a")).filter(F.col("phrase").isNull() | (F.col("a") >= least))
        some = scratch.save(some, "counts")
        counted = some if counted is None else counted.unionByName(some)
    return counted


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, inside_percent: int = 80,
                 first: int = 2000, capacity: int = CAPACITY) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``first`` phrases by score, then ``a``, then phrase in byte order.

    A text is in lower case (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and these into words at spaces and tabs. A phrase is
    2 to ``longest`` words of a piece with ``a`` >= ``least`` occurrences in its language. ``l`` and ``r`` count its two parts at the cut
    with the lowest score, floor(2,000,000 a / (l + r)), of equal ones the first. A phrase inside a longer one that has
    ``inside_percent`` of its occurrences or more is left out. ``n`` is the number of words of the language.

    Null and empty texts count nothing, a null language is ``und``, repeated rows count each time; other columns are ignored. Texts of any
    length are worked off in stretches between pieces. A language without a phrase has no row. Empty input: empty result.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    known = frequent(docs, scratch, text, lang, least, longest, capacity)
    counts = known.filter(F.col("phrase").isNotNull())
    words = F.split("phrase", " ", -1)
    long = counts.select("lang", "phrase", "a", words.alias("w")).filter(F.size("w") > 1)
    stretch = lambda start, n: F.array_join(F.slice("w", start, n), " ")

    cuts = long.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", stretch(F.lit(1), F.col("k")).alias("left"), stretch(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.select("lang", "phrase", "a", F.struct(F.expr(SCORE).alias("score"), "k", "l", "r").alias("cut"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))

    inner = long.filter(F.size("w") > 2).select("lang", "a", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("m") + 1)).alias("s"))
    inner = inner.select("lang", stretch(F.col("s"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * wide("longer") < inside_percent * wide("a")))

    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: the first of each of its shares, then the first of those.
    shared = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    shared = shared.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= first)
    top = shared.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= first)
    sizes = known.filter(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    return top.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
