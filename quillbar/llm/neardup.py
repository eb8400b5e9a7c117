"""Near-duplicate groups by b-bit MinHash, confirmed on the full shingle sets.

1. Every document gives its set of five-word shingles (64-bit hashes), a fingerprint of the set, ``BANDS`` band keys of ``ROWS`` minima each,
   and a packed signature: the hashes fall into ``BINS`` bins by their top bits, and of the minimum of each bin one low bit is kept, beside
   one bit that tells whether the bin has any.
2. Documents with equal sets are one class from there on, so exact copies cost one row, however many.
3. Classes that share a band key are candidates. Each bucket first links its members to its smallest and its largest one, a large
   bucket also to drawn ones as long as that links any of its own; groups of near copies fall into few components that way. What then
   shares a bucket across components is compared inside the join: by the packed signatures, whose collision-corrected estimate must
   come near the limit, then by the full sets. So only links leave the join, and no pair that shares a bucket goes untested unless its
   documents are already connected.
4. Every pair is confirmed on the full sets before it links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import Scratch, mixed, word_hashes, words_joined
from quillbar.llm.graph import components, merged

SHINGLE = 5
BANDS, ROWS, BINS = 32, 4, 2048
MINIMA = BANDS * ROWS
# At similarity 0.75 the estimate has a standard deviation of at most 0.013; this is five of them below. Where under SMALL bins are
# filled, one minimum more or less counts more.
LEAST_ESTIMATE, SMALL, LEAST_OF_SMALL = 0.685, 100, 0.5
CHUNK_BYTES = 4 << 20
LARGE_BUCKET, PIVOTS = 64, 4  # members from which on a bucket is compared with drawn ones first, and about how many in the first round

_RNG = np.random.default_rng(75)
_FACTORS = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 2**63, MINIMA, dtype=np.uint64)
_PLACES = [np.uint64(x) for x in _RNG.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]
SKETCH = "uid bigint, doc_id bigint, tag bigint, n bigint, h1 bigint, h2 bigint, bits array<bigint>, bands array<bigint>"


def _word_hashes_of(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Word hashes of each text, hashed together for some megabytes of text at a time."""
    at = 0
    while at < len(texts):
        bodies, size = [], 0
        while at + len(bodies) < len(texts) and size <= CHUNK_BYTES:
            bodies.append(words_joined(texts[at + len(bodies)]))
            size += len(bodies[-1]) + 1
        stream = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
        breaks = np.flatnonzero((stream == 32) | (stream == 10))
        hashes, filled = word_hashes(stream, breaks), np.diff(breaks, prepend=-1) > 1
        stops = np.searchsorted(breaks, np.flatnonzero(stream == 10), "right")
        start = 0
        for stop in stops:
            yield hashes[start:stop][filled[start:stop]]
            start = stop
        at += len(bodies)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes in order; with fewer words than a shingle has, the whole sequence as one; none without words."""
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = total + words[k: len(words) - width + 1 + k] * _PLACES[k]
    return np.unique(mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        out = np.minimum(out, (shingles[at: at + 4096, None] * _FACTORS + _SHIFTS).min(0))
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = least.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for r in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, r])
    return key.view(np.int64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Bits of the filled bins, then the low bit of each bin's minimum. ``shingles`` are in order, so the first of a bin is its minimum."""
    bins = (shingles >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    bits = np.zeros((2, BINS), np.uint8)
    bits[0, bins[first]] = 1
    bits[1, bins[first]] = mixed(shingles[first]) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def _bit_counts(a: Column, b: Column) -> tuple[Column, Column]:
    """(bins with equal minima by estimate, filled bins) of two signatures. Of the bins that both fill, those with other minima agree in
    the low bit half of the time, so equal minima are twice the agreeing bins less the common ones."""
    words, equal, filled = BINS // 64, [], []
    for w in range(words):
        in_a, in_b = F.get(a, F.lit(w)), F.get(b, F.lit(w))
        both = in_a.bitwiseAND(in_b)
        differ = F.get(a, F.lit(words + w)).bitwiseXOR(F.get(b, F.lit(words + w)))
        equal.append(2 * F.bit_count(both.bitwiseAND(F.bitwise_not(differ))) - F.bit_count(both))
        filled.append(F.bit_count(in_a.bitwiseOR(in_b)))
    return sum(equal[1:], equal[0]), sum(filled[1:], filled[0])


def likely(a: Column, b: Column) -> Column:
    """Whether the similarity estimated from two signatures comes near the limit."""
    equal, filled = _bit_counts(a, b)
    return equal >= F.when(filled < SMALL, LEAST_OF_SMALL).otherwise(LEAST_ESTIMATE) * filled


def estimate(a: Column, b: Column) -> tuple[Column, Column]:
    """(similarity, filled bins) by counts of bits."""
    equal, filled = _bit_counts(a, b)
    return F.try_divide(equal, filled), filled


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    uid = TaskContext.get().partitionId() << 33
    for batch in batches:
        n, h1, h2, signatures, bands, sizes = [], [], [], [], [], []
        for words in _word_hashes_of(batch.column("text").cast(pa.binary()).to_pylist()):
            shingles = shingle_set(words)
            n.append(len(shingles))
            h1.append(shingles.sum(dtype=np.uint64))
            h2.append(mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
            if len(shingles):
                signatures.append(signature(shingles)), bands.append(band_keys(minima(shingles)))
            sizes.append(min(1, len(shingles)))
        count = len(n)
        if not count:
            continue
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))
        lists = [pa.ListArray.from_arrays(pa.array(ends * np.int32(width)), flat(parts))
                 for width, parts in ((BINS // 32, signatures), (BANDS, bands))]
        numbers = [pa.array(np.arange(uid, uid + count)), batch.column("doc_id"), batch.column("tag"), pa.array(np.array(n, np.int64))]
        hashes = [pa.array(np.array(h, np.uint64).view(np.int64)) for h in (h1, h2)]
        uid += count
        yield pa.RecordBatch.from_arrays([*numbers, *hashes, *lists], ["uid", "doc_id", "tag", "n", "h1", "h2", "bits", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            sets = [shingle_set(words).view(np.int64) for words in _word_hashes_of(part.column("text").cast(pa.binary()).to_pylist())]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([part.column("node"), lists], ["node", "shingles"])


def linked(a: Column, b: Column, percent: int) -> Column:
    """Whether 100 * |A and B| >= ``percent`` * |A or B|, for two sets as arrays."""
    return (100 + percent) * F.size(F.array_intersect(a, b)) >= percent * (F.size(a) + F.size(b))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75) -> DataFrame:
    """``doc_id, tag, n_shingles, component_id, kept`` per row of ``docs``; ``tag`` is xxhash64 of the text.

    Documents link when 100 * |A and B| >= ``percent`` * |A or B| on their shingle sets. ``component_id`` is the smallest ``doc_id`` of the
    documents reachable over links, ``kept`` whether it is the row's own. Null and blank texts link with nothing and are kept.
    A null id loses against any other; a component of null ids has a null ``component_id`` and all its rows are kept. Rows with
    equal ids come back each. Empty input: empty result.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    keyed = _keyed(docs, doc_id, text)
    sketches = scratch.save(keyed.mapInArrow(_sketch, SKETCH), "sketches")
    one = ["n", "h1", "h2"]
    classes = scratch.save(sketches.filter("n > 0").groupBy(*one).agg(F.min("uid").alias("node"), F.min("doc_id").alias("least")), "classes")
    chosen = sketches.select("uid", "doc_id", "tag", "bits", "bands").join(classes.select(F.col("node").alias("uid")), "uid")
    reps = scratch.save(chosen, "reps")

    buckets = reps.select(F.col("uid").alias("node"), F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.max("node").alias("high")).filter("size > 1")
    members = scratch.save(buckets.join(shared, "band"), "members")
    star = members.select("node", F.explode(F.array("low", "high")).alias("other")).filter("node <> other")
    pairs = scratch.save(star.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "pairs")

    wanted = members.select("node").distinct().join(reps.select(F.col("uid").alias("node"), F.col("doc_id").alias("_id"), "tag"), "node")
    found = keyed.join(wanted, (F.col("_id").eqNullSafe(F.col("doc_id"))) & (keyed.tag == wanted.tag)).select("node", "text")
    sets = scratch.save(found.dropDuplicates(["node"]).mapInArrow(_sets, "node bigint, shingles array<bigint>"), "sets")
    # Signature, band keys and full set of the members, the only ones that are compared.
    held = scratch.save(sets.withColumnRenamed("shingles", "set").join(reps.select(F.col("uid").alias("node"), "bits", "bands"), "node"), "held")
    scratch.drop(reps), scratch.drop(sets)
    side = lambda name, column: held.select(F.col("node").alias(f"_{name}"), F.col(column).alias(f"{column}_{name}"))
    near, exact = likely(F.col("bits_a"), F.col("bits_b")), linked(F.col("set_a"), F.col("set_b"), percent)

    likely_ones = pairs.join(side("a", "bits"), F.col("a") == F.col("_a")).join(side("b", "bits"), (F.col("b") == F.col("_b")) & near).select("a", "b")
    links = likely_ones.join(side("a", "set"), F.col("a") == F.col("_a")).join(side("b", "set"), (F.col("b") == F.col("_b")) & exact).select("a", "b")
    labels = components(scratch.save(links, "links"), scratch)

    def still_open(rows: DataFrame) -> DataFrame:
        """Those of ``band, node`` in buckets that hold several components, with their ``label`` and the bucket's ``n`` rows."""
        labelled = rows.select("band", "node").join(labels, "node", "left").select("band", "node", F.coalesce("label", "node").alias("label"))
        several = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n")).filter("x <> y")
        return scratch.save(labelled.join(several.select("band", "n"), "band"), "open")

    of = lambda name, i: F.get(F.col(f"bands_{name}"), F.lit(i))
    first_shared = F.col("band_a") == F.coalesce(*[F.when(of("a", i) == of("b", i), of("a", i)) for i in range(BANDS)])

    def across(some: DataFrame, others: DataFrame, once: Column) -> DataFrame:
        """Links ``band, a, b`` between members of a bucket in different components. All tests stand in the join, the cheap ones first, so
        that only links leave it."""
        half = lambda rows, name: rows.join(held, "node").select(
            F.col("band").alias(f"band_{name}"), F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("label", "bits", "bands", "set")])
        small, large = F.least(F.size("set_a"), F.size("set_b")), F.greatest(F.size("set_a"), F.size("set_b"))
        fits = (F.col("label_a") != F.col("label_b")) & (100 * small >= percent * large)
        joined = half(some, "a").join(half(others, "b"), (F.col("band_a") == F.col("band_b")) & once & fits & near & exact)
        return joined.select(F.col("band_a").alias("band"), "a", "b")

    # Large buckets first: all their members against some that are drawn, twice as many each time. A bucket goes on as long as that links
    # any of its members; the rounds never see the others again.
    open_rows = still_open(members)
    large, pivots = open_rows.filter(F.col("n") > LARGE_BUCKET), PIVOTS
    while True:
        drawn = large.filter(F.pmod(F.xxhash64("band", "node", F.lit(pivots)), F.col("n")) < pivots)
        new = scratch.save(across(large, drawn, F.lit(True)), "links")
        if not new.limit(1).count():
            break
        labels, pivots = merged(labels, new.select("a", "b").distinct(), scratch), 2 * pivots
        large = still_open(large.join(new.select("band").distinct(), "band", "left_semi"))

    # Every pair across the components of a bucket, in the first of the buckets that both are in.
    if pivots > PIVOTS:
        open_rows = still_open(open_rows)
    more = scratch.save(across(open_rows, open_rows, (F.col("a") < F.col("b")) & first_shared).select("a", "b"), "more")
    if more.limit(1).count():
        labels = merged(labels, more, scratch)

    least = classes.select("node", "least").join(labels, "node").groupBy("label").agg(F.min("least").alias("component"))
    named = scratch.save(labels.join(least, "label").select("node", "component"), "named")
    named = classes.join(named, "node", "left").select(*one, F.coalesce("component", "least").alias("component"))
    named = scratch.save(named, "components")
    rows = sketches.select("doc_id", "tag", *one).join(named, one, "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return rows.select("doc_id", "tag", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group; of rows with equal id and text one stays. All blank texts stay."""
    kept = groups(docs, doc_id, text).filter("kept").select(F.col("doc_id").alias("_kept"), F.col("tag").alias("_ktag")).distinct()
    tagged = docs.select("*", F.xxhash64(F.col(text)).alias("_tag"))
    joined = tagged.join(kept, F.col(doc_id).cast("bigint").eqNullSafe(F.col("_kept")) & (F.col("_tag") == F.col("_ktag")))
    return joined.dropDuplicates([doc_id, "_tag"]).select(*docs.columns)
