"""Find benchmark items in documents, up to a share of edited words.

Text becomes words: ASCII letters in lower case, other ASCII characters but digits as blanks. The CGK embedding reads a window of
words with a pointer: step j writes the word under it and moves on by a random bit of (step, word). Two windows at a small edit
distance fall into step again after each edit, so their embeddings agree at most steps. Each table samples ``SAMPLES`` steps and
matches windows whose words there equal an item's. Walks and tables grow with the window (``walks_of``, ``tables_of``), so that they alone find nine of ten
items with up to ``EDITS`` of their words edited, and every unchanged one. For the rest each item is also cut into one piece more than
the edits it may have: an edit touches one piece at most, so a piece stays whole in every occurrence that counts, and no edits within the limit
hide an item. A pair of window and item that matches in a table or a piece is confirmed by exact edit distance.

Every word of every document starts a window. Walks that meet stay together, so walks are merged as they go, and a table drops a
window at the first sampled word that no item has there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import mixed, span_hashes

SAMPLES, TABLES, WALKS = 4, 4, 4
EDITS = 0.2  # of the item's words, rounded down
MIN_WORDS = 8  # shorter items are found as they are only, and do not make a document unclean by default
CHUNK_BYTES = 2 << 20
ITEM_BYTES = 16 << 20  # of item text that one pass over the documents carries
MERGE_STEPS = {3 * 2**k - 1 for k in range(30)}

_BLANKED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_SLOTS = 1 << 16


def tables_of(size: int) -> int:
    """Tables of a walk for windows of ``size`` words, so that the walks alone find nine of ten items with all the edits allowed: an edit more
    leaves a sampled step in place less often."""
    return TABLES * max(1, size // 16) * WALKS // walks_of(size)


def walks_of(size: int) -> int:
    return WALKS * (2 if size >= 64 else 1)


def _single(stream: np.ndarray) -> np.ndarray:
    """Which bytes begin a character of a script without blanks (kana, Chinese, Thai, Lao, Burmese, Khmer); each is a word, of three bytes."""
    after = np.r_[stream[1:], np.uint8(0)]
    return ((stream >= 0xE3) & (stream <= 0xE9)) | ((stream == 0xE0) & (after >= 0xB8) & (after <= 0xBB)) | (
        (stream == 0xE1) & ((after <= 0x82) & (after >= 0x80) | (after == 0x9E) | (after == 0x9F)))


def words_of(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of a blanked byte stream."""
    inside = np.r_[False, stream != 32, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(stream) and stream.max() >= 0xE0:
        alone = np.flatnonzero(_single(stream))
        if len(alone):
            behind = np.minimum(alone + 3, len(stream))
            starts = np.unique(np.concatenate([starts, alone, behind[(behind < len(stream)) & (stream[np.minimum(behind, len(stream) - 1)] != 32)]]))
            ends = np.minimum(np.r_[starts[1:], len(stream)], ends[np.searchsorted(ends, starts, "right")])
    return span_hashes(stream, starts, ends), starts, ends


def item_words(text: str | None) -> np.ndarray:
    return words_of(np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_BLANKED), np.uint8))[0]


def window_size(n_words: int) -> int:
    """Items are compared by their first 8, 16, 32, ... words, as many as they have."""
    return 1 << (n_words.bit_length() - 1)


def _step_hash(words: np.ndarray, walk: int, step: int) -> np.ndarray:
    """The random bits of 64 steps of a walk, per word."""
    return mixed(words + np.uint64((walk * 4096 + step // 64) * 2 + 1))


def embedding(words: np.ndarray, walk: int, steps: int, size: int) -> np.ndarray:
    """Places that the walk reads from the start of ``words``, ``size`` for all steps behind the window."""
    place, out = 0, np.full(steps, size)
    for step in range(steps):
        if place >= min(size, len(words)):
            break
        if step % 64 == 0:
            bits = _step_hash(words, walk, step)
        out[step] = place
        place += int(bits[place] >> np.uint64(step % 64)) & 1
    return out


def _steps(size: int) -> int:
    return size + size // 2


@dataclass
class Table:
    """Sampled steps, and what the items have there: after the first i + 1 samples, which key slots occur; at the end, key to items."""

    size: int
    steps: np.ndarray
    slots: list[np.ndarray] = field(default_factory=list)
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    items: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _next_key(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return mixed(key * np.uint64(0x9E3779B97F4A7C15) + symbol + np.uint64(1))


def allowed_edits(n_words: int) -> int:
    """Short items are told from chance only as they are."""
    return int(EDITS * n_words) if n_words >= MIN_WORDS else 0


@dataclass
class Pieces:
    """The items' pieces of one length by key: the item, and where the piece starts in it."""

    length: int
    slots: np.ndarray
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray


class Index:
    """Items, the tables of all walks, and the pieces."""

    def __init__(self, items: list[tuple[int, str]], least_words: int = 1):
        found = [(i, item_words(t)) for i, t in items]
        found = [(i, w) for i, w in found if len(w) >= least_words]
        self.ids, self.words = [i for i, _ in found], [w for _, w in found]
        self.vocabulary = np.unique(np.concatenate(self.words)) if found else np.zeros(0, np.uint64)
        sizes = np.array([window_size(len(w)) for w in self.words], int)
        rng = np.random.default_rng(11)
        self.walks: list[list[Table]] = []
        large = np.unique(sizes[sizes >= MIN_WORDS])
        for walk in range(max(map(walks_of, large.tolist()), default=0)):
            tables = []
            for size in large:
                if walk >= walks_of(int(size)):
                    continue
                own = np.flatnonzero(sizes == size)
                places = [embedding(self.words[k][:size], walk, _steps(size), size) for k in own]
                for _ in range(tables_of(int(size))):
                    table = Table(int(size), np.sort(rng.choice(_steps(size), SAMPLES, replace=False)))
                    key = np.zeros(len(own), np.uint64)
                    for step in table.steps:
                        key = _next_key(key, self.numbers(np.array([self.words[k][p[step]] if p[step] < size else 0 for k, p in zip(own, places, strict=True)], np.uint64),
                                                          np.array([p[step] >= size for p in places])))
                        slots = np.zeros(_SLOTS, bool)
                        slots[key % np.uint64(_SLOTS)] = True
                        table.slots.append(slots)
                    order = np.argsort(key, kind="stable")
                    table.keys, table.items = key[order], own[order]
                    tables.append(table)
            self.walks.append(tables)
        self.pieces = self._pieces()

    def _pieces(self) -> list[Pieces]:
        cut: dict[int, list[tuple[int, int]]] = {}
        for k, words in enumerate(self.words):
            n, parts = len(words), allowed_edits(len(words)) + 1
            for part in range(parts):
                start, stop = part * n // parts, (part + 1) * n // parts
                cut.setdefault(stop - start, []).append((k, start))
        out = []
        for length, places in sorted(cut.items()):
            items, offsets = np.array(places, np.int64).T
            keys = np.zeros(len(places), np.uint64)
            for i in range(length):
                keys = _next_key(keys, self.numbers(np.array([self.words[k][o + i] for k, o in places], np.uint64)))
            slots = np.zeros(1 << max(16, len(keys).bit_length() + 4), bool)
            slots[keys % np.uint64(len(slots))] = True
            order = np.argsort(keys, kind="stable")
            out.append(Pieces(length, slots, keys[order], items[order], offsets[order]))
        return out

    def whole_pieces(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(where the item would start, item, where the piece starts) of each piece among the words with these numbers."""
        windows, done = np.flatnonzero(numbers > 1), 0
        key = np.zeros(len(windows), np.uint64)
        for pieces in self.pieces:
            for i in range(done, pieces.length):
                inside = windows + i < len(numbers)
                windows, key = windows[inside], key[inside]
                symbol = numbers[windows + i]
                known = symbol > 1
                windows, key = windows[known], _next_key(key[known], symbol[known].astype(np.uint64))
            done = pieces.length
            hit = pieces.slots[key % np.uint64(len(pieces.slots))]
            at, own = windows[hit], key[hit]
            low, high = np.searchsorted(pieces.keys, own, "left"), np.searchsorted(pieces.keys, own, "right")
            times = high - low
            which = np.repeat(low, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            yield np.repeat(at, times) - pieces.offsets[which], pieces.items[which], np.repeat(at, times)

    def numbers(self, words: np.ndarray, behind: np.ndarray | None = None) -> np.ndarray:
        """Number of each word: 2, 3, ... in the items' vocabulary, 0 for others, 1 behind the window."""
        if not len(self.vocabulary):
            return np.zeros(len(words), np.uint64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        out = np.where(self.vocabulary[at] == words, at + 2, 0).astype(np.uint64)
        return out if behind is None else np.where(behind, np.uint64(1), out)

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, item) of windows that meet an item in a table."""
        n = len(words)
        numbers = self.numbers(words)
        found_at, found_item = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not n or not self.ids:
            return found_at[0], found_item[0]
        numbers = np.r_[numbers, np.uint64(0)].astype(np.int32)  # the last is where walks end, behind all words
        every_number = np.arange(len(self.vocabulary) + 2).astype(np.uint64)
        first_key = _next_key(np.zeros(len(every_number), np.uint64), every_number)
        for walk, tables in enumerate(self.walks):
            place, group = np.arange(n, dtype=np.int32), None  # of each walk; the walk of each window
            alive: list = [None] * len(tables)  # windows left, and their keys
            done = [0] * len(tables)
            for step in range(1 + max((int(t.steps[-1]) for t in tables), default=-1)):
                if step % 64 == 0:
                    bits = np.r_[_step_hash(words, walk, step), np.uint64(0)]
                for k, table in enumerate(tables):
                    if done[k] == SAMPLES or table.steps[done[k]] != step:
                        continue
                    slots = table.slots[done[k]]
                    if alive[k] is None and step < table.size:
                        # No walk has left its window yet, so windows of one walk pass or fail together.
                        good = (slots[first_key % np.uint64(_SLOTS)] & (every_number > 0))[numbers[place]]
                        windows = np.flatnonzero(good if group is None else good[group])
                        key = first_key[numbers[place[windows if group is None else group[windows]]]]
                    else:
                        windows, key = (np.arange(n), np.zeros(n, np.uint64)) if alive[k] is None else alive[k]
                        at = place[windows if group is None else group[windows]]
                        symbol = np.where(at - windows >= table.size, 1, numbers[at]).astype(np.uint64)
                        key = _next_key(key, symbol)
                        good = slots[key % np.uint64(_SLOTS)] & (symbol > 0)
                        windows, key = windows[good], key[good]
                    alive[k] = (windows, key)
                    done[k] += 1
                place = place + ((bits[place] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int32)
                if step in MERGE_STEPS:
                    first = np.r_[True, place[1:] != place[:-1]]
                    number = np.cumsum(first, dtype=np.int32) - 1
                    group, place = (number if group is None else number[group]), place[first]
            for table, (windows, key) in zip(tables, alive, strict=True):
                low, high = np.searchsorted(table.keys, key, "left"), np.searchsorted(table.keys, key, "right")
                times = high - low
                found_at.append(np.repeat(windows, times))
                offsets = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                found_item.append(table.items[np.repeat(low, times) + offsets])
        pairs = np.unique(np.stack([np.concatenate(found_at), np.concatenate(found_item)], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def best_match(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the span of ``words`` closest to ``item`` by word edits; free ends on the side of ``words``."""
    unit = 1 << 32
    at = np.arange(len(words) + 1, dtype=np.int64)
    row = at.copy()  # edits * unit + start
    for word in item:
        step = row + unit
        step[1:] = np.minimum(step[1:], row[:-1] + np.where(words == word, 0, unit))
        row = np.minimum.accumulate(step - at * unit) + at * unit
    end = int(row.argmin())
    return int(row[end] >> 32), int(row[end] & (unit - 1)), end


def _ranges(index: Index, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, from, to): stretches of words that hold all that candidates may match, in order per text and item."""
    if not index.ids or not len(words):
        return
    windows, items = index.candidates(words)
    found = [(windows, items, windows), *index.whole_pieces(index.numbers(words))]
    starts, items, places = (np.concatenate(c) for c in zip(*found, strict=True))
    if not len(starts):
        return
    owners = np.searchsorted(first, places, "right") - 1
    n_words = np.array([len(w) for w in index.words])[items]
    allowed = np.array([allowed_edits(len(w)) for w in index.words])[items]
    low, high = np.maximum(first[owners], starts - allowed), np.minimum(first[owners + 1], starts + n_words + 2 * allowed)
    order = np.lexsort((low, items, owners))
    owners, items, low, high = (c[order] for c in (owners, items, low, high))
    new = np.r_[True, (owners[1:] != owners[:-1]) | (items[1:] != items[:-1]) | (low[1:] > low[:-1] + n_words[order][1:])]
    # Neighbouring candidates share a stretch.
    group = np.flatnonzero(new)
    for at, stop in zip(group.tolist(), np.r_[group[1:], len(new)].tolist(), strict=True):
        yield int(owners[at]), int(items[at]), int(low[at]), int(high[at:stop].max())


def matches(index: Index, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, edits, first byte, last byte) of each item found in each text, its closest occurrence."""
    blanked = [t.translate(_BLANKED) for t in texts]
    stream = np.frombuffer(b" ".join(blanked) + b" ", np.uint8)
    offsets = np.cumsum([0, *(len(b) + 1 for b in blanked)])
    words, starts, ends = words_of(stream)
    first = np.searchsorted(starts, offsets)  # of the words of each text
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for owner, k, low, high in _ranges(index, words, first):
        item, met = index.words[k], best.get((owner, k))
        if met and met[0] == 0:
            continue
        near = words[low:high]
        allowed = allowed_edits(len(item))
        if (~np.isin(item, near)).sum() > allowed:
            continue
        edits, a, b = best_match(item, near)
        if edits <= allowed and (met is None or edits < met[0]):
            best[owner, k] = (edits, low + a, low + b)
    for (owner, k), (edits, a, b) in best.items():
        yield owner, k, edits, int(starts[a] - offsets[owner]), int(ends[b - 1] - offsets[owner])


def _per_chunk(texts: list[bytes | None], index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at + len(some) < len(texts) and size <= CHUNK_BYTES:
            some.append(texts[at + len(some)] or b"")
            size += len(some[-1])
        for owner, *rest in matches(index, some):
            yield at + owner, *rest
        at += len(some)


def _find(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        found = list(_per_chunk(texts, index))
        chars = lambda row, n: len(texts[row][:n].decode("utf-8", "replace"))
        columns = [batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64())), pa.array([index.ids[f[1]] for f in found], pa.int64()),
                   pa.array([f[2] for f in found], pa.int32()), pa.array([len(index.words[f[1]]) for f in found], pa.int32()),
                   pa.array([chars(f[0], f[3]) for f in found], pa.int32()), pa.array([chars(f[0], f[4]) for f in found], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "n_item_words", "start", "end"])


def _clean(batches: Iterator[pa.RecordBatch], index: Index, text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
        keep = np.ones(len(texts), bool)
        keep[[f[0] for f in _per_chunk(texts, index)]] = False
        yield batch.filter(pa.array(keep))


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", least_words: int = 1) -> Iterator[Index]:
    """The items of ``least_words`` words or more, in blocks of about ``ITEM_BYTES`` of text, so that what the driver holds and tasks get is bounded."""
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    for block in range(blocks):
        yield Index(sorted(((r.i, r.t) for r in items.filter(F.pmod(F.xxhash64("t"), F.lit(blocks)) == block).collect()), key=str), least_words)


FOUND = "doc_id bigint, item_id bigint, edits int, n_item_words int, start int, end int"


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, edits, n_item_words, start, end`` of each item found in each row of ``docs``, at its closest occurrence.

    Offsets are code points, end exclusive. Null and empty texts and items match nothing; items with under ``MIN_WORDS`` words are found
    where all their words stand in order, unedited; a character of a script without blanks is a word. Equal items and repeated
    rows are reported each. An empty side gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index in item_blocks(benchmark):
        part = rows.mapInArrow(lambda batches, index=index: _find(batches, index), FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", least_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` in which no item of ``least_words`` words or more is found, all columns as they are. A few words stand in clean
    documents too, so shorter items count only if asked for. Null and empty texts stay, and so do repeated rows; without items all rows stay."""
    for index in item_blocks(benchmark, least_words=least_words):
        docs = docs.mapInArrow(lambda batches, index=index: _clean(batches, index, text), docs.schema)
    return docs
