"""Code lengths by context-tree weighting over bytes, learned from a whole corpus.

Text becomes its words in lower case (A-Z), one space between them, and an end symbol. Each byte is coded as eight binary
decisions. The node of a decision is (context, bits of the byte so far), with the last d bytes as context, d = 0..DEPTH. A node
keeps the training counts of zeros and ones; KT is the Krichevsky-Trofimov estimate, and

    Pw(node) = KT / 2 + product of Pw(children) / 2        (at DEPTH: Pw = KT)

so that a prediction mixes the estimates of all depths, each weighted by what it has coded so far. A context that training
never reached has no node: its parent predicts there.

How it runs: texts are cut into pieces and blocks of some megabytes, one compressed row each. Each block reports its distinct (context,
byte) pairs and words with their training counts, as sorted, packed arrays dealt over parts: pairs by the last ``root`` bytes of their
context, words by their hash. The arrays of a part are merged ``GROUP_BLOCKS`` at a time, in as many rounds as it takes, so that no task sees
more. Trees are weighted per part, some subtrees at a time; above ``root``, one task per last byte, and one table of at most 256^2 rows for
the rest. The values go back the way the counts came: each merged array asks the one it went into, each block its group, and a block adds
them up per text. No model is held whole anywhere; what is shuffled is the distinct pairs and words per block. Parts grow with the root
of the number of blocks, as the arrays are blocks times parts; how long ``root`` is changes who works, not the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillbar.llm.common import Scratch, held_out, mixed, word_hashes, words_joined

DEPTH = 6  # at most 7, as a pair of context and byte is a 64-bit number
LONG_ROOT_BLOCKS = 256  # subtrees below contexts of 2 bytes are weighted apart, from so many blocks on below 3
END = 255  # never a byte of UTF-8
BLOCK_BYTES = 16 << 20
GROUP_BLOCKS = 200  # arrays of a part that one task merges
SLICE = 1 << 17  # pairs whose trees a task weighs at a time; longer only by one subtree
PIECE_BYTES = 2 << 20
CHUNK_BYTES = 2 << 20
LN2, LN10 = math.log(2), math.log(10)
GRAM, TERM = 0, 1

BLOCKS = "block bigint, uid array<bigint>, doc_id array<bigint>, held_out array<boolean>, sizes array<bigint>, body binary"
SEEN = "id bigint, part int, n int, keys binary, counts binary"
VALUES = "id bigint, part int, n int, keys binary, values binary"
ROOTS = "part int, key bigint, n bigint, w array<double>"
SHARES = "key bigint, a array<double>, b array<double>"


# ---- packed arrays -------------------------------------------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """The bytes of an array, the first byte of all values, then the second, ..., compressed."""
    return pa.Codec("zstd", 1).compress(np.ascontiguousarray(values.reshape(-1, 1).view(np.uint8).T).tobytes(), asbytes=True)


def _unpack(blob: bytes, n: int, kind: type = np.int64) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob, n * width, asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.int64(0)))


def _unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(blob, n))


# ---- blocks of text ------------------------------------------------------------------------------------------------

def _cut(symbols: bytes) -> Iterator[bytes]:
    """Pieces that end after a space or the end symbol, longer than ``PIECE_BYTES`` only by one word."""
    at = 0
    while at < len(symbols):
        space = symbols.find(b" ", at + PIECE_BYTES) if len(symbols) - at > PIECE_BYTES else -1
        stop = space + 1 if space >= 0 else len(symbols)
        yield symbols[at:stop]
        at = stop


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: the pieces with their leads, one after the other, compressed."""
    names = ("uid", "doc_id", "held_out", "sizes")
    part, uid, block, filled, body = TaskContext.get().partitionId() << 32, 0, 0, 0, []
    rows: dict[str, list] = {k: [] for k in names}

    def flushed() -> pa.RecordBatch:
        joined = pa.Codec("zstd", 3).compress(b"".join(body), asbytes=True)
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
        lists = [pa.array([rows[k]], pa.list_(kind)) for k, kind in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([part | block], pa.int64()), *lists, pa.array([joined], pa.binary())], ["block", *names, "body"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for doc_id, held, text in zip(batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), texts, strict=True):
            lead = bytes([END]) * DEPTH
            for piece in _cut(words_joined(text.as_py()) + bytes([END])):
                if filled > BLOCK_BYTES:
                    yield flushed()
                    block, filled, body, rows = block + 1, 0, [], {k: [] for k in names}
                for key, value in zip(names, (part | uid, doc_id, held, len(piece)), strict=True):
                    rows[key].append(value)
                body += [lead, piece]
                filled += len(piece)
                lead = (lead + piece)[-DEPTH:]
            uid += 1
    if body:
        yield flushed()


def _opened(sizes: list[int], body: bytes) -> tuple[list[bytes], list[bytes]]:
    """Leads and bodies of the pieces of a block."""
    full = pa.Codec("zstd").decompress(body, sum(sizes) + DEPTH * len(sizes), asbytes=True)
    ends = np.cumsum(np.asarray(sizes, np.int64) + DEPTH)
    starts = ends - sizes
    return [full[a - DEPTH:a] for a in starts], [full[a:b] for a, b in zip(starts, ends, strict=True)]


def _chunks(leads: list[bytes], bodies: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first piece, gram keys, piece of each gram, bytes) for runs of pieces of some ``CHUNK_BYTES``."""
    at = 0
    while at < len(bodies):
        stop, size = at, 0
        while stop < len(bodies) and (size == 0 or size + len(bodies[stop]) <= CHUNK_BYTES):
            size += len(bodies[stop])
            stop += 1
        lengths = np.array([len(b) for b in bodies[at:stop]], np.int64)
        full = np.frombuffer(b"".join(x for pair in zip(leads[at:stop], bodies[at:stop], strict=True) for x in pair), np.uint8)
        owner = np.repeat(np.arange(stop - at), lengths)
        place = np.arange(size, dtype=np.int64) + (owner + 1) * DEPTH
        keys = np.zeros(len(full) - DEPTH, np.uint64)
        for d in range(1, DEPTH + 1):
            keys = (keys << np.uint64(8)) | full[DEPTH - d: len(full) - d]
        keys = (keys << np.uint64(8)) | full[DEPTH:]
        yield at, keys[place - DEPTH], owner, full[place]
        at = stop


def _terms(stream: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and piece of every word."""
    ends = np.flatnonzero((stream == 32) | (stream == END))
    lengths = np.diff(ends, prepend=-1) - 1
    return word_hashes(stream, ends)[lengths > 0].view(np.int64), owner[ends][lengths > 0]


def _counted(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their sums."""
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def _block_seen(held: np.ndarray, leads: list[bytes], bodies: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per kind, the distinct keys of a block in order, with their training counts."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {k: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for k in (GRAM, TERM)}
    for at, grams, owner, stream in _chunks(leads, bodies):
        terms, term_owner = _terms(stream, owner)
        for kind, keys, of in ((GRAM, grams.view(np.int64), owner), (TERM, terms, term_owner)):
            out = held[at + of]
            own, n = zip(found[kind], *((d, c * known) for part, known in ((keys[~out], 1), (keys[out], 0)) for d, c in [_runs(part)]), strict=True)
            found[kind] = _counted(np.concatenate(own), np.concatenate(n))
    return found


def _part_of(keys: np.ndarray, kind: int, parts: int, root: int) -> np.ndarray:
    """Parts 0, 1, ... hold pairs, ``parts``, ``parts`` + 1, ... words."""
    of = keys >> (8 * (DEPTH - root + 1)) if kind == GRAM else keys
    return (mixed(of.view(np.uint64)) % np.uint64(parts)).astype(np.int64) + parts * (kind == TERM)


def _dealt(keys: np.ndarray, kind: int, parts: int, root: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its keys in order)."""
    part = _part_of(keys, kind, parts, root)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else []
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(part[a]), order[a:b]


def _seen(batches: Iterator[pa.RecordBatch], parts: int, root: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            block, held, sizes, body = (batch.column(c)[i].as_py() for c in ("block", "held_out", "sizes", "body"))
            rows: list[tuple] = []
            for kind, (keys, n) in _block_seen(np.array(held), *_opened(sizes, body)).items():
                rows += [(block, part, len(at), _pack_keys(keys[at]), _pack(n[at])) for part, at in _dealt(keys, kind, parts, root)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["id", "part", "n", "keys", "counts"])


def _summed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The arrays of one part and group, merged."""
    keys = np.concatenate([_unpack_keys(k, n) for k, n in zip(pdf["keys"], pdf.n, strict=True)])
    keys, n = _counted(keys, np.concatenate([_unpack(c, n) for c, n in zip(pdf.counts, pdf.n, strict=True)]))
    return pd.DataFrame({"id": [key[1]], "part": [key[0]], "n": [len(keys)], "keys": [_pack_keys(keys)], "counts": [_pack(n)]})


# ---- the weighted tree ---------------------------------------------------------------------------------------------

def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x >= 0.5: Stirling's series at x + 8."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7))


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the KT probability of a sequence with so many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - math.log(math.pi) - _lgamma(zeros + ones + 1.0)


def _shortened(keys: np.ndarray, by: int) -> np.ndarray:
    """Pairs whose contexts lose their oldest bytes. A context of ``DEPTH`` bytes reaches the sign, shorter ones do not."""
    context = (keys.view(np.uint64) >> np.uint64(8 * (by + 1))).view(np.int64)
    return (context << 8) | (keys & 255)


class _Level:
    """(context of d bytes, byte) entries in order, and, per bit, the nodes they pass."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n, self.parent = keys, n, np.zeros(0, np.int64)
        self.node, self.total, self.kt, self.estimate, self.log_w = [], [], [], [], []
        for j in range(8):
            place = keys >> (8 - j)
            node = np.cumsum(np.r_[False, place[1:] != place[:-1]]) if len(keys) else np.zeros(0, np.int64)
            bit = (keys >> (7 - j)) & 1
            ones = np.bincount(node, n * bit)
            total = np.bincount(node, n)
            self.node.append(node)
            self.total.append(total)
            self.kt.append(log_kt(total - ones, ones))
            own = np.where(bit == 1, ones[node], (total - ones)[node])
            self.estimate.append((own + 0.5) / (total[node] + 1.0))

    def shorter(self) -> _Level:
        """The level with one context byte less; notes the parent entry of each entry here."""
        keys, self.parent = np.unique(_shortened(self.keys, 1), return_inverse=True)
        return _Level(keys, np.bincount(self.parent, self.n).astype(np.int64))

    def weigh(self, below: _Level | None, log_pw_below: list[np.ndarray] | None) -> list[np.ndarray]:
        """ln Pw of each node, per bit; keeps the ln of the share of its own estimate."""
        out = []
        for j in range(8):
            if below is None:
                out.append(self.kt[j])
                self.log_w.append(np.zeros(len(self.kt[j])))
                continue
            first = np.flatnonzero(np.r_[True, below.node[j][1:] != below.node[j][:-1]]) if len(below.keys) else np.zeros(0, np.int64)
            upper = self.node[j][below.parent[first]]
            product = np.bincount(upper, log_pw_below[j], minlength=len(self.kt[j]))
            log_pw = np.logaddexp(self.kt[j], product) - LN2
            out.append(log_pw)
            self.log_w.append(self.kt[j] - LN2 - log_pw)
        return out


def _tree(keys: np.ndarray, n: np.ndarray, longest: int, shortest: int, log_pw: list[np.ndarray] | None = None) -> tuple[list[_Level], list[np.ndarray]]:
    """Levels from ``longest`` to ``shortest`` context bytes, and ln Pw at the last. ``log_pw``: that of the first, if known."""
    levels = [_Level(keys, n)]
    if log_pw is None:
        log_pw = levels[0].weigh(None, None)
    for _ in range(longest - shortest):
        levels.append(levels[-1].shorter())
        log_pw = levels[-1].weigh(levels[-2], log_pw)
    return levels, log_pw


def _mixed_estimates(levels: list[_Level], j: int, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """For bit j of each entry of the first level: (a, b) with a + b * x the mixed probability at the last level, if x is the one at the
    first. ``known`` is x itself, or None to keep it open."""
    size = len(levels[0].keys)
    a, b = (known, np.zeros(size)) if known is not None else (np.zeros(size), np.ones(size))
    place, seen = np.arange(size), levels[0].total[j][levels[0].node[j]] > 0
    for lower, level in zip(levels, levels[1:], strict=False):
        place = lower.parent[place]
        node = level.node[j][place]
        w = np.exp(level.log_w[j][node])
        own = level.estimate[j][place]
        a, b = np.where(seen, w * own + (1 - w) * a, own), np.where(seen, (1 - w) * b, 0.0)
        seen = level.total[j][node] > 0
    return a, b


def _slices(keys: np.ndarray, root: int) -> Iterator[tuple[int, int]]:
    """Runs of whole subtrees below contexts of ``root`` bytes."""
    context = keys >> (8 * (DEPTH - root + 1))
    starts, at = np.r_[np.flatnonzero(context[1:] != context[:-1]) + 1, len(keys)], 0
    while at < len(keys):
        fitting = int(np.searchsorted(starts, at + SLICE, "right")) - 1
        stop = int(starts[fitting]) if fitting >= 0 and starts[fitting] > at else int(starts[np.searchsorted(starts, at, "right")])
        yield at, stop
        at = stop


def _roots(frames: Iterator[pd.DataFrame], root: int) -> Iterator[pd.DataFrame]:
    """Per (context of ``root`` bytes, byte): the training count and ln Pw of the eight nodes."""
    for frame in frames:
        for part, n, packed, counts in zip(frame.part, frame.n, frame["keys"], frame.counts, strict=True):
            keys, counted = _unpack_keys(packed, n), _unpack(counts, n)
            for a, b in _slices(keys, root):
                levels, log_pw = _tree(keys[a:b], counted[a:b], DEPTH, root)
                yield _level_rows(levels[-1], log_pw).assign(part=part)[["part", "key", "n", "w"]]


def _level_rows(level: _Level, log_pw: list[np.ndarray]) -> pd.DataFrame:
    weights = np.stack([log_pw[j][level.node[j]] for j in range(8)], 1)
    return pd.DataFrame({"key": level.keys, "n": level.n, "w": list(weights)})


def _upwards(rows: pd.DataFrame, longest: int, shortest: int) -> tuple[list[_Level], list[np.ndarray]]:
    """The tree above rows of (context of ``longest`` bytes, byte) with their ln Pw; ``rows`` are in order."""
    weights, first = np.stack(rows.w.to_list()), _Level(rows.key.to_numpy(), rows.n.to_numpy())
    starts = [np.flatnonzero(np.r_[True, first.node[j][1:] != first.node[j][:-1]]) for j in range(8)]
    return _tree(rows.key.to_numpy(), rows.n.to_numpy(), longest, shortest, [weights[starts[j], j] for j in range(8)])


def _to_one(rows: pd.DataFrame, root: int) -> pd.DataFrame:
    """Of all rows of one last byte: the same per (that byte, byte)."""
    levels, log_pw = _upwards(rows.sort_values("key"), root, 1)
    return _level_rows(levels[-1], log_pw)


def _shares(levels: list[_Level]) -> tuple[np.ndarray, np.ndarray]:
    both = [_mixed_estimates(levels, j, None) for j in range(8)]
    return np.stack([x[0] for x in both], 1), np.stack([x[1] for x in both], 1)


def _to_none(rows: pd.DataFrame) -> pd.DataFrame:
    """Of all rows of one context byte: a and b of the eight decisions, from the root of the tree."""
    levels, _ = _upwards(rows.sort_values("key"), 1, 0)
    a, b = _shares(levels)
    return pd.DataFrame({"key": levels[0].keys, "a": list(a), "b": list(b)})


def _top(rows: pd.DataFrame, ones: pd.DataFrame, root: int) -> pd.DataFrame:
    """Of all rows of one last byte: a and b of the eight decisions, from all levels above."""
    if not len(rows):
        return pd.DataFrame({"part": [], "key": [], "a": [], "b": []})
    rows, ones = rows.sort_values("key"), ones.sort_values("key")
    levels, _ = _upwards(rows, root, 1)
    a, b = _shares(levels)
    keys = rows.key.to_numpy()
    above = np.searchsorted(ones.key.to_numpy(), _shortened(keys, root - 1))
    a_above, b_above = np.stack(ones.a.to_list())[above], np.stack(ones.b.to_list())[above]
    return pd.DataFrame({"part": rows.part.to_numpy(), "key": keys, "a": list(a_above + b_above * a), "b": list(b_above * b)})


def _log_probabilities(sums: pd.DataFrame, top: pd.DataFrame, root: int) -> pd.DataFrame:
    """ln of the probability of each (context, byte) of a part, as packed 32-bit floats."""
    if not len(sums):
        return pd.DataFrame({c.split()[0]: [] for c in VALUES.split(", ")})
    top, n = top.sort_values("key"), int(sums.n.iloc[0])
    a, b, top_keys = np.stack(top.a.to_list()), np.stack(top.b.to_list()), top.key.to_numpy()
    keys, counts = _unpack_keys(sums["keys"].iloc[0], n), _unpack(sums.counts.iloc[0], n)
    out = np.zeros(n)
    for low, high in _slices(keys, root):
        own = keys[low:high]
        levels, _ = _tree(own, counts[low:high], DEPTH, root)
        above = np.searchsorted(top_keys, _shortened(own, DEPTH - root))
        for j in range(8):
            estimate, _ = _mixed_estimates(levels, j, levels[0].estimate[j])
            out[low:high] += np.log(a[above, j] + b[above, j] * estimate)
    return pd.DataFrame({"id": sums.id, "part": sums.part, "n": [n], "keys": sums["keys"], "values": [_pack(out.astype(np.float32))]})


def _answering(parts: int, bare: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    return lambda asked, values: _answers(asked, values, parts, bare)


def _answers(asked: pd.DataFrame, values: pd.DataFrame, parts: int, bare: bool) -> pd.DataFrame:
    """The values of the keys of each array that went into one merged array; ``bare`` leaves the keys out."""
    if not len(asked):
        return pd.DataFrame({c.split()[0]: [] for c in VALUES.split(", ")})
    kind = np.float32 if asked.part.iloc[0] < parts else np.int64
    n = int(values.n.iloc[0])
    keys, value = _unpack_keys(values["keys"].iloc[0], n), _unpack(values["values"].iloc[0], n, kind)
    told = [_pack(value[np.searchsorted(keys, _unpack_keys(k, m))]) for k, m in zip(asked["keys"], asked.n, strict=True)]
    return pd.DataFrame({"id": asked.id, "part": asked.part, "n": asked.n, "keys": [b""] * len(asked) if bare else asked["keys"], "values": told})


def _types(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words with a training count, per part."""
    for frame in frames:
        yield pd.DataFrame({"types": [int((_unpack(c, n) > 0).sum()) for c, n in zip(frame.counts, frame.n, strict=True)]})


# ---- scores --------------------------------------------------------------------------------------------------------

SCORED = "uid bigint, doc_id bigint, held_out boolean, n_bytes bigint, n_words bigint, n_known bigint, ln_p double, log10_counts double"


def _told(answers: dict[int, bytes], keys: np.ndarray, kind: int, parts: int, root: int) -> np.ndarray:
    """The values of a block's distinct keys, from one array per part."""
    out = np.zeros(len(keys), np.float32 if kind == GRAM else np.int64)
    for part, at in _dealt(keys, kind, parts, root):
        out[at] = _unpack(answers[part], len(at), out.dtype.type)
    return out


def _score(block: pd.DataFrame, answers: pd.DataFrame, parts: int, root: int) -> pd.DataFrame:
    """Sums per piece of a block: ln probability of its bytes, and log10(count + 1) of its words."""
    if not len(block):
        return pd.DataFrame({c.split()[0]: [] for c in SCORED.split(", ")})
    uid, doc_id, held, sizes, body = (block[c].iloc[0] for c in ("uid", "doc_id", "held_out", "sizes", "body"))
    leads, bodies = _opened(sizes, body)
    size, held = len(sizes), np.asarray(held, bool)
    by_part = dict(zip(answers.part, answers["values"], strict=True))
    (gram_keys, _), (term_keys, _) = _block_seen(held, leads, bodies).values()
    gram_ln, term_n = (_told(by_part, keys, kind, parts, root) for kind, keys in ((GRAM, gram_keys), (TERM, term_keys)))
    ln_p, n_words, n_known, log10_counts = np.zeros(size), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
    for at, grams, owner, stream in _chunks(leads, bodies):
        stop = at + int(owner[-1]) + 1
        # One sort instead of a search per byte.
        order = np.argsort(grams.view(np.int64))
        keys = grams.view(np.int64)[order]
        first = np.r_[True, keys[1:] != keys[:-1]]
        value = gram_ln[np.searchsorted(gram_keys, keys[first])].astype(np.float64)[np.cumsum(first) - 1]
        ln_p[at:stop] += np.bincount(owner[order], value, minlength=stop - at)
        hashes, of = _terms(stream, owner)
        if len(hashes):
            count = term_n[np.searchsorted(term_keys, hashes)]
            n_words[at:stop] += np.bincount(of, minlength=stop - at)
            n_known[at:stop] += np.bincount(of[count > 0], minlength=stop - at)
            log10_counts[at:stop] += np.bincount(of, np.log10(count + 1.0), minlength=stop - at)
    return pd.DataFrame({"uid": uid, "doc_id": pd.array(list(doc_id), "Int64"), "held_out": held, "n_bytes": sizes, "n_words": n_words,
                         "n_known": n_known, "ln_p": ln_p, "log10_counts": log10_counts})


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``, one row per row of ``docs``.

    Learns from the rows whose crc32(doc_id as text) mod ``folds`` is not ``fold``. ``score`` is log10 of the probability of the words with one space
    between them and the end, ``base_score`` that of the add-one word model. Null text counts as empty, which scores its end
    only; a null id hashes as the empty text; repeated rows are scored, and learned from, each. Without training rows every
    bit costs one bit. Other columns are ignored. Empty input: empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scoring")
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), held_out(doc_id, folds, fold).alias("held_out"), F.col(text).alias("text"))
    texts = scratch.save(rows.mapInArrow(_blocks, BLOCKS), "blocks")
    n_blocks = texts.count()
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * math.isqrt(n_blocks))
    root = 2 if n_blocks < LONG_ROOT_BLOCKS else 3

    arrays = scratch.save(texts.mapInArrow(lambda batches: _seen(batches, parts, root), SEEN), "seen")
    groups = max(1, -(-n_blocks // GROUP_BLOCKS))
    rounds = [arrays.withColumn("up", F.pmod(F.xxhash64("id"), F.lit(groups)))]
    while True:
        totals = scratch.save(rounds[-1].groupBy("part", "up").applyInPandas(_summed, SEEN), "merged")
        if groups == 1:
            break
        groups = -(-groups // GROUP_BLOCKS)
        rounds.append(totals.withColumn("up", F.floor(F.col("id") / GROUP_BLOCKS)))

    grams, words = totals.filter(F.col("part") < parts), totals.filter(F.col("part") >= parts)
    roots = scratch.save(grams.mapInPandas(lambda frames: _roots(frames, root), ROOTS), "roots")
    last_byte = F.shiftright("key", 8 * root).bitwiseAND(255)
    ones = roots.groupBy(last_byte).applyInPandas(lambda rows: _to_one(rows, root), ROOTS.partition(", ")[2]).groupBy().applyInPandas(_to_none, SHARES)
    top = roots.groupBy(last_byte).cogroup(ones.groupBy(F.shiftright("key", 8).bitwiseAND(255))).applyInPandas(
        lambda rows, above: _top(rows, above, root), "part int, " + SHARES)
    model = grams.groupBy("part").cogroup(top.groupBy("part")).applyInPandas(lambda own, above: _log_probabilities(own, above, root), VALUES)
    values = model.unionByName(words.withColumnRenamed("counts", "values"))
    types = words.mapInPandas(_types, "types bigint").agg(F.sum("types")).first()[0] or 0

    for step, asked in reversed([*enumerate(rounds)]):
        values = asked.drop("counts").groupBy("part", "up").cogroup(values.groupBy("part", "id")).applyInPandas(
            _answering(parts, bare=step == 0), VALUES)
    scored = texts.groupBy("block").cogroup(values.groupBy("id")).applyInPandas(lambda block, own: _score(block, own, parts, root), SCORED)
    sums = ["n_bytes", "n_words", "n_known", "ln_p", "log10_counts"]
    scored = scratch.save(scored.groupBy("uid", "doc_id", "held_out").agg(*[F.sum(c).alias(c) for c in sums]), "scores")
    ends, words_in_train = scored.filter(~F.col("held_out")).agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    n_train, vocabulary = words_in_train + ends, types + min(1, ends)
    n_tokens = F.col("n_words") + 1
    base = F.col("log10_counts") + math.log10(ends + 1) - n_tokens * math.log10(n_train + vocabulary + 1)
    return scored.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("n_known") + min(1, ends)).alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"), base.alias("base_score"), (F.col("ln_p") / LN10).alias("score"),
        (-F.col("ln_p") / LN2 / F.col("n_bytes")).alias("bits_per_byte"))
