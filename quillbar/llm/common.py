"""What the operators of this folder share: the word pattern, let-bindings in expressions, scratch tables, byte arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbar.session import scratch_path

# A word is a run of characters other than these six blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(column: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(column: str, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls into the fold; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds == fold


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a one-row generator, so that what is built on them later never repeats their expressions."""
    fields = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


class Scratch:
    """Tables below the shared scratch folder (``spark.checkpoint.dir``), each read back as a frame with a short lineage.

    A lost executor costs a re-run of the tasks of one step, never of the steps before it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.steps = spark, scratch_path(spark, label), 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.steps += 1
        path = f"{self.root}/{name}-{self.steps}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Remove the files of a table of this folder that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if f"/{self.root.rstrip('/').rpartition('/')[2]}/" in path:
                folder = jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(conf).delete(folder, True)


# ---- byte arrays inside tasks --------------------------------------------------------------------------------------

def words_joined(text: bytes | None) -> bytes:
    """A-Z in lower case, the words with one space between them."""
    return b" ".join((text or b"").lower().split())


_RNG = np.random.default_rng(20240611)
_BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


STRETCH = 1 << 16
_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; the longest list so far is kept."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(n, base, np.uint64)
        known[:1] = 1
        known = _POWERS[int(base)] = np.multiply.accumulate(known)
    return known[:n]


def span_hashes(stream: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per span of bytes; the spans are in order. Worked off in stretches that fit the processor's cache."""
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + STRETCH, "right")))
        low, high = int(starts[at]), int(ends[stop - 1])
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTE_CODES[stream[low:high]] * powers(_BASE, high - low), out=total[1:])
        first, last = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (total[last] - total[first]) * powers(_BASE_INVERSE, high - low + 1)[first] + (last - first).astype(np.uint64)
        at = stop
    return mixed(out)


def word_hashes(stream: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word. ``ends`` are the positions of the byte after each word; a word starts after the previous end."""
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
    return span_hashes(stream, starts, ends)
