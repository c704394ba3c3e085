"""Helpers shared by the llm operators: UTF-8 views of Arrow text, word hashes, rolling hashes.

Words are maximal runs of bytes outside the fixed ASCII white space
(0x20, 0x09-0x0D).  A word's hash is a 64-bit polynomial over its bytes,
finalised by a mixer; a window's hash is a polynomial over its word
hashes.  Both come from prefix sums modulo 2**64, so a slice of text is
hashed in a few numpy passes.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5
_STEP = 0xD6E8FEB86659FD93
_GOLD = U(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, elementwise."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    """Another independent hash of the same values."""
    return mix(x + U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * _GOLD)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]

_pow: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept between calls up to a slice's length)."""
    have = _pow.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        out = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, U)
            steps[0] = 1
            out.append(np.cumprod(steps))
        have = (out[0], out[1])
        if size <= 4 * SLICE_BYTES:
            _pow[base] = have
    return have


class Prefix:
    """Prefix sums of a polynomial hash; `of(start, end)` hashes spans."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        n = len(values)
        up, self.down = _powers(base, n + 1)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(h + (end - start).astype(U) * _GOLD)


class Words(NamedTuple):
    hash: np.ndarray    # uint64 per word
    start: np.ndarray   # byte offset in the slice
    end: np.ndarray
    doc: np.ndarray     # first word of each document, and the number of words


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and the offset of each text (null: empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of at most `most` bytes, or one longer document."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi
        lo = hi


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of bounded slices of a text column."""
    data, off = utf8(texts)
    for lo, hi in slices(off, most):
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]


def words(data: np.ndarray, off: np.ndarray, values: np.ndarray = BYTE_VALUES) -> Words:
    """The words of a slice; a text's end also ends a word."""
    n = len(data)
    if not n:
        e = np.zeros(0, np.int64)
        return Words(np.zeros(0, U), e, e, np.zeros(len(off), np.int64))
    inside = ~SPACE[data]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    cuts = off[(off > 0) & (off < n)]
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(Prefix(values[data]).of(start, end), start, end, np.searchsorted(start, off))


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of every window of `width` words within one document."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, U)
    left = np.repeat(doc[1:], np.diff(doc)) - np.arange(n)
    start = np.flatnonzero(left >= width)
    return start, Prefix(hashes, _STEP).of(start, start + width)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions on tables made inside remove their shuffle files when they end, instead of whenever the driver collects garbage.

    For loops whose every step ends in a checkpoint or in rows at the driver.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_shipped: set[str] = set()
#: Bytes of an Arrow batch between a task and its Python worker, if the session leaves Spark's default of 64 MB: whole
#: texts are wide, both sides hold a batch several times over, and the worker keeps its memory through the next stages.
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's sources to the executors, once per application: the tasks import it; batches get ARROW_BYTES."""
    sc = spark.sparkContext
    if spark.conf.get(_ARROW) == "67108864b":
        spark.conf.set(_ARROW, ARROW_BYTES)
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        _shipped.add(sc.applicationId)
    return spark


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that further columns can't clash with its own."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a fresh local one only in local mode where it is unset (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="llm-checkpoints-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """`df` written once to the shared checkpoint folder; what follows starts from those files."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a narrow table that make one partition.
COMPACT_ROWS = 50_000


def compact(df: DataFrame) -> DataFrame:
    """`saved`, and read in as few partitions as its counted rows need, so that later shuffles of a small table stay small."""
    df = saved(df)
    return df.coalesce(max(1, -(-df.count() // COMPACT_ROWS)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
