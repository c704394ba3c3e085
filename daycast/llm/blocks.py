"""Hash exchange in blocks.

Documents are grouped in blocks of neighbouring ids.  A block sends each of
its distinct hashes once, sorted and packed, to the part of the hash space
it falls in: one row per block and part instead of one per hash.  That is
the pre-aggregation before the shuffle: a passage, word or anchor that a
third of all documents hold arrives once from each block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import U, partitions


def block_of(doc_id: Column, size: int) -> Column:
    return F.floor(doc_id / F.lit(size)).cast("long")


def n_parts(spark: SparkSession) -> int:
    """Parts of the hash space: one for each shuffle partition, since every block sends each part a row."""
    return partitions(spark)


def cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of sorted hashes begins, and their number."""
    bounds = np.array([(k << 64) // parts for k in range(1, parts)], U)
    return np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]])


def messages(block: int, hashes: np.ndarray, parts: int, *more: np.ndarray) -> pa.Table:
    """Rows (part, block, hashes, ...) of sorted distinct hashes and of arrays beside them."""
    at = cuts(hashes, parts)
    full = np.flatnonzero(np.diff(at))
    cols = [[x[at[k]:at[k + 1]].tobytes() for k in full] for x in (hashes, *more)]
    return pa.Table.from_arrays(
        [pa.array(full, pa.int32()), pa.array(np.full(len(full), block), pa.int64()), *(pa.array(c, pa.binary()) for c in cols)],
        ["part", "block", "hashes", *(f"more{i}" for i in range(len(more)))])


MESSAGE = "part int, block long, hashes binary"


def unpack(column: pa.ChunkedArray, kind=U) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in a row, and the message each comes from."""
    raw = [np.frombuffer(x.as_buffer(), kind) for x in column]
    sizes = np.array([len(x) for x in raw], np.int64)
    return (np.concatenate(raw) if raw else np.zeros(0, kind)), np.repeat(np.arange(len(raw)), sizes)


def answer(table: pa.Table, keep) -> pa.Table:
    """Rows (block, hashes): for each message, those of its hashes that `keep(hash, block)` chooses.

    `keep` gets all hashes of a part sorted (and by block among equals) and returns a mask.
    """
    h, of = unpack(table.column("hashes"))
    block = table.column("block").to_numpy()
    order = np.lexsort((block[of], h))
    mask = np.zeros(len(h), bool)
    mask[order] = keep(h[order], block[of[order]])
    h, of = h[mask], of[mask]
    ends = np.searchsorted(of, np.arange(table.num_rows + 1))
    full = np.flatnonzero(np.diff(ends))
    return pa.Table.from_arrays(
        [pa.array(block[full], pa.int64()), pa.array([h[ends[k]:ends[k + 1]].tobytes() for k in full], pa.binary())],
        ["block", "hashes"])


ANSWER = "block long, hashes binary"


def answered(sent: DataFrame, keep) -> DataFrame:
    """The answers to all messages, part by part."""
    return sent.groupBy("part").applyInArrow(lambda table: answer(table, keep), ANSWER)


def received(table: pa.Table) -> np.ndarray:
    """All hashes of a block's answers, sorted."""
    return np.sort(unpack(table.column("hashes"))[0])


def is_in(x: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    place = np.minimum(np.searchsorted(sorted_set, x), len(sorted_set) - 1)
    return sorted_set[place] == x
