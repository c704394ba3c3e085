"""10. Document fingerprints: a homomorphic multiset hash of paragraph pieces.

A text is cut into pieces: at paragraph ends (line feeds) and, so that one
long paragraph still has parts, behind words whose hash is 0 modulo 4 - a
cut that depends on the words alone and so survives edits elsewhere.
Every piece is hashed to a wide vector: `LANES` lanes modulo 2**64, and
`SIGNS` lanes of +1 or -1 modulo 2**16.  A fingerprint is the sum of its
pieces' vectors and their number.  Sums don't depend on the order, so
equal multisets of pieces have equal fingerprints, and inserting or
deleting a piece adds or subtracts its vector.

The likeness (an estimate of the multiset Jaccard, 0 to 1) comes from a
second set of sign sums, in which each occurrence of a piece is hashed with
its number within the text (first, second, ...): all elements are distinct,
so the mean square of the difference of two such sums estimates how many
occurrences differ, however often a piece is repeated.  Numbers don't add up
over texts, so these sums belong to a whole text and are no part of the
fingerprint.

The edited text of the query needs each document's successor in
descending doc_id.  The documents are dealt once into ranges of doc_id,
sorted within, and streamed; the first row of each following range is sent
along (one row a range), so no window over the whole table is needed.

Defined results: null text counts as empty and has the zero fingerprint;
rows of equal doc_id follow each other by text hash, then text; rows
without doc_id come after all others; a single row is its own successor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import (BYTE_VALUES, U, Prefix, documents, id_text, mix, partitions, salted, text_slices, words)

LANES, SIGNS, CUT = 8, 128, 4
RANGES_PER_PARTITION = 4


class Vectors:
    """Fingerprints of several texts, as arrays; `numbered`: sign sums of numbered occurrences, where the texts are at hand."""

    def __init__(self, lanes: np.ndarray, signs: np.ndarray, count: np.ndarray, numbered: np.ndarray | None = None):
        self.lanes, self.signs, self.count, self.numbered = lanes, signs, count, numbered

    def __getitem__(self, k) -> "Vectors":
        return Vectors(self.lanes[k], self.signs[k], self.count[k], None if self.numbered is None else self.numbered[k])

    def plus(self, other: "Vectors", sign: int = 1) -> "Vectors":
        """Insert (or with -1 delete) the pieces of `other`."""
        with np.errstate(over="ignore"):
            if sign > 0:
                return Vectors(self.lanes + other.lanes, self.signs + other.signs, self.count + other.count)
            return Vectors(self.lanes - other.lanes, self.signs - other.signs, self.count - other.count)

    def text(self) -> list[str]:
        return [c.tobytes().hex() + lane.tobytes().hex() + s.tobytes().hex()
                for c, lane, s in zip(self.count.astype("<u8"), self.lanes.astype("<u8"), self.signs.astype("<i2"))]

    @staticmethod
    def parse(texts: list[str]) -> "Vectors":
        raw = np.frombuffer(bytes.fromhex("".join(texts)), np.uint8).reshape(len(texts), 8 + 8 * LANES + 2 * SIGNS)
        part = lambda a, b, t: np.ascontiguousarray(raw[:, a:b]).view(t)
        return Vectors(part(8, 8 + 8 * LANES, "<u8").astype(U), part(8 + 8 * LANES, raw.shape[1], "<i2").astype(np.int16),
                       part(0, 8, "<u8")[:, 0].astype(np.int64))

    def likeness(self, other: "Vectors") -> np.ndarray:
        apart = np.mean((self.numbered.astype(np.float64) - other.numbered) ** 2, axis=1)
        both = (self.count + other.count).astype(np.float64)
        same = (self.lanes == other.lanes).all(axis=1) & (self.count == other.count)
        like = np.clip((both - apart) / np.maximum(both + apart, 1), 0, 1)
        return np.where(same, 1.0, np.minimum(like, 1 - 1 / np.maximum(both, 2)))


def sign_sums(pieces: np.ndarray, at: np.ndarray, salt: int, kind: type) -> np.ndarray:
    """Sums of the pieces' signs from each place of `at` to the next."""
    bits = np.stack([salted(pieces, salt + k) for k in range(SIGNS // 64)], axis=1).view(np.uint8)
    signs = np.unpackbits(bits, axis=1).view(np.int8) * np.int8(2) - np.int8(1)
    return np.add.reduceat(signs, at, axis=0, dtype=kind)


def numbered(pieces: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of each piece with its number among its equals within the text."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((pieces, text))
    p, t, place = pieces[order], text[order], np.arange(len(pieces))
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (t[1:] != t[:-1])
    out = np.empty(len(p), U)
    out[order] = p + mix((place - np.maximum.accumulate(np.where(new, place, 0))).astype(U) + U(1))
    return out


def piece_sums(pieces: np.ndarray, first: np.ndarray) -> Vectors:
    """Sums of the vectors of consecutive pieces; `first` has each text's first piece, and the number of pieces."""
    n = len(first) - 1
    out = Vectors(np.zeros((n, LANES), U), np.zeros((n, SIGNS), np.int16), np.diff(first), np.zeros((n, SIGNS), np.int32))
    full = np.flatnonzero(out.count)
    if len(full):
        at = first[full]
        for k in range(LANES):
            out.lanes[full, k] = np.add.reduceat(salted(pieces, k), at)
        out.signs[full] = sign_sums(pieces, at, 100, np.int16)
        out.numbered[full] = sign_sums(numbered(pieces, first), at, 200, np.int32)
    return out


def piece_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pieces of a slice's texts, white space included, and each text's first piece."""
    w = words(data, off)
    cut = (w.hash & U(CUT - 1)) == 0
    if len(w.end):
        feeds = np.concatenate([[0], np.cumsum(data == 10)])
        cut[:-1] |= feeds[w.start[1:]] > feeds[w.end[:-1]]
    behind = np.zeros(len(w.hash), bool)
    behind[1:] = cut[:-1]
    opening = w.doc[:-1][np.diff(w.doc) > 0]
    behind[opening] = False             # a text's first piece starts with the text
    start = np.sort(np.concatenate([off[:-1][np.diff(off) > 0], w.start[behind]]))
    hashes = Prefix(BYTE_VALUES[data]).of(start, np.concatenate([start[1:], [len(data)]]).astype(np.int64)) if len(start) else np.zeros(0, U)
    return hashes, np.searchsorted(start, off)


def fingerprint_texts(texts: pa.Array) -> Vectors:
    parts = [piece_sums(*piece_hashes(data, off)) for _, _, data, off in text_slices(texts)]
    if not parts:
        return piece_sums(np.zeros(0, U), np.zeros(1, np.int64))
    return Vectors(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("lanes", "signs", "count", "numbered")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (hexadecimal text) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fingerprint_texts(b.column(1)).text(), pa.string())],
                                             ["doc_id", "fingerprint"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, fingerprint string")


def combined(prints: DataFrame, by: list[str], fingerprint_col: str = "fingerprint", salts: int = 32) -> DataFrame:
    """The fingerprint of the union of each group's pieces; hot groups are summed in `salts` parts first."""

    @F.pandas_udf("string")
    def total(s: pd.Series) -> str:
        v = Vectors.parse(list(s))
        return Vectors(v.lanes.sum(0, keepdims=True, dtype=U), v.signs.sum(0, keepdims=True, dtype=np.int16),
                       v.count.sum(keepdims=True)).text()[0]

    part = F.pmod(F.xxhash64(fingerprint_col), F.lit(salts)).alias("part_of_group")
    return (prints.where(F.col(fingerprint_col).isNotNull())
            .groupBy(*by, part).agg(total(fingerprint_col).alias("fingerprint"))
            .groupBy(*by).agg(total("fingerprint").alias("fingerprint")))


def changed(before: str, inserted: list[str] = (), deleted: list[str] = ()) -> str:
    """A fingerprint after inserting and deleting pieces, given their fingerprints."""
    v = Vectors.parse([before])
    for sign, prints in ((1, inserted), (-1, deleted)):
        for p in prints:
            v = v.plus(Vectors.parse([p]), sign)
    return v.text()[0]


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next document."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _compare(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all texts but the last, each with its successor."""
    edited = [edited_text(a, b) for a, b in zip(texts, texts[1:])]
    own, new = fingerprint_texts(pa.array(texts, pa.large_string())), fingerprint_texts(pa.array(edited, pa.large_string()))
    mine, following = own[:-1], own[1:]
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
         pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
         pa.array(mine.text(), pa.string()), pa.array(new.text(), pa.string()),
         pa.array(mine.likeness(new)), pa.array(mine.likeness(following))],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one range, compared with their successors in bounded groups."""
    ids, texts, size, range_ = [], [], 0, None
    for b in batches:
        for r, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            t = t.as_py() or ""
            if r != range_:      # the row before was another range's end, which only serves as a successor
                if len(texts) > 1:
                    yield _compare(ids, texts)
                ids, texts, size, range_ = [], [], 0, r
            ids.append(i)
            texts.append(t)
            size += len(t)
            if size > 1 << 20 and len(texts) > 1:
                yield _compare(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if len(texts) > 1:
        yield _compare(ids, texts)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the successor's."""
    docs = id_text(docs, id_col, text_col)
    spark = docs.sparkSession
    ranges = RANGES_PER_PARTITION * partitions(spark)
    steps = [k / ranges for k in range(1, ranges)]
    bounds = np.unique(docs.approxQuantile("doc_id", steps, 1 / (4 * ranges))) if steps else np.zeros(0)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(bounds, ids.astype(float).fillna(-np.inf).to_numpy(), "left")
        return pd.Series(np.where(ids.isna(), -1, place).astype("int32"))

    h = F.xxhash64(F.coalesce("text", F.lit("")))
    # The first row of each range, one row a range: the successor of the last row of the range above.
    first = (docs.select(range_of("doc_id").alias("r"), "doc_id", h.alias("h"))
             .groupBy("r").agg(F.max(F.struct(F.coalesce("doc_id", F.lit(-2**63)), -F.col("h").cast("decimal(20,0)"))).alias("top"))
             .select("r", F.col("top.col1").alias("top_id"), (-F.col("top.col2")).cast("long").alias("top_h"))
             .orderBy(F.desc("r")).collect())
    above = {f.r: first[k - 1].r for k, f in enumerate(first)}
    heads = spark.createDataFrame([(above[f.r], None if f.r == -1 else f.top_id, f.top_h) for f in first] or [(0, None, 0)],
                                  "r int, head_id long, head_h long")
    head_rows = (docs.withColumn("h", h).join(F.broadcast(heads), F.expr("doc_id <=> head_id AND h = head_h"))
                 .select("r", "doc_id", "text", "h").dropDuplicates(["r", "doc_id", "h"]))
    rows = (docs.select(range_of("doc_id").alias("r"), "doc_id", "text", h.alias("h"), F.lit(0).alias("after"))
            .unionByName(head_rows.withColumn("after", F.lit(1)))
            .repartition("r")
            .sortWithinPartitions(F.desc("r"), "after", F.desc_nulls_last("doc_id"), "h", "text"))
    return rows.select("r", "doc_id", "text").mapInArrow(
        _runs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(documents(spark, sf_dir))
