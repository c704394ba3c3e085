"""3. Substring dedup with difference-cover anchors.

A window is `WINDOW` consecutive words of one document.  Anchors are
windows of `ANCHOR` words that start at a word position whose remainder
modulo `PERIOD` is in a difference cover: for any two positions there is a
shift below the period that takes both into the cover, so two equal windows
share an anchor at the same shift.  Only anchors (4 of 13 positions) are
exchanged to find what occurs more than once; anchors that do are extended
to the windows around them, and those windows' hashes are exchanged to find
the earliest block that holds each.  No pairs are made: a passage in a
third of all documents costs one message a block.

Blocks are ranges of `BLOCK` doc_ids, so an earlier block is an earlier
doc_id, and the order within a block is settled inside it.  A task holds
one block, or one part of the hash space, at a time.

Windows are equal when their 64-bit hashes are.

Defined results: null text has no words; rows of equal doc_id follow each
other by text, so the later of two equal rows repeats the first; a row
without doc_id takes no part, and keeps all its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.blocks import ANSWER, MESSAGE, answered, block_of, is_in, messages, n_parts, received
from daycast.llm.common import U, documents, id_text, text_slices, windows, words

WINDOW, PERIOD, ANCHOR = 20, 13, 8
COVER = (0, 1, 3, 9)            # differences of these give every remainder modulo 13
BLOCK = 256
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def cover_anchors(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start word, hash) of the anchors at cover positions of their document."""
    start, h = windows(hashes, doc, ANCHOR)
    own = start - doc[np.searchsorted(doc, start, "right") - 1]
    chosen = _IN_COVER[own % PERIOD]
    return start[chosen], h[chosen]


def _block(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


def _sent_anchors(table: pa.Table, parts: int) -> pa.Table:
    found = [np.unique(cover_anchors(w.hash, w.doc)[1])
             for _, _, data, off in text_slices(table.column("text")) for w in [words(data, off)]]
    return messages(_block(table), np.unique(np.concatenate([*found, np.zeros(0, U)])), parts)


def _sent_windows(table: pa.Table, repeated: np.ndarray, parts: int) -> pa.Table:
    """The windows that extend an anchor which other blocks hold too."""
    found = []
    for _, _, data, off in text_slices(table.column("text")):
        w = words(data, off)
        at, h = cover_anchors(w.hash, w.doc)
        hit = np.zeros(len(w.hash) + PERIOD + 1, np.int32)
        hit[at[is_in(h, repeated)] + 1] = 1
        upto = np.cumsum(hit)
        start, g = windows(w.hash, w.doc, WINDOW)
        found.append(np.unique(g[upto[start + PERIOD] > upto[start]]))
    return messages(_block(table), np.unique(np.concatenate([*found, np.zeros(0, U)])), parts)


def _kept(table: pa.Table, earlier: np.ndarray) -> pa.Table:
    """Each document without the words of windows that start earlier, in this block or before."""
    table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    texts = table.column("text").combine_chunks()
    hashes, places, sizes = [], [], []
    base = 0
    for _, _, data, off in text_slices(texts):
        w = words(data, off)
        start, g = windows(w.hash, w.doc, WINDOW)
        hashes.append(g)
        places.append(start + base)
        sizes.append(np.diff(w.doc))
        base += len(w.hash)
    h = np.concatenate([*hashes, np.zeros(0, U)])
    at = np.concatenate([*places, np.zeros(0, np.int64)])
    n = np.concatenate([*sizes, np.zeros(0, np.int64)])
    gone = is_in(h, earlier)
    _, first = np.unique(h, return_index=True)
    again = np.ones(len(h), bool)
    again[first] = False
    edge = np.zeros(base + 1, np.int64)
    np.add.at(edge, at[gone | again], 1)
    np.add.at(edge, at[gone | again] + WINDOW, -1)
    removed = np.cumsum(edge)[:base] > 0
    ends = np.concatenate([[0], np.cumsum(n)])
    total = np.concatenate([[0], np.cumsum(removed)])
    out = []
    for k, t in enumerate(texts):
        own = (t.as_py() or "").encode().split()
        if total[ends[k + 1]] > total[ends[k]]:
            own = compress(own, (~removed[ends[k]:ends[k + 1]]).tolist())
        out.append(b" ".join(own))
    return pa.Table.from_arrays(
        [table.column("doc_id"), pa.array(n, pa.int64()), pa.array(total[ends[1:]] - total[ends[:-1]], pa.int64()),
         pa.array(out, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        own = [(t.as_py() or "").encode().split() for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([0] * len(own), pa.int64()),
             pa.array([b" ".join(x).decode() for x in own], pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    docs = id_text(docs, id_col, text_col)
    parts = n_parts(docs.sparkSession)
    schema = "doc_id long, n_words long, n_removed long, kept string"
    # Dealt once by block; the three readers below share that exchange.
    by_block = docs.where(F.col("doc_id").isNotNull()).withColumn("block", block_of(F.col("doc_id"), BLOCK)).groupBy("block")

    several = lambda h, block: np.isin(h, h[1:][h[1:] == h[:-1]])
    anchors = by_block.applyInArrow(lambda t: _sent_anchors(t, parts), MESSAGE)
    repeated = answered(anchors, several)

    def not_first(h: np.ndarray, block: np.ndarray) -> np.ndarray:
        later = np.zeros(len(h), bool)
        later[1:] = h[1:] == h[:-1]
        return later

    spread = (by_block.cogroup(repeated.groupBy("block"))
              .applyInArrow(lambda t, r: _sent_windows(t, received(r), parts), MESSAGE))
    earlier = answered(spread, not_first)
    kept = (by_block.cogroup(earlier.groupBy("block"))
            .applyInArrow(lambda t, r: _kept(t, received(r)), schema))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()).mapInArrow(_untouched, schema))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN []::VARCHAR[]
                      ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS seq
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM w WHERE len(words) >= 20)),
gone AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY seq ORDER BY doc_id, p) AS k FROM win) WHERE k > 1),
lost AS (
  SELECT doc_id, list(DISTINCT q) AS qs FROM (SELECT doc_id, unnest(range(p, p + 20)) AS q FROM gone) GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, w.words, coalesce(len(l.qs), 0) AS n_removed, coalesce(l.qs, []::BIGINT[]) AS qs
  FROM w LEFT JOIN lost l USING (doc_id)),
texts AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS kept FROM (
    SELECT k.doc_id, u.q, k.words[u.q] AS word
    FROM kept k, LATERAL (SELECT unnest(range(1, len(k.words) + 1)) AS q) u) x
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT doc_id, unnest(qs) AS q FROM lost) l WHERE l.doc_id = x.doc_id AND l.q = x.q)
  GROUP BY doc_id)
SELECT k.doc_id, len(k.words)::BIGINT AS n_words, k.n_removed::BIGINT AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM kept k LEFT JOIN texts t USING (doc_id)
"""
