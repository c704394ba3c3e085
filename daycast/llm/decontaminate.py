"""5. Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are compared without case and punctuation.  From every word of a
test item the shortest n-gram (3 words or more) that is rare becomes a
seed: rare means that, with the corpus frequency of each of its words
taken alone, fewer than `RARE` of the documents would hold it by chance.
Word frequencies, unlike n-gram counts, stay low for the rare words of a
passage even when that passage leaked into a third of all documents, so
common leaks keep their seeds.

The test items are the stated query set: they are taken in blocks of at
most `BLOCK_WORDS` words, and each block's seeds and items are broadcast to
one map over all documents.  Any number of items is handled, at one pass a
block; a pass holds a bounded table.  A document in which a seed of an item
occurs is aligned with that item around the seed hits (local alignment
over words: match 2, mismatch -1, gap -1); an alignment whose score is at
least `THRESHOLD` of the item's highest possible score, or that of `PASSAGE`
matching words in a row, is a leak: a long item leaks by a part of it, too.

Scripts written without spaces (Han, kana, Thai, Lao, Khmer, Myanmar) are
compared by character: each of their characters is a word.

Defined results: null or empty texts and items match nothing; an item of
fewer than 3 words has no seed and is never reported; repeated documents
each get their rows; equal items are reported each; a document and item
have one row, with the best-scoring alignment (the earliest of equals).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import (BYTE_VALUES, U, Prefix, Words, documents, id_text, text_slices, windows, words)

SHORTEST, LONGEST, RARE = 3, 8, 1e-4
MATCH, MISMATCH, GAP, THRESHOLD, PASSAGE = 2, -1, -1, 0.5, 13
BLOCK_WORDS = 2_000_000
TABLE_BITS = 22

# Bytes that count in a word: letters and digits (case folded), and all bytes beyond ASCII.
_COUNTS = np.zeros(256, bool)
_COUNTS[48:58] = _COUNTS[65:91] = _COUNTS[97:123] = _COUNTS[128:] = True
_VALUES = BYTE_VALUES.copy()
_VALUES[65:91] = BYTE_VALUES[97:123]


def _unspaced(data: np.ndarray) -> np.ndarray:
    """First bytes of the three-byte characters of scripts without spaces."""
    at = np.flatnonzero((data >= 0xE0) & (data <= 0xE9))
    at = at[at + 2 < len(data)]
    point = ((data[at].astype(np.int32) & 15) << 12) | ((data[at + 1].astype(np.int32) & 63) << 6) | (data[at + 2] & 63)
    some = np.zeros(len(at), bool)
    for lo, hi in ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x3400, 0x9FFF)):
        some |= (point >= lo) & (point <= hi)
    return at[some]


def _by_character(w: Words, off: np.ndarray, at: np.ndarray) -> Words:
    """The words, cut before and behind each character that begins at one of `at`; their hashes are not made."""
    start = np.unique(np.concatenate([w.start, at, at + 3]))
    word = np.searchsorted(w.start, start, "right") - 1
    start, word = start[start < w.end[word]], word[start < w.end[word]]
    end = np.minimum(np.append(start[1:], w.end[-1]), w.end[word])
    return Words(np.zeros(0, U), start, end, np.searchsorted(start, off))


def plain_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a slice without case and punctuation, and each text's first word."""
    w = words(data, off)
    at = _unspaced(data)
    if len(at):
        w = _by_character(w, off, at)
    kept = np.concatenate([[0], np.cumsum(_COUNTS[data])])
    # Hash only the bytes that count: compress the slice and hash the spans there.
    h = Prefix(_VALUES[data[_COUNTS[data]]]).of(kept[w.start], kept[w.end])
    some = kept[w.end] > kept[w.start]
    before = np.concatenate([[0], np.cumsum(some)])
    return h[some], before[w.doc]


class Members:
    """A sorted set of hashes behind a bit table; `find` gives (place in input, place in set)."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.hashes >> U(64 - TABLE_BITS)] = True

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.table[x >> U(64 - TABLE_BITS)])
        place = np.searchsorted(self.hashes, x[at])
        place[place == len(self.hashes)] = 0
        right = self.hashes[place] == x[at] if len(self.hashes) else np.zeros(0, bool)
        return at[right], place[right]


class Block:
    """A bounded part of the test items: their words, seeds, and the seeds' items."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        self.words = []
        for t in texts:
            raw = np.frombuffer((t or "").encode(), np.uint8)
            self.words.append(plain_words(raw, np.array([0, len(raw)]))[0])
        self.vocabulary = Members(np.concatenate([*self.words, np.zeros(0, U)]))
        self.seeds: dict[int, tuple[Members, list[np.ndarray]]] = {}

    def choose_seeds(self, counts: dict[int, int], n_words: int, n_docs: int) -> None:
        """The shortest rare n-gram from each word of each item."""
        per_doc = max(n_words, 1) / max(n_docs, 1)
        found: dict[int, dict[int, set[int]]] = {}
        for item, w in enumerate(self.words):
            share = np.array([max(counts.get(int(x), 0), 1) / max(n_words, 1) for x in w])
            for n in range(SHORTEST, LONGEST + 1):
                at, h = windows(w, np.array([0, len(w)]), n)
                for i, x in zip(at.tolist(), h.tolist()):
                    rare = per_doc * share[i:i + n].prod() < RARE
                    shorter = n > SHORTEST and per_doc * share[i:i + n - 1].prod() < RARE
                    # An n-gram that can't be lengthened is taken as it is, so that no item is without a seed.
                    last = n == LONGEST or (len(w) <= LONGEST and n == len(w))
                    if (rare or last) and not shorter:
                        found.setdefault(n, {}).setdefault(x, set()).add(item)
        for n, seeds in found.items():
            members = Members(np.array(list(seeds), U))
            self.seeds[n] = (members, [np.array(sorted(seeds[int(x)])) for x in members.hashes])


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: (best score, first and end word of the aligned part of `doc`).

    One anti-diagonal at a time; each cell also carries where its alignment began.
    """
    n, m = len(doc), len(item)
    best, begin, end = 0, 0, 0
    rev = item[::-1]
    # Cells are indexed by document word i; on anti-diagonal d the item word is d - i.
    prev = np.zeros(n + 1, np.int64)
    prev2 = np.zeros(n + 1, np.int64)
    from1, from2 = np.arange(n + 1), np.arange(n + 1)
    for d in range(n + m - 1):
        lo, hi = max(0, d - m + 1), min(n, d + 1)
        i = np.arange(lo, hi)
        same = doc[lo:hi] == rev[m - 1 - (d - i)]
        diag = prev2[lo:hi] + np.where(same, MATCH, MISMATCH)
        up, left = prev[lo:hi] + GAP, prev[lo + 1:hi + 1] + GAP
        score = np.maximum(np.maximum(diag, 0), np.maximum(up, left))
        origin = np.where(score == diag, np.where(prev2[lo:hi] > 0, from2[lo:hi], i),
                          np.where(score == up, from1[lo:hi], from1[lo + 1:hi + 1]))
        cur, from0 = np.zeros(n + 1, np.int64), np.arange(n + 1)
        cur[lo + 1:hi + 1] = score
        from0[lo + 1:hi + 1] = np.where(score > 0, origin, i)
        k = int(score.argmax())
        if score[k] > best:
            best, begin, end = int(score[k]), int(origin[k]), int(i[k]) + 1
        prev2, prev, from2, from1 = prev, cur, from1, from0
    return best, begin, end


def _leaks(block: Block, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float, int, int]]:
    """(row, item, score, first word, end word) of the leaks in a slice."""
    hits: dict[tuple[int, int], list[int]] = {}
    for n, (members, items) in block.seeds.items():
        start, g = windows(h, first, n)
        at, place = members.find(g)
        for p, k in zip(start[at].tolist(), place.tolist()):
            row = int(np.searchsorted(first, p, "right")) - 1
            for item in items[k].tolist():
                hits.setdefault((row, item), []).append(p)
    out = []
    for (row, item), places in sorted(hits.items()):
        w = block.words[item]
        reach = len(w) + len(w) // 2 + 8     # an alignment over the threshold spans no more
        lo, hi = int(first[row]), int(first[row + 1])
        best, top = (0, 0, 0), MATCH * len(w)
        spans: list[list[int]] = []
        for p in sorted(places):
            a, b = max(lo, p - reach), min(hi, p + reach)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        for a, b in spans:
            for c in range(a, b, 8 * reach):  # long runs of hits are aligned in overlapping parts
                s, x, y = align(h[c:min(b, c + 10 * reach)], w)
                if s > best[0]:
                    best = (s, c + x - lo, c + y - lo)
        if best[0] >= min(THRESHOLD * top, MATCH * PASSAGE):
            out.append((row, item, best[0] / top, best[1], best[2]))
    return out


def _word_counts(docs: DataFrame, block) -> tuple[dict[int, int], int, int]:
    """Corpus counts of the block's words, of all words and of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = block.value.vocabulary
        counts, total, rows = np.zeros(len(members.hashes), np.int64), 0, 0
        for b in batches:
            rows += b.num_rows
            for _, _, data, off in text_slices(b.column(1)):
                h, _ = plain_words(data, off)
                total += len(h)
                counts += np.bincount(members.find(h)[1], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([members.hashes[some].view(np.int64), [0, 0]]).astype(np.int64)),
             pa.array(np.concatenate([np.zeros(len(some)), [1, 2]]).astype(np.int32)),
             pa.array(np.concatenate([counts[some], [total, rows]]).astype(np.int64))], ["word", "what", "n"])

    # At most a row for each word of the block (BLOCK_WORDS) and two totals.
    rows = docs.mapInArrow(run, "word long, what int, n long").groupBy("word", "what").agg(F.sum("n").alias("n")).collect()
    counts = {r["word"] % 2**64: r["n"] for r in rows if r["what"] == 0}
    total = {r["what"]: r["n"] for r in rows if r["what"]}
    return counts, total.get(1, 0), total.get(2, 0)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Block]:
    """The test items in blocks of at most BLOCK_WORDS words, streamed through the driver one at a time."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        n = len(plain_words(raw := np.frombuffer((r["t"] or "").encode(), np.uint8), np.array([0, len(raw)]))[0])
        if ids and size + n > BLOCK_WORDS:
            yield Block(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["item_id"])
        texts.append(r["t"])
        size += n
    if ids:
        yield Block(ids, texts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, score (share of the item's highest), first_word, end_word of every leak."""
    docs = id_text(docs, id_col, text_col)
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, first_word long, end_word long"
    found = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_id_col, item_text_col):
        counts = _word_counts(docs, spark.sparkContext.broadcast(block))
        block.choose_seeds(*counts)
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in batches:
                ids, rows = b.column(0).to_pylist(), []
                for lo, _, data, off in text_slices(b.column(1)):
                    h, first = plain_words(data, off)
                    rows += [(ids[lo + r], block.ids[i], s, x, y) for r, i, s, x, y in _leaks(block, h, first)]
                cols = list(zip(*rows)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["doc_id", "item_id", "score", "first_word", "end_word"])

        found = found.unionByName(docs.mapInArrow(run, schema))
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents, all columns, that hold no leak of any item."""
    spark, place = docs.sparkSession, docs.columns.index(text_col)
    read, schema = id_text(docs, id_col, text_col), docs.schema
    for block in _blocks(benchmark, item_id_col, item_text_col):
        block.choose_seeds(*_word_counts(read, spark.sparkContext.broadcast(block)))
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                for lo, _, data, off in text_slices(b.column(place)):
                    for leak in _leaks(shared.value, *plain_words(data, off)):
                        clean[lo + leak[0]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
