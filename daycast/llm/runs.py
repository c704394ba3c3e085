"""12. Periodic runs of words, by maximal pairs.

A run with smallest period q and length n gives the maximal pair (start,
start + q): the words from both places on agree for n - q words, and
neither the words before nor those after agree.  Conversely a maximal pair
at distance d that agrees for at least (EXPONENT - 1) * d words, and for
MIN_LENGTH - d, is a run with period d as it stands; nothing is extended.
Multiples of the smallest period give the same stretch again, and the
least one stays.

The pairs come from the tree of LCP intervals of the text's suffixes, read
bottom up.  Every interval keeps its places as sorted lists by the word to
their left; when a child joins its interval, only places with different
left words and within the allowed distance meet.  Three things are left
out because no pair in them can be a run: intervals of fewer than 16 shared
words (the least that the constraints allow), subtrees whose places all
have one left word, and those whose places lie too far apart for what is
left of the text.  In prose nothing remains, and no suffix is sorted.

Rows are independent, so the work is one map over the documents.  Texts are
handled in slices of bounded size or one longer text; sorting suffixes and
their common prefixes takes O(n log^2 n) time and O(n) memory.  Words are
equal when their 64-bit hashes are.

Defined results: null and empty texts have no words, no run, and collapse
to ""; repeated rows each get theirs; a null doc_id is passed on (and its
text not altered by the query); an empty table gives no rows; other columns
are never read.  Ties for the best run: smallest start, then period.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import _STEP, Prefix, documents, id_text, mix, text_slices, windows, words

U = np.uint64
MIN_LENGTH, EXPONENT = 24, 3

Run = tuple[int, int, int]      # start, length, period


def least_shared(min_length: int, exponent: int) -> int:
    """The fewest words that the two places of a run can share: the least max((e - 1) * d, m - d) over all distances."""
    return min(max((exponent - 1) * d, min_length - d) for d in range(1, min_length + 1))


def suffix_ranks(hashes: np.ndarray) -> np.ndarray:
    """The rank of each suffix, by doubling; words are ordered by their hashes."""
    rank = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
    n, k = len(rank), 1
    while rank.max() < n - 1:
        key = rank * (n + 1)
        key[:-k] += rank[k:] + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        k *= 2
    return rank


def shared_words(prefix: Prefix, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of words on which the suffixes at a and b agree, by bisection over prefix hashes."""
    lo, hi = np.zeros(len(a), np.int64), n - np.maximum(a, b)
    while (open_ := lo < hi).any():
        mid = (lo + hi + 1) // 2
        same = prefix.of(a, a + mid) == prefix.of(b, b + mid)
        lo, hi = np.where(open_ & same, mid, lo), np.where(open_ & ~same, mid - 1, hi)
    return lo


class Interval:
    """The places of an LCP interval: all of them, and by the word to their left, in order."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.by_left = {left: [place]}

    def join(self, other: Interval) -> Interval:
        """Both as one; the smaller is put into the larger."""
        big, small = (self, other) if len(self.places) >= len(other.places) else (other, self)
        _put(big.places, small.places)
        for left, places in small.by_left.items():
            if left in big.by_left:
                _put(big.by_left[left], places)
            else:
                big.by_left[left] = places
        return big


def _put(into: list[int], places: list[int]) -> None:
    if len(places) > 8:
        into += places
        into.sort()
    else:
        for p in places:
            insort(into, p)


def meeting(a: Interval, b: Interval, reach: int, left_of: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs of places from a and b with different left words, at most `reach` apart.

    The lists of the other left words are searched, or the neighbours
    themselves where they are fewer than the lists.
    """
    if len(a.places) > len(b.places):
        a, b = b, a
    if len(a.by_left) == 1 and a.by_left.keys() == b.by_left.keys():
        return
    for left, places in a.by_left.items():
        for i in places:
            lo, hi = bisect_left(b.places, i - reach), bisect_right(b.places, i + reach)
            if hi - lo <= len(b.by_left):
                for j in b.places[lo:hi]:
                    if left_of[j] != left:
                        yield i, j
            else:
                for other, there in b.by_left.items():
                    if other != left:
                        for j in there[bisect_left(there, i - reach):bisect_right(there, i + reach)]:
                            yield i, j


def maximal_pairs(order: list[int], shared: list[int], left_of: list[int], exponent: int) -> Iterator[tuple[int, int, int]]:
    """(place, place, words shared) of maximal pairs close enough for a run, from suffixes in order.

    shared[k] belongs to order[k] and order[k + 1].
    """
    stack: list[tuple[int, Interval]] = []
    child = Interval(order[0], left_of[order[0]])
    for k in range(len(order)):
        depth = shared[k] if k < len(shared) else -1
        while stack and stack[-1][0] >= depth:
            own, places = stack.pop()
            for i, j in meeting(places, child, own // (exponent - 1), left_of):
                yield i, j, own
            child = places.join(child)
            if own == depth:
                break
        if k < len(shared):
            stack.append((depth, child))
            child = Interval(order[k + 1], left_of[order[k + 1]])


def _groups(start: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of groups of two or more equal keys, in order, and where each group begins."""
    order = np.lexsort((start, key))
    k = key[order]
    same = np.concatenate([[False], k[1:] == k[:-1], [False]])
    order = order[same[:-1] | same[1:]]
    k = key[order]
    return order, np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(order) else np.zeros(0, np.int64)


def places_with_runs(hashes: np.ndarray, doc: np.ndarray, least: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that share `least` words with another of the same document and may form a run with it, and a group number each."""
    start, h = windows(hashes, doc, least)
    none = np.zeros(0, np.int64)
    if not len(start):
        return none, none
    of = np.searchsorted(doc, start, "right") - 1
    order, first = _groups(start, h ^ mix(of.astype(U) + U(1)))
    if not len(order):
        return none, none
    place, of = start[order], of[order]
    # The word to the left; a text's first word has none, which is a left word of its own.
    left = np.where(place > doc[of], hashes[place - 1], U(0))
    gap = np.diff(place, prepend=0)
    gap[first] = np.iinfo(np.int64).max
    close = gap <= (doc[of + 1] - place) // (exponent - 1)
    wanted = (np.minimum.reduceat(left, first) != np.maximum.reduceat(left, first)) & np.logical_or.reduceat(close, first)
    size = np.diff(np.append(first, len(place)))
    keep = np.repeat(wanted, size)
    return place[keep], np.repeat(np.arange(len(first)), size)[keep]


def runs_of(hashes: np.ndarray, places: np.ndarray, group: np.ndarray, min_length: int, exponent: int) -> list[Run]:
    """The runs of one text, given its places that may form one, by group."""
    rank = suffix_ranks(hashes)
    order = np.lexsort((rank[places], group))
    places, group = places[order], group[order]
    shared = shared_words(Prefix(hashes, _STEP), len(hashes), places[:-1], places[1:])
    # Left words as numbers; a text's start has the number 0.
    left_of = np.concatenate([[0], np.unique(hashes, return_inverse=True)[1][:-1] + 1]).tolist()
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(places)]])
    best: dict[tuple[int, int], int] = {}
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        for i, j, own in maximal_pairs(places[lo:hi].tolist(), shared[lo:hi - 1].tolist(), left_of, exponent):
            d = abs(i - j)
            if own >= max((exponent - 1) * d, min_length - d):
                stretch = min(i, j), own + d
                best[stretch] = min(best.get(stretch, d), d)
    return sorted((start, length, period) for (start, length), period in best.items())


def collapsed(text: bytes, runs: list[Run]) -> bytes:
    """The text's words without those that a run repeats, joined by one space."""
    kept = text.split()
    if runs:
        keep = np.ones(len(kept), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        kept = [kept[k] for k in np.flatnonzero(keep)]
    return b" ".join(kept)


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = EXPONENT, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs by start and period, and the text with every run cut to its first period.

    `exponent` (2 or more) is the least number of periods, `min_length` the least number of words of a run.
    """
    if exponent < 2 or min_length < 2:
        raise ValueError("exponent and min_length must be at least 2")
    least = least_shared(min_length, exponent)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(1)):
                w = words(data, off)
                places, group = places_with_runs(w.hash, w.doc, least, exponent)
                of = np.searchsorted(w.doc, places, "right") - 1
                # A group lies in one document; a document's places together.
                order = np.argsort(of, kind="stable")
                places, group, of = places[order], group[order], of[order]
                bounds = np.searchsorted(of, np.arange(hi - lo + 1))
                found, texts = [], []
                for k in range(hi - lo):
                    first, last = w.doc[k], w.doc[k + 1]
                    p = slice(bounds[k], bounds[k + 1])
                    runs = runs_of(w.hash[first:last], places[p] - first, group[p], min_length, exponent) if p.start < p.stop else []
                    found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                    texts.append(collapsed(data[off[k]:off[k + 1]].tobytes(), runs))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(np.diff(w.doc), pa.int64()), pa.array(found, pa.list_(run_type)),
                     pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return id_text(docs, id_col, text_col).mapInArrow(find, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The query's input: a tenth of the texts, chosen and cut by crc32 of the doc_id, repeat a stretch to their end.

    From word a = g % n on, word i becomes word a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    ws = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, ws).alias("ws"))
    cut = cut.withColumn("n", F.size("ws").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)))
    a, p = F.col("a"), F.col("p")

    def word(w: Column, i: Column) -> Column:
        return F.get(F.col("ws"), F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))

    return cut.select("doc_id", F.when(F.col("n") > 0, F.concat_ws(" ", F.transform("ws", word))).otherwise(F.col("text")).alias("text"))


def best_run() -> Column:
    """The run with the greatest exact length / period: smallest start, then period, among equals; null without runs."""
    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    return F.aggregate("runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the best one, and the digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("best", best_run()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_planted_periods(documents(spark, sf_dir))))
