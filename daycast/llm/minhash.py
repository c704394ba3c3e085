"""2. MinHash near-dedup with DartMinHash signatures.

A document is a set of shingles of `SHINGLE` words (with `weighted`, a
multiset: weight is the number of occurrences).  Each element's part of the
plane (weight x rank) is divided into regions of area 1; a region holds a
Poisson(1) number of darts at places that depend on the element and region
alone.  A dart hits if it lies under the element's weight and under a rank
bound that is chosen so that about k ln k + 2 k darts hit in a document,
whatever its length; darts are dealt to k coordinates by hash, and each
coordinate keeps the lowest rank.  A document with an empty coordinate is
thrown again with twice the bound.  Two documents agree in a coordinate
with probability equal to their (weighted) Jaccard similarity.

The `BANDS` x `ROWS` coordinates are joined by band.  Exact copies are
folded into one representative first.  Within a band's bucket every member
is compared with the bucket's smallest and largest member - linear, not all
pairs - by exact Jaccard similarity; verified links give components.
Buckets whose members are then still in different components are
finished through a pivot (see `_rest`), so no link between components that
a band finds is lost.  A pair at 0.8 meets in no band with probability
3e-6.

Defined results: one row per input row.  The class is the smallest doc_id
of the component.  Texts of 1 to 4 words have their whole sequence as the
one shingle; texts without words (null, empty) are alone in their class;
rows without doc_id have no class (null) and take no part; rows that share
a doc_id are classed by their text, texts represented by one doc_id together.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import U, Prefix, Words, compact, documents, id_text, mix, salted, saved, ship, text_slices, windows, words
from daycast.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4
K = BANDS * ROWS
DARTS = K * log(K) + 2 * K
#: Cumulative probabilities of a Poisson(1) count, as 64-bit thresholds.
POISSON = np.array([int(sum(1 / factorial(j) for j in range(n + 1)) / 2.718281828459045 * 2**64) for n in range(17)], U)
_UNIT = 2.0**-53


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * _UNIT


def dart_ranks(elements: np.ndarray, weights: np.ndarray, first: np.ndarray, darts: float = DARTS) -> np.ndarray:
    """Lowest rank per document and coordinate; `first`: each document's first element, and their number.

    Documents without elements have infinite ranks.
    """
    n = len(first) - 1
    sizes = np.diff(first)
    lowest = np.full((n, K), np.inf)
    todo = np.flatnonzero(sizes)
    while len(todo):
        part = np.repeat(np.arange(len(todo)), sizes[todo])
        at = np.arange(len(part)) + np.repeat(first[todo] - np.concatenate([[0], np.cumsum(sizes[todo])[:-1]]), sizes[todo])
        e, x = elements[at], weights[at]
        total = np.add.reduceat(x, np.concatenate([[0], np.cumsum(sizes[todo])[:-1]]))
        bound = darts / total
        found = np.full(len(todo) * K, np.inf)
        level, low, width = 0, 0.0, 1.0
        while True:
            own = np.flatnonzero(x > low)
            if not len(own):
                break
            # Regions of this weight range: `width` wide and 1 / width high, stacked up to the bound.
            cells = np.ceil(bound[part[own]] * width).astype(np.int64)
            at = np.repeat(own, cells)
            high = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
            key = mix(salted(e[at], 1000 + level) + high.astype(U) * U(0xA0761D6478BD642F))
            count = np.searchsorted(POISSON, key, "right")
            at, high, key = np.repeat(at, count), np.repeat(high, count), np.repeat(key, count)
            turn = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            dart = mix(key + (turn + 1).astype(U) * U(0xE7037ED1A0B428DB))
            rank = (high + _unit(salted(dart, 1))) / width
            hit = rank < bound[part[at]]
            if low + width > 1 or (x < 1).any():
                hit &= low + _unit(salted(dart, 2)) * width < x[at]
            dart, rank, at = dart[hit], rank[hit], at[hit]
            np.minimum.at(found, part[at] * K + (dart % U(K)).astype(np.int64), rank)
            low, width, level = low + width, low + width, level + 1
        found = found.reshape(len(todo), K)
        lowest[todo] = found
        todo = todo[np.isinf(found).any(axis=1)]
        darts *= 2
    return lowest


def sequence_hash(w: Words, base: int) -> np.ndarray:
    """A hash of each text's whole word sequence."""
    return Prefix(w.hash, base).of(w.doc[:-1], w.doc[1:])


def shingles(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first shingle of each text and their number, two hashes of each text's whole word sequence)."""
    w = words(data, off)
    n = np.diff(w.doc)
    whole = sequence_hash(w, 0xD1342543DE82EF95)
    start, h = windows(w.hash, w.doc, SHINGLE)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    at = np.concatenate([start, w.doc[:-1][short]])
    h = np.concatenate([h, whole[short]])
    order = np.argsort(at, kind="stable")
    return h[order], np.searchsorted(at[order], w.doc), whole, sequence_hash(w, 0xAEF17502108EF2D9)


def band_keys(ranks: np.ndarray) -> np.ndarray:
    """One hash per document and band."""
    bits = np.ascontiguousarray(ranks).view(U).reshape(len(ranks), BANDS, ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=U)), bits.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * U(0x9E3779B97F4A7C15) + bits[:, :, r])
    return key


def signatures(docs: DataFrame, weighted: bool = False) -> DataFrame:
    """doc_id, t, k1, k2 (hashes of the word sequence) and bands of every text with words; docs: doc_id, text, t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(1)):
                h, first, k1, k2 = shingles(data, off)
                x = np.ones(len(h))
                if weighted:
                    of = np.repeat(np.arange(hi - lo), np.diff(first))
                    order = np.lexsort((h, of))
                    new = np.ones(len(h), bool)
                    new[1:] = (np.diff(of[order]) != 0) | (h[order][1:] != h[order][:-1])
                    keep = np.flatnonzero(new)
                    x = np.diff(np.append(keep, len(h))).astype(float)
                    h = h[order][keep]
                    first = np.searchsorted(of[order][keep], np.arange(hi - lo + 1))
                full = np.flatnonzero(np.diff(first))
                keys = band_keys(dart_ranks(h, x, first)[full]).view(np.int64)
                sizes = pa.array(np.arange(len(full) + 1) * BANDS, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).take(pa.array(full)), b.column(2).slice(lo, hi - lo).take(pa.array(full)),
                     pa.array(k1[full].view(np.int64)), pa.array(k2[full].view(np.int64)),
                     pa.ListArray.from_arrays(sizes, pa.array(keys.ravel()))], ["doc_id", "t", "k1", "k2", "bands"])

    return docs.mapInArrow(run, "doc_id long, t long, k1 long, k2 long, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """node, shingles (sorted distinct hashes) of each text; docs: doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, off in text_slices(b.column(1)):
                h, first, _, _ = shingles(data, off)
                sets = [np.unique(h[first[k]:first[k + 1]]) for k in range(hi - lo)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate([*sets, np.zeros(0, U)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    ["node", "shingles"])

    return docs.mapInArrow(run, "node long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose exact Jaccard similarity is at least `similarity`."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(a, "u").join(b, "v").withColumn("common", F.size(F.array_intersect("a", "b")))
    return both.where(F.col("common") >= F.lit(similarity) * (F.size("a") + F.size("b") - F.col("common"))).select("u", "v")


def _rest(crowd: DataFrame, sets: DataFrame, links: DataFrame, roots: DataFrame, similarity: float) -> DataFrame | None:
    """Links between members of one bucket that are still in different components; None if there are none.

    Every such bucket of four or more (smaller ones were compared in full)
    gets a pivot: the node with the most links in the component of its
    best-linked member.  The pivot's shingles, and those that more than a
    quarter of the members around it hold, are the core; c is a member's
    overlap with it.  A member x outside the pivot's component can be
    similar to a member y of another component only if they share a
    shingle beyond the core, or if their sizes allow it: else at most
    min(c_x, c_y) shingles are common, and that must be `similarity` of
    their union.  Both conditions are equality joins, so the pairs to
    verify are found without making all pairs of the bucket, and none is
    lost.
    """
    own_root = F.coalesce("root", "node").alias("root")
    ends = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node")))
    degree = compact(ends.groupBy("node").agg(F.count("*").alias("degree")))
    best = F.max(F.struct("degree", (-F.col("node")).alias("node")))
    centre = (degree.join(roots, "node", "left").select("node", "degree", own_root)
              .groupBy("root").agg(best.alias("top")).select("root", (-F.col("top.node")).alias("centre")))
    placed = (crowd.where("n > 3").join(roots, "node", "left").join(degree, "node", "left")
              .select("key", "node", own_root, F.coalesce("degree", F.lit(0)).alias("degree")))
    mixed = compact(placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2"),
                                            F.max(F.struct("degree", (-F.col("node")).alias("node"), "root")).alias("top"))
                  .where("r1 <> r2").select("key", F.col("top.root").alias("root"), (-F.col("top.node")).alias("member"))
                  .join(centre, "root", "left").select("key", F.coalesce("centre", "member").alias("pivot")))
    around = crowd.select("key", "node").join(mixed, "key").select("pivot", "node").distinct()
    theirs = sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("p"))
    seen = saved(around.join(sets, "node").join(theirs, "pivot")
                 .select("pivot", "node", F.size("shingles").alias("n"), F.size("p").alias("np"),
                         F.size(F.array_intersect("shingles", "p")).alias("c"), F.array_except("shingles", "p").alias("added")))
    more = compact(seen.where((F.col("pivot") != F.col("node")) & (F.col("c") >= similarity * (F.col("n") + F.col("np") - F.col("c"))))
                 .select(F.col("pivot").alias("u"), F.col("node").alias("v")))
    links = compact(links.unionByName(more))
    roots = components(links)

    items = seen.select("pivot", "node", F.explode("added").alias("item"))
    held = items.groupBy("pivot", "item").agg(F.count("*").alias("held"))
    lists = (items.join(held, ["pivot", "item"]).groupBy("pivot", "node")
             .agg(F.array_sort(F.collect_list(F.struct("held", "item"))).alias("added")))
    around_pivot = seen.groupBy("pivot").agg(F.count("*").alias("members"), F.min("n").alias("least_n"))
    in_core = lambda e: e.held * 4 > F.col("members")
    # A similar pair shares at least `need` items beyond the core, so one of them is among the first
    # size - need + 1 of each, in the same order; rare items come first.
    need = F.greatest(F.lit(1), F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("least_n")) - F.col("c") - 1e-9))
    seen = (seen.drop("added").join(lists, ["pivot", "node"], "left").join(around_pivot, "pivot")
            .withColumn("added", F.coalesce("added", F.array().cast("array<struct<held:bigint,item:bigint>>")))
            .withColumn("c", F.col("c") + F.size(F.filter("added", in_core)))
            .withColumn("added", F.filter("added", lambda e: ~in_core(e)))
            .withColumn("size", F.size("added"))
            .withColumn("added", F.slice("added", F.lit(1), F.greatest(F.lit(0), F.col("size") - need + 1).cast("int")))
            .withColumn("added", F.filter(F.transform("added", lambda e, i: F.struct(e.item.alias("item"), e.held.alias("held"),
                                                                                     (F.col("size") - i).alias("left"))),
                                          lambda e: e.held > 1))
            .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
            .join(roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root")), "pivot", "left")
            .withColumn("outside", F.col("root") != F.coalesce("pivot_root", "pivot")))
    seen = saved(seen)
    outside = seen.where("outside")
    side = lambda df, k: (df.select("pivot", F.explode("added").alias("e"), F.col("node").alias(k), F.col("root").alias(f"r{k}"),
                                    F.col("n").alias(f"n{k}"), F.col("c").alias(f"c{k}"))
                          .select("pivot", "e.item", F.col("e.left").alias(f"left{k}"), k, f"r{k}", f"n{k}", f"c{k}"))
    # Behind the first item they share, no more than the shorter rest can be shared; that must be enough.
    still = F.least("leftu", "leftv") + F.least("cu", "cv")
    by_item = (side(outside, "u").join(side(seen, "v"), ["pivot", "item"])
               .where("ru <> rv").where(still * (1 + similarity) >= similarity * (F.col("nu") + F.col("nv")) - 1e-9).select("u", "v"))
    low, high = F.ceil(F.lit(similarity) * F.col("n")).cast("int"), F.floor(F.col("c") * (1 + 1 / similarity) - F.col("n")).cast("int")
    x = (outside.where(low <= high).select("pivot", F.explode(F.sequence(low, high)).alias("nv"), F.col("n").alias("nu"),
                                           F.col("c").alias("cu"), F.col("node").alias("u"), F.col("root").alias("ru")))
    y = seen.select("pivot", F.col("n").alias("nv"), F.col("c").alias("cv"), F.col("node").alias("v"), F.col("root").alias("rv"))
    by_size = (x.join(y, ["pivot", "nv"]).where("ru <> rv")
               .where(F.least("cu", "cv") * (1 + similarity) >= similarity * (F.col("nu") + F.col("nv"))).select("u", "v"))
    pairs = by_item.unionByName(by_size).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    found = compact(more.unionByName(verified(pairs, sets, similarity)))
    return found if found.take(1) else None


def _classes(docs: DataFrame, similarity: float, weighted: bool) -> DataFrame:
    """doc_id, t, class_id of every row; docs: doc_id, text, t (a hash of the text)."""
    ship(docs.sparkSession)
    known = docs.where(F.col("doc_id").isNotNull())
    signed = saved(signatures(known, weighted))
    # One representative for each distinct text.
    reps = saved(signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    members = reps.select(F.explode("bands").alias("key"), F.col("rep").alias("node"))
    buckets = (members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
               .where("low <> high"))
    crowd = compact(members.join(compact(buckets), "key"))

    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    pairs = crowd.select(F.explode(F.array(pair("low", "node"), pair("node", "high"))).alias("p")).select("p.u", "p.v")
    pairs = pairs.where("u <> v").distinct()
    wanted = crowd.select("node").distinct()
    texts = known.join(wanted, known.doc_id == wanted.node, "left_semi")
    sets = saved(shingle_sets(texts).groupBy("node").agg(F.first("shingles").alias("shingles")))
    links = compact(verified(pairs, sets, similarity))
    roots = components(links)

    rest = _rest(crowd, sets, links, roots, similarity)
    if rest is not None:
        roots = components(links.unionByName(rest))

    classed = reps.select("k1", "k2", "rep").join(roots, F.col("rep") == F.col("node"), "left") \
        .select("k1", "k2", F.coalesce("root", "rep").alias("class_id"))
    with_words = signed.select("doc_id", "t", "k1", "k2").join(compact(classed), ["k1", "k2"]).select("doc_id", "t", "class_id")
    wordless = docs.where(F.col("doc_id").isNull() | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return with_words.unionByName(wordless.select("doc_id", "t", F.col("doc_id").alias("class_id")))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id of every row."""
    docs = id_text(docs, id_col, text_col).withColumn("t", F.xxhash64("text"))
    return _classes(docs, similarity, weighted).select("doc_id", "class_id")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, weighted: bool = False,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, without those whose class has a smaller doc_id; equal rows stay once."""
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.withColumn("t", F.xxhash64("text"))
    first = (_classes(keyed.select("doc_id", "text", "t"), similarity, weighted)
             .where("doc_id = class_id").select("doc_id", "t").distinct())
    known = keyed.select("row", "doc_id", "t").join(first, ["doc_id", "t"]).dropDuplicates(["doc_id", "t"])
    return known.select("row").unionByName(keyed.where(F.col("doc_id").isNull()).select("row")).select("row.*")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
