"""11. Spelling variant grouping by dense prefix-suffix tiling.

Two words differ by one inserted, deleted or replaced code point exactly
when they are different and their common prefix and common suffix together
reach the longer one's length minus one.  Tiles of words are compared as
padded code-point matrices: one pass over the columns from the left gives
all common prefixes of the tile, one from the right all common suffixes.

Only tiles that can hold a near pair are compared.  An edit spares the
first floor(g/2) or the last g - floor(g/2) code points of both words,
where g is the shorter one's length.  A word of length L is therefore put
under its two halves for g = L and for g = L - 1, and meets only the words
under the same half.  A pair that shares both halves counts under the
first only, so each pair counts once.

How it scales: words are counted in the tasks that read the texts (a
bounded table per task) before the only shuffle of corpus size.  Halves
with few words fill tiles together; a half with more words than a tile is
dealt over blocks by hash, and its blocks meet as block pairs, each its own
row, so no task or row holds a group as a whole.  Tiles send one row per
word (number of near words, and the best one), never the pairs.

Defined results: null and empty texts have no words; rows of one doc_id
count apart, with the same deletions; a null doc_id counts as empty text in
the crc32; a run of any length is one word (longer words get narrower
tiles, so a tile's memory is bounded by TILE_CELLS or one word).  Equal
n: the form is the smallest word in code-point order.  An empty table gives
no rows.  Other columns of the input are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import compact, documents, id_text, saved, ship

# A run of A-Z, a-z and U+00C0 to U+00FF in UTF-8 after lower-casing A-Z; the deletion rule; the least sizes.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
DELETED = 97
MIN_LENGTH, MIN_COUNT, RATIO = 5, 3, 2

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words of a tile, and code points of its matrix.
TILE, TILE_CELLS = 512, 1 << 23
#: Different words that a task counts before it sends them on.
TABLE_WORDS = 100_000


def _words_of(doc_id: int | None, text: str, least: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of one text, after the deletions, words of at least `least` code points."""
    seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().translate(LOWER))).items():
        h = zlib.crc32(run, seed)
        if h % DELETED == 0:
            word = run.decode()
            at = h % len(word)
            run = (word[:at] + word[at + 1:]).encode()
        if len(run) >= least and (len(run) >= 2 * least or len(run.decode()) >= least):
            yield run, n


def word_counts(docs: DataFrame, least: int = MIN_LENGTH, min_count: int = MIN_COUNT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """word, n: the words of at least `least` code points and `min_count` occurrences in all texts."""

    def send(table: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(table), pa.binary()).cast(pa.string()), pa.array(list(table.values()), pa.int64())], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                for word, n in _words_of(doc_id, text.as_py() or "", least):
                    table[word] += n
                if len(table) > TABLE_WORDS:
                    yield send(table)
                    table.clear()
        if table:
            yield send(table)

    return (id_text(docs, id_col, text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def _halves(least: int) -> Column:
    """The up to four halves of a word: for each length g of the shorter word of a pair, the side and the text."""
    length = F.length("word")

    def half(g: Column, side: int) -> Column:
        head = F.floor(g / 2).cast("int")
        text = F.substr("word", F.lit(1), head) if side == 0 else F.substr("word", length - (g - head) + 1, g - head)
        return F.struct(g.alias("g"), F.lit(side).alias("side"), text.alias("half"))

    own = [half(length, 0), half(length, 1)]
    shorter = [half(length - 1, 0), half(length - 1, 1)]
    return F.explode(F.when(length > least, F.array(*own, *shorter)).otherwise(F.array(*own)))


def _tile_rows(g: Column) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_CELLS) / (g + 1)))).cast("long")


def _width(g: Column) -> Column:
    """Words of one tile have equal or similar lengths: below 64 the length, then its power of two (at most 128 classes)."""
    return F.when(g < 64, g).otherwise(F.lit(64) + F.floor(F.log2(g.cast("double")))).cast("int")


def _tiles(words: DataFrame, least: int) -> DataFrame:
    """home, block, items: packed words; `home` names the half of a hot group's block and is empty for shared tiles."""
    under = words.select("word", "n", _halves(least).alias("h")).select("word", "n", "h.*")
    key = ["g", "side", "half"]
    sizes = (under.groupBy(*key).agg(F.count("*").alias("size"), F.count_if(F.length("word") == F.col("g")).alias("shorter"))
             .where("shorter > 0 AND size > 1")      # a half of one word, or of longer words alone, holds no pair
             .withColumn("blocks", F.ceil(F.col("size") / _tile_rows(F.col("g")))).withColumn("width", _width(F.col("g"))))
    sizes = saved(sizes.select(*key, "size", "blocks", "width"))
    # One row for each width class: 128 at most.
    shared = F.broadcast(sizes.where("blocks = 1").groupBy("width")
                         .agg(F.ceil(F.sum("size") / F.min(_tile_rows(F.col("g")))).alias("shared")))
    gid = F.xxhash64(*key)
    hot = F.col("blocks") > 1
    dealt = (under.join(sizes, key).join(shared, "width", "left").select(
        F.when(hot, F.concat_ws(":", *key)).otherwise(F.lit("")).alias("home"), "width",
        F.when(hot, F.pmod(F.xxhash64("word"), "blocks")).otherwise(F.pmod(gid, "shared")).alias("block"),
        F.struct("word", "n", "g", "side", gid.alias("gid")).alias("item")))
    return dealt.groupBy("home", "width", "block").agg(F.collect_list("item").alias("items"))


class _Tile:
    """Words as matrices of code points, padded on the right and, reversed, on the left."""

    def __init__(self, items: pa.StructArray):
        self.words = items.field("word")
        self.n, self.g, self.side, self.gid = (items.field(f).to_numpy() for f in ("n", "g", "side", "gid"))
        self.length = pc.utf8_length(self.words).to_numpy().astype(np.int64)
        points = np.frombuffer("".join(self.words.to_pylist()).encode("utf-32-le"), "<u4")
        if not len(points) or points.max() < 256:
            points = points.astype(np.uint8)
        row = np.repeat(np.arange(len(self.length)), self.length)
        at = np.arange(len(points)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        width = int(self.length.max(initial=0))
        self.heads = np.zeros((width, len(self.length)), points.dtype)
        self.tails = np.zeros_like(self.heads)
        self.heads[at, row] = points
        self.tails[self.length[row] - 1 - at, row] = points


def _common(x: np.ndarray, y: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """For each pair that is `alive`, the number of first columns in which its words agree."""
    alive = alive.copy()
    n = np.zeros(alive.shape, np.int32 if len(x) > 255 else np.uint8)
    for a, b in zip(x, y):
        alive &= a[:, None] == b[None, :]
        if not alive.any():
            break
        n += alive
    return n


def near_pairs(x: _Tile, y: _Tile, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the words of two tiles (or of one, with both orders) that are one edit apart under a common half."""
    meet = (x.gid[:, None] == y.gid[None, :]) & (np.minimum.outer(x.length, y.length) == x.g[:, None])
    if same:
        np.fill_diagonal(meet, False)
    prefix = _common(x.heads, y.heads, meet)
    suffix = _common(x.tails, y.tails, meet)
    i, j = np.nonzero(meet)
    p, s = prefix[i, j].astype(np.int64), suffix[i, j].astype(np.int64)
    g, longer = x.g[i].astype(np.int64), np.maximum(x.length[i], y.length[j])
    head = g // 2
    under = np.where(x.side[i] == 0, p >= head, (p < head) & (s >= g - head))
    near = under & (p + s >= longer - 1) & (p < longer)
    return i[near], j[near]


def _best(x: _Tile, y: _Tile, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """For each word of x with near words: their number, and the n and text of the most frequent, first in code-point order."""
    texts = y.words.to_pylist()
    used = np.unique(j)
    rank = np.zeros(len(texts), np.int64)
    rank[sorted(used.tolist(), key=lambda k: texts[k])] = np.arange(len(used))
    order = np.lexsort((rank[j], -y.n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.diff(i, prepend=-1))
    n_near = np.diff(np.append(first, len(i)))
    return pa.RecordBatch.from_arrays(
        [x.words.take(pa.array(i[first])), pa.array(n_near, pa.int64()), pa.array(y.n[j[first]], pa.int64()),
         y.words.take(pa.array(j[first]))], ["word", "n_near", "form_n", "form"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (x, y) of packed tiles, y null for a tile that meets itself, to one row per word with near words."""
    for b in batches:
        for k in range(b.num_rows):
            x = _Tile(b.column(0)[k].values)
            own = not b.column(1)[k].is_valid
            y = x if own else _Tile(b.column(1)[k].values)
            i, j = near_pairs(x, y, own)
            if len(i):
                yield _best(x, y, i, j)
                if not own:
                    yield _best(y, x, j, i)


def near_words(words: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """word, n_near, form_n, form for each of the distinct words (word, n) that has near words: their number, and the
    most frequent one.  `least` is a lower bound of the words' lengths."""
    ship(words.sparkSession)
    tiles = saved(_tiles(words, least))
    hot = tiles.where("home <> ''").select("home", "block", "items")
    other = hot.select("home", F.col("block").alias("later"), F.col("items").alias("y"))
    pairs = tiles.select(F.col("items").alias("x"), F.lit(None).cast(tiles.schema["items"].dataType).alias("y")).unionByName(
        hot.join(other, "home").where("block < later").select(F.col("items").alias("x"), "y"))
    found = pairs.mapInArrow(_compare, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"))


def roots(links: DataFrame) -> DataFrame:
    """word, root: where the forms of each word of (word, form) end, by doubling.

    A form is at least RATIO times as frequent as its word, so a chain is
    no longer than the logarithm of the largest count, and the rounds no
    more than that number's.
    """
    found = compact(links.select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = compact(found.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"),
                                                              F.col("beyond").isNotNull().alias("moved")))
        found = step.drop("moved")
        if step.where("moved").isEmpty():
            return found


def spelling_variants(words: DataFrame, least: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words (word, n): see the module."""
    words = saved(words.select("word", "n"))
    near = near_words(words, least)
    told = saved(words.join(near, "word", "left").withColumn("ok", F.coalesce(F.col("form_n") >= ratio * F.col("n"), F.lit(False)))
                 .select("word", F.when(F.col("ok"), F.col("form")).alias("form"), "n",
                         F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("ok"), F.col("form_n")).alias("form_n")))
    ends = roots(told.where(F.col("form").isNotNull()))
    return (told.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(documents(spark, sf_dir)))
