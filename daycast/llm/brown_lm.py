"""6. Language-model scoring with a Brown class bigram model.

log10 P(text) = sum over its tokens of log10 P(class | class before) +
log10 P(token | class).  Tokens are the case-folded words and one end; the
class before the first token is that of the end.

Classes: every training word gets one of `CLASSES` classes; a word never
seen has the class of its ending (the hash of its last two bytes,
`ENDINGS` classes); the end is a class of its own.  Exchange clustering of
the `TOP` most frequent words makes the classes to start from, with all
other words by their endings: it starts from classes dealt by frequency,
moves one word at a time to the class that raises the training likelihood
of the class bigrams most, and stops when a pass moves nothing (`PASSES` at
most).  Then passes over all training words: each moves to the class under
which its own neighbours are most likely, given the class bigrams of the
pass before.  All words move at once, so a pass may overshoot: passes end
when the likelihood no longer rises, with the best classes found (`PASSES`
at most; the first one always counts, as it takes the words out of the
ending classes).

What is counted covers all training documents:
* documents are dealt into blocks, each written once as places in its
  sorted distinct words, in buckets that no pass shuffles again;
* counts of every word: each block sends every distinct word once with its
  count to the part of the hash space it falls in, and gets the corpus count
  of each back;
* bigrams of units (top words, endings, the end): one dense table of bounded
  size ((TOP + ENDINGS + 1) squared) a task, added up by row;
* a pass: each block sends every distinct word once with the classes before
  and behind it, and gets the new class of each back.
The first exchange works on that one bounded table, on the driver; of a pass
the driver holds the class bigrams.  Everything that grows with the corpus
stays distributed.

Smoothing: transitions (n + 0.5) / (n of the class before + 0.5 classes);
emissions (c + 0.5) / (class total + 0.5 (class words + 1)), the 1 for
words never seen, of which only ending classes have any.

Words are equal when their 64-bit hashes are.

Defined results: null text counts as empty and has the end alone; a null
doc_id has crc32 of the empty text (0), so it trains; without training
documents every count is 0; repeated rows count, and are scored, each.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.blocks import block_of, cuts, is_in, n_parts
from daycast.llm.common import FOLDED_VALUES, U, Words, checkpoint_dir, documents, fold_of, id_text, mix, saved, shuffles_removed, text_slices, words

TOP, CLASSES, ENDINGS, PASSES = 1024, 48, 64, 8
BLOCK = 1024
ALPHA = 0.5
UNITS = TOP + ENDINGS + 1
TOTAL = CLASSES + ENDINGS + 1
#: Words whose neighbour classes are added up at once.
CHUNK = 8192
UNSEEN = 255
END = UNITS - 1


def _words(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray]:
    """Case-folded words of a slice, and the ending class (0..ENDINGS-1) of each."""
    w = words(data, off, FOLDED_VALUES)
    last = FOLDED_VALUES[data[w.end - 1]]
    before = np.where(w.end - w.start > 1, FOLDED_VALUES[data[np.maximum(w.end - 2, 0)]], U(0))
    return w, (mix(last * U(3) + before) % U(ENDINGS)).astype(np.uint8)


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, sorted, and the place of each hash among them; only the distinct ones are sorted."""
    found = pa.array(hashes).dictionary_encode()
    h, at = found.dictionary.to_numpy(), found.indices.to_numpy()
    order = np.argsort(h)
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))
    return h[order], place[at]


def _encode(table: pa.Table) -> pa.Table:
    """One row for a block: its texts as places in its sorted distinct words, their training counts and endings."""
    train = table.column("train").to_numpy()
    hashes, endings, sizes = [np.zeros(0, U)], [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for _, _, data, off in text_slices(table.column("text")):
        w, e = _words(data, off)
        hashes.append(w.hash)
        endings.append(e)
        sizes.append(np.diff(w.doc))
    sizes = np.concatenate(sizes)
    h, places = _distinct(np.concatenate(hashes))
    n = np.bincount(places, np.repeat(train.astype(float), sizes), len(h))
    ending = np.zeros(len(h), np.uint8)
    ending[places] = np.concatenate(endings)        # of a word always the same
    cols = [train.astype(np.uint8), sizes, h, n.astype(np.uint32), ending, places.astype(np.uint32)]
    return pa.Table.from_arrays([table.column("block").slice(0, 1), pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                                 *(pa.array([_packed(c)], pa.binary()) for c in cols)], ["block", "doc_ids", *ENCODED])


#: Columns of an encoded block: by document: training or not, number of words; by distinct word: hash, count, ending; the texts.
ENCODED = {"train": np.bool_, "sizes": np.int64, "words": U, "counts": np.uint32, "endings": np.uint8, "places": np.uint32}


def _packed(x: np.ndarray) -> bytes:
    """Compressed values behind their number of bytes: every pass reads the blocks and shuffles their messages again."""
    return x.nbytes.to_bytes(8, "little") + pa.compress(x.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd"), kind)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return _unpacked(table.column(name)[0].as_py(), ENCODED[name])


def _send(table: pa.Table, parts: int) -> pa.Table:
    h, n, e = (_column(table, x) for x in ("words", "counts", "endings"))
    at = cuts(h, parts)
    full = np.flatnonzero(np.diff(at))
    pack = lambda x: pa.array([x[at[k]:at[k + 1]].tobytes() for k in full], pa.binary())
    return pa.Table.from_arrays([pa.array(full, pa.int32()), pa.array(np.full(len(full), table.column("block")[0].as_py()), pa.int64()),
                                 pack(h), pack(n), pack(e)], ["part", "block", "words", "counts", "endings"])


def _count_part(table: pa.Table) -> pa.Table:
    """Corpus counts back to every block, and the part's own word statistics.

    kind 0: block and counts in the order sent; kind 1: word and vocabulary
    totals by ending; kind 2: the part's most frequent words.
    """
    raw = [np.frombuffer(x.as_buffer(), U) for x in table.column("words")]
    n = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("counts")])
    e = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("endings")])
    h, inverse = _distinct(np.concatenate(raw))
    ending = np.zeros(len(h), np.uint8)
    ending[inverse] = e
    total = np.bincount(inverse, n, len(h)).astype(np.int64)
    back, ends = total[inverse], np.cumsum([0, *map(len, raw)])
    kinds, blocks, blobs = [], [], []
    for k, b in enumerate(table.column("block").to_pylist()):
        kinds.append(0)
        blocks.append(b)
        blobs.append(back[ends[k]:ends[k + 1]].tobytes())
    seen = total > 0
    sums = np.stack([np.bincount(ending, total, ENDINGS), np.bincount(ending[seen], minlength=ENDINGS)]).astype(np.int64)
    best = np.lexsort((h, -total))[:TOP]
    best = best[total[best] > 0]
    top = np.stack([h[best].view(np.int64), total[best], ending[best].astype(np.int64)], axis=1)
    part = table.column("part")[0].as_py()
    return pa.Table.from_arrays(
        [pa.array([part] * (len(kinds) + 2), pa.int32()), pa.array([*kinds, 1, 2], pa.int32()), pa.array([*blocks, 0, 0], pa.int64()),
         pa.array([*blobs, sums.tobytes(), top.tobytes()], pa.binary())], ["part", "kind", "block", "blob"])


def _units(w: Words, endings: np.ndarray, top: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The unit of each word: its place among the top words, or TOP + its ending."""
    unit = TOP + endings.astype(np.int64)
    if len(top):
        at = np.flatnonzero(is_in(w.hash, top))
        unit[at] = order[np.searchsorted(top, w.hash[at])]
    return unit


def _with_ends(values: np.ndarray, doc: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The words' values with `end` behind each text's, and each text's first place."""
    return np.insert(values, doc[1:], end), doc + np.arange(len(doc))


def _before(values: np.ndarray, first: np.ndarray, end) -> np.ndarray:
    """The value before each place; before a text's first one it is the end's."""
    out = np.roll(values, 1)
    out[first[:-1]] = end
    return out


def exchange(table: np.ndarray, n_top: int, passes: int = PASSES) -> np.ndarray:
    """Classes of all units: exchange clustering of the first `n_top` from their bigram counts.

    Classes: 0..CLASSES-1 for top words, then the endings, then the end.
    """
    total = CLASSES + ENDINGS + 1
    of = np.concatenate([np.arange(TOP) % CLASSES, CLASSES + np.arange(ENDINGS + 1)])
    table = table.astype(np.float64)
    member = np.zeros((UNITS, total))
    member[np.arange(UNITS), of] = 1
    after, before = table @ member, (member.T @ table).T     # unit x class: what follows, what comes before
    pairs = member.T @ after
    xlogx = lambda x: x * np.log(np.maximum(x, 1e-300))
    out_of, into = table.sum(1), table.sum(0)
    for _ in range(passes):
        moved = 0
        for u in range(n_top):
            a, own = of[u], table[u, u]
            # Take u out of its class.
            right, left = after[u].copy(), before[u].copy()
            right[a] -= own
            left[a] -= own
            pairs[a] -= right
            pairs[:, a] -= left
            pairs[a, a] -= own
            rows, cols = pairs.sum(1), pairs.sum(0)
            # Likelihood gained by adding u to each class.
            base, c = pairs[:CLASSES], np.arange(CLASSES)
            gain = (xlogx(base + right) - xlogx(base)).sum(1) + (xlogx(pairs[:, :CLASSES].T + left) - xlogx(pairs[:, :CLASSES].T)).sum(1)
            d = pairs[c, c]
            gain += xlogx(d + right[c] + left[c] + own) - xlogx(d + right[c]) - xlogx(d + left[c]) + xlogx(d)
            gain -= xlogx(rows[c] + out_of[u]) - xlogx(rows[c]) + xlogx(cols[c] + into[u]) - xlogx(cols[c])
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            pairs[b] += right
            pairs[:, b] += left
            pairs[b, b] += own
            if b != a:
                of[u] = b
                after[:, a] -= table[:, u]
                after[:, b] += table[:, u]
                before[:, a] -= table[u]
                before[:, b] += table[u]
                moved += 1
        if not moved:
            break
    return of


class Start:
    """Classes to start from: those of the top words, and of all others by their endings."""

    def __init__(self, top: np.ndarray, classes: np.ndarray):
        """top: (hash, count, ending) by rank; classes: of all units."""
        self.hashes, self.order = np.sort(top[:, 0].view(U)), np.argsort(top[:, 0].view(U))
        self.classes = classes

    def of(self, block: pa.Table) -> np.ndarray:
        words = Words(_column(block, "words"), *[np.zeros(0, np.int64)] * 3)
        return self.classes[_units(words, _column(block, "endings"), self.hashes, self.order)]


def _answered(block: pa.Table, answers: pa.Table, kind) -> np.ndarray:
    """What the parts answered for each distinct word of a block; the answers are in the order in which the words were sent: sorted."""
    answers = answers.sort_by("part")
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in answers.column("blob"))])


def _classes(block: pa.Table, answers: pa.Table) -> np.ndarray:
    """The class of each distinct word of a block: answered, or by its ending if no training text has it."""
    own = _answered(block, answers, np.uint8).astype(np.int64)
    return np.where(own == UNSEEN, CLASSES + _column(block, "endings").astype(np.int64), own)


def _training(block: pa.Table, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place (-1: the end) and class of each token of the training texts, and the class before it."""
    train, sizes, places = (_column(block, x) for x in ("train", "sizes", "places"))
    places, sizes = places[np.repeat(train, sizes)].astype(np.int64), sizes[train]
    doc = np.concatenate([[0], np.cumsum(sizes)])
    own, first = _with_ends(classes[places], doc, TOTAL - 1)
    return _with_ends(places, doc, -1)[0], own, _before(own, first, TOTAL - 1)


def _pairs_of(block: pa.Table, classes: np.ndarray) -> pa.Table:
    """Class bigrams of a block's training texts, by row."""
    _, own, before = _training(block, classes)
    pairs = np.bincount(before * TOTAL + own, minlength=TOTAL * TOTAL).reshape(TOTAL, TOTAL)
    some = np.flatnonzero(pairs.any(axis=1))
    return pa.Table.from_arrays([pa.array(some, pa.int32()), pa.array([pairs[c].astype(np.int64).tobytes() for c in some], pa.binary())], ["unit", "counts"])


def _send_neighbours(block: pa.Table, classes: np.ndarray, parts: int) -> pa.Table:
    """Every distinct word of a block with the classes behind it (0..TOTAL-1) and before it (TOTAL..) in training texts."""
    place, own, before = _training(block, classes)
    some = place >= 0
    behind = np.append(own[1:], 0)      # the last token is an end
    keys, n = np.unique(np.concatenate([place[some] * 2 * TOTAL + behind[some], place[some] * 2 * TOTAL + TOTAL + before[some]]), return_counts=True)
    h = _column(block, "words")
    sizes = np.bincount(keys // (2 * TOTAL), minlength=len(h))
    at = cuts(h, parts)
    ends = np.concatenate([[0], np.cumsum(sizes)])[at]
    full = np.flatnonzero(np.diff(at))
    pack = lambda x, to: pa.array([_packed(x[to[k]:to[k + 1]]) for k in full], pa.binary())
    return pa.Table.from_arrays(
        [pa.array(full, pa.int32()), pa.array(np.full(len(full), block.column("block")[0].as_py()), pa.int64()),
         pa.array([h[at[k]:at[k + 1]].tobytes() for k in full], pa.binary()),
         pack(sizes.astype(np.uint32), at), pack((keys % (2 * TOTAL)).astype(np.uint8), ends), pack(n.astype(np.uint32), ends)],
        ["part", "block", "words", "sizes", "classes", "counts"])


def gains(pairs: np.ndarray) -> np.ndarray:
    """Log likelihood of each neighbour class (behind, then before) under each of the CLASSES."""
    log = lambda x, total: np.log((x + ALPHA) / (total + ALPHA * TOTAL))
    return np.concatenate([log(pairs, pairs.sum(1, keepdims=True))[:CLASSES].T, log(pairs, pairs.sum(0, keepdims=True))[:, :CLASSES]])


def _move_part(table: pa.Table, gain: np.ndarray) -> pa.Table:
    """kind 0: the new class of each word sent (UNSEEN without training texts); kind 1: words by class."""
    column = lambda name, kind: [_unpacked(x.as_py(), kind) for x in table.column(name)]
    raw = [np.frombuffer(x.as_buffer(), U) for x in table.column("words")]
    h, inverse = _distinct(np.concatenate(raw))
    word = np.repeat(inverse, np.concatenate(column("sizes", np.uint32)))
    near, n = np.concatenate(column("classes", np.uint8)), np.concatenate(column("counts", np.uint32))
    new = np.full(len(h), UNSEEN, np.uint8)
    chunk = word // CHUNK
    if len(h) > CHUNK:
        # Dealt by chunk, not put in order: counts are added up in any order. 16 bits have a faster sort.
        order = np.argsort(chunk.astype(np.uint16) if len(h) <= CHUNK << 16 else chunk, kind="stable")
        word, near, n, chunk = word[order], near[order], n[order], chunk[order]
    for lo in range(0, len(h), CHUNK):
        hi = min(len(h), lo + CHUNK)
        a, b = np.searchsorted(chunk, [lo // CHUNK, lo // CHUNK + 1])
        near_counts = np.bincount((word[a:b] - lo) * 2 * TOTAL + near[a:b], n[a:b], (hi - lo) * 2 * TOTAL).reshape(hi - lo, 2 * TOTAL)
        new[lo:hi] = np.where(near_counts.any(axis=1), (near_counts @ gain).argmax(axis=1), UNSEEN)
    back, ends = new[inverse], np.cumsum([0, *map(len, raw)])
    blobs = [back[ends[k]:ends[k + 1]].tobytes() for k in range(len(raw))]
    sizes = np.bincount(new[new != UNSEEN], minlength=CLASSES).astype(np.int64)
    part = table.column("part")[0].as_py()
    return pa.Table.from_arrays(
        [pa.array([part] * (len(blobs) + 1), pa.int32()), pa.array([*[0] * len(blobs), 1], pa.int32()),
         pa.array([*table.column("block").to_pylist(), 0], pa.int64()), pa.array([*blobs, sizes.tobytes()], pa.binary())], ["part", "kind", "block", "blob"])


def likelihood(pairs: np.ndarray) -> float:
    """Training likelihood of the class bigram model, but for a term that the classes don't change."""
    xlogx = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return float(xlogx(pairs.astype(float)) - xlogx(pairs.sum(1).astype(float)) - xlogx(pairs.sum(0).astype(float)))


class BrownModel:
    """Bounded tables: log10 transitions, class totals and word numbers."""

    def __init__(self, pairs: np.ndarray, sizes: np.ndarray, endings: np.ndarray, ends: int):
        """pairs: class bigrams; sizes: words of each of the CLASSES; endings: totals and distinct words by ending, of all words."""
        self.transition = np.log10((pairs + ALPHA) / (pairs.sum(1, keepdims=True) + ALPHA * TOTAL))
        self.train_tokens = int(endings[0].sum()) + ends
        self.vocabulary = int(endings[1].sum()) + (ends > 0)
        self.ends = ends
        # No training word is in an ending class, which has the words never seen.
        size = np.concatenate([sizes, np.ones(ENDINGS), [0]])
        self.emission_total = np.log10(np.maximum(pairs.sum(0) + ALPHA * size, ALPHA))
        self.base_total = np.log10(self.train_tokens + ALPHA * (self.vocabulary + 1))

    def score(self, sizes: np.ndarray, classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """n_tokens, n_known, base score and score of each text, given its number of words; classes, corpus counts: of each word."""
        doc = np.concatenate([[0], np.cumsum(sizes)])
        classes, first = _with_ends(classes, doc, TOTAL - 1)
        counts, _ = _with_ends(counts, doc, self.ends)
        smoothed = np.log10(counts + ALPHA)
        model = smoothed - self.emission_total[classes]
        model[first[1:] - 1] = 0.0      # the end is the one word of its class
        model += self.transition[_before(classes, first, TOTAL - 1), classes]
        at = first[:-1]
        return (np.diff(first), np.add.reduceat((counts > 0).astype(np.int64), at),
                np.add.reduceat(smoothed - self.base_total, at), np.add.reduceat(model, at))


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of tables of `size` x `size` counts sent by row."""

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts")], axis=0)
        return pa.Table.from_arrays([table.column("unit").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["unit", "counts"])

    table = np.zeros((size, size), np.int64)
    # At most `size` rows of `size` counts.
    for r in rows.groupBy("unit").applyInArrow(add, "unit int, counts binary").collect():
        table[r["unit"]] = np.frombuffer(r["counts"], np.int64)
    return table


def _bigrams(encoded: DataFrame, top: np.ndarray) -> tuple[np.ndarray, int]:
    """Bigram counts of units over all training texts, and the number of texts; one table a task."""
    shared = encoded.sparkSession.sparkContext.broadcast((np.sort(top), np.argsort(top)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, order = shared.value
        table, rows = np.zeros(UNITS * UNITS, np.int64), 0
        for b in batches:
            for k in range(b.num_rows):
                rows += 1
                block = pa.Table.from_batches([b.slice(k, 1)])
                train, sizes = _column(block, "train"), _column(block, "sizes")
                words = Words(_column(block, "words"), *[np.zeros(0, np.int64)] * 3)
                unit = _units(words, _column(block, "endings"), hashes, order)[_column(block, "places")[np.repeat(train, sizes)]]
                unit, first = _with_ends(unit, np.concatenate([[0], np.cumsum(sizes[train])]), END)
                table += np.bincount(_before(unit, first, END) * UNITS + unit, minlength=UNITS * UNITS)
        if rows:
            table = table.reshape(UNITS, UNITS)
            some = np.flatnonzero(table.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([table[u].tobytes() for u in some], pa.binary())],
                                             ["unit", "counts"])

    table = _added(encoded.mapInArrow(run, "unit int, counts binary"), UNITS)
    return table, int(table[:, END].sum())


def _each_block(encoded: DataFrame, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """`run` on every block where it lies: a block is one row, which no shuffle has to bring together."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                yield from run(pa.Table.from_batches([b.slice(k, 1)])).to_batches()

    return encoded.mapInArrow(rows, schema)


def _in_buckets(blocks: DataFrame, n: int) -> DataFrame:
    """The blocks, written once to the shared checkpoint folder in `n` buckets by block: what is joined with them by block
    comes to them, and they are not shuffled.

    The table is only a name to read the buckets by, and goes from the catalog; its files stay.
    """
    spark = blocks.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    (blocks.write.format("parquet").bucketBy(n, "block").option("path", f"{checkpoint_dir(spark)}/{name}")
     .option("compression", "none").saveAsTable(name))
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def _clustered(encoded: DataFrame, start: Start, parts: int) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Classes of all training words (as answers to the blocks), class bigrams, and the words of each class."""
    spark = encoded.sparkSession
    by_block, first = encoded.groupBy("block"), spark.sparkContext.broadcast(start)

    def swept(run, schema: str, answers: DataFrame | None) -> DataFrame:
        if answers is None:
            return _each_block(encoded, lambda block: run(block, first.value.of(block)), schema)
        return by_block.cogroup(answers.groupBy("block")).applyInArrow(lambda block, own: run(block, _classes(block, own)), schema)

    message = "part int, block long, words binary, sizes binary, classes binary, counts binary"
    class_pairs = lambda answers: _added(swept(_pairs_of, "unit int, counts binary", answers), TOTAL)
    best, sizes, pairs = None, np.zeros(CLASSES), class_pairs(None)
    for _ in range(PASSES):
        gain = spark.sparkContext.broadcast(gains(pairs))
        moved = saved(swept(lambda block, classes: _send_neighbours(block, classes, parts), message, best)
                      .groupBy("part").applyInArrow(lambda t: _move_part(t, gain.value), "part int, kind int, block long, blob binary"))
        answers = moved.where("kind = 0").select("part", "block", "blob")
        new = class_pairs(answers)
        if best is not None and likelihood(new) <= likelihood(pairs):
            break
        # One bounded row a part.
        sizes = sum((np.frombuffer(r["blob"], np.int64) for r in moved.where("kind = 1").select("blob").collect()), np.zeros(CLASSES))
        best, pairs = answers, new
    return best, pairs, sizes


def class_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: int = 1) -> DataFrame:
    """Train outside fold `held_out` of 5 and score every whole text.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    docs = id_text(docs, id_col, text_col).withColumn("train", fold_of(F.col("doc_id")) != held_out)
    parts = n_parts(docs.sparkSession)
    spread = F.coalesce(block_of(F.col("doc_id"), BLOCK), -1 - F.pmod(F.xxhash64("text"), F.lit(4096)))
    with shuffles_removed(docs.sparkSession):
        encoded = _in_buckets(docs.withColumn("block", spread).groupBy("block").applyInArrow(
            _encode, "block long, doc_ids array<long>, " + ", ".join(f"{c} binary" for c in ENCODED)), parts)
        counted = saved(_each_block(encoded, lambda t: _send(t, parts), "part int, block long, words binary, counts binary, endings binary")
                        .groupBy("part").applyInArrow(_count_part, "part int, kind int, block long, blob binary"))

        endings = np.zeros((2, ENDINGS), np.int64)
        top = np.zeros((0, 3), np.int64)
        for r in counted.where("kind > 0").select("kind", "blob").collect():     # two bounded rows a part
            if r["kind"] == 1:
                endings += np.frombuffer(r["blob"], np.int64).reshape(2, ENDINGS)
            else:
                top = np.concatenate([top, np.frombuffer(r["blob"], np.int64).reshape(-1, 3)])
                top = top[np.lexsort((top[:, 0], -top[:, 1]))[:TOP]]
        table, ends = _bigrams(encoded, top[:, 0].view(U))
        answers, pairs, sizes = _clustered(encoded, Start(top, exchange(table, len(top))), parts)
    by_block = encoded.groupBy("block")
    model = docs.sparkSession.sparkContext.broadcast(BrownModel(pairs, sizes, endings, ends))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        m, places, train = model.value, _column(block, "places"), _column(block, "train")
        of_kind = lambda k: answers.filter(pc.equal(answers.column("kind"), k))
        counts, classes = _answered(block, of_kind(0), np.int64), _classes(block, of_kind(1))
        n, known, base, model_score = m.score(_column(block, "sizes"), classes[places], counts[places])
        return pa.Table.from_arrays(
            [pa.array(block.column("doc_ids")[0].as_py(), pa.int64()), pa.array(~train), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
             pa.array(np.full(len(n), m.train_tokens), pa.int64()), pa.array(base), pa.array(model_score)], names)

    both = (counted.where("kind = 0").select("part", "kind", "block", "blob")
            .unionByName(answers.select("part", F.lit(1).alias("kind"), "block", "blob")))
    return by_block.cogroup(both.groupBy("block")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op6_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_scores(documents(spark, sf_dir))
