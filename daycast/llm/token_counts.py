"""4. Token counts that follow edits.

Each document is a segment tree over chunks of pre-tokens; every node
holds the number of characters and of BPE tokens below it.  An edit
re-tokenises only the touched pre-tokens with the context the pattern can
see (two characters to the left, and to the right until the new boundaries
meet the old ones), re-encodes those, and updates the sums on the path to
the root.

Rows are independent, so the work is one map over the documents.

Defined results: null text counts as empty; a null or empty list of edits
leaves the counts; an edit's bounds are clipped to the text as it then is
and a null replacement is empty; null edits are skipped; special tokens
count as ordinary text; repeated rows each get their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.bpe import PRE_TOKEN, ByteBPE, model_of, pre_tokens, share
from daycast.llm.common import documents

CHUNK = 64
EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"


class TokenTree:
    """Pre-tokens of one text in chunks, with subtree sums of characters and tokens."""

    def __init__(self, text: str, model: ByteBPE):
        self.model = model
        pieces = pre_tokens(text)
        self.encoded = len(pieces)
        self.chunks = [pieces[i:i + CHUNK] for i in range(0, len(pieces), CHUNK)] or [[]]
        self.size = 1 << (len(self.chunks) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, chunk in enumerate(self.chunks):
            self._measure(i, chunk)
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _measure(self, i: int, chunk: list[str]) -> None:
        self.chars[self.size + i] = sum(map(len, chunk))
        self.tokens[self.size + i] = sum(map(len, map(self.model.pre_tokens.__getitem__, chunk))) // 4

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _chunk_at(self, char: int) -> tuple[int, int]:
        """The chunk that holds a character, and the position where the chunk begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            if char >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace the characters start..stop by `text`."""
        start = min(max(start, 0), self.n_chars)
        stop = min(max(stop, start), self.n_chars)
        first, begin = self._chunk_at(max(start - 2, 0))
        chunk, at = self.chunks[first], 0
        while at < len(chunk) and begin + len(chunk[at]) <= start - 2:
            begin += len(chunk[at])
            at += 1
        last, pieces, end = first, chunk[at:], begin + sum(map(len, chunk[at:]))
        more = 4
        while True:
            while end < stop + more and last + 1 < len(self.chunks):
                last += 1
                pieces += self.chunks[last]
                end += self.chars[self.size + last]
            old = "".join(pieces)
            new = old[:start - begin] + text + old[stop - begin:]
            shift = len(new) - len(old)
            at_end = last + 1 == len(self.chunks)
            # Old boundaries behind the edit, as positions in `new`.
            bounds, p = {}, 0
            for i, piece in enumerate(pieces):
                if begin + p >= stop:
                    bounds[p + shift] = i
                p += len(piece)
            fresh, p, meet = [], 0, None
            for m in PRE_TOKEN.finditer(new):
                if p in bounds and p >= start - begin + len(text):
                    meet = bounds[p]
                    break
                if not at_end and m.end() + 2 > len(new):
                    break
                fresh.append(m.group())
                p = m.end()
            else:
                if p == len(new) and at_end:
                    meet = len(pieces)
            if meet is None and at_end and p == len(new):
                meet = len(pieces)
            if meet is not None:
                break
            more = 4 * max(more, end - stop)
        self.encoded += len(fresh)
        self._put(first, last, chunk[:at] + fresh + pieces[meet:])

    def _put(self, first: int, last: int, pieces: list[str]) -> None:
        """Chunks first..last now hold `pieces`; their number stays, so the tree's shape does."""
        each = -(-max(len(pieces), 1) // (last - first + 1))
        for k, i in enumerate(range(first, last + 1)):
            self.chunks[i] = pieces[k * each:(k + 1) * each]
            self._measure(i, self.chunks[i])
        lo, hi = (self.size + first) // 2, (self.size + last) // 2
        while lo:
            for node in range(lo, hi + 1):
                self._sum(node)
            lo, hi = lo // 2, hi // 2

    def text(self) -> str:
        return "".join(p for chunk in self.chunks for p in chunk)


def token_counts(docs: DataFrame, edits: Column | None = None, tokenizer: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text before and after its edits (an array of start, stop, text in order).

    Returns doc_id, n_chars, n_tokens, n_pre_tokens, edited_chars,
    edited_tokens and n_reencoded, the pre-tokens the edits touched.
    """
    shared = share(docs.sparkSession, tokenizer)
    edits = (F.lit(None) if edits is None else edits).cast(EDITS)
    names = ["doc_id", "n_chars", "n_tokens", "n_pre_tokens", "edited_chars", "edited_tokens", "n_reencoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shared)
        for b in batches:
            rows = []
            for text, changes in zip(b.column(1), b.column(2)):
                tree = TokenTree(text.as_py() or "", model)
                row = [tree.n_chars, tree.n_tokens, tree.encoded]
                for e in changes.as_py() or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["stop"] if e["stop"] is not None else e["start"] or 0, e["text"] or "")
                rows.append([*row, tree.n_chars, tree.n_tokens, tree.encoded - row[2]])
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)], names)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        edits.alias("edits"))
            .mapInArrow(run, ", ".join(f"{n} long" for n in names)))


def sample_edits(text: Column) -> Column:
    """Three edits of each text: an insertion at a quarter, a deletion in the middle, a new end."""
    n = F.coalesce(F.length(text), F.lit(0)).cast("long")
    quarter, half = F.floor(n / 4), F.floor(n / 2)
    edit = lambda a, b, t: F.struct(a.cast("long").alias("start"), b.cast("long").alias("stop"), F.lit(t).alias("text"))
    return F.array(edit(quarter, quarter, " (edited) "), edit(half, half + 7, ""), edit(n - 2, n + 100, "... the end."))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), sample_edits(F.col("text")))
