"""9. BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be merged
across, so such a pair is a certain cut.  Each pre-token is cut there, the
fragments are merged independently (lowest merge rank first) and the ids
concatenated.  Fragments and pre-tokens are cached per task in a bounded
table.  The vocabulary file is read on the driver and broadcast (its size
is that of the file, checked against `MAX_VOCABULARY_BYTES`).

Defined results: a null or empty text has no tokens and decodes to ""; a
null id is passed on; repeated rows each get their row; a pre-token of any
length is merged in O(n log n).  Special tokens in a text become their id,
as in the tokenizers library's default.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from daycast.llm.common import documents, id_text, ship

MAX_VOCABULARY_BYTES = 64 << 20
CACHE_ENTRIES = 400_000

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRE_TOKEN = regex.compile(PATTERN)
# The same for texts of ASCII alone, which the standard library reads faster; the common case is tried first.
ASCII_PRE_TOKEN = re.compile(r" ?[A-Za-z]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


def pre_tokens(text: str) -> list[str]:
    return (ASCII_PRE_TOKEN if text.isascii() else PRE_TOKEN).findall(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bounded(dict):
    """A cache that computes what is missing and starts afresh when full."""

    def __init__(self, compute, most: int = CACHE_ENTRIES):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class ByteBPE:
    def __init__(self, tokenizer_json: str):
        spec = json.loads(tokenizer_json)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for token, i in vocab.items():
            if token not in self.specials:
                self.token_bytes[i] = bytes(alphabet[c] for c in token)
        for token, i in self.specials.items():
            self.token_bytes[i] = token.encode()
        self.byte_ids = [0] * 256
        self.inner = np.zeros(1 << 16, bool)     # byte pairs that occur inside a token
        for i, token in enumerate(self.token_bytes):
            if i in self.specials.values():
                continue
            if len(token) == 1:
                self.byte_ids[token[0]] = i
            for a, b in zip(token, token[1:]):
                self.inner[a << 8 | b] = True
        self.inner_pairs = self.inner.tobytes()
        self.merges: dict[tuple[int, int], int] = {}    # rank of a pair of ids
        self.merged: list[int] = []                     # id that the merge of a rank makes
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[a], vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.fragments = Bounded(self._merge)
        self.pre_tokens = Bounded(self._encode_pre_token)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None

    def cut(self, piece: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        inner, out, last = self.inner_pairs, [], 0
        for i in range(1, len(piece)):
            if not inner[piece[i - 1] << 8 | piece[i]]:
                out.append(piece[last:i])
                last = i
        out.append(piece[last:])
        return out

    def _merge(self, fragment: bytes) -> list[int]:
        """Merge by rank, the leftmost first among equal ranks."""
        ids = [self.byte_ids[b] for b in fragment]
        if len(ids) > 64:
            return self._merge_long(ids)
        rank, none = self.merges.get, len(self.merged)
        ranks = [rank(p, none) for p in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) != none:
            i = ranks.index(r)
            ids[i:i + 2] = [self.merged[r]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a linked list and a heap: O(n log n) for a fragment of any length."""
        n, rank = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], alive[j] = self.merged[r], False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := rank((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x, ok in zip(ids, alive) if ok]

    def _encode_pre_token(self, text: str) -> bytes:
        parts = self.cut(text.encode())
        # A pre-token of one fragment is kept as a pre-token alone.
        ids = self._merge(parts[0]) if len(parts) == 1 else [i for part in parts for i in self.fragments[part]]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_ordinary(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens are ordinary text."""
        return b"".join(map(self.pre_tokens.__getitem__, pre_tokens(text)))

    def encode(self, text: str) -> bytes:
        if self.special_cut is None or not any(s in text for s in self.specials):
            return self.encode_ordinary(text)
        out = []
        for part in self.special_cut.split(text):
            if part in self.specials:
                out.append(np.array([self.specials[part]], "<u4").tobytes())
            elif part:
                out.append(self.encode_ordinary(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, with what is no UTF-8 replaced."""
        raw = b"".join(map(self.token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode()


def tokenizer_file(path: str | None = None) -> str:
    """The tokenizer file's text; by default the public byte-level vocabulary of 50k tokens."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary file over {MAX_VOCABULARY_BYTES} bytes: {path}")
    return text


_models: dict[int, ByteBPE] = {}


def model_of(shared) -> ByteBPE:
    """One model per Python worker and broadcast vocabulary."""
    if shared.value[0] not in _models:
        _models.clear()
        _models[shared.value[0]] = ByteBPE(shared.value[1])
    return _models[shared.value[0]]


def share(spark: SparkSession, path: str | None = None):
    text = tokenizer_file(path)
    return ship(spark).sparkContext.broadcast((hashlib.sha256(text.encode()).hexdigest(), text))


def bpe_encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit), n_tokens of every whole text."""
    shared = share(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shared)
        for b in batches:
            ids = [model.encode(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                ["doc_id", "ids", "n_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary, n_tokens long")


def bpe_decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, text of rows that hold doc_id and ids (null ids: empty text)."""
    shared = share(encoded.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shared)
        for b in batches:
            texts = [model.decode(x.as_py() or b"").decode() for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = False, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encode, decode the ids, and return digests of both (and the ids): one pass."""
    shared = share(docs.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shared)
        for b in batches:
            n, ids_sha, text_sha, kept = [], [], [], []
            for t in b.column(1):
                ids = model.encode(t.as_py() or "")
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(model.decode(ids)).hexdigest())
                if with_ids:
                    kept.append(ids)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols, names = [*cols, pa.array(kept, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(documents(spark, sf_dir))
