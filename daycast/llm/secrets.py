"""8. Secret scans.

An Aho-Corasick automaton finds the keywords in the ASCII-lowered text;
a regular expression anchored at each hit reads the candidate, in text
order, so that matches of a kind never overlap and a match that is too
short still uses up its characters.  Kinds whose tokens carry a checksum
(`github`, `npm`: CRC-32 in base 62) or a structure that can be decoded
(`jwt`) are kept only when it holds.  `hex` has no keyword: its runs are
read directly, and only in texts that hold one of 16 characters.

Rows are independent, so the work is one map over the documents.

Defined results: null text counts as empty (no spans, the digest of "");
positions are code points, ends exclusive; repeated rows each get theirs.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import documents, id_text

# The kinds in their order, their keywords, patterns and least lengths.
KINDS = ["assign", "access", "hex", "github", "npm", "jwt"]
BASE = 3
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign",
    "api_key": "assign", "apikey": "assign", "akia": "access",
    "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
    "npm_": "npm", "eyj": "jwt",
}
ANCHORED = {
    "assign": re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"),
    "jwt": re.compile(r"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)"),
}
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LOWER = {c: c + 32 for c in range(65, 91)}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


def base62_crc(body: str) -> str:
    """The six base-62 digits of the CRC-32 that ends such a token."""
    n, out = zlib.crc32(body.encode()), ""
    while n:
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.rjust(6, "0")


def holds(kind: str, m: re.Match) -> bool:
    """Whether a match is long enough, or its embedded checksum or structure is right."""
    if kind == "assign":
        return len(m[2]) >= MIN_ASSIGN
    if kind == "access":
        return m.end() - m.start() >= MIN_ACCESS
    if kind in ("github", "npm"):
        return base62_crc(m[1][:30]) == m[1][30:]
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + "=" * (-len(m[1]) % 4)))
    except ValueError:
        return False
    return isinstance(head, dict) and "alg" in head


def scan(text: str, found: ahocorasick.Automaton, with_hex: bool) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span, in order."""
    spans, last = [], dict.fromkeys(KINDS, 0)
    lowered = text.lower() if text.isascii() else text.translate(LOWER)
    hits = sorted((end + 1 - size, kind) for end, (size, kind) in found.iter(lowered))
    for at, kind in hits:
        if at >= last[kind] and (m := ANCHORED[kind].match(text, at)):
            last[kind] = m.end()
            if holds(kind, m):
                spans.append((at, KINDS.index(kind), m.end()))
    if with_hex:
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans: array of (kind, start, end) in order of start, then kind."""
    schema = "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint>>"
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for b in batches:
            has_hex = pc.fill_null(pc.match_substring_regex(b.column(1), "[0-9a-f]{16}"), False)
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan(t.as_py() or "", found, h.as_py())]
                    for t, h in zip(b.column(1), has_hex)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, the digest of the base kinds and all spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return scanned.select(
        "doc_id", *map(count, KINDS[:BASE]),
        F.sha2(listed(F.filter("spans", lambda s: s.kind.isin(KINDS[:BASE]))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(secret_scan(documents(spark, sf_dir)))
