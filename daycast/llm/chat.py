r"""13. Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, as one text in which control strings
stand around each turn.  It is encoded once, with the place of every token
in the text; the turns to be learnt and the tokens are two sorted lists of
spans, and a binary search gives the tokens of each turn.  The control
strings are added tokens of the tokenizer, so no token reaches over the end
of a turn and the mask holds each learnt text exactly.

Control strings within a text or a role are escaped: the escape character
is doubled, and one is put after the first character of each control
string.  No control string has its first character anywhere else within
it, so an escaped text never holds one, alone or with the marker behind
it.  Removing the escapes gives the text back.

`read_back` takes roles and texts from the rendered text, and the learnt
texts from the masked ids alone, decoded.

How it scales: one shuffle by conversation.  The unit is a conversation,
which the method renders and encodes whole: its turns are one row, so a
task needs memory for one conversation (its turns' order is settled in
the row).  Conversations are independent of each other.  The vocabulary
file's size is checked before it is broadcast.

Defined results: a null text is empty, a null role the empty role; an
empty text has no token under the mask; rows of equal turn stand in order
of role, then text (nulls first), and a repeated row is a turn of its own;
a null turn comes first; rows with null conv_id are one conversation; texts
and conversations of any length are taken whole; an empty table gives no
rows; other columns are never read.
"""

from __future__ import annotations

import dataclasses
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from daycast.llm.bpe import share
from daycast.llm.common import ship

ESCAPE = "\\"


@dataclasses.dataclass(frozen=True)
class Template:
    """Control strings: for each known role what stands before and after its text; other roles are named in the text."""

    turns: tuple[tuple[str, str, str], ...] = (
        ("system", "[SYS]", "[/SYS]"), ("user", "[INST]", "[/INST]"), ("assistant", "<s>", "</s>"))
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "[/TURN]")
    learnt: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if len(set(self.controls)) < len(self.controls):
            raise ValueError("control strings must differ")
        firsts = {c[:1] for c in self.controls}
        if any(ESCAPE in c or len(c) < 2 or firsts & set(c[1:]) for c in self.controls):
            raise ValueError("a control string's first character may stand in no control string again, and no escape in any")

    @property
    def controls(self) -> tuple[str, ...]:
        return tuple(c for turn in self.turns for c in turn[1:]) + self.other


class Renderer:
    """Renders, encodes and reads conversations by one template and tokenizer."""

    def __init__(self, template: Template, tokenizer_json: str):
        self.template = template
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        own = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.add_special_tokens([AddedToken(c, special=True, normalized=False) for c in template.controls])
        reserved = "|".join(re.escape(c) for c in sorted({*template.controls, *own}, key=len, reverse=True))
        self.reserved = re.compile(f"(?={reserved})")
        self.around = {role: (head, tail) for role, head, tail in template.turns}
        by_head = "|".join(re.escape(head) for head in (*(h for _, h, _ in template.turns), template.other[0]))
        self.head = re.compile(by_head)
        self.named = {head: (role, tail) for role, head, tail in template.turns}

    def escape(self, text: str) -> str:
        text = text.replace(ESCAPE, ESCAPE * 2)
        at = [m.start() + 1 for m in self.reserved.finditer(text)]
        if not at:
            return text
        return ESCAPE.join(text[a:b] for a, b in zip([0, *at], [*at, len(text)]))

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if ESCAPE in text else text

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
        """The conversation's text, and the spans of its learnt texts in order."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            if role in self.around:
                head, tail = self.around[role]
            else:
                head, tail = self.template.other[0] + self.escape(role) + self.template.other[1], self.template.other[2]
            body = self.escape(text)
            start = at + len(head)
            at = start + len(body) + len(tail)
            if role in self.template.learnt:
                spans.append((start, start + len(body)))
            parts += [head, body, tail]
        return "".join(parts), spans

    def encode(self, texts: list[str], spans: list[list[tuple[int, int]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, mask) of each rendered text: a token is under the mask if it meets a learnt span."""
        for encoding, learnt in zip(self.tokenizer.encode_batch(texts, add_special_tokens=False), spans):
            place = np.array(encoding.offsets, np.int64).reshape(-1, 2)
            span = np.array(learnt, np.int64).reshape(-1, 2)
            first = np.searchsorted(place[:, 1], span[:, 0], "right")       # ends beyond the span's start
            last = np.searchsorted(place[:, 0], span[:, 1], "left")         # starts before its end
            edge = np.zeros(len(place) + 1, np.int64)
            full = span[:, 0] < span[:, 1]
            np.add.at(edge, first[full], 1)
            np.add.at(edge, last[full], -1)
            yield np.array(encoding.ids, np.int32), np.cumsum(edge[:-1]) > 0

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """The (role, text) turns of a rendered text."""
        turns, at = [], 0
        while at < len(formatted):
            head = self.head.match(formatted, at)
            if not head:
                raise ValueError(f"no turn at {at}")
            at = head.end()
            if head[0] in self.named:
                role, tail = self.named[head[0]]
            else:
                end = formatted.index(self.template.other[1], at)
                role, tail = self.unescape(formatted[at:end]), self.template.other[2]
                at = end + len(self.template.other[1])
            end = formatted.index(tail, at)
            turns.append((role, self.unescape(formatted[at:end])))
            at = end + len(tail)
        return turns

    def learnt_texts(self, ids: np.ndarray, mask: np.ndarray) -> list[str]:
        """The texts under the mask, each decoded from its ids alone."""
        edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
        return [self.unescape(self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False))
                for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


_renderers: dict = {}


def _renderer(template: Template, shared) -> Renderer:
    """One per Python worker, template and broadcast vocabulary."""
    # Tasks already fill the cores, and the library's threads don't survive a worker's fork.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = template, shared.value[0]
    if key not in _renderers:
        _renderers.clear()
        _renderers[key] = Renderer(template, shared.value[1])
    return _renderers[key]


#: Characters that are encoded in one call.
ENCODED = 1 << 20
FORMATTED = "conv_id long, formatted string, ids array<int>, loss array<boolean>"


def whole_conversations(rows: DataFrame) -> DataFrame:
    """conv_id and turns: an array of (turn, role, text) in order."""
    turn = F.struct(*(F.col(c).cast(kind).alias(c) for c, kind in (("turn", "long"), ("role", "string"), ("text", "string"))))
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.struct(
                F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text"))).alias("turns")))


def _batches(rows: list[tuple], size) -> Iterator[list[tuple]]:
    """Consecutive rows of about ENCODED characters."""
    part, n = [], 0
    for row in rows:
        part.append(row)
        n += size(row)
        if n >= ENCODED:
            yield part
            part, n = [], 0
    if part:
        yield part


def _list(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values), kind))


def format_conversations(rows: DataFrame, template: Template = Template(), tokenizer: str | None = None) -> DataFrame:
    """conv_id, formatted (the text), ids, and loss (one boolean a token) of each conversation of (conv_id, turn, role, text)."""
    shared = share(rows.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer = _renderer(template, shared)
        for b in batches:
            told = ((i.as_py(), *renderer.render([(t["role"], t["text"]) for t in turns.as_py()]))
                    for i, turns in zip(b.column(0), b.column(1)))
            for part in _batches(told, lambda row: len(row[1])):
                conv, texts, spans = (list(x) for x in zip(*part))
                ids, loss = (list(x) for x in zip(*renderer.encode(texts, spans)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(conv, pa.int64()), pa.array(texts, pa.string()), _list(ids, pa.int32()), _list(loss, pa.bool_())],
                    ["conv_id", "formatted", "ids", "loss"])

    return whole_conversations(rows).mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, template: Template = Template(), tokenizer: str | None = None) -> DataFrame:
    """conv_id, turns (role, text) parsed from the formatted text, learnt (texts decoded from the masked ids), formatted_chars."""
    shared = share(formatted.sparkSession, tokenizer)
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        renderer = _renderer(template, shared)
        for b in batches:
            for k in range(b.num_rows):
                text = b.column(1)[k].as_py()
                turns = [{"role": r, "text": t} for r, t in renderer.parse(text)]
                ids, loss = (b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in (2, 3))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[k:k + 1], pa.array([turns], pa.list_(turn)),
                     pa.array([renderer.learnt_texts(ids, loss)], pa.list_(pa.string())), pa.array([len(text)], pa.int64())],
                    ["conv_id", "turns", "learnt", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "ids", "loss").mapInArrow(
        run, "conv_id long, turns array<struct<role:string,text:string>>, learnt array<string>, formatted_chars long")


def digests(read: DataFrame) -> DataFrame:
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.withColumn("loss_text", F.concat_ws("", "learnt")).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


#: The query's further conversation: control strings in both turns.
HARD = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ship(spark).read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame(HARD, "conv_id long, turn long, role string, text string")
    return digests(read_back(format_conversations(rows.unionByName(hard))))


#: What must be escaped (no two can overlap), in the order of SQL's alternation.
_CONTROLS = r"\[/?SYS\]|\[/?INST\]|\[/?ROLE\]|\[/TURN\]|</?s>|<\|endoftext\|>"

ORACLE_SQL = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, role AS r, coalesce(text, '') AS text, text AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', 'user', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', 'assistant', '</s>[INST] ok [/INST]', '</s>[INST] ok [/INST]'),
sized AS (
    SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + len(regexp_extract_all(text, '{_CONTROLS}'))
           + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
             ELSE 20 + length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, '{_CONTROLS}')) END
           AS chars
    FROM rows),
whole AS (
    SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS told,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '') AS learnt
    FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM whole
"""
