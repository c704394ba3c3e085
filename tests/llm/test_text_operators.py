"""Spelling variants, periodic runs and chat formatting against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from daycast.llm import chat, runs, spelling

# Columns whose names the operators use inside.
SCHEMA = "doc_id long, text string, word string, n int, g int, half string, runs string, `left` string, block int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, "h", "r", "l", 0) for i, t in rows], SCHEMA)


# --- spelling variants

def plain_counts(rows, least=5, min_count=3):
    counts = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-z\u00C0-\u00FF]+", t or ""):
            w = w.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if n >= min_count and len(w) >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def plain_variants(words):
    out = set()
    form = {}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    for w, n in words.items():
        end = w
        while end in form:
            end = form[end]
        out.add((w, form.get(w), end, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def variant_rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return [tuple(r) for r in df.collect()]


def some_words(r, n, letters, sizes):
    base = ["".join(r.choice(letters) for _ in range(r.choice(sizes))) for _ in range(n)]
    for w in list(base):
        at = r.randrange(len(w))
        base.append(r.choice([w[:at] + w[at + 1:], w[:at] + r.choice(letters) + w[at:], w[:at] + r.choice(letters) + w[at + 1:]]))
    return {w: int(2 ** r.uniform(1, 8)) + 1 for w in base if len(w) >= 5}


def test_one_edit_in_every_place(spark):
    r = random.Random(2)
    words = some_words(r, 250, "abéÿ", [5, 6, 7]) | {"aaaaa": 40, "aaaaaa": 20, "aaaaaaa": 9, "baaaaa": 9} | some_words(r, 40, "xyzw", [40, 70, 140])
    got = variant_rows(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert len(got) == len(words) and set(got) == plain_variants(words)


def test_hot_half_is_dealt_over_block_pairs(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE", 16)
    r = random.Random(7)
    words = {f"prefix{''.join(r.choice('abc') for _ in range(r.choice([5, 6])))}": r.randint(3, 400) for _ in range(400)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    tiles = spelling._tiles(table, 5).collect()
    assert max(len(t["items"]) for t in tiles) < 60 and len({t["home"] for t in tiles}) > 1
    assert set(variant_rows(spelling.spelling_variants(table))) == plain_variants(words)


def test_code_points_beyond_the_query_s_alphabet_and_ties(spark):
    words = {"☃☃☃☃☃": 4, "☃☃☃☃\U0001f600": 9, "☃☃☃☃é": 9, "\U0001f600☃☃☃☃": 1}
    assert set(variant_rows(spelling.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long")))) == plain_variants(words)


def test_spelling_query_against_plain_python(spark, tmp_path):
    r = random.Random(4)
    vocabulary = list(some_words(r, 120, "abcdefÉé", [4, 5, 6, 9]))
    rows = [(k, " ".join(r.choice(vocabulary).title() + r.choice(["", ",", "7", "\n"]) for _ in range(r.randint(0, 300)))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, "1 2 3"), (5, rows[5][1]), (5, rows[5][1]), (None, rows[6][1]), (63, "x" * 300_000 + " tail")]
    rows += [(k, "y" * 4000) for k in (70, 71, 72)] + [(k, "y" * 4001) for k in range(73, 80)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = variant_rows(spelling.op11_spelling(spark, str(tmp_path)))
    expected = plain_variants(plain_counts(rows))
    assert len(got) == len(expected) and set(got) == expected and any(row[1] for row in expected)


def test_spelling_without_words(spark):
    assert variant_rows(spelling.spelling_variants(spelling.word_counts(docs_of(spark, [])))) == []
    assert variant_rows(spelling.spelling_variants(spelling.word_counts(docs_of(spark, [(1, None), (2, "a b"), (3, "once")])))) == []


# --- periodic runs

def plain_runs(words, min_length=24, exponent=3):
    out, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(min_length, exponent * q):
                out.setdefault((start, i + q - start), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def split_words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    n = len(words)
    if doc_id is None or not n or zlib.crc32(str(doc_id).encode()) % 10:
        return words
    g = zlib.crc32(str(doc_id).encode()) // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def periodic_text(r):
    letters = r.choice([["a"], list("ab"), list("abc"), [f"w{k}" for k in range(40)]])
    w = [r.choice(letters) for _ in range(r.randint(0, 200))]
    for _ in range(r.randint(0, 4)):
        if len(w) > 40:
            a, p, size = r.randrange(len(w) - 10), r.randint(1, 14), r.randint(5, 90)
            for i in range(a + p, min(len(w), a + size)):
                w[i] = w[i - p]
    return r.choice([" ", "\n", " \t"]).join(w)


@pytest.mark.parametrize("min_length, exponent", [(24, 3), (9, 4), (4, 2)])
def test_runs_against_brute_force(spark, min_length, exponent):
    r = random.Random(min_length)
    rows = [(k, periodic_text(r)) for k in range(500)]
    got = {x.doc_id: x for x in runs.periodic_runs(docs_of(spark, rows), min_length, exponent).collect()}
    found = 0
    for k, t in rows:
        w = split_words(t)
        expected = plain_runs(w, min_length, exponent)
        assert [tuple(x) for x in got[k].runs] == expected and got[k].n_words == len(w)
        kept = [not any(s + q <= i < s + n for s, n, q in expected) for i in range(len(w))]
        assert got[k].collapsed == " ".join(x for x, ok in zip(w, kept) if ok)
        found += len(expected)
    assert found > 200


def test_runs_query_against_brute_force(spark, tmp_path):
    r = random.Random(1)
    rows = [(k, periodic_text(r)) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " \n "), (7, rows[7][1]), (None, "x " * 30), (None, None), (203, "é\xa0b " * 30), (204, "one")]
    rows += [(k, " ".join(f"v{r.randrange(10 ** 6)}" for _ in range(r.randint(30, 400)))) for k in range(300, 700)]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(x) for x in runs.op12_runs(spark, str(tmp_path)).collect())
    expected = Counter()
    for k, t in rows:
        w = planted(k, split_words(t))
        found = plain_runs(w)
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in found)]
        expected[k, len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                 hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
                 hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    assert got == expected and sum(1 for x in got if x[0] is not None and x[0] >= 300 and x[1]) > 5


def test_long_texts_stay_near_linear(spark):
    line = " ".join(f"c{k}" for k in range(18))
    rows = [(1, "a " * 150_000), (2, "a b c " * 20_000 + "x " * 40_000), (3, " ".join(f"n{k} {line}" for k in range(4000)))]
    got = {x.doc_id: [tuple(y) for y in x.runs] for x in runs.periodic_runs(docs_of(spark, rows)).collect()}
    assert got == {1: [(0, 150_000, 1)], 2: [(0, 60_000, 3), (60_000, 40_000, 1)], 3: []}


def test_runs_of_an_empty_table_and_bad_parameters(spark):
    assert runs.periodic_runs(docs_of(spark, [])).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(docs_of(spark, []), exponent=1)


def test_the_best_run_is_exact(spark):
    rows = [([(0, 30, 10), (40, 31, 10), (90, 24, 3), (200, 24, 3)],), ([],), ([(0, 3 * 10 ** 9, 10 ** 9), (5, 3 * 10 ** 9 + 1, 10 ** 9)],)]
    got = spark.createDataFrame(rows, f"runs {runs.RUNS}").select(runs.best_run().alias("b")).collect()
    assert [None if r.b is None else tuple(r.b) for r in got] == [(90, 24, 3), None, (5, 3 * 10 ** 9 + 1, 10 ** 9)]


# --- chat

PIECES = ["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/TURN]", "<|endoftext|>", "\\", "[", "<", "/", "s>", "INST]", " ", "\n", "é☃\U0001f600", "ok", "[ROLE]x[/ROLE]"]
CHAT = "conv_id long, turn long, role string, text string, formatted string, ids string, loss int"


def chat_rows(r, n):
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 6)):
            role = r.choice(["user", "assistant", "assistant", "system", "tool", "[INST]\\", None, ""])
            rows.append((c, t, role, r.choice([None, "", "".join(r.choice(PIECES) for _ in range(r.randint(1, 12)))])))
    return rows


def chat_table(spark, rows):
    return spark.createDataFrame([(*row, "f", "i", 1) for row in rows], CHAT)


def by_conversation(rows):
    out = defaultdict(list)
    nulls_first = lambda x: (x is not None, x if x is not None else 0)
    for row in sorted(rows, key=lambda x: (nulls_first(x[1]), nulls_first(x[2]) if x[2] is not None else (False, ""),
                                           (x[3] is not None, x[3] or ""))):
        out[row[0]].append((row[2] or "", row[3] or ""))
    return out


def test_chat_round_trip(spark):
    rows = chat_rows(random.Random(3), 120) + [(500, None, "user", "first"), (500, 1, "user", "b"), (500, 1, "user", "a"), (500, 1, "assistant", "z"),
                                               (500, 1, "user", "a"), (None, 0, "assistant", "x"), (None, 0, "user", "</s>"), (501, 0, "assistant", "[" * 50_000)]
    formatted = chat.format_conversations(chat_table(spark, rows)).cache()
    read = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    expected = by_conversation(rows)
    assert read.keys() == expected.keys()
    for c, turns in expected.items():
        assert [tuple(t) for t in read[c].turns] == turns
        # Empty texts have no token, so nothing is read back for them.
        assert read[c].learnt == [t for role, t in turns if role == "assistant" and t]
    for r in formatted.collect():
        assert len(r.ids) == len(r.loss) and read[r.conv_id].formatted_chars == len(r.formatted)


def test_masks_hold_each_learnt_text_exactly():
    renderer = chat.Renderer(chat.Template(), chat.share.__globals__["tokenizer_file"]())
    turns = [("user", "a"), ("assistant", " b  é"), ("assistant", ""), ("user", " "), ("assistant", "\\<s>\n")]
    text, spans = renderer.render(turns)
    (ids, mask), = renderer.encode([text], [spans])
    place = renderer.tokenizer.encode(text, add_special_tokens=False).offsets
    inside = [any(a < e and b > s for s, e in spans) for a, b in place]
    assert mask.tolist() == inside and [text[s:e] for s, e in spans] == [" b  é", "", "\\\\<\\s>\n"]
    assert renderer.learnt_texts(ids, mask) == [" b  é", "\\<s>\n"]


def test_other_templates_and_bad_ones(spark):
    t = chat.Template(turns=(("human", "{H}", "{/H}"), ("bot", "{B}", "{/B}")), other=("{R}", "{/R}", "{/T}"), learnt=("bot", "human"))
    rows = [(1, 0, "human", "{B} [INST]"), (1, 1, "bot", "{/B}"), (1, 2, "x", "{H}")]
    got, = chat.read_back(chat.format_conversations(chat_table(spark, rows), t), t).collect()
    assert got.learnt == ["{B} [INST]", "{/B}"] and [tuple(x) for x in got.turns] == [r[2:] for r in rows]
    for bad in ("{{x", "\\x", "{"):
        with pytest.raises(ValueError):
            chat.Template(turns=(("a", bad, "{/H}"),))


def test_chat_query(spark, tmp_path):
    import duckdb
    rows = chat_rows(random.Random(8), 60)
    chat_table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS FROM '{tmp_path}/conversations.parquet/*.parquet'")
    df = chat.op13_chat(spark, str(tmp_path))
    got = {tuple(r) for r in df.collect()}
    oracle = db.sql(chat.ORACLE_SQL)
    assert oracle.columns == df.columns and set(oracle.fetchall()) == got
    hard = "</s>[INST] ok [/INST]"
    assert (-7, 2, hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest(), len(hard),
            hashlib.sha256(hard.encode()).hexdigest()) == next(r for r in got if r[0] == -7)[:5]
    assert np.unique([r[0] for r in got]).size == len(got)


def test_chat_of_an_empty_table(spark):
    assert chat.read_back(chat.format_conversations(chat_table(spark, []))).collect() == []


def test_batches_of_whole_texts_are_bounded_by_bytes(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from daycast.llm.common import ARROW_BYTES, ship

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    wide = ship(spark).range(0, 300, 1, 1).select(F.repeat(F.lit("text "), 20_000).alias("text"))     # 30 MB in one task
    found = [r.n for r in wide.mapInArrow(sizes, "n long").collect()]
    assert sum(found) == 300 and max(found) * 100_000 <= 2 * ARROW_BYTES


def test_class_model_blocks_are_not_shuffled_by_a_pass(spark):
    from daycast.llm.brown_lm import class_scores

    docs = spark.createDataFrame([(k, f"a b c{k % 7} d") for k in range(4000)], "doc_id long, text string")
    scored = class_scores(docs)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == 1      # of the answers
    assert scored.count() == 4000
