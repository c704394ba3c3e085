"""The pipeline's kept documents, texts and tokens, and near duplicates, against plain Python on planted tables."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from daycast.llm import minhash

R = random.Random(12)
VOCABULARY = {lang: ["".join(R.choice(letters) for _ in range(R.randint(3, 8))) for _ in range(3000)]
              for lang, letters in (("xx", "abcdefghij"), ("yy", "klmnopqrst"))}


def line(lang, n):
    return [R.choice(VOCABULARY[lang]) for _ in range(n)]


def split_words(text):
    return re.findall("[^\x20\x09-\x0D]+", text)


def one_word_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def plain_lines(texts):
    """Line dedup of {doc_id: text}: a line goes if an earlier one is the same, or both have 8 words and one edit between them."""
    seen, out = [], {}
    for i in sorted(texts):
        kept, removed = [], False
        for row in texts[i].split("\n"):
            w = split_words(row)
            gone = bool(w) and any(w == v or (len(w) >= 8 and len(v) >= 8 and one_word_edit(w, v)) for v in seen)
            if w:
                seen.append(w)
            removed |= gone
            if not gone:
                kept.append(row)
        if not removed or split_words("\n".join(kept)):
            out[i] = "\n".join(kept)
    return out


def plain_classes(texts, similarity=0.8):
    """Smallest id of each document's component of pairs with a Jaccard similarity of five-word shingles of `similarity` or more."""
    shingles = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, t in texts.items() for w in [split_words(t)]}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and len(shingles[a] & shingles[b]) >= similarity * len(shingles[a] | shingles[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def edited(words, n):
    words = list(words)
    for at in R.sample(range(len(words)), n):
        words[at] = "new" + words[at]
    return words


def planted():
    item = line("xx", 25)
    docs = {}
    for k in range(120):
        lang = "xx" if k % 2 else "yy"
        docs[k] = [line(lang, R.randint(9, 40)) for _ in range(R.randint(1, 5))] + [line(lang, 60)]
    for k in range(20):
        docs[200 + k] = docs[k]                                             # the same lines: nothing is left
        docs[300 + k] = [edited(docs[k][0], 1), line("xx", 50)]             # a near line and one of its own
        docs[400 + k] = [docs[k][-1], line("yy", 30)]                       # a repeated line and one of its own
    for k in range(12):
        base = line("xx" if k % 2 else "yy", 220)
        docs[500 + k], docs[520 + k], docs[540 + k] = [base], [edited(base, 2)], [edited(base, 3)]     # near copies
        docs[560 + k] = [edited(base, 40)]                                  # too far away
    for k in range(6):
        docs[600 + k] = [line("xx", 30), line("xx", 10) + item + line("xx", 12)]
    texts = {i: "\n".join(" ".join(w) for w in rows) for i, rows in docs.items()}
    texts |= {700: "12345 678 !!", 701: "", 702: " \n "}
    return texts, " ".join(item)


def test_pipeline_against_plain_python(spark, tmp_path):
    texts, item = planted()
    rows = [(i, t, "xx" if set(t) & set("abcdefghij") else "yy", "s", len(t)) for i, t in texts.items()] + [(703, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, " ".join(line("yy", 30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = plain_lines({i: t for i, t in texts.items() if re.search("[a-z]", t)})
    classes = plain_classes(left)
    left = {i: t for i, t in left.items() if classes[i] == i and item not in t}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {}
    for i, t in left.items():
        ids = library.encode(t, add_special_tokens=False).ids
        expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == expected
    # Of what was planted nothing that should go stays, and the clean documents stay.
    assert {*range(120), *(500 + k for k in range(12)), *(560 + k for k in range(12))} <= got.keys()
    assert not {*range(200, 220), *range(520, 552), *range(600, 606), 700, 701, 702, 703} & got.keys()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "an item of some words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_against_all_pairs(spark):
    texts = {i: t for i, t in planted()[0].items() if len(split_words(t)) >= 5}
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == plain_classes(texts)
