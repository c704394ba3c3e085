"""1. Line dedup by a deletion-neighbourhood join, in DataFrame functions alone.

A line is the sequence of its words.  It is removed when an earlier line
(smaller doc_id, or same document and earlier place) has the same words
or, if both have at least `MIN_WORDS`, is within `EDITS` = 1 edit of it (a
word replaced, inserted or deleted).  Lines are judged on the input.

1. Exact: lines are grouped by a 128-bit hash of their words; each distinct
   line keeps its first place.
2. Candidates: one edit leaves the first or the last half of a line as it
   was, so only distinct lines that share such a half with another one go
   on.  The test loses no pair, and says on which side the edit must be.
3. Deletion neighbourhood: for each word on that side the line without it
   becomes a variant, known by a 62-bit hash (two sums modulo 2**31 - 1, so
   all variants of a line come from running sums).  Lines that share a
   variant at the same place differ in that word at most; a variant that
   equals a whole line differs by one deletion.  A variant's group is joined
   with its earliest line, not with itself: no pairs are made within it.
4. The edit distance of each line and its earliest partner is verified on
   their words.

Every group is aggregated before it is shuffled, and joined with its
aggregate, which adaptive execution can split; a template line with
thousands of fillings costs its rows, not their square.

Defined results: null text has no line and stays null; lines without words
are kept and never compared; rows without doc_id take no part; equal rows
(doc_id and text) are one document and get equal results; rows that share
a doc_id alone are ordered by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import documents, saved, shuffles_removed

MIN_WORDS = 8
PRIME = 2**31 - 1
#: Places of candidate lines up to which they are sent to all tasks (32 bytes each) rather than the lines to them.
BROADCAST_ROWS = 1_000_000
_BLANK = " \t\x0b\x0c\r"


def _lines(docs: DataFrame) -> DataFrame:
    """place (doc_id, text hash, line number) and the line, of lines with words; docs: doc_id, t, text."""
    return (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
            .select("doc_id", "t", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .withColumn("line", F.btrim(F.col("line"), F.lit(_BLANK))).where("line <> ''"))


def _with_words(lines: DataFrame) -> DataFrame:
    """Lines with their words, the number n of them, and the words' hash k1, k2, instead of the text.

    A line whose words stand one plain space apart is cut at single characters, the others by a pattern.
    """
    odd = F.lit(False)
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains("line", F.lit(blank))
    words = F.when(odd, F.split("line", r"[ \t\x0B\f\r]+")).otherwise(F.split("line", " "))
    return (lines.withColumn("words", words).drop("line")
            .withColumns({"n": F.size("words"), "k1": F.xxhash64("words"), "k2": F.xxhash64(F.lit(17), "words")}))


def _halves() -> Column:
    """Hashes of the line's halves, as a line of c words: c = n, and c = n - 1 if the other line is shorter."""
    out = []
    for c in (F.col("n"), F.col("n") - 1):
        h = F.floor(c / 2).cast("int")
        out += [F.when(c >= MIN_WORDS, F.xxhash64(F.lit("head"), c, F.slice("words", F.lit(1), h))),
                F.when(c >= MIN_WORDS, F.xxhash64(F.lit("tail"), c, F.slice("words", F.col("n") - (c - h) + 1, c - h)))]
    return F.when(F.col("n") >= MIN_WORDS, F.array(*out))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are within one edit."""
    differ = lambda x, y: F.zip_with(x, y, lambda p, q: p != q)

    def grown(s: Column, l: Column) -> Column:
        n = F.size(s)
        at = F.array_position(differ(s, F.slice(l, F.lit(1), n)), F.lit(True)).cast("int")
        return (at == 0) | (F.slice(s, F.greatest(at, F.lit(1)), n) == F.slice(l, at + 1, n))

    return (F.when(F.size(a) == F.size(b), F.size(F.filter(differ(a, b), lambda x: x)) <= 1)
            .when(F.size(a) + 1 == F.size(b), grown(a, b))
            .when(F.size(b) + 1 == F.size(a), grown(b, a)).otherwise(False))


def _variants(candidates: DataFrame) -> DataFrame:
    """k1, k2, v: a hash of each deletion variant (with its place, or as a line one word shorter) and of the whole line."""
    x = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "word"), F.lit(PRIME))
    weight = lambda j: F.pmod(F.xxhash64(F.lit(5), j), F.lit(PRIME))
    line = "partition by k1, k2"
    rows = candidates.select("k1", "k2", "n", "head", "tail", F.posexplode("words").alias("i", "word"))
    stays, moves = weight(F.col("i")), weight(F.col("i") - 1)
    rows = rows.select("k1", "k2", "n", "head", "tail", "i",
                       *((x(s) * stays % PRIME).alias(f"a{s}") for s in (1, 2)),
                       *((x(s) * moves % PRIME).alias(f"c{s}") for s in (1, 2)))
    upto = f"over ({line} order by i rows between unbounded preceding and current row)"
    # Without word i: the words before it at their places, those behind it one place further to the left.
    rows = rows.select("k1", "k2", "n", "head", "tail", "i",
                       *(F.expr(f"sum(a{s}) {upto}").alias(f"b{s}") for s in (1, 2)),
                       *(F.expr(f"sum(a{s}) {upto} - a{s} + sum(c{s}) over ({line}) - sum(c{s}) {upto}").alias(f"r{s}") for s in (1, 2)))
    rest = [F.col("r1"), F.col("r2")]
    # head: the first half is shared, so the edit is behind it; tail: the other way round.
    here = (F.col("head") & (F.col("i") >= F.floor((F.col("n") - 1) / 2))) | (F.col("tail") & (F.col("i") <= F.floor(F.col("n") / 2)))
    whole = F.when(F.col("i") == F.col("n") - 1,
                   F.struct(F.lit("w").alias("role"), F.xxhash64("n", "b1", "b2").alias("v")))
    sub = F.when(here, F.struct(F.lit("s").alias("role"), F.xxhash64(F.lit(-1), "n", "i", *rest).alias("v")))
    less = F.when(here & (F.col("n") > MIN_WORDS), F.struct(F.lit("d").alias("role"), F.xxhash64(F.col("n") - 1, *rest).alias("v")))
    return (rows.select("k1", "k2", F.explode(F.array_compact(F.array(sub, less, whole))).alias("e"))
            .select("k1", "k2", "e.role", "e.v"))


def _near(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """k1, k2 of the lines with an earlier line within one edit; distinct: k1, k2, first, halves.

    The lines are read again for the candidates' words; only candidates are split into words.
    """
    halves = distinct.where("halves is not null").select("k1", "k2", F.posexplode(F.array_compact("halves")).alias("side", "half"))
    shared = saved(halves.groupBy("half").agg(F.count("*").alias("m")).where("m > 1").select("half"))
    sides = (halves.join(shared, "half").groupBy("k1", "k2")
             .agg(F.max(F.col("side") % 2 == 0).alias("head"), F.max(F.col("side") % 2 == 1).alias("tail")))
    places = saved(sides.join(distinct.select("k1", "k2", "first"), ["k1", "k2"]))
    n_places = places.count()
    few = n_places <= BROADCAST_ROWS
    own = places.select("head", "tail", "first", "first.doc_id", "first.t", "first.pos")
    candidates = saved(_with_words(lines.join(F.broadcast(own) if few else own, ["doc_id", "t", "pos"]))
                       .select("k1", "k2", "n", "head", "tail", "first", "words"))
    if candidates.count() > n_places:      # repeated rows of the input have a line at one place several times
        candidates = saved(candidates.dropDuplicates(["k1", "k2"]))

    variants = saved(_variants(candidates))
    met = saved(variants.groupBy("v").agg(F.count("*").alias("m")).where("m > 1").select("v"))
    firsts = candidates.select("k1", "k2", F.struct("first", "k1", "k2").alias("line"))
    shared_variants = saved(variants.join(met, "v").distinct().join(firsts, ["k1", "k2"]).select("v", "role", "line"))
    at = lambda role: F.min(F.when(F.col("role") == role, F.col("line")))
    groups = saved(shared_variants.groupBy("v").agg(at("s").alias("s"), at("d").alias("d"), at("w").alias("w")))
    # A replaced word: the same place; a deleted word: the whole line that is left; an inserted one: the other way round.
    partner = F.when(F.col("role") == "s", F.col("s")).when(F.col("role") == "d", F.col("w")).otherwise(F.col("d"))
    links = (shared_variants.join(groups, "v").select("line", partner.alias("partner")).where("partner < line")
             .groupBy(F.col("line.k1").alias("k1"), F.col("line.k2").alias("k2")).agg(F.min("partner").alias("partner"))
             .select("k1", "k2", F.col("partner.k1").alias("p1"), F.col("partner.k2").alias("p2")))
    texts = candidates.select("k1", "k2", "words")
    return (links.join(texts, ["k1", "k2"])
            .join(texts.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("words").alias("others")), ["p1", "p2"])
            .where(_one_edit(F.col("words"), F.col("others"))).select("k1", "k2"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (the document as it was), kept (its text without the removed lines), n_lines, n_exact, n_near."""
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    whole = whole.withColumn("t", F.xxhash64("text"))
    lines = _lines(whole.select("doc_id", "t", "text"))
    place = F.struct("doc_id", "t", "pos")
    with shuffles_removed(docs.sparkSession):
        # Every line once without its words: 16 bytes of hash, its place, and the hashes of its halves.
        hashed = saved(_with_words(lines).select("doc_id", "t", "pos", "k1", "k2", _halves().alias("halves")))
        distinct = saved(hashed.select("k1", "k2", place.alias("place"), "halves")
                         .groupBy("k1", "k2").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.first("halves").alias("halves")))
        near = _near(lines, distinct).withColumn("near", F.lit(True))
        hit = saved(distinct.select("k1", "k2", "first", (F.col("first") != F.col("last")).alias("again"))
                    .join(near, ["k1", "k2"], "left").where("again or near")
                    .select("k1", "k2", "first", F.coalesce("near", F.lit(False)).alias("near")))
    removed = (hashed.select("doc_id", "t", "pos", "k1", "k2").join(hit, ["k1", "k2"])
               .withColumn("exact", place != F.col("first")).where("exact or near")
               .groupBy("doc_id", "t").agg(F.collect_set("pos").alias("places"),
                                           F.count_distinct(F.when(F.col("exact"), F.col("pos"))).alias("n_exact")))
    parts = F.split("text", "\n")
    n = F.size(parts)
    left = F.array_except(F.sequence(F.lit(0), n - 1), F.col("places"))
    kept = F.when(F.col("places").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.element_at(parts, i + 1)), "\n"))
    return (whole.join(removed, ["doc_id", "t"], "left")
            .select("row", kept.alias("kept"), F.when(F.col("text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
                    F.coalesce("n_exact", F.lit(0)).cast("long").alias("n_exact"),
                    (F.coalesce(F.size("places"), F.lit(0)) - F.coalesce("n_exact", F.lit(0))).cast("long").alias("n_near")))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents without their removed lines; one that loses all its words with them goes.

    A column `size_col`, if there is one, gets the new text's length.
    """
    new = F.col("row").withField(text_col, F.col("kept"))
    if size_col in docs.columns:
        new = F.when((F.col("n_exact") + F.col("n_near")) > 0, new.withField(size_col, F.length("kept").cast(docs.schema[size_col].dataType))).otherwise(F.col("row"))
    return (line_dedup(docs, id_col, text_col)
            .where((F.col("n_exact") + F.col("n_near") == 0) | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
            .select(new.alias("row")).select("row.*"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
            .select("row.doc_id", "n_lines", "n_exact", "n_near", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, u.pos, u.line FROM documents,
    LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos) u),
w AS (
  SELECT doc_id, pos, line, CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]')
         THEN regexp_extract_all(line, '[^\x20\x09-\x0D]+') ELSE []::VARCHAR[] END AS ws FROM l),
s AS (
  SELECT *, array_to_string(ws, ' ') AS seq,
         row_number() OVER (PARTITION BY array_to_string(ws, ' ') ORDER BY doc_id, pos) AS k FROM w WHERE len(ws) > 0),
f AS (SELECT doc_id, pos, ws, len(ws) AS n, seq FROM s WHERE k = 1 AND len(ws) >= 8),
pairs AS (
  SELECT a.seq, a.ws AS x, b.ws AS y FROM f a JOIN f b ON a.ws[1:4] = b.ws[1:4]
  WHERE abs(a.n - b.n) <= 1 AND (b.doc_id, b.pos) < (a.doc_id, a.pos)
  UNION ALL
  SELECT a.seq, a.ws, b.ws FROM f a JOIN f b ON a.ws[-4:] = b.ws[-4:]
  WHERE abs(a.n - b.n) <= 1 AND (b.doc_id, b.pos) < (a.doc_id, a.pos)),
near AS (
  SELECT DISTINCT seq FROM pairs
  WHERE (len(x) = len(y) AND len(list_filter(range(1, len(x) + 1), lambda i: x[i] <> y[i])) <= 1)
     OR (len(x) = len(y) + 1 AND len(list_filter(range(1, len(x) + 1), lambda i: list_concat(x[:i - 1], x[i + 1:]) = y)) > 0)
     OR (len(y) = len(x) + 1 AND len(list_filter(range(1, len(y) + 1), lambda i: list_concat(y[:i - 1], y[i + 1:]) = x)) > 0)),
j AS (
  SELECT w.doc_id, w.pos, w.line, coalesce(s.k > 1, false) AS exact, n.seq IS NOT NULL AS near
  FROM w LEFT JOIN s ON s.doc_id = w.doc_id AND s.pos = w.pos LEFT JOIN near n ON n.seq = s.seq)
SELECT d.doc_id, coalesce(count(j.pos), 0)::BIGINT AS n_lines, coalesce(count(*) FILTER (j.exact), 0)::BIGINT AS n_exact,
       coalesce(count(*) FILTER (j.near AND NOT j.exact), 0)::BIGINT AS n_near,
       sha256(coalesce(string_agg(j.line, chr(10) ORDER BY j.pos) FILTER (NOT j.exact AND NOT j.near), '')) AS kept_sha256
FROM documents d LEFT JOIN j USING (doc_id) GROUP BY d.doc_id
"""
