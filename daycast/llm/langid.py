"""7. Language identification: a bidirectional gated recurrent network over bytes.

Texts are cut into segments of `SEGMENT` bytes (the last one padded with
spaces).  Two gated recurrent layers read each segment forwards and
backwards, every byte position gets a probability for each language, and a
document's probabilities are the mean over its positions.

Training is numpy backpropagation through time with Adam on a bounded
sample of every labelled language: `SAMPLE_PER_LANGUAGE` documents each in
expectation, fewer where there are so many languages that they would pass
`MAX_SAMPLE` together, but `LEAST_PER_LANGUAGE` (all of a language with
fewer), drawn by hash at a rate set from counts over all training rows, one
passage of `PASSAGE` characters each.  More than `MAX_LANGUAGES` different
labels are no languages, and stop the training.  Scoring is a map over all
documents and reads every byte.

Defined results: a text that is null or has no letter is `und`, score 0;
a null lang is never learned from; without any labelled row all are `und`;
equal texts get equal results; a tie goes to the first language in
alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.llm.common import documents, fold_of, ship, text_slices

SEGMENT, HIDDEN = 64, 8
SAMPLE_PER_LANGUAGE, LEAST_PER_LANGUAGE, MAX_SAMPLE, PASSAGE = 600, 40, 12_000, 512
MAX_LANGUAGES = 10_000
STEPS, BATCH, RATE = 220, 192, 0.02
UND = "und"
#: The part of the way from chance (one over the number of languages) to certainty that a document's mean probability
#: must have covered, or it counts as in none of the languages.
LEAST_GAIN = 1 / 15


def _bend(x: np.ndarray) -> np.ndarray:
    """In place x / (1 + |x|), the squashing function; its derivative is (1 - |result|)**2."""
    a = np.abs(x)
    a += np.float32(1)
    return np.divide(x, a, out=x)


def _gate(x: np.ndarray) -> np.ndarray:
    """In place: the same, moved to 0..1; its derivative is (1 - |2 result - 1|)**2 / 2."""
    _bend(x)
    x += np.float32(1)
    x *= np.float32(0.5)
    return x


def _slope(s: np.ndarray) -> np.ndarray:
    return np.square(1 - np.abs(s))


class BiGRU:
    """Parameters: per direction, input rows per byte for the three gates, and recurrent weights; a softmax layer."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        g = np.random.default_rng(seed)
        f = np.float32
        self.languages, self.hidden = languages, hidden
        self.p = {}
        for d in "fb":
            self.p[f"W{d}"] = (g.standard_normal((256, 3 * hidden)) * 0.3).astype(f)
            self.p[f"U{d}"] = (g.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(f)
        self.p["V"] = (g.standard_normal((2 * hidden, len(languages))) * 0.3).astype(f)
        self.p["c"] = np.zeros(len(languages), f)

    def _read(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, segment, unit) of one direction; x: bytes (time, segment)."""
        k = self.hidden
        W, R = ([np.ascontiguousarray(self.p[f"{name}{d}"][:, a:a + k]) for a in (0, k, 2 * k)] for name in "WU")
        T, n = x.shape
        x = x.astype(np.intp)
        out, tape = np.empty((T, n, k), np.float32), []
        h = np.zeros((n, k), np.float32)
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            z, r, m = h @ R[0], h @ R[1], W[2].take(x[t], 0)
            z += W[0].take(x[t], 0)
            r += W[1].take(x[t], 0)
            _gate(z)
            rh = _gate(r) * h
            m += rh @ R[2]
            _bend(m)
            if keep:
                tape.append((t, h, z, r, rh, m))
            new = out[t]
            np.subtract(h, m, out=new)
            new *= z
            new += m                    # z h + (1 - z) m
            h = new
        return out, tape

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, segment, language) of every byte position."""
        k = self.hidden
        s = self._read(x, "f", False)[0].reshape(-1, k) @ self.p["V"][:k]
        s += self._read(x, "b", False)[0].reshape(-1, k) @ self.p["V"][k:]
        s += self.p["c"]
        np.exp(s, out=s)
        s /= s.sum(1, keepdims=True)
        return s.reshape(*x.shape, -1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over all positions, and its gradients by backpropagation through time."""
        k, (T, n) = self.hidden, x.shape
        states, tapes = {}, {}
        for d in "fb":
            states[d], tapes[d] = self._read(x, d, True)
        h = np.concatenate([states["f"], states["b"]], axis=2)
        s = h @ self.p["V"] + self.p["c"]
        s = np.exp(s - s.max(2, keepdims=True))
        s /= s.sum(2, keepdims=True)
        at = (np.arange(T)[:, None], np.arange(n)[None, :], y[None, :])
        loss = float(-np.log(s[at] + 1e-12).mean())
        s[at] -= 1
        s /= np.float32(T * n)
        g = {"V": np.tensordot(h, s, axes=([0, 1], [0, 1])), "c": s.sum((0, 1))}
        back = s @ self.p["V"].T
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            R = self.p[f"U{d}"]
            gW, gR = np.zeros_like(self.p[f"W{d}"]), np.zeros_like(R)
            dh = np.zeros((n, k), np.float32)
            for t, before, z, r, rh, m in reversed(tapes[d]):
                dh = dh + back[t][:, part]
                dm = dh * (1 - z) * _slope(m)
                dz = dh * (before - m) * _slope(2 * z - 1) / 2
                drh = dm @ R[:, 2 * k:].T
                dr = drh * before * _slope(2 * r - 1) / 2
                da = np.concatenate([dz, dr, dm], axis=1)
                for col in range(3 * k):
                    gW[:, col] += np.bincount(x[t], da[:, col], 256).astype(np.float32)
                gR[:, :k] += before.T @ dz
                gR[:, k:2 * k] += before.T @ dr
                gR[:, 2 * k:] += rh.T @ dm
                dh = dh * z + drh * r + dz @ R[:, :k].T + dr @ R[:, k:2 * k].T
            g[f"W{d}"], g[f"U{d}"] = gW, gR
        return loss, g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 11):
        """Adam over random batches, each language equally often; x: bytes (segment, time)."""
        g = np.random.default_rng(seed)
        by = [np.flatnonzero(y == c) for c in range(len(self.languages))]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for step in range(1, steps + 1):
            of = g.integers(0, len(by), batch)
            rows = np.array([by[c][g.integers(len(by[c]))] for c in of])
            _, grad = self.gradients(np.ascontiguousarray(x[rows].T), y[rows])
            norm = np.sqrt(sum(float((d * d).sum()) for d in grad.values()))
            lr = rate * min(1.0, 2.5 * (1 - step / (steps + 1)))
            for k, d in grad.items():
                d = d * np.float32(min(1.0, 1.0 / (norm + 1e-9)))
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.99 * v[k] + 0.01 * d * d
                self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def document_probabilities(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean position probabilities of each text of a slice (zeros for an empty one)."""
        sizes = np.diff(off)
        segments = -(-sizes // SEGMENT)
        ends = np.concatenate([[0], np.cumsum(segments)])
        total = int(ends[-1])
        out = np.zeros((len(sizes), len(self.languages)))
        if not total:
            return out
        padded = np.full(total * SEGMENT, 32, np.uint8)
        target = np.arange(len(data)) + np.repeat(ends[:-1] * SEGMENT - off[:-1], sizes)
        padded[target] = data
        real = np.zeros(total * SEGMENT, bool)
        real[target] = True
        sums = np.empty((total, len(self.languages)))
        x, real = padded.reshape(total, SEGMENT), real.reshape(total, SEGMENT)
        for lo in range(0, total, 512):
            hi = min(lo + 512, total)
            p = self.positions(np.ascontiguousarray(x[lo:hi].T))
            if not real[lo:hi].all():
                p *= real[lo:hi].T[:, :, None]
            sums[lo:hi] = p.sum(0)
        full = np.flatnonzero(segments)
        out[full] = np.add.reduceat(sums, ends[:-1][full]) / sizes[full, None]
        return out


def training_sample(labelled: DataFrame) -> list:
    """(lang, passage) rows: a bounded hash sample, evenly over the languages; labelled: doc_id, text, lang."""
    counts = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if not counts:
        return []
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different labels")
    each = max(LEAST_PER_LANGUAGE, min(SAMPLE_PER_LANGUAGE, MAX_SAMPLE // len(counts)))
    rates = labelled.sparkSession.createDataFrame([(c["lang"], min(1.0, each / c["count"])) for c in counts], "lang string, rate double")
    h = F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit(7))
    begin = F.greatest(F.pmod(F.shiftright(h, 20), F.greatest(F.length("text") - PASSAGE, F.lit(1))), F.lit(0)) + 1
    rows = (labelled.join(F.broadcast(rates), "lang")
            .withColumn("h", h)
            .where(F.pmod(F.shiftright("h", 8), F.lit(1_000_000)) < F.col("rate") * 1_000_000)
            .select("h", "lang", F.substring(F.col("text"), begin.cast("int"), F.lit(PASSAGE)).alias("passage")))
    # In order of the hash here: sorting them in Spark would read the documents once more.
    return sorted(rows.collect(), key=lambda r: (r["h"], r["lang"], r["passage"]))


def train(sample: list) -> BiGRU | None:
    """The network for (lang, passage) rows; None without any."""
    languages = sorted({r["lang"] for r in sample})
    xs, ys = [], []
    for r in sample:
        raw = np.frombuffer(r["passage"].encode(), np.uint8)
        n = -(-len(raw) // SEGMENT)
        padded = np.full(n * SEGMENT, 32, np.uint8)
        padded[:len(raw)] = raw
        xs.append(padded.reshape(n, SEGMENT))
        ys += [languages.index(r["lang"])] * n
    if not ys:
        return None
    return BiGRU(languages).fit(np.concatenate(xs), np.array(ys))


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> BiGRU | None:
    """Learn from the text and lang of documents outside fold 0 of 5."""
    labelled = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                            F.col(lang_col).cast("string").alias("lang"))
                .where((fold_of(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")))
    return train(training_sample(labelled))


def labels(net: BiGRU | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(language, score) of each text."""
    names = np.array([*(net.languages if net else []), UND], dtype=object)
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if net is not None:
        for lo, hi, data, off in text_slices(texts):
            p = net.document_probabilities(data, off)
            best[lo:hi], score[lo:hi] = p.argmax(1), p.max(1)
        mute = ~pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        best[mute], score[mute] = -1, 0
    return names[best], np.clip(score, 0, 1)


def predict_language(docs: DataFrame, model: BiGRU | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every whole text; only the text is read."""
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score = labels(shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def least_score(n_languages: int, gain: float = LEAST_GAIN) -> float:
    """The least mean probability that stands for a language, relative to chance; with one language all texts have it."""
    chance = 1 / max(n_languages, 1)
    return chance + (1 - chance) * gain - 1e-6


def in_known_language(docs: DataFrame, model: BiGRU | None, gain: float = LEAST_GAIN, text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose language is predicted with a score of `least_score` or more (`und` never is)."""
    least = least_score(len(model.languages) if model else 0, gain)
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, score = labels(shared.value, b.column(place))
            yield b.filter(pa.array((names != UND) & (score >= least)))

    return docs.mapInArrow(run, docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict_language(docs, fit_language_model(docs))
    return found.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
