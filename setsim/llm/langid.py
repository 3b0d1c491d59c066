"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader (FTRL-proximal)
with L1 and L2 penalties, then calibrated by a temperature.

N-grams of one to three lower-cased letters (everything else is a gap) are
hashed into 2**15 columns.  Document frequencies come from all documents that
may be learnt from; the weights from a bounded sample of them, at most
``max_docs`` rows spread evenly over the languages and taken by hash of the id.

Defined results: ``und`` with score 0 for a text that is null or has no letter,
and for every text when there is nothing to learn from; rows without a language
or id are not learnt from, of several texts under an id and language at most one, by
hash, for the weights; extra columns pass through unless named like a
result column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim.llm.common import held_out, mix, multipliers, row_slices, small_batches

BITS = 15
ORDERS = 3
MAX_DOCS = 4000
UNKNOWN = "und"


class Grams:
    """Hashed n-gram columns of a text."""

    def __init__(self):
        self.letter = np.array([chr(c).isalpha() for c in range(1 << 16)])
        self.m = multipliers(ORDERS, 10)

    def codes(self, raw: bytes | None) -> np.ndarray | None:
        """Code points of the text, gaps as spaces; None without a letter."""
        if not raw:
            return None
        c = np.frombuffer(raw.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
        low = c < 1 << 16
        letter = self.letter[np.where(low, c, 0)]
        if not low.all():
            high, inverse = np.unique(c[~low], return_inverse=True)
            letter[~low] = np.array([chr(h).isalpha() for h in high])[inverse]
        if not letter.any():
            return None
        gap = ~letter
        keep = np.ones(len(c), bool)
        keep[1:] = letter[1:] | letter[:-1]  # one space for a run of gaps
        return np.concatenate([[32], np.where(gap, 32, c)[keep], [32]]).astype(np.uint64)

    def columns(self, codes: np.ndarray) -> np.ndarray:
        out, h = [], np.zeros(len(codes), np.uint64)
        for k in range(min(ORDERS, len(codes))):
            h = h[:len(codes) - k] + codes[k:] * self.m[k]
            out.append((mix(h + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int64))
        return np.concatenate(out)

    def counts(self, raw: bytes | None) -> np.ndarray | None:
        codes = self.codes(raw)
        return None if codes is None else np.bincount(self.columns(codes), minlength=1 << BITS)


def tfidf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    used = np.flatnonzero(counts)
    x = np.log1p(counts[used]) * idf[used]
    return used, x / np.sqrt((x * x).sum())


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # columns x languages, float32
    bias: np.ndarray
    temperature: float

    def logits(self, used: np.ndarray, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[used] + self.bias

    def predict(self, counts: np.ndarray | None) -> tuple[str, float]:
        if counts is None:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*tfidf(counts, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_lang: int, *, alpha: float = 0.5, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.05, epochs: int = 3, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; the last row of the state is the bias, without L1."""
    dim = 1 << BITS
    z, n = np.zeros((dim + 1, n_lang)), np.zeros((dim + 1, n_lang))
    penalty = np.full(dim + 1, l1)
    penalty[dim] = 0

    def weights(at):
        lasso = penalty[at][:, None] if isinstance(at, np.ndarray) else penalty[:, None]
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= lasso, 0.0, -(zz - np.sign(zz) * lasso) / ((beta + np.sqrt(nn)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            used, x, y = rows[i]
            at, x = np.append(used, dim), np.append(x, 1.0)
            w = weights(at)
            miss = softmax(x @ w)
            miss[y] -= 1
            g = x[:, None] * miss
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    final = weights(slice(None))
    return final[:dim].astype(np.float32), final[dim]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    def loss(t):
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]).mean())
    a, b, r = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_docs: int = MAX_DOCS) -> LanguageModel | None:
    """Model from the rows that have a language and are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")) \
        .filter("id is not null and lang is not null and text is not null").filter(~held_out(F.col("id")))
    counts = dict(rows.groupBy("lang").count().collect())  # one row for each language
    if not counts:
        return None

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df = Grams(), np.zeros((1 << BITS) + 1, np.int64)
        for _, texts in row_slices(batches, "text"):
            for raw in texts:
                codes = grams.codes(raw)
                if codes is not None:
                    seen = np.zeros(1 << BITS, bool)
                    seen[grams.columns(codes)] = True
                    df[:-1] += seen
                    df[-1] += 1
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(df[used])], ["col", "n"])

    df = np.zeros((1 << BITS) + 1)
    for col, n in rows.select("text").mapInArrow(frequencies, "col bigint, n bigint").groupBy("col").agg(F.sum("n")).collect():
        df[col] = n
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    share = max_docs / len(counts)
    spot = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30))
    limit = F.create_map(*(F.lit(v) for lang, c in counts.items() for v in (lang, int(min(1.0, share / c) * (1 << 30)))))
    sample = rows.filter(spot < F.element_at(limit, F.col("lang"))) if counts else rows

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch, texts in row_slices(batches, "text"):
            # Only the columns in use are kept: a slice may hold thousands of short texts.
            xs = [tfidf(c, idf) if (c := grams.counts(t)) is not None else (np.zeros(0, np.int64), np.zeros(0)) for t in texts]
            get = lambda c: batch.column(batch.schema.names.index(c))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [get("id"), get("version"), get("lang"), pa.array([u.astype(np.int32).tobytes() for u, _ in xs], pa.binary()),
                 pa.array([x.astype(np.float32).tobytes() for _, x in xs], pa.binary())],
                ["id", "version", "lang", "used", "x"])

    id_type = rows.schema["id"].dataType.simpleString()
    # Of several texts under one id and language the one of the smallest hash.
    found = sample.mapInArrow(vectors, f"id {id_type}, version long, lang string, used binary, x binary") \
        .filter(F.length("used") > 0).groupBy("id", "lang").agg(F.min_by(F.struct("used", "x"), "version").alias("v")) \
        .select("id", "lang", "v.*").orderBy(F.xxhash64(F.col("id").cast("string")), "lang").collect()
    if not found:
        return None
    languages = sorted({r["lang"] for r in found})
    name = {lang: k for k, lang in enumerate(languages)}
    data = [(np.frombuffer(r["used"], np.int32).astype(np.int64), np.frombuffer(r["x"], np.float32).astype(np.float64),
             name[r["lang"]]) for r in found]
    fit, check = [d for k, d in enumerate(data) if k % 5], data[::5]  # every fifth row sets the temperature
    weights, bias = ftrl(fit or data, len(languages))
    model = LanguageModel(languages, idf, weights, bias, 1.0)
    model.temperature = fit_temperature(np.array([model.logits(u, x) for u, x, _ in check]), np.array([y for *_, y in check]))
    return model


def identify_language(docs: DataFrame, model: LanguageModel | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    out = docs.select(*kept)
    if model is None:
        return out.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, m = Grams(), shared.value
        for batch, texts in row_slices(batches, text_col):
            found = [m.predict(grams.counts(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in kept), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], [*kept, "lang_pred", "score"])

    schema = T.StructType([*out.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return out.mapInArrow(run, schema)


def language_digest(docs: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    found = identify_language(docs.select("doc_id", "text"), fit_language(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
