"""Quality classifier by Bradley-Terry pairwise ranking.

Each text becomes a vector of surface statistics (character classes, word and
line shape, repetition).  The model is linear: a document of label 1 should beat
one of label 0 with probability sigmoid(w . (x1 - x0)), so ``w`` minimises the
logistic loss over feature differences of preference pairs.  The cut is the
score quantile at the share of label 0 among the training rows; the score is
scaled so that the cut stands at 0.7.

Fitting takes every labelled row that is not held out and every pair of a row of
label 1 with a row of label 0 (``fit_all_pairs``); together the pairs weigh as much
as ``N_PAIRS`` against the ridge.  The statistics are written once.  A Newton step
reads them twice: what a row contributes depends on the other label's rows only
through its score, so a histogram of the scores, by label, gives each row the sum
over all its pairs.  Tasks return sums of fixed size; no rows go through the driver
but the last few thousand scores around the cut.

Defined results: null and empty texts have all-zero statistics and get a score
like any other; labels that are null or not 0/1 are ignored; a document with
both labels counts once for each, and of several texts under an id one, by hash; without rows of both labels nothing is known
against any document, so each scores 1.0; extra columns pass through unless
named like a result column, which replaces them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim.functions import key_filter
from setsim.llm.common import drop_step, held_out, row_slices, small_batches, write_step

N_PAIRS = 60_000
CUT = 0.7
# Points of the score histogram, groups of them in the curvature, bins of a round
# that narrows the cut down, and scores that are few enough to be fetched.
GRID = 8192
GROUPS = 256
CUT_BINS = 4096
FEW = 4096

_MARKS = b"|#$%&*!?.,:;@/<>{}_=+-()[]\"'~^\\`"
_FEATURES = len(_MARKS) + 18


def features(raw: bytes | None) -> np.ndarray:
    """Surface statistics of a text (shares as square roots, to spread small ones)."""
    x = np.zeros(_FEATURES)
    if not raw:
        return x
    n = len(raw)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = count[65:91].sum(), count[97:123].sum()
    k = len(_MARKS)
    words = raw.split()
    lines = raw.split(b"\n")
    n_words, n_lines = max(1, len(words)), len(lines)
    distinct = len(set(words))
    filled = [s for s in lines if s.strip()]
    x[:k] = np.sqrt(count[list(_MARKS)] / n)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    x[k:] = [
        np.sqrt(upper / max(1, upper + lower)), np.sqrt(count[48:58].sum() / n), np.sqrt(count[128:].sum() / n),
        np.sqrt((count[9:14].sum() + count[32]) / n), np.sqrt(count[10] / n), np.sqrt(count[:9].sum() / n),
        np.log1p(len(words)), np.log1p(lengths.mean()), np.log1p(lengths.max()), (lengths <= 3).mean(), (lengths >= 12).mean(),
        distinct / n_words, np.sqrt(distinct) / np.sqrt(n_words) * np.log1p(n_words),
        1 - len(set(filled)) / max(1, len(filled)), np.log1p(n_words / n_lines), len(words) == 0,
        np.sqrt((upper + lower + count[128:].sum()) / n), len(words) < 20,
    ]
    return x


def feature_matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.stack([features(t) for t in texts])


@dataclass
class QualityModel:
    """A linear score; ``slope`` and ``cut`` map it to [0, 1] with the cut at 0.7."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    slope: float
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * (self.raw(x) - self.cut), -30, 30)
        return 1 / (1 + np.exp(-z) * (1 - CUT) / CUT)


def fit_pairs(good: np.ndarray, bad: np.ndarray, share_bad: float, n_pairs: int = N_PAIRS, ridge: float = 1.0,
              seed: int = 7) -> QualityModel:
    """Bradley-Terry fit by Newton steps on the pairwise logistic loss."""
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    g, b = (np.clip((m - mean) / scale, -6, 6) for m in (good, bad))
    rng = np.random.default_rng(seed)
    d = g[rng.integers(len(g), size=n_pairs)] - b[rng.integers(len(b), size=n_pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # of losing
        grad = d.T @ p - ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    # Each label weighs as often as it occurs, though the sample evens them out.
    s = np.concatenate([g @ w, b @ w])
    weight = np.concatenate([np.full(len(g), (1 - share_bad) / len(g)), np.full(len(b), share_bad / len(b))])
    order = np.argsort(s, kind="stable")
    cut = float(s[order][min(len(s) - 1, np.searchsorted(np.cumsum(weight[order]), share_bad))])
    y = np.concatenate([np.ones(len(g)), np.zeros(len(b))])
    return QualityModel(w, mean, scale, _slope(s, y, weight), cut)


def _slope(s: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """One-dimensional logistic scale of the score."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * s + shift, -30, 30)))
        r, v = weight * (y - p), weight * p * (1 - p)
        h = np.array([[(v * s * s).sum() + 1e-4, (v * s).sum()], [(v * s).sum(), v.sum() + 1e-4]])
        move = np.linalg.solve(h, [(r * s).sum() - 1e-4 * slope, r.sum() - 1e-4 * shift])
        slope, shift = slope + move[0], shift + move[1]
    return max(float(slope), 1e-3)


def _per_task(rows: DataFrame, work: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``work(label, x)``, flat, summed over all rows (0 without any); a task sends one array of sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                got = work(batch.column(0).to_numpy(zero_copy_only=False), x)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = [np.array(r[0]) for r in rows.select("label", "x").mapInArrow(run, "sums array<double>").collect()]
    return sum(sorted(found, key=lambda a: a.tobytes()))


def _points(score: np.ndarray, weight: np.ndarray, first: float, step: float) -> np.ndarray:
    """A histogram on ``GRID`` points from ``first`` on; a score is shared by the points beside it."""
    place = (score - first) / step
    low = np.clip(place.astype(np.int64), 0, GRID - 2)
    part = place - low
    return np.bincount(low, weight * (1 - part), GRID) + np.bincount(low + 1, weight * part, GRID)


def _cut(rows: DataFrame, raw: Callable[[np.ndarray], np.ndarray], reach: float, weight: np.ndarray, share: float) -> float:
    """The first score below which rows weigh ``share``; ``weight`` is a row's, by label."""
    low, width, below = -reach, 2 * reach, 0.0
    share += weight.min() / 2  # rounding decides for no row

    def place(x: np.ndarray) -> np.ndarray:
        return np.floor((raw(x) - low) / (width / CUT_BINS)).astype(np.int64)

    def binned(label: np.ndarray, x: np.ndarray) -> np.ndarray:
        at = place(x)
        kept = (at >= 0) & (at < CUT_BINS)
        return np.stack([np.bincount(at[kept & (label == k)], minlength=CUT_BINS) for k in (0, 1)]).astype(float)

    while True:
        counts = _per_task(rows, binned).reshape(2, CUT_BINS)
        upto = below + np.cumsum(weight @ counts)
        at = min(CUT_BINS - 1, int(np.searchsorted(upto, share)))
        before = below if at == 0 else float(upto[at - 1])
        if counts[:, at].sum() <= FEW:
            break
        low, width, below = low + at * (width / CUT_BINS), width / CUT_BINS, before
        if width < 1e-9:
            return float(low)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                kept = place(x) == at
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), pa.array(raw(x[kept]))], ["label", "s"])

    near = sorted((r[1], r[0]) for r in rows.select("label", "x").mapInArrow(inside, "label int, s double").collect())
    upto = before + np.cumsum([weight[label] for _, label in near])
    return float(near[min(len(near) - 1, int(np.searchsorted(upto, share)))][0])


def fit_all_pairs(rows: DataFrame, share_bad: float, weight_of_pairs: float = N_PAIRS, ridge: float = 1.0) -> QualityModel | None:
    """Bradley-Terry fit over every pair of a row of label 1 with one of label 0 of
    ``rows(label int, x array<double>)``; None without rows of both labels.

    Scores meet each other on a grid of ``GRID`` points, each shared by the two
    points beside it; the curvature takes the points in ``GROUPS`` groups, which
    slows the last steps a little and moves no optimum."""
    def moments(label: np.ndarray, x: np.ndarray) -> np.ndarray:
        return np.concatenate([[(label == 0).sum(), (label == 1).sum()], x.sum(axis=0)])

    sums = _per_task(rows, moments)
    if not np.any(sums) or not sums[:2].all():
        return None
    n = sums[:2]
    mean = np.round(sums[2:] / n.sum(), 9)
    scale = np.round(np.sqrt(_per_task(rows, lambda _, x: ((x - mean) ** 2).sum(axis=0)) / n.sum()), 9) + 1e-6

    def norm(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -6, 6)

    d, per_pair = len(mean), weight_of_pairs / (n[0] * n[1])

    def nearest(s: np.ndarray, first: float, step: float) -> np.ndarray:
        return np.clip(np.rint((s - first) / step).astype(np.int64), 0, GRID - 1)

    def histogram(w: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """First point, step and the scores by label: shared by points, and whole at
        the nearest one.  The points are drawn together around the scores there are."""
        reach = 6 * np.abs(w).sum() + 1e-3
        first, step = -reach, 2 * reach / (GRID - 1)
        while True:
            def work(label: np.ndarray, x: np.ndarray) -> np.ndarray:
                s = norm(x) @ w
                return np.stack([_points(s, (label == k).astype(float), first, step) for k in (0, 1)]
                                + [np.bincount(nearest(s[label == k], first, step), minlength=GRID) for k in (0, 1)])
            found = _per_task(rows, work).reshape(4, GRID)
            taken = np.flatnonzero(found[:2].sum(axis=0))
            low, high = max(0, taken[0] - 1), min(GRID - 1, taken[-1] + 1)
            if high - low > GRID / 2 or step < 1e-3:
                return first, step, found[:2], found[2:]
            first, step = first + low * step, (high - low) * step / (GRID - 1)

    def loss(w: np.ndarray, step: float, hist: np.ndarray) -> float:
        won = np.logaddexp(0, step * np.arange(GRID - 1, -GRID, -1))  # of a lead of -(GRID - 1) to GRID - 1 points
        return per_pair * float(hist[1] @ np.convolve(hist[0], won, "valid")) + ridge / 2 * float(w @ w)

    w = np.zeros(d)
    first, step, hist, whole = histogram(w)
    best = loss(w, step, hist)
    for _ in range(30):
        lead = step * np.arange(1 - GRID, GRID)
        p = 1 / (1 + np.exp(np.clip(lead, -700, 700)))  # that the row in the lead loses all the same
        # By point: how many pairs a row of label 0, or of label 1, is expected to have the wrong way round.
        lost = np.stack([np.convolve(hist[1], p[::-1], "valid"), np.convolve(hist[0], p, "valid")])
        grid = first + step * np.arange(GRID)
        # Groups of equal width over the points that are taken, and the mean score of each, by label.
        taken = np.flatnonzero(whole.sum(axis=0))
        group = np.clip((np.arange(GRID) - taken[0]) * GROUPS // (taken[-1] - taken[0] + 1), 0, GROUPS - 1)
        size = np.stack([np.bincount(group, h, GROUPS) for h in whole])
        centre = np.stack([np.bincount(group, h * grid, GROUPS) for h in whole]) / np.maximum(size, 1e-300)
        q = 1 / (1 + np.exp(np.clip(centre[1][:, None] - centre[0][None, :], -700, 700)))
        curve = q * (1 - q)
        # A row's share of the curvature within its label, by group.
        share = np.stack([size[1] @ curve, curve @ size[0]])

        def sums_of(label: np.ndarray, x: np.ndarray) -> np.ndarray:
            z = norm(x)
            s = z @ w
            at, out = group[nearest(s, first, step)], []
            for k in (0, 1):
                zk, ak = z[label == k], at[label == k]
                total = np.zeros((GROUPS, d))
                np.add.at(total, ak, zk)
                out += [np.interp(s[label == k], grid, lost[k]) @ zk, total.ravel(), ((zk * share[k][ak][:, None]).T @ zk).ravel()]
            return np.concatenate(out)

        halves = np.split(_per_task(rows, sums_of), 2)
        (g0, t0, m0), (g1, t1, m1) = (np.split(half, [d, d + GROUPS * d]) for half in halves)
        cross = t1.reshape(GROUPS, d).T @ curve @ t0.reshape(GROUPS, d)
        hess = per_pair * ((m0 + m1).reshape(d, d) - cross - cross.T) + ridge * np.eye(d)
        move = np.linalg.solve(hess, per_pair * (g1 - g0) - ridge * w)
        if np.abs(move).max() < 1e-6:
            break
        for _ in range(6):  # a step that overshoots is halved
            fresh = w + move
            first, step, hist, whole = histogram(fresh)
            if (now := loss(fresh, step, hist)) <= best + 1e-9 * abs(best):
                break
            move = move / 2
        w, best = fresh, now
    # Sums differ in their last digits with the order of the rows; the model does not.
    w = np.round(w, 8)
    first, step, hist, whole = histogram(w)
    weight = np.array([share_bad / n[0], (1 - share_bad) / n[1]])
    grid = first + step * np.arange(GRID)
    slope = _slope(np.concatenate([grid, grid]), np.repeat([0.0, 1.0], GRID), (hist * weight[:, None]).ravel())
    cut = _cut(rows, lambda x: norm(x) @ w, 6 * np.abs(w).sum() + 1e-6, weight, share_bad)
    return QualityModel(w, mean, scale, round(slope, 9), cut)


def fit_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> QualityModel | None:
    """Model from the labelled rows that are not held out; None without both labels."""
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter("id is not null and label in (0, 1)").filter(~held_out(F.col("id"))).distinct()
    counts = dict(rows.groupBy("label").count().collect())
    if not (counts.get(0) and counts.get(1)):
        return None
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    # The statistics are joined with the labels, not the texts: those stay in the task that reads them.
    if texts.schema["id"].dataType == rows.schema["id"].dataType:
        texts = texts.filter(key_filter(rows, "id", sum(counts.values()))(F.col("id")))
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in row_slices(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in ("id", "version")),
                 pa.array(list(feature_matrix(raw)), pa.list_(pa.float64()))], ["id", "version", "x"])

    # Of several texts under one id the one of the smallest hash.
    found = texts.mapInArrow(run, f"id {id_type}, version long, x array<double>").join(rows, "id").groupBy("id", "label").agg(
        F.min_by("x", "version").alias("x"))
    kept = write_step(found.sortWithinPartitions("id", "label").select("label", "x"), "quality_rows")
    model = fit_all_pairs(kept, counts[0] / (counts[0] + counts[1]))
    drop_step(kept)
    return model


def score_quality(docs: DataFrame, model: QualityModel | None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from the cut on)."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*kept, F.lit(1.0).alias("score"), F.lit(1).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in row_slices(batches, text_col):
            score = model.score(feature_matrix(raw))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in kept), pa.array(score),
                 pa.array((score >= CUT).astype(np.int32))], [*kept, "score", "predicted"])

    out = docs.select(*kept)
    schema = T.StructType([*out.schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return out.mapInArrow(run, schema)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    scored = score_quality(docs.select("doc_id", "text"), fit_quality(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents from the cut on, with the columns of ``docs``."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return score_quality(docs, fit_quality(docs, labels)).filter("predicted = 1").select(kept)
