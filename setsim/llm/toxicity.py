"""Toxicity by the nearest labelled examples.

1. Examples: at most ``EXAMPLES`` labelled rows of each label, by hash order.
2. Vocabulary: words and word beginnings (4 to 6 letters) whose share of examples
   differs between the labels by ``LEAST_Z`` standard errors, at most ``MAX_TERMS``.
3. One scan of all texts writes each document's vocabulary terms; their document
   frequencies over all documents give TF-IDF vectors of length 1.
4. The examples' vectors form an inverted index: posting lists cut into blocks of
   ``BLOCK`` examples, each with the list's greatest weight in the block.  A
   document's terms times these maxima bound its cosine with every example of a
   block; blocks are opened best first until no bound reaches the k-th best
   cosine, so the k nearest are exact.
5. Neighbours vote with weight 1 / (distance + SOFT), each label scaled to its
   share of the labelled rows.  A logistic curve over the vote and the similarity,
   fitted on the examples with themselves left out, makes a probability of it.
   The neighbours' ids, labels and cosines are the evidence.

Only the fit is bounded (examples, terms); frequencies and scores cover all rows
and whole texts.

Defined results: null, empty and wordless texts, and texts without a vocabulary
term, have no neighbours and get the share of toxic rows among such examples;
ties of equal cosine go to the smaller id; rows of equal id are scored each for
itself, and a label counts for the smallest text of its id; without labels of both kinds every
score is the share of label 1 (0 without labels); extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setsim.llm.common import drop_step, row_slices, small_batches, write_step
from setsim.session import tasks_for

EXAMPLES = {0: 6000, 1: 3000}
MAX_TERMS = 1024
LEAST_Z = 4.0
PREFIXES = (4, 5, 6)
NEIGHBOURS = 15
BLOCK = 64
FIRST_BLOCKS = 4
SOFT = 0.1
_WORDS = re.compile(r"[^\W\d_]+")
_CHUNK = 1 << 18
_KNOWN_WORDS = 1 << 18
ROWS_PER_TASK = 20_000


def held_out(doc_id: Column) -> Column:
    """Rows kept out of the fit: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))


def word_counts(raw: bytes | None) -> Counter:
    """Words of a text in lower case, about a quarter of a million characters at a time."""
    text, found, start = (raw or b"").decode("utf-8", "replace"), Counter(), 0
    while start < len(text):
        stop = min(len(text), start + _CHUNK)
        while stop < len(text) and text[stop].isalpha():
            stop += 1
        found.update(_WORDS.findall(text[start:stop].lower()))
        start = stop
    return found


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, the latter marked."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, label, n): the examples of a slice that hold each term."""
    for batch, texts in row_slices(batches, "text"):
        found = Counter()
        for label, raw in zip(batch.column(batch.schema.names.index("label")).to_pylist(), texts, strict=True):
            found.update((t, label) for t in {t for w in word_counts(raw) for t in terms_of(w)})
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([x for _, x in found], pa.int32()),
                                          pa.array(list(found.values()), pa.int64())], ["term", "label", "n"])


def _vectors(vocabulary):
    """Rows (doc, held_out, terms, tfs) of all documents; terms ascend."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        known: dict[str, tuple[int, ...]] = {}
        for batch, texts in row_slices(batches, "text"):
            keys, counts = [], []
            for raw in texts:
                found: dict[int, int] = {}
                if len(known) > _KNOWN_WORDS:
                    known.clear()
                for word, n in word_counts(raw).items():
                    at = known.get(word)
                    if at is None:
                        at = known[word] = tuple(number[t] for t in terms_of(word) if t in number)
                    for t in at:
                        found[t] = found.get(t, 0) + n
                keys.append(sorted(found))
                counts.append([found[t] for t in keys[-1]])
            cols = [batch.column(batch.schema.names.index(c)) for c in ("doc", "version", "held_out")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(keys, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                                             ["doc", "version", "held_out", "terms", "tfs"])
    return run


def _frequencies(n_terms: int):
    """(t, n): the rows of a task that hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(batch.schema.names.index("terms")).flatten().to_numpy(), minlength=n_terms)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(held[some])], ["t", "n"])
    return run


class Index:
    """Block-max inverted index over unit vectors, and exact nearest examples."""

    def __init__(self, ids, labels, rows, terms, weights, n_terms):
        """``rows`` (ascending), ``terms``, ``weights``: the vectors' entries."""
        n = len(ids)
        # Examples with the same heaviest terms side by side, so that blocks differ.
        heavy = np.lexsort((terms, -weights, rows))
        first = np.searchsorted(rows, np.arange(n))
        lead = np.full((3, n), -1, np.int64)
        for j in range(3):
            some = np.flatnonzero(np.bincount(rows, minlength=n) > j)
            lead[j, some] = terms[heavy[first[some] + j]]
        order = np.lexsort((ids, lead[2], lead[1], lead[0]))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.labels = ids[order], labels[order]
        self.n_blocks = max(1, -(-n // BLOCK))
        slot = place[rows]
        by = np.lexsort((slot, terms))
        self.slot, self.weight = slot[by], weights[by]
        key = terms[by] * self.n_blocks + self.slot // BLOCK
        self.first = np.searchsorted(key, np.arange(n_terms * self.n_blocks + 1))
        self.maxima = np.zeros(n_terms * self.n_blocks)
        np.maximum.at(self.maxima, key, self.weight)
        self.maxima = self.maxima.reshape(n_terms, self.n_blocks)

    def _open(self, terms, weights, blocks) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the blocks that share a term, with their cosines."""
        blocks = np.sort(blocks)
        key = (terms[:, None] * self.n_blocks + blocks).ravel()
        first, size = self.first[key], self.first[key + 1] - self.first[key]
        stop = np.cumsum(size)
        at = np.repeat(first - (stop - size), size) + np.arange(stop[-1])
        slot = self.slot[at]
        spot = np.repeat(np.tile(np.arange(len(blocks)), len(terms)), size) * BLOCK + slot % BLOCK
        score = np.bincount(spot, self.weight[at] * np.repeat(np.repeat(weights, len(blocks)), size), len(blocks) * BLOCK)
        hit = np.flatnonzero(score)
        return blocks[hit // BLOCK] * BLOCK + hit % BLOCK, score[hit]

    def nearest(self, terms, weights, k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Slots and cosines of the k nearest examples that share a term; ``without``: an id left out."""
        bound = np.einsum("i,ij->j", weights, self.maxima[terms])
        order = np.argsort(-bound, kind="stable")
        order = order[:int(np.count_nonzero(bound > 0))]
        slots, scores, bar, done = [], [], 0.0, 0
        # A few best blocks give a bar; those that can still reach it follow in one go.
        while done < len(order) and bound[order[done]] >= bar - 1e-9:
            blocks = order[done:done + FIRST_BLOCKS] if not done else order[done:]
            blocks = blocks[bound[blocks] >= bar - 1e-9]
            done += len(blocks)
            slot, score = self._open(terms, weights, blocks)
            if without is not None:
                other = self.ids[slot] != without
                slot, score = slot[other], score[other]
            near = score >= bar - 1e-9
            slots.append(slot[near])
            scores.append(score[near])
            held = np.concatenate(scores)
            if len(held) >= k:
                bar = float(np.partition(held, len(held) - k)[len(held) - k])
        if not slots:
            return np.zeros(0, np.int64), np.zeros(0)
        slot, score = np.concatenate(slots), np.concatenate(scores)
        near = score >= bar - 1e-9
        slot, score = slot[near], score[near]
        best = np.lexsort((self.ids[slot], -np.round(score, 9)))[:k]
        return slot[best], score[best]


def unit_vector(terms: np.ndarray, tfs: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1.0 + np.log(tfs)) * idf[terms]
    size = math.sqrt(float((w * w).sum()))
    return w / size if size else w


def vote_features(cosines: np.ndarray, labels: np.ndarray, scale: np.ndarray) -> tuple[float, float]:
    """Log-odds of the distance-weighted vote, and the neighbours' mean cosine."""
    w = scale[labels] / (1.0 - np.minimum(cosines, 1.0) + SOFT)
    for_1, for_0 = float(w[labels == 1].sum()), float(w[labels == 0].sum())
    least = 0.05 * (for_1 + for_0) / max(1, len(labels))
    return math.log((for_1 + least) / (for_0 + least)), float(cosines.mean())


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-2)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


class Model:
    """Index, votes and curve; small enough to be sent to every task."""

    def __init__(self, index: Index | None, idf: np.ndarray, scale: np.ndarray, alone: float, k: int):
        self.index, self.idf, self.scale, self.alone, self.k = index, idf, scale, alone, k
        self.curve: np.ndarray | None = None
        self.n_rows = 1

    def votes(self, terms, tfs, without: int | None = None):
        """Slots, cosines and vote features; None without neighbours."""
        if self.index is None or not len(terms):
            return None
        slot, cosine = self.index.nearest(terms, unit_vector(terms, tfs, self.idf), self.k, without)
        return (slot, cosine, *vote_features(cosine, self.index.labels[slot], self.scale)) if len(slot) else None

    def score(self, terms, tfs) -> tuple[float, list[tuple[int, int, float]]]:
        found = self.votes(terms, tfs)
        if found is None or self.curve is None:
            return self.alone, []
        slot, cosine, odds, near = found
        z = float(self.curve @ np.array([1.0, odds, near, odds * near]))
        evidence = zip(self.index.ids[slot].tolist(), self.index.labels[slot].tolist(), cosine.tolist(), strict=True)
        return 1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0))), list(evidence)


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        known: dict[bytes, tuple] = {}
        for batch in batches:
            terms, tfs = (batch.column(batch.schema.names.index(c)) for c in ("terms", "tfs"))
            stop = np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy())])
            terms, tfs = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy()
            scores, ids, labels, cosines = [], [], [], []
            for i in range(batch.num_rows):
                t, f = terms[stop[i]:stop[i + 1]], tfs[stop[i]:stop[i + 1]]
                key = t.tobytes() + f.tobytes()
                found = known.get(key)
                if found is None:
                    if len(known) >= 1 << 14:
                        known.clear()
                    found = m.score(t, f)
                    if len(key) <= 256:
                        known[key] = found
                scores.append(found[0])
                ids.append([x for x, _, _ in found[1]])
                labels.append([x for _, x, _ in found[1]])
                cosines.append([x for _, _, x in found[1]])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in ("doc", "held_out")), pa.array(scores, pa.float64()),
                 pa.array(ids, pa.list_(pa.int64())), pa.array(labels, pa.list_(pa.int32())), pa.array(cosines, pa.list_(pa.float64()))],
                ["doc", "held_out", "score", "near_ids", "near_labels", "near_cosines"])
    return run


def _pick_terms(examples: DataFrame, n: np.ndarray, max_terms: int, least_z: float) -> list[str]:
    """The terms that tell the labels apart best, by the z-score of two shares."""
    held = examples.mapInArrow(_example_terms, "term string, label int, n long").groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("n0"))
    share = (F.col("n0") + F.col("n1")) / float(n.sum())
    spread = F.sqrt(share * (1 - share) * float(1 / n[0] + 1 / n[1]))
    z = F.abs(F.col("n1") / float(n[1]) - F.col("n0") / float(n[0])) / spread
    best = held.filter(share < 1).withColumn("z", z).filter(F.col("z") >= least_z).orderBy(F.desc("z"), "term").limit(max_terms)
    return [r[0] for r in best.select("term").collect()]


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   examples: dict[int, int] | None = None, max_terms: int = MAX_TERMS, least_z: float = LEAST_Z,
                   k: int = NEIGHBOURS, threshold: float = 0.5) -> DataFrame:
    """``(id_col, held_out, score, predicted, near_ids, near_labels, near_cosines)`` for every row."""
    spark = docs.sparkSession
    small_batches(spark)
    bound = EXAMPLES if examples is None else examples
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).select(
        "doc", F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("version"), held_out(F.col("doc")).alias("held_out"), "text")
    marked = labels.select(F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("label")) \
        .filter("doc is not null and label in (0, 1)").groupBy("doc").agg(F.max("label").alias("label"))
    learn = marked.filter(~held_out(F.col("doc")))
    # Labelled rows by hash order, with the ids that have a document.
    chosen = write_step(source.select("doc", "version").join(learn, "doc").groupBy("doc").agg(
        F.min("version").alias("version"), F.max("label").alias("label")), "toxic-labelled")
    totals = {r[0]: r[1] for r in chosen.groupBy("label").count().collect()}
    total = np.array([totals.get(0, 0), totals.get(1, 0)], np.float64)
    prior = float(total[1] / total.sum()) if total.sum() else 0.0
    first = [chosen.filter(F.col("label") == x).orderBy(F.xxhash64(F.lit("examples"), "doc"), "doc").limit(bound[x]) for x in (0, 1)]
    picked = write_step(first[0].union(first[1]), "toxic-examples")
    n = np.minimum(total, [bound[0], bound[1]])
    names = []
    if n.min() > 0:
        texts = source.join(picked, ["doc", "version"]).select("doc", "label", "text")
        # An id with repeated rows is one example.
        names = _pick_terms(write_step(texts.dropDuplicates(["doc"]), "toxic-texts"), n, max_terms, least_z)
    vocabulary = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})
    vectors = write_step(source.mapInArrow(
        _vectors(vocabulary), "doc long, version long, held_out boolean, terms array<int>, tfs array<long>"), "toxic-vectors")
    model = _fit(vectors, picked, names, n, total, prior, k)
    # The vectors are few bytes and much work: spread by rows, not by size.
    tasks = tasks_for(spark, model.n_rows, ROWS_PER_TASK)
    scored = vectors.repartition(tasks, F.xxhash64("doc", "version")).mapInArrow(_scored(spark.sparkContext.broadcast(model)),
                                "doc long, held_out boolean, score double, near_ids array<long>, near_labels array<int>, "
                                "near_cosines array<double>")
    drop_step(chosen, picked)
    return scored.select(F.col("doc").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                         "near_ids", "near_labels", "near_cosines")


def _fit(vectors: DataFrame, picked: DataFrame, names: list[str], n: np.ndarray, total: np.ndarray, prior: float, k: int) -> Model:
    if not names:
        return Model(None, np.zeros(0), np.ones(2), prior, k)
    df = np.zeros(len(names))
    for t, c in vectors.mapInArrow(_frequencies(len(names)), "t int, n long").groupBy("t").agg(F.sum("n")).collect():
        df[t] = c
    n_rows = vectors.count()
    idf = np.log((1.0 + n_rows) / (1.0 + df)) + 1.0
    # At most the examples' bound times the vocabulary's.
    held = vectors.join(picked, ["doc", "version"]).select("doc", "label", "terms", "tfs").dropDuplicates(["doc"]).orderBy("doc").toArrow()
    ids, labels = held.column("doc").to_numpy(), held.column("label").to_numpy().astype(np.int64)
    lists = held.column("terms").combine_chunks()
    size = lists.value_lengths().to_numpy().astype(np.int64)
    terms = lists.flatten().to_numpy().astype(np.int64)
    tfs = held.column("tfs").combine_chunks().flatten().to_numpy()
    stop = np.concatenate([[0], np.cumsum(size)])
    weights = np.concatenate([np.zeros(0), *(unit_vector(terms[a:b], tfs[a:b], idf) for a, b in zip(stop[:-1], stop[1:], strict=True))])
    scale = total / n
    bare = size == 0
    alone = scale[labels[bare]]
    alone = float((alone[labels[bare] == 1].sum() + prior) / (alone.sum() + 1.0))
    if bare.all():
        return Model(None, idf, scale, alone, k)
    keep = np.flatnonzero(~bare)
    renamed = np.cumsum(~bare) - 1
    index = Index(ids[keep], labels[keep], renamed[np.repeat(np.arange(len(ids)), size)], terms, weights, len(names))
    model = Model(index, idf, scale, alone, k)
    model.n_rows = n_rows
    x, y, weight = [], [], []
    for i in keep.tolist():
        at = slice(stop[i], stop[i + 1])
        found = model.votes(terms[at], tfs[at], int(ids[i]))
        if found is not None:
            odds, near = found[2:]
            x.append((odds, near, odds * near))
            y.append(labels[i])
            weight.append(scale[labels[i]])
    if x:
        model.curve = fit_curve(np.array(x), np.array(y, np.float64), np.array(weight))
    return model


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The report of the registered query; ``evidence`` lists id:label:cosine of the neighbours."""
    one = F.transform(F.arrays_zip("near_ids", "near_labels", "near_cosines"), lambda x: F.format_string(
        "%d:%d:%.4f", x["near_ids"], x["near_labels"], x["near_cosines"]))
    return score_toxicity(docs, labels).select("doc_id", "held_out", "score", "predicted", F.array_join(one, ",").alias("evidence"))
