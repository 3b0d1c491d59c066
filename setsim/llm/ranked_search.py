"""Ranked lexical search, term-at-a-time over short lists and document-at-a-time
over long ones.

The score is an integer BM25: a term's weight is floor(1000 ln((2N+2)/(2df+1))),
a posting adds ``weight * ((10**9 tf) div (1000 tf + 8 m))`` with a length norm
``m = 25 + (75 n N) div L``.  N, L and df are exact counts over all documents.

1. One scan of the texts writes a row for each document: its number of terms and
   the query terms it holds, with their occurrences.
2. N and L, then df of the query terms, are counted from that table.
3. A task turns its rows into posting lists, slice by slice, and answers every
   item against them.  The item's short lists are summed into accumulators (term
   at a time); they become one iterator with a bound for each block of documents.
   The walk over documents reads a long list only where the accumulator plus the
   long lists' block maxima can still reach the k-th best score, which a task
   carries from slice to slice.
4. Spark ranks the k best of the tasks.

Items travel to the tasks in blocks of ``ITEM_BYTES`` of distinct terms; each
block is a scan of its own.

Defined results: null, empty and term-less texts are no documents of the
statistics and are never found; a row without an id counts in the statistics but
is never found; rows that repeat an id are documents of their own; an item
without an id or without terms finds nothing; texts of items that repeat an id
are one item (equal texts once); ties go to the smaller id; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setsim.llm.common import drop_step, row_slices, small_batches, write_step

K = 10
#: Distinct terms of the items that one scan looks for, in bytes with ids.
ITEM_BYTES = 4 << 20
#: Documents of a slice, and of a block that has one maximum for each long list.
SLICE_DOCS = 1 << 16
BLOCK_DOCS = 1 << 10
#: A list is long from one posting in so many documents of the slice on.
LONG_SHARE = 32
SLICE_POSTINGS = 1 << 22
_CHUNK = 1 << 20

#: A-Z to a-z; other ASCII bytes than letters and digits to a space.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                   for c in range(256))


def term_chunks(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, about a MiB of it at a time."""
    folded, start = (text or b"").translate(TERM_BYTES), 0
    while start < len(folded):
        stop = folded.find(b" ", start + _CHUNK)
        stop = len(folded) if stop < 0 else stop
        yield folded[start:stop].split()
        start = stop


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in row_slices(batches, "text"):
        ids = batch.column(batch.schema.names.index("item")).to_pylist()
        for item, text in zip(ids, texts, strict=True):
            found = Counter()
            for terms in term_chunks(text):
                found.update(terms)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(found), pa.int64()), pa.array(list(found), pa.binary()),
                 pa.array(list(found.values()), pa.int64())], ["item", "term", "tf"])


def _documents(terms):
    """Rows (doc, n, terms, tfs) of the documents with at least one term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(terms.value)}
        for batch, texts in row_slices(batches, "text"):
            ids = batch.column(batch.schema.names.index("doc")).to_pylist()
            docs, sizes, keys, counts = [], [], [], []
            for doc, text in zip(ids, texts, strict=True):
                found, n = Counter(), 0
                for chunk in term_chunks(text):
                    n += len(chunk)
                    found.update(map(number.get, chunk))
                if n:
                    found.pop(None, None)
                    docs.append(doc)
                    sizes.append(n)
                    keys.append(list(found))
                    counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], ["doc", "n", "terms", "tfs"])
    return run


def length_norms(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each length; through whole numbers of any size where 64 bits are too few."""
    if 75 * int(n.max(initial=0)) * n_docs < 1 << 63:
        return 25 + (75 * n * n_docs) // n_terms
    return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n], np.int64)


class Slice:
    """Posting lists over the documents of a slice, with block maxima of the long ones."""

    def __init__(self, ids, owner, term, impact):
        order = np.argsort(term, kind="stable")
        self.ids, self.doc, self.impact = ids, owner[order], impact[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.first = np.append(first, len(term))
        self.n_blocks = -(-len(ids) // BLOCK_DOCS)
        self.place = {int(t): j for j, t in enumerate(self.terms)}
        self.maxima = {}
        for j in np.flatnonzero(np.diff(self.first) * LONG_SHARE >= max(len(ids), BLOCK_DOCS)).tolist():
            docs, impact = self.posting(j)
            top = np.zeros(self.n_blocks, np.int64)
            blocks, start = np.unique(docs // BLOCK_DOCS, return_index=True)
            top[blocks] = np.maximum.reduceat(impact, start)
            self.maxima[j] = top

    def posting(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.first[j], self.first[j + 1])
        return self.doc[at], self.impact[at]


def _accumulate(lists) -> tuple[np.ndarray, np.ndarray]:
    """The short lists as one: documents in order and their sums."""
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc, impact = np.concatenate([d for d, _ in lists]), np.concatenate([s for _, s in lists])
    order = np.argsort(doc, kind="stable")
    doc, first = np.unique(doc[order], return_index=True)
    return doc, np.add.reduceat(impact[order], first)


def search(part: Slice, item: list[tuple[int, int]], bar: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the slice (positions) with at least ``bar``, all that can be
    among the k best, with their scores.  ``item``: (term, occurrences)."""
    short, long = [], []
    for term, times in item:
        j = part.place.get(term)
        if j is not None:
            docs, impact = part.posting(j)
            if j in part.maxima:
                long.append((int(part.maxima[j].max()) * times, docs, impact * times, part.maxima[j] * times))
            else:
                short.append((docs, impact * times))
    doc, score = _accumulate(short)
    if len(score) >= k:
        bar = max(bar, int(np.partition(score, len(score) - k)[len(score) - k]))
    if not long:
        keep = score >= max(bar, 1)
        return doc[keep], score[keep]
    long.sort(key=lambda x: -x[0])
    ceiling = np.sum([top for *_, top in long], axis=0)  # of the long lists, for each block

    # Documents that the accumulators name: read on only while they can reach the bar.
    left, owed = np.arange(len(doc)), ceiling[doc // BLOCK_DOCS]
    for _, docs, impact, top in long:
        alive = score[left] + owed[left] >= bar
        left = left[alive]
        at = np.searchsorted(docs, doc[left])
        held = (at < len(docs)) & (docs[np.minimum(at, len(docs) - 1)] == doc[left])
        score[left[held]] += impact[at[held]]
        owed[left] -= top[doc[left] // BLOCK_DOCS]
    found_doc, found = doc[left], score[left]
    if len(found) >= k:
        bar = max(bar, int(np.partition(found, len(found) - k)[len(found) - k]))
    out = [(found_doc, found)]

    # Documents of the long lists alone, in the blocks whose maxima reach the bar.
    for b in np.flatnonzero(ceiling >= max(bar, 1)).tolist():
        if ceiling[b] < bar:
            continue
        low, high = b * BLOCK_DOCS, (b + 1) * BLOCK_DOCS
        total = np.zeros(BLOCK_DOCS, np.int64)
        for _, docs, impact, _ in long:
            x, y = np.searchsorted(docs, (low, high))
            total[docs[x:y] - low] += impact[x:y]
        x, y = np.searchsorted(doc, (low, high))
        total[doc[x:y] - low] = 0
        some = np.flatnonzero(total >= max(bar, 1))
        out.append((some + low, total[some]))
        if len(some) >= k:
            bar = max(bar, int(np.partition(total[some], len(some) - k)[len(some) - k]))
    doc, score = np.concatenate([d for d, _ in out]), np.concatenate([s for _, s in out])
    keep = score >= max(bar, 1)
    return doc[keep], score[keep]


def _slices(batches: Iterator[pa.RecordBatch]):
    """Rows of a task in slices of bounded documents and postings."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        start = 0
        sizes = np.cumsum(batch.column(batch.schema.names.index("terms")).value_lengths().to_numpy())
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = min(start + SLICE_DOCS - docs, int(np.searchsorted(sizes, done + SLICE_POSTINGS - postings, "right")))
            stop = min(batch.num_rows, max(stop, start + (docs == 0)))
            held.append(batch.slice(start, stop - start))
            docs, postings = docs + stop - start, postings + int(sizes[stop - 1] - done if stop > start else 0)
            start = stop
            if start < batch.num_rows or docs >= SLICE_DOCS or postings >= SLICE_POSTINGS:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def _best(query, n_docs: int, n_terms: int, k: int):
    """The k best documents of each item among the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, items = query.value
        best = {item: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for item in items}
        for rows in _slices(batches):
            ids = rows.column("doc").to_numpy()
            m = length_norms(rows.column("n").to_numpy(), n_docs, n_terms)
            terms, tfs = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
            owner = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy())
            term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            part = Slice(ids, owner, term, weight[term] * ((10 ** 9 * tf) // (1000 * tf + 8 * m[owner])))
            for item, wanted in items.items():
                doc, score = best[item]
                at, more = search(part, wanted, int(score[-1]) if len(score) == k else 0, k)
                if len(at):
                    doc, score = np.concatenate([doc, ids[at]]), np.concatenate([score, more])
                    order = np.lexsort((doc, -score))[:k]
                    best[item] = doc[order], score[order]
        n = [len(doc) for doc, _ in best.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(list(best), np.int64), n)),
             pa.array(np.concatenate([d for d, _ in best.values()] or [np.zeros(0, np.int64)])),
             pa.array(np.concatenate([s for _, s in best.values()] or [np.zeros(0, np.int64)]))],
            ["item_id", "doc_id", "score"])
    return run


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = K, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")) \
        .filter("item is not null").distinct()
    pairs = write_step(asked.mapInArrow(_item_terms, "item long, term binary, tf long")
                       .groupBy("item", "term").agg(F.sum("tf").alias("tf")), "search-items")
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    size = pairs.agg(F.coalesce(F.sum(F.length("term") + 16), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = None
    for b in range(n_blocks):
        mine = pairs.filter(block == b)
        if n_blocks > 1 and (mine.agg(F.sum(F.length("term") + 16)).first()[0] or 0) > 8 * ITEM_BYTES:
            raise ValueError(f"an item holds over {7 * ITEM_BYTES} bytes of terms")
        held = mine.toArrow()
        names, term = np.unique(np.array(held.column("term").to_pylist(), object), return_inverse=True) \
            if held.num_rows else (np.zeros(0, object), np.zeros(0, np.int64))
        known = spark.sparkContext.broadcast(names.tolist())
        postings = write_step(source.mapInArrow(_documents(known), "doc long, n long, terms array<int>, tfs array<long>"),
                              "search-postings")
        total = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weight = np.array([term_weight(total[0], df[t]) if t in df else 0 for t in range(len(names))], np.int64)
        wanted: dict[int, list[tuple[int, int]]] = {}
        for item, t, times in zip(held.column("item").to_pylist(), term.tolist(), held.column("tf").to_pylist(), strict=True):
            if weight[t]:
                wanted.setdefault(item, []).append((t, times))
        query = spark.sparkContext.broadcast((weight, wanted))
        best = write_step(postings.filter("doc is not null").mapInArrow(
            _best(query, total[0], max(1, total[1]), k), "item_id long, doc_id long, score long"), "search-best")
        drop_step(postings)
        found = best if found is None else found.union(best)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")
