"""Substring dedup by recompression.

Token sequences are re-named in rounds: a maximal run of one symbol becomes a
symbol, then each pair of a "left" and a "right" symbol (a coin drawn from the
symbol's own hash) becomes a symbol.  Names are hashes of what they stand for,
so that every executor gives equal runs and pairs the same name.  A symbol
depends only on a known stretch of words, its context; two equal substrings
therefore hold the same symbols wherever a context lies inside them.

1. Every window of ``window`` words takes as its anchor one symbol whose context
   lies inside it (the largest by rank, then by hash, so equal windows take equal
   anchors).  Spark groups the anchors; one that only a single document holds
   rules its windows out.
2. Windows whose anchor is shared are verified by two 64-bit hashes of all their
   words; a window that a smaller document id holds too is marked.
3. Every word covered by a marked window is removed.

Each task first settles what it can see itself: an anchor or window that several
of its documents share goes out once, so that the rows of a hot passage grow
with the number of text slices and not with its documents.

Defined results: a null or empty text has no words; texts shorter than the
window keep all words; a row without an id neither loses words nor makes others
lose any; rows of equal id never remove each other's words; bytes that are not
valid UTF-8 are kept as they are; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setsim.llm.common import GAPS, WordHasher, drop_step, mix, multipliers, row_slices, signed, small_batches, write_step

WINDOW = 13
SLICE_BYTES = 3 << 20
_FAR = 1 << 40
TAG = (1 << 15) - 1


def default_rounds(window: int) -> int:
    """Rounds after which the contexts of most symbols still fit inside a window."""
    return max(1, int(np.log2(max(2, window / 3))))


class Symbols:
    """Symbols over a flat word array: name, span [s, e), context [cs, ce)."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        at = np.arange(len(words), dtype=np.int64)
        self.name, self.doc = words, doc
        self.s, self.e, self.cs, self.ce = at, at + 1, at, at + 1

    def _with_neighbours(self, first: np.ndarray, last: np.ndarray, left: np.ndarray, right: np.ndarray):
        """Contexts of groups [first, last] that also depend on the symbol
        before (``left``) or after (``right``); no symbol there: out of reach."""
        n = len(self.name)
        cs, ce = self.cs[first], self.ce[last]
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        has_b = (first > 0) & (self.doc[before] == self.doc[first])
        has_a = (last < n - 1) & (self.doc[after] == self.doc[last])
        cs = np.where(left, np.where(has_b, np.minimum(cs, self.cs[before]), -_FAR), cs)
        ce = np.where(right, np.where(has_a, np.maximum(ce, self.ce[after]), _FAR), ce)
        return cs, ce

    def _regroup(self, first, last, name, left, right) -> None:
        cs, ce = self._with_neighbours(first, last, left, right)
        self.name, self.s, self.e, self.cs, self.ce = name, self.s[first], self.e[last], cs, ce
        self.doc = self.doc[first]

    def name_runs(self, salt: int) -> None:
        same = (self.name[1:] == self.name[:-1]) & (self.doc[1:] == self.doc[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        last = np.concatenate([first[1:] - 1, [len(self.name) - 1]])
        length = (last - first + 1).astype(np.uint64)
        a, b = multipliers(2, 2 * salt)
        name = np.where(length > 1, mix(self.name[first] * a + length * b), self.name[first])
        every = np.ones(len(first), bool)
        self._regroup(first, last, name, every, every)

    def name_pairs(self, salt: int) -> None:
        n = len(self.name)
        a, b = multipliers(2, 2 * salt + 1)
        right = (mix(self.name * a + b) >> np.uint64(63)).astype(bool)
        joined = np.zeros(n, bool)  # with the next symbol
        joined[:-1] = ~right[:-1] & right[1:] & (self.doc[1:] == self.doc[:-1])
        second = np.zeros(n, bool)
        second[1:] = joined[:-1]
        first = np.flatnonzero(~second)
        pair = joined[first]
        last = first + pair
        name = np.where(pair, mix(self.name[first] * a + self.name[last] * b), self.name[first])
        # A lone left symbol depends on what follows, a lone right one on what precedes.
        self._regroup(first, last, name, ~pair & right[first], ~pair & ~right[first])


def anchors(words: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray, window: int,
            rounds: int) -> np.ndarray:
    """The anchor of the window at each word (0 where none starts).  ``doc`` is
    the owner of each word, [begin, end) its stretch of the array."""
    n = len(words)
    best = np.zeros(n, np.uint64)
    if not n:
        return best
    m = multipliers(window, window)
    level = Symbols(words, doc)
    for r in range(rounds):
        level.name_runs(r)
        level.name_pairs(r)
        cs, ce, of = level.cs, level.ce, level.doc
        fits = np.flatnonzero((cs >= begin[of]) & (ce <= end[of]) & (ce - cs <= window))
        cs, ce, of = cs[fits], ce[fits], of[fits]
        key = level.name[fits] + (level.s[fits] - cs).astype(np.uint64)
        for k in range(int((ce - cs).max(initial=0))):
            inside = ce - cs > k
            key[inside] += words[cs[inside] + k] * m[k]
        rank = np.uint64(2 * r + 2) + (level.e[fits] - level.s[fits] > 1).astype(np.uint64)
        key = (mix(key) >> np.uint64(4)) | (rank << np.uint64(60))
        low, high = np.maximum(ce - window, begin[of]), np.minimum(cs, end[of] - window)
        for k in range(window):
            p = low + k
            ok = p <= high
            np.maximum.at(best, p[ok], key[ok])
    starts = np.arange(n) + window <= end[doc]
    bare = np.flatnonzero(starts & (best == 0))
    if len(bare):
        best[bare] = (mix(words[bare[:, None] + np.arange(window)]) >> np.uint64(4)).max(axis=1) | np.uint64(1 << 60)
    return best


def _flat(texts: list[bytes | None], hashes: WordHasher):
    words, counts = hashes(texts)
    end = np.cumsum(counts)
    return words, np.repeat(np.arange(len(texts)), counts), end - counts, end


def _anchor_rows(window: int, rounds: int):
    """Rows (key, id, tag, first, count): ``count`` windows of a document from word
    ``first`` on with one anchor.  An anchor that documents of the slice share is
    settled: its rows are spread over other keys, and one row of the smallest id
    with no windows stands for them.  ``tag``: bits of the text's hash, which keep
    the texts of an id apart, and in the lowest bit whether the row is settled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHasher(GAPS)
        for batch, texts in row_slices(batches, "text", SLICE_BYTES):
            ids, version = (batch.column(batch.schema.names.index(c)).to_numpy() for c in ("id", "version"))
            words, doc, begin, end = _flat(texts, hashes)
            best = anchors(words, doc, begin, end, window, rounds)
            lead = np.flatnonzero((best != 0) & np.concatenate([[True], (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])])) \
                if len(best) else np.zeros(0, np.int64)
            # A stretch ends where the next one starts or where windows end.
            stop = np.minimum(np.concatenate([lead[1:], [len(best)]]), end[doc[lead]] - window + 1)
            key, owner = best[lead], doc[lead]
            order = np.lexsort((ids[owner], key))
            key, owner, first, count = key[order], owner[order], (lead - begin[doc[lead]])[order], (stop - lead)[order]
            who, text = ids[owner], version[owner] & TAG
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            group = np.cumsum(new) - 1
            head = np.flatnonzero(new)
            tail = np.concatenate([head[1:], [len(key)]]) - 1 if len(head) else head
            shared = (who[tail] != who[head])[group] if len(head) else np.zeros(0, bool)
            lone = head[shared[head]] if len(head) else head
            alone, lone_who, lone_first = key[lone], who[lone], first[lone]
            back = np.argsort(order)  # in text order the rows compress better
            key, who, text, first, count, shared = key[back], who[back], text[back], first[back], count[back], shared[back]
            spread = mix(who.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + first.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.concatenate([np.where(shared, spread, key), alone]))),
                 pa.array(np.concatenate([who, lone_who])),
                 pa.array(np.concatenate([text << 1 | shared, np.zeros(len(lone), np.int64)]).astype(np.int32)),
                 pa.array(np.concatenate([first, lone_first]).astype(np.int32)),
                 pa.array(np.concatenate([count, np.zeros(len(lone), np.int64)]).astype(np.int32))],
                ["key", "id", "tag", "first", "count"])
    return run


def _window_rows(window: int):
    """Rows (h1, h2, id, version, at, settled) of the candidate windows; a window
    that a smaller id of the slice holds is settled here."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHasher(GAPS)
        m1, m2 = multipliers(window, 1), multipliers(window, 2)
        for batch, texts in row_slices(batches, "text", SLICE_BYTES):
            get = lambda c: batch.column(batch.schema.names.index(c))  # noqa: E731, B023
            ids, version = get("id").to_numpy(), get("version").to_numpy()
            words, _, begin, end = _flat(texts, hashes)
            other = mix(words ^ np.uint64(0xD1B54A32D192ED03))
            ranges = get("ranges")
            row = np.repeat(np.arange(len(texts)), ranges.value_lengths().to_numpy())
            flat = ranges.flatten()
            first, count = flat.field("first").to_numpy().astype(np.int64), flat.field("count").to_numpy().astype(np.int64)
            # Ranges of another text under the same id and tag may reach past this one.
            count = np.clip(np.minimum(count, end[row] - begin[row] - window + 1 - first), 0, None)
            row = np.repeat(row, count)
            at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            start = begin[row] + at
            h1, h2 = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
            for k in range(window):
                h1 += words[start + k] * m1[k]
                h2 += other[start + k] * m2[k]
            h1, h2 = mix(h1), mix(h2)
            order = np.lexsort((at, ids[row], h2, h1))
            h1, h2, row, at = h1[order], h2[order], row[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            who = ids[row]
            settled = who != who[np.flatnonzero(new)][np.cumsum(new) - 1] if len(at) else new
            back = np.argsort(order)
            h1, h2, row, at, who, settled = h1[back], h2[back], row[back], at[back], who[back], settled[back]
            spread = mix(who.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.where(settled, spread, h1))), pa.array(signed(h2)), pa.array(who),
                 pa.array(version[row]), pa.array(at.astype(np.int32)), pa.array(settled)],
                ["h1", "h2", "id", "version", "at", "settled"])
    return run


def _cut(window: int, kept_cols: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in row_slices(batches, "text", SLICE_BYTES):
            marks = batch.column(batch.schema.names.index("marks")).to_pylist()
            n_words, n_removed, kept = [], [], []
            for raw, at in zip(texts, marks, strict=True):
                words = raw.split() if raw else []
                if at:
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, at, 1)
                    np.add.at(cover, np.asarray(at) + window, -1)
                    gone = np.cumsum(cover)[:-1] > 0
                    left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                else:
                    left = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.names.index(c)) for c in kept_cols), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                [*kept_cols, "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   rounds: int | None = None) -> DataFrame:
    """``(id_col, n_words, n_removed, kept)`` for every row; ``kept`` holds the
    words that stay, joined by one space.  Ids are whole numbers."""
    rounds = default_rounds(window) if rounds is None else rounds
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    named = source.filter("id is not null")
    anchored = named.mapInArrow(_anchor_rows(window, rounds),
                                "key bigint, id bigint, tag int, first int, count int")
    group = Window.partitionBy("key")
    ranges = write_step(
        anchored.withColumn("low", F.min("id").over(group)).withColumn("high", F.max("id").over(group))
        .filter("count > 0 and (tag % 2 = 1 or low <> high)")
        .groupBy("id", F.shiftright("tag", 1).cast("long").alias("tag")).agg(F.collect_list(F.struct("first", "count")).alias("ranges")), "repeats-ranges")
    windows = named.withColumn("tag", F.col("version").bitwiseAND(TAG)).join(ranges, ["id", "tag"]).select("id", "version", "text", "ranges").mapInArrow(
        _window_rows(window), "h1 bigint, h2 bigint, id bigint, version bigint, at int, settled boolean")
    marks = write_step(
        windows.withColumn("low", F.min("id").over(Window.partitionBy("h1", "h2")))
        .filter("settled or id > low")
        .groupBy("id", "version").agg(F.collect_set("at").alias("marks")), "repeats-marks")
    drop_step(ranges)
    return source.join(marks, ["id", "version"], "left").select(
        "id", "text", "marks").mapInArrow(_cut(window, ["id"]), "id bigint, n_words bigint, n_removed bigint, kept binary").select(
        F.col("id").alias(id_col), "n_words", "n_removed", F.col("kept").cast("string").alias("kept"))


def repeats_digest(docs: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
