"""Benchmark decontamination with one Aho-Corasick automaton.

Text is normalised to lower-cased words joined by single spaces; every run of
``window`` consecutive benchmark words (a shorter item whole) is one pattern,
padded with spaces so that it matches whole words only.  A document is scanned
once, and each match is mapped back to words and to code-point offsets of the
original text.

The benchmark is the small side by nature, yet its size is checked: Spark cuts the
items into patterns and deals these by hash to blocks of about
``max_pattern_bytes`` (an automaton takes some 45 times that).  One block is the
normal case; a larger benchmark is scanned block by block over written steps, with
the same results.  The driver holds one block at a time.

Defined results: a null or wordless text has no words and no hits; a null or
wordless item has no window; an item with a null id marks words but is not
listed; repeated items and repeated rows are each judged alone; an empty
benchmark hits nothing.  Extra columns pass through unless they carry one of
the result names, in which case the result replaces them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim.llm.common import row_slices, small_batches, write_step

WINDOW = 10
MAX_PATTERN_BYTES = 4 << 20

#: A-Z to a-z; every other ASCII character that is no letter or digit to space.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")
_RESULT = ("n_words", "n_hit", "items", "spans")


def item_windows(raw: bytes | None, window: int) -> list[bytes]:
    """The distinct windows of an item, in order."""
    words = raw.translate(_NORMAL).split() if raw else []
    if not words:
        return []
    spans = [words] if len(words) < window else [words[i:i + window] for i in range(len(words) - window + 1)]
    return list(dict.fromkeys(b" ".join(w) for w in spans))


def _windows(window: int):
    """Rows (gram, item): the windows of the items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in row_slices(batches, "text", 1 << 18):
            items, grams = [], []
            for item, raw in zip(batch.column(batch.schema.names.index("item")).to_pylist(), texts, strict=True):
                found = item_windows(raw, window)
                items += [item] * len(found)
                grams += found
            yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array(items, pa.string())], ["gram", "item"])
    return run


def pattern_table(benchmark: DataFrame, item_col: str, text_col: str, window: int, max_bytes: int) -> tuple[DataFrame, int]:
    """(gram, items, block) of the distinct windows, written, and the number of blocks."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    grams = write_step(rows.mapInArrow(_windows(window), "gram binary, item string").groupBy("gram").agg(
        F.array_sort(F.collect_set("item")).alias("items")), "patterns")
    size = F.length("gram") + 2 + 8 * F.size("items")
    n_blocks = -(-(grams.agg(F.sum(size)).first()[0] or 0) // max_bytes)
    return grams.withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(max(1, n_blocks)))), n_blocks


def patterns_of(grams: DataFrame, block: int) -> dict[str, tuple[int, tuple]]:
    """Pattern -> (number of words, item ids) of one block."""
    held = grams.filter(F.col("block") == block).select("gram", "items").toArrow()
    return {f" {g.decode('latin-1')} ": (g.count(b" ") + 1, tuple(ids))
            for g, ids in zip(held.column("gram").to_pylist(), held.column("items").to_pylist(), strict=True)}


def scan(raw: bytes | None, automaton) -> tuple[int, list[tuple[int, int]], list]:
    """Number of words, merged hit ranges of words, ids of the items found."""
    words = raw.translate(_NORMAL).split() if raw else []
    if not words or automaton is None:
        return len(words), [], []
    text = f" {b' '.join(words).decode('latin-1')} "
    found = list(automaton.iter(text))
    if not found:
        return len(words), [], []
    # A match ends on the space after its last word: count the spaces up to it.
    gaps = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
    ranges, items = [], {}
    for end, (n, ids) in found:
        last = int(np.searchsorted(gaps, end))  # words before this gap
        items.update(dict.fromkeys(ids))
        ranges.append((last - n, last))
    return len(words), merge(ranges), list(items)


def merge(ranges: list) -> list[tuple[int, int]]:
    """Sorted disjoint half-open ranges covering the given ones."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def original_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code-point offsets of the original text."""
    at = [m.span() for m in _WORD.finditer(raw.translate(_NORMAL))]
    # Continuation bytes 10xxxxxx carry no code point of their own.
    points = np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
    upto = lambda byte: int(points[byte - 1]) if byte else 0
    return [{"first_word": a, "last_word": b - 1, "start": upto(at[a][0]), "end": upto(at[b - 1][1])}
            for a, b in ranges]


SPANS = "array<struct<first_word:bigint,last_word:bigint,start:bigint,end:bigint>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       max_pattern_bytes: int = MAX_PATTERN_BYTES) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids, as text) and
    ``spans`` (hit ranges as words and as code points of the original)."""
    spark = docs.sparkSession
    small_batches(spark)
    grams, n_blocks = pattern_table(benchmark, item_col, item_text_col, window, max_pattern_bytes)
    out = docs.drop(*_RESULT)
    kept = out.columns
    schema = T.StructType(out.schema.fields + T._parse_datatype_string(
        f"n_words bigint, n_hit bigint, items array<string>, spans {SPANS}").fields)
    for k in range(max(1, n_blocks)):
        shared = spark.sparkContext.broadcast(patterns_of(grams, k) if n_blocks else {})
        out = out.mapInArrow(_scanner(shared, text_col, kept, k > 0), schema)
        if k + 1 < n_blocks:
            out = write_step(out, f"decontaminate-{k}")
            shared.unpersist()
    return out


def _scanner(shared, text_col: str, kept: list[str], again: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = None
        if shared.value:
            automaton = ahocorasick.Automaton()
            for key, value in shared.value.items():
                automaton.add_word(key, value)
            automaton.make_automaton()
        for batch, texts in row_slices(batches, text_col):
            names = batch.schema.names
            earlier = batch.column(names.index("spans")).to_pylist() if again else [[]] * len(texts)
            named = batch.column(names.index("items")).to_pylist() if again else [[]] * len(texts)
            n_words, n_hit, items, spans = [], [], [], []
            for raw, was, ids in zip(texts, earlier, named, strict=True):
                n, ranges, found = scan(raw, automaton)
                ranges = merge([*ranges, *((s["first_word"], s["last_word"] + 1) for s in was)])
                n_words.append(n)
                n_hit.append(sum(b - a for a, b in ranges))
                items.append(sorted({*ids, *map(str, found)}))
                spans.append(original_spans(raw, ranges) if ranges else [])
            span = pa.list_(pa.struct([(f, pa.int64()) for f in ("first_word", "last_word", "start", "end")]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(c)) for c in kept), pa.array(n_words, pa.int64()),
                 pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, span)],
                [*kept, *_RESULT])
    return run


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window (columns unchanged)."""
    return find_contamination(docs, benchmark).filter("n_hit = 0").select(docs.columns)
