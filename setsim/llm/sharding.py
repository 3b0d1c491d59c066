"""Sharding into byte-equal shards by histogram sort, with built-in functions only.

Rows are ordered by a key: a hash of the text, then a hash of the id, so that
equal texts stand together.  A small table of keys and sizes is written once;
each round counts the exact bytes and rows below the probes of every open
bracket (at most 2**16 probes in all) and narrows the brackets, until each
splitter is known.  A splitter stands between two texts where that meets the
tolerance; else, as inside a large group of copies, between two rows; and inside
a large group of rows equal in id and text after an exact number of them.  Rows
then cross the network once, straight to their place; only rows of groups that
are cut that way are written before, to be numbered: by the task that wrote them,
then within it, so that no task takes a whole group.

``parts_of`` cuts a shard into ranges of about ``part_bytes``, the tasks of that
exchange; slots stay gapless because the histograms count the rows below each
range.

Defined results: a null text has no bytes and hashes like the empty text; a null
id hashes like an empty one; rows equal in id and text share a key, and which of
them a splitter parts is open; an empty table gives an empty result; extra columns pass through
unless named like a result column, which replaces them.
"""

from __future__ import annotations

import json
import math
from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setsim.llm.common import write_step

N_SHARDS = 40
ROW_OVERHEAD = 16
#: Share of a mean shard by which a splitter may miss to keep equal texts together.
TOLERANCE = 0.02
PART_BYTES = 256 << 20
PROBE_BITS = 16
_BITS = 60
_RESULT = ("size", "shard", "slot")


@dataclass(frozen=True)
class Splitter:
    """Rows with (text_key, id_key) from (text, row) on lie to its right, without
    the first ``copies`` of those at (text, row)."""

    text: int
    row: int
    rows_below: int
    copies: int = 0


def _hash60(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with its size and key columns."""
    text, ident = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.drop(*_RESULT).withColumns({
        "size": (F.octet_length(text) + ROW_OVERHEAD).cast("long"), "_text_key": _hash60(text), "_id_key": _hash60(ident)})


@dataclass
class _Bracket:
    """Rows that share the first bits of a key; ``target`` falls among them."""

    target: int  # in bytes times the number of parts
    prefix: int
    bytes_below: int
    rows_below: int


def _narrow(rows: DataFrame, group: str | None, key: str, open_brackets: dict[int, list[_Bracket]], n_parts: int):
    """Histogram rounds over ``key`` within each group; yields (group, bracket,
    key value, bytes, rows) once a bracket holds one key value."""
    depth = 0
    state = [(g, b) for g, bs in open_brackets.items() for b in bs]
    while state:
        spots = {(g, b.prefix) for g, b in state}
        bits = min(_BITS - depth, max(1, PROBE_BITS - math.ceil(math.log2(len(spots)))))
        left = _BITS - depth - bits
        outer = F.shiftright(key, _BITS - depth) if depth else F.lit(0).cast("long")
        within = F.struct(F.col(group), outer).isin([F.struct(F.lit(g).cast("long"), F.lit(p).cast("long")) for g, p in spots]) \
            if group else outer.isin([p for _, p in spots])
        by = ([F.col(group).alias("g")] if group else [F.lit(0).cast("long").alias("g")])
        counted = rows.filter(within).groupBy(*by, F.shiftright(key, left).alias("p")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min(key).alias("least"), F.max(key).alias("most"))
        bins: dict = {}
        for r in counted.collect():  # at most 2**PROBE_BITS rows
            bins.setdefault((r["g"], r["p"] >> bits), []).append(r)
        # Bytes and rows up to each bin, once; each target then is a binary search.
        for held in bins.values():
            held.sort(key=lambda r: r["p"])
        upto = {k: (list(accumulate(r["bytes"] for r in held)), list(accumulate(r["n"] for r in held))) for k, held in bins.items()}
        following = []
        for g, b in state:
            held, (size, count) = bins[g, b.prefix], upto[g, b.prefix]
            i = bisect_right(size, b.target // n_parts - b.bytes_below)
            r = held[i]
            now = _Bracket(b.target, r["p"], b.bytes_below + size[i] - r["bytes"], b.rows_below + count[i] - r["n"])
            if r["least"] == r["most"]:
                yield g, now, r["least"], r["bytes"], r["n"]
            else:
                following.append((g, now))
        state = following
        depth += bits


def find_splitters(keys: DataFrame, n_parts: int, total: int, slack: float) -> list[Splitter]:
    """The ``n_parts - 1`` splitters; ``slack`` is the tolerance in bytes."""
    found, inside = [], {}
    start = [_Bracket(total * i, 0, 0, 0) for i in range(1, n_parts)]
    for _, b, value, size, n in _narrow(keys, None, "_text_key", {0: start}, n_parts):
        before, after = b.target - b.bytes_below * n_parts, (b.bytes_below + size) * n_parts - b.target
        if min(before, after) <= slack * n_parts:
            found.append(Splitter(value, -1, b.rows_below) if before <= after
                         else Splitter(value + 1, -1, b.rows_below + n))
        else:
            inside.setdefault(value, []).append(_Bracket(b.target, 0, b.bytes_below, b.rows_below))
    for text, b, value, size, n in _narrow(keys, "_text_key", "_id_key", inside, n_parts):
        before, after = b.target - b.bytes_below * n_parts, (b.bytes_below + size) * n_parts - b.target
        copies = 0 if before <= after else n
        if min(before, after) > slack * n_parts:
            copies = min(n, (2 * before * n + size * n_parts) // (2 * size * n_parts))  # the nearest row
        found.append(Splitter(text, value, b.rows_below + copies, copies) if copies < n
                     else Splitter(text, value + 1, b.rows_below + n))
    return sorted(found, key=lambda s: (s.text, s.row, s.copies))


def _lookup(spark, splitters: list[Splitter]) -> tuple[DataFrame, int]:
    """(spot, base, near): for each value of the first bits of the text key the
    number of splitters below and those inside, one row for about each splitter."""
    bits = math.ceil(math.log2(len(splitters) + 1)) + 1
    shift = _BITS - bits
    rows, base = [], 0
    by_spot: dict[int, list] = {}
    for s in splitters:
        by_spot.setdefault(s.text >> shift, []).append({"text": s.text, "row": s.row, "copies": s.copies})
    for spot in range(1 << bits):
        near = by_spot.get(spot, [])
        rows.append({"_spot": spot, "_base": base, "_near": near})
        base += len(near)
    schema = "array<struct<_spot:bigint,_base:int,_near:array<struct<text:bigint,row:bigint,copies:bigint>>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), schema))), shift


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_copy``: their place among the rows of their key, from 0."""
    # Written once, so that counts and numbers see the same rows in the same tasks.
    rows = write_step(rows.withColumns({"_task": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "shard-copies")
    key = ["_text_key", "_id_key"]
    counts = rows.groupBy(*key, "_task").count()  # one row for each key and task
    first = counts.withColumn("_first", F.sum("count").over(Window.partitionBy(*key).orderBy("_task")) - F.col("count"))
    own = Window.partitionBy(*key, "_task").orderBy("_at")
    return rows.join(first.drop("count"), [*key, "_task"]).withColumn("_copy", F.col("_first") + F.row_number().over(own) - 1)


def shard(docs: DataFrame, n_shards: int = N_SHARDS, *, id_col: str = "doc_id", text_col: str = "text",
          tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``; a task holds one range of
    one shard, in key order."""
    spark = docs.sparkSession
    keys = write_step(keyed(docs, id_col, text_col).select("_text_key", "_id_key", "size"), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts_of = max(1, -(-total // (n_shards * part_bytes)))
    n_parts = n_shards * parts_of
    splitters = find_splitters(keys, n_parts, total, tolerance * total / n_shards) if total else []
    lookup, shift = _lookup(spark, splitters)
    part = F.col("_base") + F.size(F.filter("_near", lambda s: (s["text"] < F.col("_text_key")) | (
        (s["text"] == F.col("_text_key")) & ((s["row"] < F.col("_id_key")) | (
            (s["row"] == F.col("_id_key")) & (s["copies"] <= F.col("_copy")))))))
    below = [0, *(s.rows_below for s in splitters), *([0] * (n_parts - 1 - len(splitters)))]
    offset = F.from_json(F.lit(json.dumps([b - below[k - k % parts_of] for k, b in enumerate(below)])), "array<bigint>")
    columns = [c for c in docs.columns if c not in _RESULT]
    placed = keyed(docs, id_col, text_col).withColumn("_spot", F.shiftright("_text_key", shift)) \
        .join(F.broadcast(lookup), "_spot")  # at most 4 rows a splitter
    if any(s.copies for s in splitters):
        cut = F.exists("_near", lambda s: (s["copies"] > 0) & (s["text"] == F.col("_text_key")) & (s["row"] == F.col("_id_key")))
        whole = placed.filter(~cut).withColumn("_copy", F.lit(0).cast("long"))
        placed = whole.unionByName(_numbered(placed.filter(cut)).select(whole.columns))
    else:
        placed = placed.withColumn("_copy", F.lit(0).cast("long"))
    placed = placed.withColumn("_part", part)
    order = Window.partitionBy("_part").orderBy("_text_key", "_id_key", "_copy")
    return placed.withColumn("slot", F.row_number().over(order) - 1).select(
        *columns, "size", F.floor(F.col("_part") / parts_of).cast("int").alias("shard"),
        (F.get(offset, F.col("_part")) + F.col("slot")).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, a file for each of its ranges."""
    sharded.write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame) -> DataFrame:
    """The per-document report of the registered query."""
    hashed = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    return shard(hashed).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                F.lit(None).cast("int").alias("grown_shard"))
