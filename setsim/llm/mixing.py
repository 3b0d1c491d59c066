"""Mixing sources to target weights by Poisson replication.

A source of ``size`` bytes and weight ``w`` has the mean repetition rate
``w * total / size`` (sizes are UTF-8 bytes and one more for each row).  Each row
inverts the Poisson distribution of its source's rate at a uniform number hashed
from seed, id and text, is repeated that often, and all copies are shuffled
globally by a second hash.  Rows equal in id and text are numbered, by task and
then within it, and all but the first hash their number too: each has a draw and
places of its own.  The outcome depends on the rows and the seed alone.

Without given weights a source weighs ``size ** alpha``; given weights are
scaled to sum to one over the sources at hand, and a source without one weighs 0.

Defined results: null sources are one source, null texts have no bytes; a null id
hashes like an empty one; which of the rows equal in id and text has which number
is open; a rate of 0 drops its source (that is its weight); an empty table gives
an empty result; extra columns pass through unless named ``copy`` or
``shuffle_key``, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setsim.llm.common import write_step

SEED = 17
ALPHA = 0.5
_RESULT = ("copy", "shuffle_key")


def _hash52(value: Column) -> Column:
    return F.conv(F.substring(F.md5(value), 1, 13), 16, 10).cast("long")


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """The distribution function from the first count that matters on: a uniform
    ``u`` stands for ``low`` and as many more as steps are at most ``u``."""
    if rate <= 0:
        return 0, []
    reach = 12 * rate ** 0.5 + 30
    low = max(0, int(rate - reach))
    k = np.arange(low, int(rate + reach) + 1)
    log_p = k * np.log(rate) - rate - np.array([lgamma(i + 1) for i in k])
    steps = np.cumsum(np.exp(log_p))
    return low, steps[:1 + int(np.searchsorted(steps, 1 - 2.0 ** -53))].tolist()


def rates(docs: DataFrame, source_col: str, text_col: str, weights: dict[str, float] | None, alpha: float,
          epochs: float) -> DataFrame:
    """(source, rate, low, steps) for each source; written, so that its size is
    known to the planner that may broadcast it."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
    sizes = write_step(docs.groupBy(F.col(source_col).alias("_mix_source")).agg(F.sum(size).alias("size")), "mix-sizes")
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(alpha))
    else:
        pairs = [F.lit(v) for kv in weights.items() for v in (kv[0], float(kv[1]))]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce("_mix_source", F.lit("\0"))), F.lit(0.0))
    weighed = sizes.withColumn("weight", weight)
    total, scale = weighed.agg(F.sum("size"), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(float(scale or 1)) * F.lit(float((total or 0) * epochs)) / F.col("size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [poisson_steps(r) for r in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int32()),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))], ["_mix_source", "_rate", "_low", "_steps"])

    kind = sizes.schema["_mix_source"].dataType.simpleString()
    return write_step(weighed.select("_mix_source", rate.alias("_rate")).mapInArrow(
        run, f"_mix_source {kind}, _rate double, _low int, _steps array<double>"), "mix-rates")


def mix_sources(docs: DataFrame, *, weights: dict[str, float] | None = None, alpha: float = ALPHA, epochs: float = 1.0,
                seed: int = SEED, source_col: str = "source", id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The copies of ``docs``, globally shuffled, with ``copy`` (from 1) and
    ``shuffle_key``, by which each task's rows are sorted."""
    columns = [c for c in docs.columns if c not in _RESULT]
    per_source = rates(docs, source_col, text_col, weights, alpha, epochs)
    # The columns of the input as one struct: none of its names can meet ours.
    rows = docs.select(F.struct(*columns).alias("row"))
    source, ident, text = (F.col("row").getField(c) for c in (source_col, id_col, text_col))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(ident.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    named = _numbered(rows.withColumn("name", name))
    named = named.withColumn("name", F.when(F.col("nth") > 0, F.concat_ws(":", "name", (F.col("nth") + 1).cast("string")))
                             .otherwise(F.col("name")))
    uniform = _hash52("name") / F.lit(float(1 << 52))
    drawn = named.withColumn("u", uniform).join(per_source, source.eqNullSafe(F.col("_mix_source"))).withColumn(
        "times", F.col("_low") + F.size(F.filter("_steps", lambda s: s <= F.col("u"))))
    copies = drawn.filter("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    key = _hash52(F.concat_ws(":", "name", F.col("copy").cast("string"))).alias("shuffle_key")
    return copies.select("row.*", "copy", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``nth``: 0, and from 1 on for the further rows of a name.  Only
    rows whose name repeats are written and numbered."""
    first = F.lit(0).cast("long")
    repeats = write_step(rows.groupBy(F.xxhash64("name").alias("mark")).count().filter("count > 1").select("mark"), "mix-repeats")
    if repeats.isEmpty():
        return rows.withColumn("nth", first)
    marked = rows.withColumn("mark", F.xxhash64("name"))
    single = marked.join(repeats, "mark", "left_anti").withColumn("nth", first)
    # Written once, so that counts and numbers see the same rows in the same tasks.
    again = write_step(marked.join(repeats, "mark", "left_semi").withColumns(
        {"task": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "mix-again")
    counts = again.groupBy("name", "task").count()  # one row for each name and task
    before = counts.withColumn("before", F.sum("count").over(Window.partitionBy("name").orderBy("task")) - F.col("count"))
    within = F.row_number().over(Window.partitionBy("name", "task").orderBy("place"))
    numbered = again.join(before.drop("count"), ["name", "task"]).withColumn("nth", F.col("before") + within - 1)
    return single.unionByName(numbered.select(single.columns))


def remix(docs: DataFrame) -> DataFrame:
    """The mixed copies with the columns of ``docs``."""
    return mix_sources(docs).select([c for c in docs.columns if c not in _RESULT])
