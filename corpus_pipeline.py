"""The corpus pipeline: five stages over ``documents``, each one operator.

1. the quality classifier's rejects go (op 9);
2. of each group of near duplicates one document stays (the join of op 6, but on
   5-word shingles and from a Jaccard of 0.8: op 6's own numbers bind its query only);
3. documents that hold a benchmark window go (op 1);
4. sources are mixed to target weights, copies included (op 2);
5. what is left is put into shards (op 5).

A stage reads all rows its predecessor kept, as written Parquet, and returns the
columns of ``documents``; the last one adds ``size``, ``shard`` and ``slot``.
Labels and benchmark come from the same folder as the documents.  A stage is
judged on its own input: documents that an earlier one dropped are not looked at
again.  The quality model is fitted in Python, so no SQL expresses the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from setsim.llm import decontaminate, jaccard_join, mixing, quality, sharding
from setsim.llm.common import table, write_step

ORACLE_SQL = None
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs, width=NEAR_SHINGLE, percent=NEAR_PERCENT)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.remix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_clean),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_step(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
