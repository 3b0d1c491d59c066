"""The DDL constraints as data jobs (Q1–Q5).

Each check is one aggregation pass per table and returns a small report
DataFrame; "fail" behaviour is the caller's decision (see ``enforce``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setsim.functions import key_filter
from setsim.schemas import ALL_TABLES, TableSpec


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def pk_violations(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = ALL_TABLES) -> DataFrame:
    """Q1: per keyed table, how many key values repeat and how many rows have a
    NULL key part.  Grouping by the key is a partial (map-side) count, so a
    hot key costs one counter, not one task's worth of rows."""
    out = []
    for name, df in tables.items():
        spec = specs[name]
        if not spec.key:
            continue
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.key])
        per_key = df.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(
            F.count(F.when((F.col("n") > 1) & ~any_null, 1)).cast("bigint").alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(any_null, F.col("n"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
        ).select(F.lit(name).alias("table_name"), "duplicate_keys", "null_key_rows"))
    return _union(out)


def not_null_violations(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = ALL_TABLES) -> DataFrame:
    """Q2: NULL count of every NOT NULL (or key) column, one pass per table."""
    out = []
    for name, df in tables.items():
        spec = specs[name]
        cols = [c.name for c in spec.columns if not c.nullable or c.name in spec.key]
        if not cols:
            continue
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).cast("bigint").alias(c) for c in cols])
        out.append(counts.unpivot([], cols, "column_name", "null_count")
                   .select(F.lit(name).alias("table_name"), "column_name", "null_count"))
    return _union(out)


def length_violations(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = ALL_TABLES) -> DataFrame:
    """Q4: values longer than their VARCHAR(n), per column, one pass per table."""
    out = []
    for name, df in tables.items():
        spec = specs[name]
        cols = [c for c in spec.columns if c.max_len is not None]
        if not cols:
            continue
        counts = df.agg(*[F.count(F.when(F.length(c.name) > c.max_len, 1)).cast("bigint").alias(c.name)
                          for c in cols])
        long_ = counts.unpivot([], [c.name for c in cols], "column_name", "too_long")
        limits = df.sparkSession.createDataFrame([(c.name, c.max_len) for c in cols],
                                                 "column_name string, max_length int")
        out.append(long_.join(limits, "column_name")
                   .select(F.lit(name).alias("table_name"), "column_name", "max_length", "too_long"))
    return _union(out)


def fk_violations(fact: DataFrame, dim: DataFrame, fact_rows: int | None = None) -> DataFrame:
    """Q3: fact rows whose source or target id is missing from the dimension.

    Each fact row is asked once for each role; one anti-join reads the
    dimension once, through a filter of the ids asked for, so that the dimension's
    other rows never leave its scan."""
    roles = F.array(*(F.struct(F.lit(c).alias("fk_column"), F.col(c).alias("chembl_id"))
                      for c in ("source_chembl_id", "target_chembl_id")))
    asked = fact.select("source_chembl_id", "target_chembl_id", F.inline(roles))
    can_match = key_filter(asked, "chembl_id", 2 * (fact.count() if fact_rows is None else fact_rows))
    known = dim.select("chembl_id").filter(can_match(F.col("chembl_id")))
    return asked.join(known, "chembl_id", "left_anti").select(
        "fk_column", "source_chembl_id", "target_chembl_id")


def enforce(report: DataFrame, count_col: str | None = None, what: str = "constraint") -> None:
    """Raise if a report has violations (rows, or a positive ``count_col``)."""
    bad = report if count_col is None else report.filter(F.col(count_col) > 0)
    if not bad.isEmpty():
        raise ValueError(f"{what} violated: {bad.limit(20).collect()}")
