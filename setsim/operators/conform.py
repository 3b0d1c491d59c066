"""Conformed loads into the bronze layer (L1–L6) and schema evolution.

The reference moves each extract through CSV into a typed store; the typing
rules that survive that trip are applied here as column expressions:

* every empty string becomes NULL (so do NULL and NaN; whitespace stays),
* listed columns are whole numbers: ``24.0 -> 24``, a fraction is an error,
* every whole-number target takes whole numbers only, keys included,
* VARCHAR(n), NOT NULL and the key are constraints: ``fail`` (error, the
  store's behaviour), ``drop`` (remove the row) or ``report`` (leave it; see
  ``quality``).

A load is a projection and one write into a fresh path; a truncate is the
overwrite itself.  A table with a key is shuffled once, by that key: into
buckets, each sorted by the key.  That one pass does three things.  Rows of one
key stand side by side, so repeats are counted as they are written; NOT NULL,
VARCHAR(n) and key counts are metrics of the write (``Loaded.audit``), so that
nothing written is scanned again; and joins on the key find both tables laid out
alike and exchange no rows (``attach`` declares the layout in a later session).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim import schemas
from setsim.functions import blank_to_null, nan_to_null, strict_whole_number
from setsim.operators import quality
from setsim.schemas import TableSpec
from setsim.session import default_parallelism, tasks_for
from setsim.sources.writers import _join, run_concurrently

ON_VIOLATION = ("fail", "drop", "report")
ROWS_PER_BUCKET = 1_000_000


def _conform_column(df: DataFrame, spec: TableSpec, name: str) -> Column:
    col = spec.col(name)
    src_type = df.schema[name].dataType
    c = F.col(name)
    if isinstance(src_type, T.StringType):
        c = blank_to_null(c)
    elif isinstance(src_type, (T.DoubleType, T.FloatType)):
        c = nan_to_null(c)
    whole = name in spec.int_columns or isinstance(col.dtype, T.IntegralType)
    if whole and isinstance(src_type, T.FractionalType):
        return strict_whole_number(c, col.dtype, f"{spec.name}.{name}")
    return c.cast(col.dtype)


def _violation(raw: DataFrame, spec: TableSpec) -> Column | None:
    """A boolean over the raw columns, true where a row breaks NOT NULL or VARCHAR(n)."""
    checks = []
    for c in spec.columns:
        value = _conform_column(raw, spec, c.name)
        if not c.nullable:
            checks.append(value.isNull())
        if c.max_len is not None:
            checks.append(F.coalesce(F.length(value) > c.max_len, F.lit(False)))
    return reduce(lambda a, b: a | b, checks) if checks else None


def _fraction(raw: DataFrame, spec: TableSpec) -> Column | None:
    """True where a whole-number column holds a fraction."""
    checks = [F.coalesce(F.col(c.name) != F.floor(c.name), F.lit(False)) for c in spec.columns
              if isinstance(c.dtype, T.IntegralType) and isinstance(raw.schema[c.name].dataType, T.FractionalType)]
    return reduce(lambda a, b: a | b, checks) if checks else None


def conform(raw: DataFrame, spec: TableSpec, on_violation: str = "fail") -> DataFrame:
    """L1: project to the table's columns and apply the load typing rules.  In
    every mode a fraction in a whole-number column is an error."""
    if on_violation not in ON_VIOLATION:
        raise ValueError(f"on_violation must be one of {ON_VIOLATION}")
    bad, fraction = _violation(raw, spec), _fraction(raw, spec)
    # A filter on every checked column: no projection or count above it can
    # prune it, and it raises on the first offending row, like the store.
    def broken(what: str) -> Column:
        return F.raise_error(F.lit(f"{what} in {spec.name}")).cast("boolean")

    if fraction is not None:
        raw = raw.filter(F.when(fraction, broken("non-integral value")).otherwise(F.lit(True)))
    if bad is not None and on_violation == "drop":
        raw = raw.filter(~bad)
    if bad is not None and on_violation == "fail":
        raw = raw.filter(F.when(bad, broken("constraint violated")).otherwise(F.lit(True)))
    return raw.select(*[_conform_column(raw, spec, n).alias(n) for n in spec.names])


def _one_row_per_key(table: DataFrame, spec: TableSpec) -> DataFrame:
    """The smallest row of each key (combined before the shuffle) and, as ``_n``,
    the number of its rows."""
    rest = [n for n in spec.names if n not in spec.key]
    return table.groupBy(*spec.key).agg(F.min(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n")).select(
        *spec.key, "_row.*", "_n").select(*spec.names, "_n")


def _numbered(table: DataFrame, spec: TableSpec) -> DataFrame:
    """As ``_n`` 2 on the second row of each key, found beside the first one."""
    nth = F.row_number().over(Window.partitionBy(*spec.key).orderBy(*spec.key))
    return table.withColumn("_n", F.least(nth, F.lit(3)))


@dataclass(frozen=True)
class Loaded:
    """A written table, its row count and what the write counted: ``rows``,
    ``duplicate_keys``, ``null_key_rows``, ``null:<column>``, ``long:<column>``."""

    table: DataFrame
    rows: int | None
    path: str | None = None
    buckets: int | None = None
    audit: dict[str, int] = field(default_factory=dict)


def _metrics(spec: TableSpec, repeats: Column | None) -> list[Column]:
    def counted(when: Column, name: str) -> Column:
        return F.count(F.when(when, 1)).alias(name)

    out = [F.count(F.lit(1)).alias("rows")]
    out += [counted(F.col(c.name).isNull(), f"null:{c.name}") for c in spec.columns if not c.nullable or c.name in spec.key]
    out += [counted(F.length(c.name) > c.max_len, f"long:{c.name}") for c in spec.columns if c.max_len is not None]
    if repeats is not None:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.key])
        out += [counted(repeats & ~null_key, "duplicate_keys"), counted(null_key, "null_key_rows")]
    return out


def table_name(spec: TableSpec) -> str:
    """A fresh name in the session's catalog for a bucketed table of ``spec``."""
    return f"setsim_{spec.name}_{uuid.uuid4().hex[:12]}"


def attach(spark: SparkSession, spec: TableSpec, path: str, buckets: int) -> DataFrame:
    """The bucketed table that an earlier session wrote to ``path``, layout declared."""
    name, keys = table_name(spec), ", ".join(spec.key)
    columns = ", ".join(f"{c.name} {c.dtype.simpleString()}" for c in spec.columns)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path.replace(chr(39), chr(92) + chr(39))}'")
    return spark.table(name)


def reopen(spark: SparkSession, spec: TableSpec, path: str, buckets: int | None) -> DataFrame:
    """A table that an earlier load wrote, bucketed or not."""
    return attach(spark, spec, path, buckets) if buckets else spark.read.schema(spec.struct).parquet(path)


def load_audited(raw: DataFrame, spec: TableSpec, path: str, on_violation: str = "fail",
                 buckets: int | None = None) -> Loaded:
    """L1 with the write, in one pass.  ``fail`` raises on a key that repeats,
    ``drop`` keeps one row of each key, ``report`` keeps all rows: there one key may
    hold most of them, so that the table is written as it comes, without buckets,
    and its keys are counted by an aggregate afterwards."""
    spark = raw.sparkSession
    table = conform(raw, spec, on_violation)
    bucketed = bool(spec.key) and on_violation != "report"
    repeats, n = None, None
    if bucketed:
        n = buckets or default_parallelism(spark)
        if on_violation == "drop":
            table, repeats = _one_row_per_key(table, spec).repartition(n, *spec.key), F.col("_n") > 1
        else:
            table, repeats = _numbered(table.repartition(n, *spec.key), spec), F.col("_n") == 2
    observation = Observation(f"load_{spec.name}")
    observed = table.observe(observation, *_metrics(spec, repeats)).select(*spec.names)
    writer = observed.write.mode("overwrite").format("parquet")
    if bucketed:
        name = table_name(spec)
        writer.option("path", path).bucketBy(n, *spec.key).sortBy(*spec.key).saveAsTable(name)
        written = spark.table(name)
    else:
        writer.save(path)
        written = spark.read.schema(observed.schema).parquet(path)
    audit = {k: int(v) for k, v in observation.get.items()}
    if spec.key and not bucketed:
        audit |= quality.pk_violations({spec.name: written}, {spec.name: spec}).drop("table_name").first().asDict()
    if on_violation == "fail" and audit.get("duplicate_keys"):
        raise ValueError(f"primary key of {spec.name} violated: {audit['duplicate_keys']} keys repeat")
    return Loaded(written, audit["rows"], path, n, audit)


def load_table(raw: DataFrame, spec: TableSpec, path: str | None = None, on_violation: str = "fail",
               buckets: int | None = None) -> tuple[DataFrame, int | None]:
    """L1: ``(table, rows)`` of the written table; without a path the rows as they
    would be written, not counted, keys unchecked."""
    if path is None:
        table = conform(raw, spec, on_violation)
        return _one_row_per_key(table, spec).drop("_n") if spec.key and on_violation == "drop" else table, None
    done = load_audited(raw, spec, path, on_violation, buckets)
    return done.table, done.rows


def audit_report(spark: SparkSession, loaded: dict[str, Loaded]) -> DataFrame:
    """``(table_name, check_name, column_name, violations)``: Q1, Q2 and Q4 as the
    loads counted them, without reading a table."""
    rows = []
    for name, done in loaded.items():
        for key, count in done.audit.items():
            if key != "rows":
                check, _, column = key.partition(":")
                rows.append((name, {"null": "not_null", "long": "length"}.get(check, check), column or None, count))
    return spark.createDataFrame(rows, "table_name string, check_name string, column_name string, violations bigint")


def load_chembl_id_lookup(raw: DataFrame, **kw) -> DataFrame:
    """L2 (whole-number column: entity_id)."""
    return conform(raw, schemas.ID_LOOKUP, **kw)


def load_molecule_dictionary(raw: DataFrame, **kw) -> DataFrame:
    """L3 (whole-number columns: therapeutic_flag, withdrawn_flag)."""
    return conform(raw, schemas.MOLECULE_DICTIONARY, **kw)


def load_compound_properties(raw: DataFrame, **kw) -> DataFrame:
    """L4 (whole-number columns: hba, hbd, aromatic_rings, heavy_atoms)."""
    return conform(raw, schemas.COMPOUND_PROPERTIES, **kw)


def load_compound_structures(raw: DataFrame, **kw) -> DataFrame:
    """L5 (no whole-number columns)."""
    return conform(raw, schemas.COMPOUND_STRUCTURES, **kw)


LOADERS = {
    "chembl_id_lookup": load_chembl_id_lookup,
    "molecule_dictionary": load_molecule_dictionary,
    "compound_properties": load_compound_properties,
    "compound_structures": load_compound_structures,
}


def run_load_audited(release: dict[str, DataFrame], output_dir: str, on_violation: str = "fail",
                     rows: dict[str, int] | None = None) -> dict[str, Loaded]:
    """Load all four tables.  ``rows``, where known, sizes the buckets; the
    tables that share the key share their number, so that joins line up."""
    spark = next(iter(release.values())).sparkSession
    keyed = [rows[n] for n in LOADERS if schemas.BRONZE[n].key] if rows else []
    buckets = tasks_for(spark, max(keyed), ROWS_PER_BUCKET) if keyed else None

    def one(name: str) -> tuple[str, Loaded]:
        return name, load_audited(release[name], schemas.BRONZE[name], _join(output_dir, name), on_violation, buckets)

    # Independent tables: their write jobs run concurrently.
    return dict(run_concurrently(one, list(LOADERS)))


def run_load(release: dict[str, DataFrame], output_dir: str | None = None,
             on_violation: str = "fail") -> tuple[dict[str, DataFrame], dict[str, int | None]]:
    """L6 as tables and row counts (none without an output folder)."""
    if output_dir is None:
        return {n: load_table(release[n], schemas.BRONZE[n], None, on_violation)[0] for n in LOADERS}, dict.fromkeys(LOADERS)
    done = run_load_audited(release, output_dir, on_violation)
    return {n: x.table for n, x in done.items()}, {n: x.rows for n, x in done.items()}


def add_column_if_missing(df: DataFrame, name: str, dtype: T.DataType) -> DataFrame:
    """``ADD COLUMN IF NOT EXISTS`` — a NULL column when absent, else unchanged."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(None).cast(dtype))
