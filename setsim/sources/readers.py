"""Scans of the release extracts and readers of written outputs.

A *release* is a mapping ``table name -> DataFrame``: either the fixture
bindings, a directory of Parquet extracts (``read_release``) or JDBC tables.
All scans are plain projections so Catalyst prunes columns and pushes the
filters into the Parquet reader.  ``limit`` is honoured after ordering by the
table key, so "the first n rows" is deterministic.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim import schemas

# The projection of each release table, in the extract's order.
EXTRACT_COLUMNS = {
    "chembl_id_lookup": ["chembl_id", "entity_type", "entity_id", "status"],
    "molecule_dictionary": ["molregno", "chembl_id", "pref_name", "molecule_type", "max_phase",
                            "therapeutic_flag", "withdrawn_flag"],
    "compound_properties": ["molregno", "mw_freebase", "full_mwt", "alogp", "hba", "hbd", "psa",
                            "aromatic_rings", "heavy_atoms", "qed_weighted"],
    "compound_structures": ["molregno", "canonical_smiles", "standard_inchi", "standard_inchi_key"],
}
ORDER_KEY = {
    "chembl_id_lookup": "chembl_id",
    "molecule_dictionary": "molregno",
    "compound_properties": "molregno",
    "compound_structures": "molregno",
}


def _first(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    # ORDER BY + LIMIT plans as TakeOrderedAndProject: a bounded top-n per
    # partition, merged once; no global sort.
    return df if limit is None else df.orderBy(F.col(key).asc()).limit(int(limit))


def scan_extract(release: dict[str, DataFrame], table: str, limit: int | None = None) -> DataFrame:
    df = release[table].select(*EXTRACT_COLUMNS[table])
    if table == "compound_structures":
        df = df.filter(F.col("canonical_smiles").isNotNull())
    return _first(df, ORDER_KEY[table], limit)


def structures_with_ids(dictionary: DataFrame, structures: DataFrame) -> DataFrame:
    """Dictionary ⋈ structures on molregno, non-NULL structure only."""
    d = dictionary.select("molregno", "chembl_id")
    s = structures.select("molregno", "canonical_smiles").filter(F.col("canonical_smiles").isNotNull())
    return d.join(s, "molregno").select("chembl_id", "canonical_smiles")


def fetch_structures(dictionary: DataFrame, structures: DataFrame, limit: int | None = None,
                     ordered: bool = False) -> DataFrame:
    """``(chembl_id, canonical_smiles)`` of every structured molecule.

    The id order only matters when a prefix is asked for (``limit``), which
    plans as a bounded top-n.  A full ordered read (``ordered=True``) is a
    global range sort; downstream operators never need it.
    """
    df = structures_with_ids(dictionary, structures)
    if limit is not None:
        return _first(df, "chembl_id", limit)
    return df.orderBy("chembl_id") if ordered else df


def pull_sample(dictionary: DataFrame, structures: DataFrame, limit: int = 2000) -> DataFrame:
    """A sample of ``limit`` structured molecules (the first by id)."""
    return _first(structures_with_ids(dictionary, structures), "chembl_id", limit)


def fetch_structures_page(dictionary: DataFrame, structures: DataFrame, offset: int,
                          batch_size: int) -> DataFrame:
    """One id-ordered page (LIMIT/OFFSET).  For whole reads do not page:
    Spark's partitions already split the work."""
    df = structures_with_ids(dictionary, structures)
    return df.orderBy("chembl_id").offset(int(offset)).limit(int(batch_size))


RANGE = "_range"


@dataclass(frozen=True)
class PagedTable:
    """S7 through a count index: a table in key ranges, each a folder, with the
    rows and the first key of every range.  A page is found by its offset in the
    index; only the ranges it lies in are read and sorted."""

    table: DataFrame
    key: str
    index: tuple[tuple[int, int, object], ...]  # range, rows, first key

    def _rows(self, ranges: list[int], offset: int, size: int) -> DataFrame:
        near = self.table.filter(F.col(RANGE).isin(ranges) if ranges else F.lit(False)).drop(RANGE)
        return near.orderBy(self.key).offset(int(offset)).limit(int(size))

    def page(self, offset: int, size: int) -> DataFrame:
        ranges, first, start = [], 0, 0
        for number, rows, _ in self.index:
            if start < offset + size and start + rows > offset:
                first = first if ranges else start
                ranges.append(number)
            start += rows
        return self._rows(ranges, offset - first if ranges else 0, size)

    def after(self, last: object, size: int) -> DataFrame:
        """The page that follows the key ``last``, as far as the ranges that can hold it."""
        ranges, held = [], 0
        for i, (number, rows, _) in enumerate(self.index):
            upto = self.index[i + 1][2] if i + 1 < len(self.index) else None
            if (upto is None or last is None or upto > last) and held < size:
                # The first range may lie before ``last`` in part or whole.
                held += rows if ranges else 0
                ranges.append(number)
        near = self.table.filter(F.col(RANGE).isin(ranges) if ranges else F.lit(False)).drop(RANGE)
        return (near if last is None else near.filter(F.col(self.key) > F.lit(last))).orderBy(self.key).limit(int(size))


def open_paged(spark: SparkSession, path: str, key: str, schema: T.StructType) -> PagedTable:
    """The paged table at ``path``; its index is one row for each range."""
    table = spark.read.schema(T.StructType([*schema.fields, T.StructField(RANGE, T.IntegerType())])).parquet(path)
    index = table.groupBy(RANGE).agg(F.count(F.lit(1)).alias("rows"), F.min(key).alias("first")).orderBy(RANGE).collect()
    return PagedTable(table, key, tuple((r[RANGE], r["rows"], r["first"]) for r in index))


def write_paged(df: DataFrame, path: str, key: str, ranges: int) -> PagedTable:
    """Range-partition ``df`` by ``key`` (unique) into about ``ranges`` sorted folders."""
    placed = df.repartitionByRange(int(ranges), F.col(key).asc()).withColumn(RANGE, F.spark_partition_id())
    placed.sortWithinPartitions(RANGE, key).write.mode("overwrite").partitionBy(RANGE).parquet(path)
    return open_paged(df.sparkSession, path, key, df.schema)


def fetch_structures_after(dictionary: DataFrame, structures: DataFrame, last_id: str | None,
                           batch_size: int) -> DataFrame:
    """S7 by key: the page that follows ``last_id``.  Each task keeps one page at
    most, however far the reading has come (an offset keeps all rows before)."""
    df = structures_with_ids(dictionary, structures)
    if last_id is not None:
        df = df.filter(F.col("chembl_id") > last_id)
    return df.orderBy("chembl_id").limit(int(batch_size))


def read_parquet_columns(spark: SparkSession, path: str, columns: list[str],
                         schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan of chosen columns (the reader splits files into tasks)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).select(*columns)


def read_release(spark: SparkSession, input_dir: str) -> dict[str, DataFrame]:
    """A release stored as one Parquet dataset per table (as written by K3)."""
    return {name: spark.read.parquet(f"{input_dir.rstrip('/')}/{name}.parquet") for name in EXTRACT_COLUMNS}


def text_ranges(column: str, bounds: list[str]) -> list[str]:
    """Disjoint conditions on a text key that cover all its values, NULL too:
    one for each range between sorted ``bounds``."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in sorted(set(bounds))]
    if not quoted:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(quoted, quoted[1:], strict=False)]
    return [f"{column} < {quoted[0]} OR {column} IS NULL", *inner, f"{column} >= {quoted[-1]}"]


def read_release_jdbc(spark: SparkSession, url: str, properties: dict, key_bounds: dict[str, tuple[int, int]],
                      num_partitions: int = 64, schema_prefix: str = "",
                      lookup_bounds: list[str] | None = None) -> dict[str, DataFrame]:
    """A release served by a database: one partitioned JDBC read per table.

    Tables keyed by ``molregno`` are read as ``num_partitions`` parallel range
    queries over ``key_bounds[table] = (lower, upper)`` (Spark's
    ``partitionColumn`` reads); the id lookup, whose key is text, as one query
    for each range between ``lookup_bounds``.  Only the projected columns are
    fetched.  Not exercised by the tests: no database may be started in this
    environment.
    """
    out = {}
    for table, cols in EXTRACT_COLUMNS.items():
        name = f"{schema_prefix}{table}"
        if table in key_bounds:
            lo, hi = key_bounds[table]
            df = spark.read.jdbc(url, name, column="molregno", lowerBound=int(lo), upperBound=int(hi),
                                 numPartitions=int(num_partitions), properties=properties)
        else:
            df = spark.read.jdbc(url, name, predicates=text_ranges(ORDER_KEY[table], lookup_bounds or []),
                                 properties=properties)
        out[table] = df.select(*cols)
    return out


SAMPLE_COLUMNS = ["chembl_id", "canonical_smiles"]


@dataclass(frozen=True)
class CsvRows:
    """``good``: the named columns of the whole records; ``broken``: the text of
    the records whose number of fields is not the header's, or whose quotes do not close."""

    good: DataFrame
    broken: DataFrame


def read_csv_by_name(spark: SparkSession, path: str, columns: list[str], multi_line: bool = True) -> CsvRows:
    """The named columns of a CSV with a header, wherever they stand in it.

    Quotes are doubled inside quoted values (RFC 4180); a quoted value may span
    lines.  Values are text, unquoted empty ones NULL, white space kept.  A column
    that the header lacks is an error, and so is a folder whose files differ in
    their headers: values never end up under another name.  With ``multi_line`` a
    file is read by one task; without it Spark splits files, and a line break
    inside quotes breaks the record.
    """
    options = {"header": True, "multiLine": multi_line, "escape": '"', "ignoreLeadingWhiteSpace": False,
               "ignoreTrailingWhiteSpace": False}
    header = spark.read.options(**options).csv(path).columns
    if missing := [c for c in columns if c not in header]:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(header)}")
    record = "_record"
    while record in header:
        record += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, record]])
    # Without column pruning every field of a record is counted.
    rows = spark.read.options(**options, enforceSchema=False, columnPruning=False, mode="PERMISSIVE",
                              columnNameOfCorruptRecord=record).schema(schema).csv(path)
    # Spark reads no record text without one of the columns: a test that is always true names one.
    rows = rows.filter(F.coalesce(F.length(header[0]), F.lit(0)) >= 0)
    found = F.col(record).isNotNull()
    return CsvRows(rows.filter(~found).select(*columns), rows.filter(found).select(F.col(record).alias("record")))


def load_molecules_csv(spark: SparkSession, path: str) -> DataFrame:
    """The two sample columns, by name; broken records are left out
    (``read_csv_by_name`` gives them)."""
    return read_csv_by_name(spark, path, SAMPLE_COLUMNS).good


def preview_tables(release: dict[str, DataFrame], n: int = 5) -> DataFrame:
    """The first ``n`` whole rows (by key) of each table, one row for each
    value: table, row key, column, value as text (fractions to four places)."""
    parts = []
    for table, key in ORDER_KEY.items():
        top = _first(release[table], key, n)
        text = [F.col(f.name).cast("decimal(38,4)").cast("string") if isinstance(f.dataType, T.FractionalType)
                else F.col(f.name).cast("string") for f in top.schema.fields]
        values = F.array(*(F.struct(F.lit(f.name).alias("column_name"), v.alias("value"))
                           for f, v in zip(top.schema.fields, text, strict=True)))
        parts.append(top.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("row_key"), F.inline(values)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


__all__ = [
    "EXTRACT_COLUMNS", "ORDER_KEY", "fetch_structures", "fetch_structures_page",
    "CsvRows", "PagedTable", "load_molecules_csv", "open_paged", "preview_tables", "pull_sample", "read_csv_by_name",
    "read_parquet_columns", "read_release", "read_release_jdbc", "scan_extract", "structures_with_ids", "schemas",
    "write_paged",
]
