"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the fixture bindings of ``sf_dir``.

Expensive intermediates (the fingerprint table, the fact table, the
dimension) are written once per application and data directory under the
shared checkpoint folder and read back by every query that needs them — the
same "fingerprint once, reuse" shape the refresh job has.  Output columns are
aliased to the names of the SQL oracles; arrays are rendered as comma-joined
text and averages rounded to 10 places so that values compare exactly.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setsim import fixtures, schemas
from setsim.functions import bits_to_text
from setsim.operators import conform, fingerprint, mart, quality, similarity
from setsim.plans.oracle import PIVOT_IDS
from setsim.plans.refresh import full_refresh
from setsim.session import app_id, materialize, scratch_path, table_path, tasks_for
from setsim.sources import readers, writers

COUNT = similarity.DEFAULT_SOURCE_COUNT
K = similarity.DEFAULT_K
N_BITS = fingerprint.DEFAULT_N_BITS
# Size of the sample and of its CSV; below the rows of the test tables, so that
# the limit and its order show.
SAMPLE = 500


class Workspace:
    """Lazily built, written-once intermediates for one (application, data dir)."""

    _lock = threading.Lock()
    _cache: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.release = fixtures.raw_release(spark, sf_dir)
        self._made: dict[str, DataFrame] = {}
        self._building = threading.RLock()
        self.n_fingerprints: int | None = None

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        key = (app_id(spark), os.path.abspath(sf_dir))
        with cls._lock:
            if key not in cls._cache:
                cls._cache[key] = Workspace(spark, sf_dir)
            return cls._cache[key]

    # -- written once ---------------------------------------------------------
    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._building:
            if name not in self._made:
                self._made[name] = build()
            return self._made[name]

    def bronze(self, name: str) -> DataFrame:
        """The conformed table, written and checked as a whole."""
        return self._once(f"bronze-{name}", lambda: conform.load_table(
            self.release[name], schemas.BRONZE[name], scratch_path(self.spark, f"bronze-{name}"))[0])

    @property
    def structures(self) -> DataFrame:
        return readers.fetch_structures(self.bronze("molecule_dictionary"), self.bronze("compound_structures"))

    def tasks(self) -> int:
        return tasks_for(self.spark, self.bronze("compound_structures").count(), fingerprint.ROWS_PER_TASK)

    def fingerprints(self) -> DataFrame:
        def build() -> DataFrame:
            path = scratch_path(self.spark, "fingerprints")
            self.n_fingerprints, _ = writers.export_fingerprints(self.structures, path, partitions=self.tasks())
            return self.spark.read.schema(schemas.FINGERPRINTS).parquet(path)
        return self._once("fingerprints", build)

    def packed(self) -> DataFrame:
        return self._once("packed", lambda: similarity.packed_table(self.fingerprints(), N_BITS))

    def sources(self) -> DataFrame:
        return self._once("sources", lambda: materialize(
            similarity.select_source_molecules(self.packed(), COUNT), "sources"))

    def top_k(self) -> DataFrame:
        return similarity.compute_top_k(self.sources(), self.packed(), K, n_targets=self.n_fingerprints)

    def fact(self) -> DataFrame:
        return self._once("fact", lambda: mart.write_fact_similarity(
            self.top_k(), scratch_path(self.spark, "fact"))[0])

    def dim(self) -> DataFrame:
        return self._once("dim", lambda: materialize(mart.populate_dim_molecule(
            self.bronze("molecule_dictionary"), self.bronze("compound_properties"),
            self.bronze("compound_structures")), "dim"))

    def quality_tables(self) -> dict[str, DataFrame]:
        return {
            "chembl_id_lookup": self.bronze("chembl_id_lookup"),
            "molecule_dictionary": self.bronze("molecule_dictionary"),
            "compound_properties": self.bronze("compound_properties"),
            "compound_structures": self.bronze("compound_structures"),
            "dim_molecule": self.dim(),
            "fact_similarity": self.fact(),
        }


def _ws(spark, sf_dir) -> Workspace:
    return Workspace.get(spark, sf_dir)


def _text_bits(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, bits_to_text(fingerprint.BITS_COL).alias(fingerprint.BITS_COL))


def _r10(c: str) -> F.Column:
    return F.round(F.col(c), 10).alias(c)


# -- sources ------------------------------------------------------------------

def q_scan(table: str):
    return lambda spark, d: readers.scan_extract(_ws(spark, d).release, table)


def q_sample_structures(spark, d):
    ws = _ws(spark, d)
    return readers.pull_sample(ws.bronze("molecule_dictionary"), ws.bronze("compound_structures"), SAMPLE)


def q_fetch_structures(spark, d):
    return _ws(spark, d).structures


def q_structures_page(spark, d):
    """A page by offset, through the count index of the table in key ranges."""
    ws = _ws(spark, d)
    paged = readers.write_paged(ws.structures, scratch_path(spark, "structures_paged"), "chembl_id", ws.tasks())
    return paged.page(offset=100, size=500)


def q_structures_offset(spark, d):
    """The same page by sorting everything before it."""
    ws = _ws(spark, d)
    return readers.fetch_structures_page(ws.bronze("molecule_dictionary"), ws.bronze("compound_structures"),
                                         offset=100, batch_size=500)


def q_structures_after(spark, d):
    ws = _ws(spark, d)
    return readers.fetch_structures_after(ws.bronze("molecule_dictionary"), ws.bronze("compound_structures"),
                                          "P1500", batch_size=300)


def q_csv_roundtrip(spark, d):
    path = writers.save_csv(q_sample_structures(spark, d), scratch_path(spark, "sample_csv"))
    return readers.load_molecules_csv(spark, path)


def _csv_by_name(spark, d) -> readers.CsvRows:
    """A folder of CSV files with other columns and another order than asked for,
    and records whose unquoted commas break them."""
    rows = fixtures.binding(spark, d, "csv_records")
    path = scratch_path(spark, "csv_by_name")
    names = [c for c in rows.columns if c != "broken"]
    writers.save_csv(rows.filter("not broken").select(*names), path)
    # Written as one column, a record is not quoted.
    record = F.translate(F.concat_ws(",", *names), "\n", " ").alias(",".join(names))
    rows.filter("broken").select(record).write.mode("append").options(**writers.CSV_OPTIONS).option("sep", ";").csv(path)
    return readers.read_csv_by_name(spark, path, readers.SAMPLE_COLUMNS)


def q_csv_by_name(spark, d):
    return _csv_by_name(spark, d).good


def q_csv_quarantine(spark, d):
    return _csv_by_name(spark, d).broken


def q_preview_tables(spark, d):
    ws = _ws(spark, d)
    ingested = {t: readers.scan_extract(ws.release, t) for t in readers.EXTRACT_COLUMNS}
    return readers.preview_tables(ingested, 5)


# -- sinks / loads --------------------------------------------------------------

def q_parquet_roundtrip(spark, d):
    path = writers.save_to_parquet(_ws(spark, d).bronze("molecule_dictionary"),
                                   scratch_path(spark, "roundtrip"), "molecule_dictionary.parquet")
    return spark.read.parquet(path)


def q_ingest_counts(spark, d):
    report = writers.run_ingestion(_ws(spark, d).release, scratch_path(spark, "ingested"))
    return spark.createDataFrame([(f, int(n)) for f, (_, n) in report.items()], "file_name string, row_count bigint")


def q_bronze(table: str):
    return lambda spark, d: _ws(spark, d).bronze(table)


def q_bronze_counts(spark, d):
    _, counts = conform.run_load(_ws(spark, d).release, scratch_path(spark, "bronze"))
    return spark.createDataFrame([(t, int(n)) for t, n in counts.items()], "table_name string, row_count bigint")


def q_dim_molecule(spark, d):
    return _ws(spark, d).dim()


def q_load_drop_dictionary(spark, d):
    """A load that drops what breaks a constraint: repeated keys and missing ids."""
    raw = fixtures.binding(spark, d, "raw_dictionary_with_faults")
    path = scratch_path(spark, "bronze-dropped")
    return conform.load_table(raw, schemas.MOLECULE_DICTIONARY, path, on_violation="drop")[0]


def q_load_audit(spark, d):
    """What the loads counted while they wrote: the faulty dictionary with its
    repeated keys dropped, and the structures."""
    release = {"molecule_dictionary": fixtures.binding(spark, d, "raw_dictionary_with_faults"),
               "compound_structures": _ws(spark, d).release["compound_structures"]}
    return conform.audit_report(spark, {
        n: conform.load_audited(raw, schemas.BRONZE[n], scratch_path(spark, f"audit-{n}"), on_violation="drop")
        for n, raw in release.items()})


def q_fact_similarity(spark, d):
    return _ws(spark, d).fact()


def q_topk_similarity(spark, d):
    return _ws(spark, d).top_k()


def q_fingerprints_export(spark, d):
    ws = _ws(spark, d)
    path = scratch_path(spark, "fingerprints_export")
    writers.export_fingerprints(ws.structures, path, partitions=ws.tasks())
    return _text_bits(spark.read.schema(schemas.FINGERPRINTS).parquet(path), "chembl_id")


def q_full_similarity_partitioned(spark, d):
    ws = _ws(spark, d)
    path = scratch_path(spark, "full_similarity")
    writers.write_full_similarity(ws.sources(), ws.packed(), path, COUNT, ws.n_fingerprints)
    return spark.read.schema(schemas.FULL_SCORES).parquet(path)


def q_full_similarity_clustered(spark, d):
    ws = _ws(spark, d)
    path = scratch_path(spark, "full_similarity_clustered")
    writers.write_full_similarity(ws.sources(), ws.packed(), path, COUNT, ws.n_fingerprints, layout="clustered")
    return spark.read.schema(schemas.FULL_SCORES).parquet(path)


def q_add_missing_column(spark, d):
    props = _ws(spark, d).bronze("compound_properties").drop("full_mwt")
    out = conform.add_column_if_missing(props, "full_mwt", schemas.COMPOUND_PROPERTIES.col("full_mwt").dtype)
    return out.select(*schemas.COMPOUND_PROPERTIES.names)


# -- quality --------------------------------------------------------------------

def q_pk_violations(spark, d):
    t = _ws(spark, d).quality_tables()
    t.pop("chembl_id_lookup")
    return quality.pk_violations(t)


def q_not_null_violations(spark, d):
    t = _ws(spark, d).quality_tables()
    t.pop("chembl_id_lookup")
    return quality.not_null_violations(t)


def q_fk_violations(spark, d):
    ws = _ws(spark, d)
    return quality.fk_violations(ws.fact(), ws.dim())


def q_length_violations(spark, d):
    t = _ws(spark, d).quality_tables()
    t.pop("compound_properties")
    return quality.length_violations(t)


# -- fingerprints -------------------------------------------------------------------

def q_string_fingerprint(spark, d):
    return _text_bits(fingerprint.string_fingerprint(_ws(spark, d).structures), "chembl_id")


def q_fingerprint_structures(spark, d):
    return _text_bits(_ws(spark, d).fingerprints(), "chembl_id")


def q_fingerprint_rolling(spark, d):
    ws = _ws(spark, d)
    return _text_bits(fingerprint.fingerprint_structures(ws.structures, partitions=ws.tasks(), method="rolling"), "chembl_id")


def q_fingerprint_failures(spark, d):
    return fingerprint.fingerprint_counts(_ws(spark, d).structures)


def q_fingerprint_bit_counts(spark, d):
    return fingerprint.bit_counts(_ws(spark, d).fingerprints())


def q_fingerprint_documents(spark, d):
    """Whole texts through the ring windows, the longest ones too."""
    docs = spark.read.parquet(table_path(d, "documents"))
    return _text_bits(fingerprint.string_fingerprint(docs, "doc_id", "text").withColumnRenamed("chembl_id", "doc_id"), "doc_id")


def q_graph_fingerprint(spark, d):
    nodes, edges = fixtures.graph_inputs(spark, d, keep=materialize)
    return _text_bits(fingerprint.graph_fingerprint(nodes, edges), "graph_id")


# -- search -------------------------------------------------------------------------

def q_tanimoto_pairs(spark, d):
    pairs = fixtures.binding(spark, d, "compare_pairs")
    return similarity.compare_pairs(pairs, _ws(spark, d).fingerprints())


def q_select_sources(spark, d):
    return _ws(spark, d).sources().select("chembl_id")


def q_full_similarity(spark, d):
    ws = _ws(spark, d)
    return similarity.compute_full_similarity(ws.sources(), ws.packed(), n_targets=ws.n_fingerprints)


def q_topk_single_source(spark, d):
    return similarity.top_k_single_source(_ws(spark, d).packed(), 5)


def q_sample_csv_top5(spark, d):
    """The sample flow end to end: sample -> CSV -> read -> fingerprint ->
    top 5 of the first sampled record among the rest of the sample."""
    path = writers.save_csv(q_sample_structures(spark, d), scratch_path(spark, "sample_flow_csv"))
    sample = readers.load_molecules_csv(spark, path)
    fps = fingerprint.fingerprint_structures(sample)
    return similarity.top_k_single_source(fps, 5)


# -- views ------------------------------------------------------------------------

def q_avg_similarity_per_source(spark, d):
    return mart.avg_similarity_per_source(_ws(spark, d).fact()).select(
        "source_chembl_id", _r10("avg_similarity_score"))


def q_avg_alogp_deviation_per_source(spark, d):
    ws = _ws(spark, d)
    return mart.avg_alogp_deviation_per_source(ws.fact(), ws.dim()).select(
        "source_chembl_id", _r10("avg_alogp_deviation"))


def q_similarity_pivot(spark, d):
    return mart.similarity_pivot(_ws(spark, d).fact(), PIVOT_IDS)


def q_published_pivot(spark, d):
    """The pivot as the published table that later sessions read."""
    ws = _ws(spark, d)
    mart.create_views(ws.fact(), ws.dim(), PIVOT_IDS, scratch_path(spark, "views"))
    return spark.table("similarity_pivot")


def q_similarity_chain(spark, d):
    return mart.similarity_chain(_ws(spark, d).fact())


def q_similarity_two_hop(spark, d):
    ws = _ws(spark, d)
    return mart.similarity_two_hop(ws.fact(), ws.packed())


def q_avg_similarity_grouped(spark, d):
    ws = _ws(spark, d)
    return mart.avg_similarity_grouped(ws.fact(), ws.dim()).select(
        "source_chembl_id", "aromatic_rings_plus_heavy_atoms", "heavy_atoms", _r10("avg_similarity_score"))


# -- end to end -----------------------------------------------------------------------

def q_refresh_report(spark, d):
    res = full_refresh(spark, _ws(spark, d).release, fk_mode="drop")
    return res.report(spark)


def _refreshed(spark, d):
    """A refresh of a release whose ids look like numbers: six digits or more, never
    cut (a plain ``lpad`` takes 100000 and 1000001 for one id)."""
    ws = _ws(spark, d)
    digits = F.col("molregno").cast("string")

    def build() -> DataFrame:
        release = dict(ws.release)
        release["molecule_dictionary"] = release["molecule_dictionary"].withColumn(
            "chembl_id", F.lpad(digits, F.greatest(F.length(digits), F.lit(6)), F.lit("0")))
        ws.refreshed = full_refresh(spark, release, fk_mode="drop")
        return ws.refreshed.tables["gold.fact_similarity"]
    return ws._once("refresh", build), ws


def q_refresh_fact(spark, d):
    return _refreshed(spark, d)[0]


def q_refresh_full_similarity(spark, d):
    return _refreshed(spark, d)[1].refreshed.tables["full_similarity"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_id_lookup": q_scan("chembl_id_lookup"),
        "scan_dictionary": q_scan("molecule_dictionary"),
        "scan_properties": q_scan("compound_properties"),
        "scan_structures": q_scan("compound_structures"),
        "sample_structures": q_sample_structures,
        "fetch_structures": q_fetch_structures,
        "structures_page": q_structures_page,
        "structures_offset": q_structures_offset,
        "structures_after": q_structures_after,
        "csv_roundtrip": q_csv_roundtrip,
        "csv_by_name": q_csv_by_name,
        "csv_quarantine": q_csv_quarantine,
        "preview_tables": q_preview_tables,
        "parquet_roundtrip": q_parquet_roundtrip,
        "ingest_counts": q_ingest_counts,
        "bronze_id_lookup": q_bronze("chembl_id_lookup"),
        "bronze_dictionary": q_bronze("molecule_dictionary"),
        "bronze_properties": q_bronze("compound_properties"),
        "bronze_structures": q_bronze("compound_structures"),
        "bronze_counts": q_bronze_counts,
        "load_drop_dictionary": q_load_drop_dictionary,
        "load_audit": q_load_audit,
        "dim_molecule": q_dim_molecule,
        "fact_similarity": q_fact_similarity,
        "fingerprints_export": q_fingerprints_export,
        "full_similarity_partitioned": q_full_similarity_partitioned,
        "full_similarity_clustered": q_full_similarity_clustered,
        "add_missing_column": q_add_missing_column,
        "pk_violations": q_pk_violations,
        "not_null_violations": q_not_null_violations,
        "fk_violations": q_fk_violations,
        "length_violations": q_length_violations,
        "string_fingerprint": q_string_fingerprint,
        "fingerprint_documents": q_fingerprint_documents,
        "graph_fingerprint": q_graph_fingerprint,
        "fingerprint_structures": q_fingerprint_structures,
        "fingerprint_rolling": q_fingerprint_rolling,
        "fingerprint_failures": q_fingerprint_failures,
        "fingerprint_bit_counts": q_fingerprint_bit_counts,
        "tanimoto_pairs": q_tanimoto_pairs,
        "select_sources": q_select_sources,
        "full_similarity": q_full_similarity,
        "topk_similarity": q_topk_similarity,
        "topk_single_source": q_topk_single_source,
        "sample_csv_top5": q_sample_csv_top5,
        "avg_similarity_per_source": q_avg_similarity_per_source,
        "avg_alogp_deviation_per_source": q_avg_alogp_deviation_per_source,
        "similarity_pivot": q_similarity_pivot,
        "published_pivot": q_published_pivot,
        "similarity_chain": q_similarity_chain,
        "similarity_two_hop": q_similarity_two_hop,
        "avg_similarity_grouped": q_avg_similarity_grouped,
        "refresh_report": q_refresh_report,
        "refresh_fact": q_refresh_fact,
        "refresh_full_similarity": q_refresh_full_similarity,
    }
