"""End-to-end full refresh (E1) and its row-count report.

Order of jobs (each a Spark job; the scheduler of the reference is not
rebuilt): ingest -> bronze -> dimension -> fingerprints (once, written) ->
full score tables -> top-k fact -> views.  Every intermediate is a written
table in a fresh folder under ``out_dir`` (default: the shared checkpoint
directory), which both cuts lineage and lets a lost executor be recovered
from files instead of recomputation.

A step that is done leaves an entry in the run's ledger: its parameters, row
counts and where its tables are.  ``resume=True`` takes up the run that was
started last below ``out_dir``, if it is unfinished and had the same parameters:
steps in the ledger are read back, the first one missing runs.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from setsim import schemas
from setsim.operators import conform, fingerprint, mart, quality, similarity
from setsim.session import materialize, scratch_path, tasks_for
from setsim.sources import readers, writers


@dataclass
class RefreshResult:
    out_dir: str
    counts: dict[str, int] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    views: dict[str, DataFrame] = field(default_factory=dict)
    fingerprint_failures: int = 0
    fk_violations: int = 0
    seconds: dict[str, float] = field(default_factory=dict)
    audits: dict[str, conform.Loaded] = field(default_factory=dict)
    resumed: list[str] = field(default_factory=list)

    @contextmanager
    def timed(self, step: str):
        t0 = time.perf_counter()
        try:
            yield
        finally:
            self.seconds[step] = round(time.perf_counter() - t0, 3)

    def report(self, spark: SparkSession) -> DataFrame:
        """``(table_name, row_count)`` of every output."""
        rows = [(k, int(v)) for k, v in self.counts.items()]
        return spark.createDataFrame(rows, "table_name string, row_count bigint")


CURRENT = "CURRENT"
STARTED = "STARTED"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside its place and renamed over it."""
    target, fs = _fs(spark, path)
    fresh, _ = _fs(spark, f"{path}-{uuid.uuid4().hex[:12]}")
    out = fs.create(fresh)
    out.write(bytearray(text.encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(fresh), fs.makeQualified(target), overwrite)


def _read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    where, fs = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, base: str, run: str) -> None:
    """Point readers of ``base`` to the finished folder ``run``."""
    _write_text(spark, writers._join(base, CURRENT), run)


class Ledger:
    """The finished steps of one run, a small file each below its folder."""

    def __init__(self, spark: SparkSession, out: str, res: RefreshResult):
        self.spark, self.folder, self.res = spark, writers._join(out, "_ledger"), res

    def step(self, name: str, work: Callable[[], dict]) -> dict:
        """What ``work`` returned (JSON), now or in the run taken up."""
        path = writers._join(self.folder, f"{name}.json")
        done = _read_text(self.spark, path)
        if done is not None:
            self.res.resumed.append(name)
            return json.loads(done)
        with self.res.timed(name):
            found = work()
        _write_text(self.spark, path, json.dumps(found))
        return found


def _start(spark: SparkSession, base: str, params: str, resume: bool) -> str:
    """The run to fill: the last one started, if it is to be taken up, or a fresh one."""
    last = _read_text(spark, writers._join(base, STARTED)) if resume else None
    if last is not None:
        run, _, before = last.partition("\n")
        if before == params and run != _read_text(spark, writers._join(base, CURRENT)):
            return run
    run = f"refresh-{uuid.uuid4().hex[:12]}"
    _write_text(spark, writers._join(base, STARTED), f"{run}\n{params}")
    return run


def full_refresh(spark: SparkSession, release: dict[str, DataFrame], out_dir: str | None = None,
                 count: int = similarity.DEFAULT_SOURCE_COUNT, k: int = similarity.DEFAULT_K,
                 radius: int = fingerprint.DEFAULT_RADIUS, n_bits: int = fingerprint.DEFAULT_N_BITS,
                 pivot_ids: list[str] | None = None, on_violation: str = "fail",
                 fk_mode: str = "fail", full_tables: bool = True, method: str = "md5",
                 valid_pattern: str | None = None, limit: int | None = None, resume: bool = False) -> RefreshResult:
    """Run the whole refresh; returns counts, written tables and views.

    Each refresh writes a fresh folder below ``out_dir``; readers find the last
    finished one by ``current_refresh``, which changes only at the very end, so
    a refresh that fails leaves the tables before it untouched and together.

    ``fk_mode``: ``fail`` raises if a fact row's source or target is missing
    from the dimension (the store's FK), ``drop`` removes such rows before
    the fact is written, ``report`` keeps them and counts them.  ``limit``
    takes the first rows of each extract, for trial runs.  ``resume`` takes up
    an unfinished run of the same parameters over the same release.
    """
    base = out_dir or scratch_path(spark, "refresh")
    params = json.dumps([count, k, radius, n_bits, pivot_ids, on_violation, fk_mode, full_tables, method, valid_pattern, limit,
                         {name: df.schema.json() for name, df in sorted(release.items())}])
    out = writers._join(base, _start(spark, base, params, resume))
    res = RefreshResult(out)
    ledger, join = Ledger(spark, out, res), writers._join

    # K3: extract the release.
    ingest = ledger.step("ingest", lambda: {
        name: rows for name, (_, rows) in writers.run_ingestion(release, join(out, "ingested"), limit).items()})
    res.counts.update({f"ingested/{name}": rows for name, rows in ingest.items()})

    # Conformed bronze tables, checked as they are written, bucketed by their key.
    def load() -> dict:
        res.audits = conform.run_load_audited(
            readers.read_release(spark, join(out, "ingested")), join(out, "bronze"), on_violation,
            {name.removesuffix(".parquet"): rows for name, rows in ingest.items()})
        return {n: [x.rows, x.path, x.buckets, x.audit] for n, x in res.audits.items()}

    loaded = ledger.step("load_bronze", load)
    if not res.audits:
        res.audits = {n: conform.Loaded(conform.reopen(spark, schemas.BRONZE[n], path, buckets), rows, path, buckets, audit)
                      for n, (rows, path, buckets, audit) in loaded.items()}
    bronze = {n: x.table for n, x in res.audits.items()}
    res.counts.update({f"bronze.{n}": x.rows for n, x in res.audits.items()})
    res.tables.update({f"bronze.{n}": t for n, t in bronze.items()})
    md, cp, cs = bronze["molecule_dictionary"], bronze["compound_properties"], bronze["compound_structures"]

    # Dimension.
    dim_path = join(out, "gold/dim_molecule")
    dim = spark.read.schema(schemas.DIM_MOLECULE.struct)

    def dimension() -> dict:
        rows = writers.write_counted(mart.populate_dim_molecule(md, cp, cs), dim_path)
        if on_violation == "fail":
            _check_table("dim_molecule", dim.parquet(dim_path))
        return {"rows": rows}

    res.counts["gold.dim_molecule"] = ledger.step("dim_molecule", dimension)["rows"]
    dim = res.tables["gold.dim_molecule"] = dim.parquet(dim_path)

    # F3 + K4, once: every later step reads the written fingerprints or their
    # packed words, written once too.  Without any, the tables after are empty.
    fp_path = join(out, "fingerprints")

    def fingerprints() -> dict:
        tasks = tasks_for(spark, res.counts["bronze.compound_structures"], fingerprint.ROWS_PER_TASK)
        written, failed = writers.export_fingerprints(
            readers.fetch_structures(md, cs), fp_path, partitions=tasks, radius=radius, n_bits=n_bits, method=method,
            valid_pattern=valid_pattern)
        return {"written": written, "failed": failed}

    made = ledger.step("fingerprints", fingerprints)
    written = res.counts["fingerprints"] = made["written"]
    res.fingerprint_failures = made["failed"]
    fps = res.tables["fingerprints"] = spark.read.schema(schemas.FINGERPRINTS).parquet(fp_path)

    words = similarity.pack_fingerprints(fps, n_bits)
    packed = spark.read.schema(words.schema).parquet

    def pack() -> dict:
        words.write.mode("overwrite").parquet(join(out, "packed"))
        similarity.select_source_molecules(packed(join(out, "packed")), count).write.mode("overwrite").parquet(join(out, "sources"))
        return {}

    ledger.step("pack", pack)
    targets, sources, n_sources = packed(join(out, "packed")), packed(join(out, "sources")), min(count, written)

    # Full score tables; T5/L8: top-k fact.
    if full_tables:
        full_path = join(out, "full_similarity")
        res.counts["full_similarity"] = ledger.step("full_similarity", lambda: {"rows": writers.write_full_similarity(
            sources, targets, full_path, n_sources, written, n_bits)})["rows"]
        # The ids are folder names there: without a schema 007 would read as 7.
        res.tables["full_similarity"] = spark.read.schema(schemas.FULL_SCORES).parquet(full_path)

    fact_path = join(out, "gold/fact_similarity")

    def fact_table() -> dict:
        top = similarity.compute_top_k(sources, targets, k, n_sources, written, n_bits)
        # Staged, so the FK check reads the written rows, not the ranking again.
        staged, rows = mart.write_fact_similarity(top, join(out, "gold/_fact_staged"))
        bad = materialize(quality.fk_violations(staged, dim, rows)
                          .select("source_chembl_id", "target_chembl_id").distinct(), "fk_violations")
        n_bad = bad.count()
        if fk_mode == "fail" and n_bad:
            raise ValueError(f"fact_similarity: {n_bad} rows break the FK to dim_molecule")
        if fk_mode == "drop" and n_bad:
            staged = staged.join(bad, ["source_chembl_id", "target_chembl_id"], "left_anti")
        fact, rows = mart.write_fact_similarity(staged, fact_path)
        if on_violation == "fail":
            _check_table("fact_similarity", fact)
        return {"rows": rows, "fk_violations": n_bad}

    made = ledger.step("top_k_fact", fact_table)
    res.counts["gold.fact_similarity"], res.fk_violations = made["rows"], made["fk_violations"]
    fact = res.tables["gold.fact_similarity"] = spark.read.schema(schemas.FACT_SIMILARITY.struct).parquet(fact_path)

    # K7: views, written next to the tables.  Always run: the temp views belong to this session.
    with res.timed("views"):
        if pivot_ids is None:
            pivot_ids = [r[0] for r in sources.select("chembl_id").orderBy("chembl_id").limit(10).collect()]
        res.views = mart.create_views(fact, dim, pivot_ids, join(out, "views"))
    publish(spark, base, out.rsplit("/", 1)[-1])
    return res


def _check_table(name: str, table: DataFrame) -> None:
    """Keys and NOT NULL of a written mart table, enforced."""
    quality.enforce(quality.pk_violations({name: table}), "duplicate_keys", f"primary key of {name}")
    quality.enforce(quality.not_null_violations({name: table}), "null_count", f"NOT NULL of {name}")


def current_refresh(spark: SparkSession, base: str) -> str:
    """The folder of the last finished refresh below ``base``."""
    name = _read_text(spark, writers._join(base, CURRENT))
    if name is None:
        raise FileNotFoundError(f"no refresh has finished below {base}")
    return writers._join(base, name)
