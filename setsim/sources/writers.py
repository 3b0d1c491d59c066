"""Sinks (K1–K6): Parquet and CSV writers, the ingest report and the exports.

Row counts come from an ``Observation`` attached to the write itself, so a
report never re-scans what was just written.  Any Hadoop URI works as a
target (``s3a://…``, ``hdfs://…``, ``file:/…``); that is the object-store
upload of the reference (K6).
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from setsim.sources.readers import EXTRACT_COLUMNS, scan_extract


def _join(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}" if "://" in base or base.startswith("file:") else os.path.join(base, name)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None, options: dict | None = None) -> int:
    """Write ``df`` and return the number of rows written (observed, one pass)."""
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode).format(fmt)
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return int(obs.get["rows"])


def save_to_parquet(df: DataFrame, output_dir: str, filename: str) -> str:
    """K1: overwrite ``output_dir/filename`` as Parquet; directories are created."""
    path = _join(output_dir, filename)
    df.write.mode("overwrite").parquet(path)
    return path


# Quotes are doubled, not escaped: a structure may hold backslashes.
CSV_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def save_csv(df: DataFrame, path: str) -> str:
    """K2: CSV with a header row; whitespace inside values is kept."""
    writer = df.write.mode("overwrite")
    for k, v in CSV_OPTIONS.items():
        writer = writer.option(k, v)
    writer.csv(path)
    return path


def run_ingestion(release: dict[str, DataFrame], output_dir: str,
                  limit: int | None = None) -> dict[str, tuple[str, int]]:
    """K3: extract the four tables to Parquet; ``{file: (path, rows)}``."""
    def one(table: str) -> tuple[str, tuple[str, int]]:
        filename = f"{table}.parquet"
        path = _join(output_dir, filename)
        return filename, (path, write_counted(scan_extract(release, table, limit), path))

    # The four extracts are independent jobs: submitted together, they share
    # the cluster instead of queueing behind the largest table.
    return dict(run_concurrently(one, list(EXTRACT_COLUMNS)))


def run_concurrently(fn, items: list, max_workers: int = 4) -> list:
    """Run independent Spark jobs from a few driver threads; results in order.
    The first failure is raised."""
    with ThreadPoolExecutor(max_workers=max(1, min(max_workers, len(items)))) as pool:
        return list(pool.map(fn, items))


def export_fingerprints(structures: DataFrame, path: str, partitions: int | None = None,
                        id_col: str = "chembl_id", col: str = "canonical_smiles",
                        radius: int | None = None, n_bits: int | None = None,
                        valid_pattern: str | None = None, method: str = "md5") -> tuple[int, int]:
    """K4: fingerprint ``structures`` and write ``(chembl_id, fingerprint_on_bits)``;
    returns ``(written, failed)``.

    One pass: the input is read once, by the write.  With ``partitions``
    (``tasks_for`` the rows) it is hash-partitioned by id first, so that the
    hashing is spread whatever the input layout; the Observation that counts
    valid and invalid structures sits in the write's own stage, where Spark
    applies each task's update once even if a lost executor forces earlier
    stages to re-run.  Without a valid row the folder holds no rows.
    """
    from setsim.operators.fingerprint import DEFAULT_N_BITS, DEFAULT_RADIUS, is_valid_structure, window_bits

    radius = DEFAULT_RADIUS if radius is None else radius
    n_bits = DEFAULT_N_BITS if n_bits is None else n_bits
    flagged = structures.select(id_col, col, is_valid_structure(col, valid_pattern).alias("_valid"))
    if partitions:
        flagged = flagged.repartition(int(partitions), id_col)
    obs = Observation("fingerprint_export")
    observed = flagged.observe(obs, F.count(F.when(F.col("_valid"), 1)).alias("written"),
                               F.count(F.when(~F.col("_valid"), 1)).alias("failed"))
    out = window_bits(observed.filter(F.col("_valid")), id_col, col, radius, n_bits, method)
    out.sortWithinPartitions("chembl_id").write.mode("overwrite").parquet(path)
    got = obs.get
    return int(got["written"]), int(got["failed"])


# Targets that one file of a full score table holds, and sources whose files one
# task writes: together they bound a task's sort at 16 M rows.
ROWS_PER_FILE = 1_000_000
SOURCES_PER_TASK = 16


LAYOUTS = ("folders", "clustered")
#: Rows of a row group are about this many bytes before compression.
ROW_GROUP_BYTES = 16 << 20


def write_full_similarity(sources: DataFrame, targets: DataFrame, uri: str, n_sources: int, n_targets: int,
                          n_bits: int | None = None, rows_per_file: int = ROWS_PER_FILE,
                          sources_per_task: int = SOURCES_PER_TASK, layout: str = "folders") -> int:
    """K5: the full score tables; returns the rows.

    A task scores one block of sources against one block of targets and writes
    what it scored, sorted by source and target: the pairs are never shuffled.
    ``folders``: ``uri/source_chembl_id=<id>/part-*.parquet``, one file of a source
    for each block of ``rows_per_file`` targets.  ``clustered``, for many sources: one
    file for each pair of blocks, in small row groups; the sorted sources, their
    dictionaries and a Bloom filter on them let a reader of one source skip the
    others' row groups, without a folder for each (``sources_of`` reads it).
    """
    from setsim.operators.fingerprint import DEFAULT_N_BITS
    from setsim.operators.similarity import compute_full_similarity, pair_blocks

    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    blocks = pair_blocks(sources.sparkSession, n_sources, n_targets, source_block=sources_per_task,
                         target_block=rows_per_file)
    scored = compute_full_similarity(sources, targets, n_sources, n_targets,
                                     DEFAULT_N_BITS if n_bits is None else n_bits, blocks)
    scored = scored.sortWithinPartitions("source_chembl_id", "target_chembl_id")
    if layout == "folders":
        return write_counted(scored, uri, partition_by=["source_chembl_id"])
    column = "source_chembl_id"
    return write_counted(scored, uri, options={
        "parquet.block.size": str(ROW_GROUP_BYTES), f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(sources_per_task)})


def sources_of(spark: SparkSession, uri: str, ids: list[str]) -> DataFrame:
    """K5: the scores of the named sources, from either layout."""
    from setsim.schemas import FULL_SCORES
    return spark.read.schema(FULL_SCORES).parquet(uri).filter(F.col("source_chembl_id").isin(list(ids))).select(*FULL_SCORES.names)


def upload_uri(bucket: str, key: str, scheme: str = "s3a") -> str:
    """K6: the object-store URI a writer should target for ``bucket/key``."""
    return f"{scheme}://{bucket}/{key.lstrip('/')}"
