"""Tables laid out for their readers: pages by a count index, score tables by source."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from setsim.operators import similarity
from setsim.session import materialize, scratch_path
from setsim.sources import readers, writers


def scanned_rows(df) -> int:
    """Rows that the file scans of a query gave out."""
    df.collect()

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        total = node.metrics().get("numOutputRows").get().value() if name == "FileSourceScanExec" else 0
        children = node.children()
        return total + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_pages_by_offset_and_by_key(spark):
    rows = spark.range(2000).select(F.format_string("C%05d", "id").alias("chembl_id"), (F.col("id") * 3).alias("v")).repartition(7)
    path = scratch_path(spark, "t_paged")
    written = readers.write_paged(rows, path, "chembl_id", 20)
    paged = readers.open_paged(spark, path, "chembl_id", rows.schema)
    assert sum(n for _, n, _ in paged.index) == 2000 and len(paged.index) > 10 and paged.index == written.index
    name = "C{:05d}".format
    for offset, size in ((0, 5), (95, 30), (3, 1500), (1990, 50), (2000, 5), (0, 0), (700, 1)):
        want = [(name(i), 3 * i) for i in range(offset, min(2000, offset + size))]
        assert [tuple(r) for r in paged.page(offset, size).collect()] == want
    for last, size in ((None, 4), ("C00099", 10), ("C01995", 10), ("C01999", 3), ("A", 2), ("C00450x", 300), ("Z", 1)):
        want = [name(i) for i in range(2000) if last is None or name(i) > last][:size]
        assert [r.chembl_id for r in paged.after(last, size).collect()] == want
    assert scanned_rows(paged.page(1500, 20)) < 500 and scanned_rows(paged.after("C01500", 20)) < 600
    assert readers.write_paged(rows.filter("false"), scratch_path(spark, "t_paged"), "chembl_id", 3).page(0, 5).collect() == []


def test_a_lookup_in_clustered_scores_reads_few_row_groups(spark, monkeypatch):
    monkeypatch.setattr(writers, "ROW_GROUP_BYTES", 32 << 10)
    fps = materialize(spark.range(600).select(
        F.format_string("C%04d", "id").alias("chembl_id"),
        F.array_sort(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(2048)))))
        .alias("fingerprint_on_bits")), "t_layout_fps")
    packed = similarity.packed_table(fps)
    sources = materialize(similarity.select_source_molecules(packed, 64), "t_layout_sources")
    tables = {}
    for layout in writers.LAYOUTS:
        path = scratch_path(spark, f"t_{layout}")
        assert writers.write_full_similarity(sources, packed, path, 64, 600, rows_per_file=200, layout=layout) == 64 * 599
        tables[layout] = sorted(tuple(r) for r in writers.sources_of(spark, path, ["C0003", "C0050"]).collect())
        if layout == "clustered":
            files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")]
            groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
            # A file for each pair of blocks; no folder for a source.
            assert len(files) <= 12 and len(groups) > 3 * len(files)
            one = writers.sources_of(spark, path, ["C0007"])
            assert one.count() == 599
            # The rows of one source, and of the row groups at their ends.
            most = max(g.num_rows for g in groups)
            assert scanned_rows(one) <= 599 + 3 * 2 * most < 64 * 599 / 4
            assert scanned_rows(writers.sources_of(spark, path, ["none"])) == 0
    assert tables["folders"] == tables["clustered"] and len(tables["folders"]) == 2 * 599
    with pytest.raises(ValueError, match="layout"):
        writers.write_full_similarity(sources, packed, "x", 1, 1, layout="other")
