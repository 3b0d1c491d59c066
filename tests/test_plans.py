"""Plan shape: the properties the design relies on, asserted on the physical plan."""

import contextlib
import io
import re

from conftest import SF_SMOKE
from setsim import schemas
from setsim.operators import conform, fingerprint, mart, quality, similarity
from setsim.plans import catalog
from setsim.session import tasks_for
from setsim.sources import readers


def _explain(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_topk_plan(spark):
    text = _explain(catalog.q_topk_similarity(spark, SF_SMOKE))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # Partial top-(k+1) before the shuffle, final after it.
    assert "row_number(), 11, Partial" in text and "row_number(), 11, Final" in text
    # The words are read from the stored packed table, never packed again.
    assert "aggregate(fingerprint_on_bits" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def _shape(df):
    return re.findall(r"\w*(?:Join|Exchange)\b", _explain(df))


def test_ten_and_many_sources_plan_alike(spark):
    packed = catalog.Workspace.get(spark, SF_SMOKE).packed()
    shapes = [_shape(similarity.score_pairs(packed, packed, n_sources=n, n_targets=10 ** 6)) for n in (10, 100_000)]
    assert shapes[0] == shapes[1]


def test_tasks_follow_the_pairs(spark):
    few, many = (similarity.pair_blocks(spark, 100, n) for n in (10 ** 6, 10 ** 9))
    assert many.tasks >= 500 * few.tasks and similarity.pair_blocks(spark, 100_000, 10 ** 9).source > 20
    assert tasks_for(spark, 10 ** 9, 50_000) == 20_000 and tasks_for(spark, 0, 50_000) == 1


def test_fingerprints_are_row_local(spark):
    ws = catalog.Workspace.get(spark, SF_SMOKE)
    rows = ws.bronze("compound_structures").select("molregno", "canonical_smiles")
    text = _explain(fingerprint.fingerprint_structures(rows, "molregno"))
    assert "Exchange" not in text and "monotonically_increasing_id" not in text and "EvalPython" not in text


def test_full_score_tables_shuffle_no_pairs(spark):
    packed = catalog.Workspace.get(spark, SF_SMOKE).packed()
    blocks = similarity.pair_blocks(spark, 100, 10_000, source_block=16, target_block=1000)
    text = _explain(similarity.compute_full_similarity(packed, packed, blocks=blocks)
                    .sortWithinPartitions("source_chembl_id", "target_chembl_id"))
    assert "Exchange" not in text[:text.index("Join")]


def test_dimension_is_read_once(spark):
    ws = catalog.Workspace.get(spark, SF_SMOKE)
    for df in (mart.avg_alogp_deviation_per_source(ws.fact(), ws.dim()), mart.avg_similarity_grouped(ws.fact(), ws.dim()),
               quality.fk_violations(ws.fact(), ws.dim())):
        assert _explain(df).count("/dim-") == 1


def test_scan_prunes_columns(spark):
    text = _explain(catalog.q_fetch_structures(spark, SF_SMOKE))
    assert "ReadSchema: struct<molregno:bigint,chembl_id:string>" in text
    assert "ReadSchema: struct<molregno:bigint,canonical_smiles:string>" in text


def test_joins_on_the_key_of_bronze_tables_exchange_nothing(spark):
    ws = catalog.Workspace.get(spark, SF_SMOKE)
    md, cp, cs = (ws.bronze(n) for n in ("molecule_dictionary", "compound_properties", "compound_structures"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (mart.populate_dim_molecule(md, cp, cs), readers.fetch_structures(md, cs)):
            text = _explain(df)
            assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
        # A later session declares the layout again.
        path = cs.inputFiles()[0].rsplit("/", 1)[0]
        again = conform.attach(spark, schemas.COMPOUND_STRUCTURES, path, 4)
        assert "Exchange" not in _explain(md.join(again, "molregno")) and again.count() == cs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_words_of_a_stored_table_are_never_null_in_the_pairs(spark):
    """What a file holds reads as nullable; null checks on 64 words a pair made the loop several times slower."""
    packed = catalog.Workspace.get(spark, SF_SMOKE).packed()
    for role in ("source", "target"):
        fields = {f.name: f.nullable for f in similarity._side(packed, role).schema.fields}
        assert len(fields) == 34 and [n for n, null in fields.items() if null] == [f"{role}_chembl_id"]


def test_a_task_holds_one_block_of_a_full_score_table(spark):
    """By the hash of the blocks some tasks held several blocks and others none."""
    from pyspark.sql import functions as F
    packed = catalog.Workspace.get(spark, SF_SMOKE).packed()
    blocks = similarity.Blocks(7, 3, 21)
    held = similarity.compute_full_similarity(packed, packed, blocks=blocks).select(
        F.spark_partition_id().alias("task"), (F.pmod(F.xxhash64("source_chembl_id"), F.lit(7)) * 3
                                               + F.pmod(F.xxhash64("target_chembl_id"), F.lit(3))).alias("block")).distinct().collect()
    assert len(held) == len({r.task for r in held}) == len({r.block for r in held}) == 21
