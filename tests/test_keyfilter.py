"""The key filter of a small table on the scan of a large one."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from setsim.functions import key_filter
from setsim.functions.keyfilter import MAX_WORDS, filter_words
from setsim.operators import quality, similarity
from setsim.session import materialize


def shuffled_rows(df) -> int:
    """Rows that the exchanges of a query wrote, its subqueries' left out."""
    df.collect()

    def walk(node) -> int:
        name, total = node.getClass().getSimpleName(), 0
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            total += node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        return total + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_every_key_passes_and_few_others(spark):
    for n in (0, 1, 30, 5000):
        keys = spark.range(n).select((F.col("id") * 7).cast("string").alias("k"))
        passes = key_filter(keys, "k", n)
        assert keys.filter(~passes(F.col("k"))).count() == 0
        others = spark.range(40_000).select(F.concat(F.lit("x"), "id").alias("k"))
        assert others.filter(passes(F.col("k"))).count() < 0.03 * 40_000


def test_size_is_bounded(spark):
    assert filter_words(0) == 16 and filter_words(1000) == 256 and filter_words(1 << 20) == MAX_WORDS
    assert filter_words(1 << 22) is None
    keys = spark.createDataFrame([("a",), (None,)], "k string")
    assert keys.filter(key_filter(keys, "k", 1 << 22)(F.col("k"))).count() == 2
    assert [r.k for r in keys.filter(key_filter(keys, "k")(F.col("k"))).collect()] == ["a"]


def test_foreign_keys_shuffle_the_rows_asked_for(spark, no_broadcast):
    dim = materialize(spark.range(20_000).select(F.concat(F.lit("C"), "id").alias("chembl_id")), "t_dim")
    fact = materialize(spark.createDataFrame(
        [(f"C{i}", f"C{7 * i}", 0.5, False) for i in range(40)] + [("Z", "C1", 0.5, False), ("C1", "Y", 0.5, False)],
        "source_chembl_id string, target_chembl_id string, similarity_score double, has_duplicates_of_last_largest_score boolean"), "t_fact")
    bad = quality.fk_violations(fact, dim)
    assert {(r.fk_column, r.source_chembl_id, r.target_chembl_id) for r in bad.collect()} == {
        ("source_chembl_id", "Z", "C1"), ("target_chembl_id", "C1", "Y")}
    assert shuffled_rows(bad) < 1000
    plain = fact.select("source_chembl_id").join(dim.withColumnRenamed("chembl_id", "source_chembl_id"), "source_chembl_id", "left_anti")
    assert shuffled_rows(plain) > 20_000


def test_named_pairs_shuffle_their_fingerprints_only(spark, no_broadcast):
    fps = materialize(spark.range(10_000).select(F.concat(F.lit("C"), "id").alias("chembl_id"),
                                                 F.array(F.col("id") % 64, F.lit(100).cast("long")).alias("fingerprint_on_bits")), "t_fps")
    pairs = spark.createDataFrame([("C1", "C2"), ("C1", "C65"), ("C3", "none")], "id_a string, id_b string")
    got = similarity.compare_pairs(pairs, fps)
    assert {(r.id_a, r.id_b): round(r.similarity_score, 6) for r in got.collect()} == {("C1", "C2"): round(1 / 3, 6), ("C1", "C65"): 1.0}
    assert shuffled_rows(got) < 1500
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        got.explain()
    assert "BroadcastExchange" not in buf.getvalue()
