"""The gold mart: dimension and fact (L7, L8) and the analytic views (V1–V6).

The fact holds ``count × k`` rows, the dimension is as large as the release.
A view that needs both reads the dimension once; the joins carry no hint, so
Spark broadcasts the fact side where its size allows and shuffles where not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setsim import schemas
from setsim.functions import key_filter
from setsim.operators.fingerprint import DEFAULT_N_BITS
from setsim.operators.similarity import compute_top_k, packed_table
from setsim.session import materialize

FACT_COLUMNS = ["source_chembl_id", "target_chembl_id", "similarity_score",
                "has_duplicates_of_last_largest_score"]


def populate_dim_molecule(dictionary: DataFrame, properties: DataFrame,
                          structures: DataFrame) -> DataFrame:
    """One row per molecule that has properties and a non-NULL structure.

    ``cx_logp`` and ``molecular_species`` are kept as all-NULL columns.
    """
    md = dictionary.select("molregno", "chembl_id", "molecule_type")
    cp = properties.select("molregno", "mw_freebase", "alogp", "psa", "full_mwt",
                           "aromatic_rings", "heavy_atoms")
    cs = structures.filter(F.col("canonical_smiles").isNotNull()).select("molregno")
    return (md.join(cp, "molregno").join(cs, "molregno")
            .select("chembl_id", "molecule_type", "mw_freebase", "alogp", "psa",
                    F.lit(None).cast(T.DoubleType()).alias("cx_logp"),
                    F.lit(None).cast(T.StringType()).alias("molecular_species"),
                    "full_mwt", "aromatic_rings", "heavy_atoms"))


def fact_rows(top_k: DataFrame) -> DataFrame:
    """L8 shape: the fact columns with the flag defaulting to FALSE (Q5)."""
    return top_k.select(
        "source_chembl_id", "target_chembl_id", "similarity_score",
        F.coalesce(F.col("has_duplicates_of_last_largest_score"), F.lit(False))
        .alias("has_duplicates_of_last_largest_score"))


def write_fact_similarity(top_k: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Full refresh of the fact table at ``path``; returns (table, rows).

    Write a *fresh* path per refresh and let readers switch to it: a path is
    never overwritten while a job reads it (M11).
    """
    from setsim.sources.writers import write_counted
    rows = write_counted(fact_rows(top_k), path)
    return top_k.sparkSession.read.schema(schemas.FACT_SIMILARITY.struct).parquet(path), rows


# ---------------------------------------------------------------------------
# Views


def avg_similarity_per_source(fact: DataFrame) -> DataFrame:
    """V1: mean score per source."""
    return fact.groupBy("source_chembl_id").agg(F.avg("similarity_score").alias("avg_similarity_score"))


def avg_alogp_deviation_per_source(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """V2: mean |alogp(target) − alogp(source)|; pairs with a NULL alogp on
    either side are left out, a source without any pair vanishes.

    Each pair goes to the dimension as two rows, one for each of its ids, so
    that one join brings both values."""
    roles = F.array(F.struct(F.lit("s").alias("role"), F.col("source_chembl_id").alias("chembl_id")),
                    F.struct(F.lit("t").alias("role"), F.col("target_chembl_id").alias("chembl_id")))
    asked = fact.select("source_chembl_id", "target_chembl_id", F.inline(roles))
    value = lambda role: F.max(F.when(F.col("role") == role, F.col("alogp")))
    pairs = asked.join(dim.select("chembl_id", "alogp"), "chembl_id").groupBy(
        "source_chembl_id", "target_chembl_id").agg(F.abs(value("t") - value("s")).alias("deviation"))
    return pairs.filter(F.col("deviation").isNotNull()).groupBy("source_chembl_id").agg(
        F.avg("deviation").alias("avg_alogp_deviation"))


def similarity_pivot(fact: DataFrame, source_ids: list[str]) -> DataFrame:
    """V3: one row per target of the chosen sources, one score column per
    source (NULL when the target is not in that source's top-k).  The source
    list is static, so the pivot needs no extra job to find its values."""
    return (fact.filter(F.col("source_chembl_id").isin(source_ids))
            .groupBy("target_chembl_id")
            .pivot("source_chembl_id", list(source_ids))
            .agg(F.max("similarity_score")))


def _best_two(fact: DataFrame) -> DataFrame:
    order = Window.partitionBy("source_chembl_id").orderBy(F.col("similarity_score").desc(),
                                                           F.col("target_chembl_id").asc())
    return fact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= 2)


def similarity_chain(fact: DataFrame) -> DataFrame:
    """V4: each source's rank-1 and rank-2 rows side by side (ties by target id).

    The self-join on ``rank = rank + 1`` of the view definition is one window
    plus a conditional aggregate on the same key: one shuffle.
    """
    r = F.col("rank")
    return _best_two(fact).groupBy("source_chembl_id").agg(
        F.max(F.when(r == 1, F.col("target_chembl_id"))).alias("most_similar_target"),
        F.max(F.when(r == 1, F.col("similarity_score"))).alias("most_similar_score"),
        F.max(F.when(r == 2, F.col("target_chembl_id"))).alias("next_most_similar_target"),
        F.max(F.when(r == 2, F.col("similarity_score"))).alias("next_most_similar_score"),
    )


def similarity_two_hop(fact: DataFrame, fingerprinted: DataFrame, n_bits: int = DEFAULT_N_BITS) -> DataFrame:
    """V5: each source's best match, and *that match's* own best match among
    all fingerprinted records (itself excluded).  The matched ids are searched
    like any other sources."""
    best = _best_two(fact).filter(F.col("rank") == 1).select(
        "source_chembl_id", F.col("target_chembl_id").alias("most_similar_target"),
        F.col("similarity_score").alias("most_similar_score"))
    packed = packed_table(fingerprinted, n_bits)
    # Written: the filter, the search and the result all read it.
    best = materialize(best, "best-matches")
    wanted = best.select(F.col("most_similar_target").alias("chembl_id")).distinct()
    can_match = key_filter(wanted, "chembl_id")
    matched = materialize(packed.filter(can_match(F.col("chembl_id"))).join(wanted, "chembl_id"), "matched")
    hop = compute_top_k(matched, packed, 1, n_bits=n_bits, flag=False)
    hop = hop.select(F.col("source_chembl_id").alias("most_similar_target"),
                     F.col("target_chembl_id").alias("next_most_similar_target"),
                     F.col("similarity_score").alias("next_most_similar_score"))
    return best.join(hop, "most_similar_target", "left").select(
        "source_chembl_id", "most_similar_target", "most_similar_score",
        "next_most_similar_target", "next_most_similar_score")


def avg_similarity_grouped(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """V6: averages at four levels — per source, per (heavy_atoms,
    aromatic_rings), per heavy_atoms, overall — as GROUPING SETS
    ((id), ROLLUP(heavy_atoms, aromatic_rings)); NULL labels print 'TOTAL'
    (a genuine NULL attribute prints 'TOTAL' too, as in the view)."""
    joined = fact.select("source_chembl_id", "similarity_score").join(
        dim.select(F.col("chembl_id").alias("source_chembl_id"), "aromatic_rings", "heavy_atoms"), "source_chembl_id")
    sets = [[F.col("source_chembl_id")],
            [F.col("heavy_atoms"), F.col("aromatic_rings")],
            [F.col("heavy_atoms")],
            []]
    grouped = joined.groupingSets(sets, "source_chembl_id", "heavy_atoms", "aromatic_rings").agg(
        F.avg("similarity_score").alias("avg_similarity_score"))
    total = F.lit("TOTAL")
    return grouped.select(
        F.coalesce(F.col("source_chembl_id"), total).alias("source_chembl_id"),
        F.coalesce((F.col("aromatic_rings") + F.col("heavy_atoms")).cast("string"), total)
        .alias("aromatic_rings_plus_heavy_atoms"),
        F.coalesce(F.col("heavy_atoms").cast("string"), total).alias("heavy_atoms"),
        "avg_similarity_score")


VIEWS = {
    "vw_avg_similarity_per_source": "avg_similarity_per_source",
    "vw_avg_alogp_deviation_per_source": "avg_alogp_deviation_per_source",
    "similarity_pivot": "similarity_pivot",
    "similarity_chain": "similarity_chain",
    "avg_similarity_grouped": "avg_similarity_grouped",
}


def build_views(fact: DataFrame, dim: DataFrame, pivot_ids: list[str]) -> dict[str, DataFrame]:
    return {
        "vw_avg_similarity_per_source": avg_similarity_per_source(fact),
        "vw_avg_alogp_deviation_per_source": avg_alogp_deviation_per_source(fact, dim),
        "similarity_pivot": similarity_pivot(fact, pivot_ids),
        "similarity_chain": similarity_chain(fact),
        "avg_similarity_grouped": avg_similarity_grouped(fact, dim),
    }


def create_views(fact: DataFrame, dim: DataFrame, pivot_ids: list[str], out_dir: str | None = None) -> dict[str, DataFrame]:
    """K7: publish the five views (create or replace) as temp views and, with
    ``out_dir``, as Parquet tables that outlive the session; the temp views then
    read those tables."""
    views = build_views(fact, dim, pivot_ids)
    if out_dir is not None:
        from setsim.sources.writers import _join, run_concurrently

        def publish(name: str) -> tuple[str, DataFrame]:
            path = _join(out_dir, name)
            views[name].write.mode("overwrite").parquet(path)
            return name, fact.sparkSession.read.schema(views[name].schema).parquet(path)

        views = dict(run_concurrently(publish, list(views)))
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
