"""Mart and views on a literal fact/dim pair."""

from setsim.operators import mart


def _fact(spark, rows):
    return spark.createDataFrame(
        rows, "source_chembl_id string, target_chembl_id string, similarity_score double, "
              "has_duplicates_of_last_largest_score boolean")


def _dim(spark, rows):
    return spark.createDataFrame(
        rows, "chembl_id string, alogp double, aromatic_rings int, heavy_atoms int")


FACT = [("S1", "T1", 0.9, False), ("S1", "T2", 0.5, False), ("S2", "T1", 0.7, False), ("S2", "T3", 0.7, False)]
DIM = [("S1", 1.0, 1, 10), ("S2", None, 2, None), ("T1", 2.0, 0, 5), ("T2", 4.0, 0, 5), ("T3", 0.0, 0, 5)]


def test_avg_per_source(spark):
    got = {r[0]: r[1] for r in mart.avg_similarity_per_source(_fact(spark, FACT)).collect()}
    assert got == {"S1": 0.7, "S2": 0.7}


def test_alogp_deviation_drops_null_pairs(spark):
    got = {r[0]: r[1] for r in mart.avg_alogp_deviation_per_source(_fact(spark, FACT), _dim(spark, DIM)).collect()}
    assert got == {"S1": 2.0}  # S2 has NULL alogp: vanishes


def test_chain_uses_target_tie_break(spark):
    got = {r[0]: tuple(r)[1:] for r in mart.similarity_chain(_fact(spark, FACT)).collect()}
    assert got["S2"] == ("T1", 0.7, "T3", 0.7)
    assert got["S1"] == ("T1", 0.9, "T2", 0.5)


def test_pivot_static_columns(spark):
    out = mart.similarity_pivot(_fact(spark, FACT), ["S1", "S9"])
    assert out.columns == ["target_chembl_id", "S1", "S9"]
    got = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert got == {"T1": (0.9, None), "T2": (0.5, None)}


def test_grouped_null_prints_total(spark):
    rows = mart.avg_similarity_grouped(_fact(spark, FACT), _dim(spark, DIM)).collect()
    labels = sorted((r.source_chembl_id, r.aromatic_rings_plus_heavy_atoms, r.heavy_atoms) for r in rows)
    # per source (2), per (heavy, rings) (2), per heavy (2), overall (1).  S2's NULL
    # heavy_atoms prints TOTAL, so its (heavy, rings) and (heavy) rows read exactly
    # like the overall row: three ('TOTAL', 'TOTAL', 'TOTAL') rows.
    assert len(rows) == 7
    assert labels.count(("TOTAL", "TOTAL", "TOTAL")) == 3
    assert ("TOTAL", "11", "10") in labels


def test_dim_requires_properties_and_structure(spark):
    md = spark.createDataFrame([(1, "A", "t"), (2, "B", "t"), (3, "C", "t")], "molregno long, chembl_id string, molecule_type string")
    cp = spark.createDataFrame([(1, 1.0, 1.0, 1.0, 1.0, 1, 1), (2, 1.0, 1.0, 1.0, 1.0, 1, 1)],
                               "molregno long, mw_freebase double, alogp double, psa double, full_mwt double, "
                               "aromatic_rings int, heavy_atoms int")
    cs = spark.createDataFrame([(1, "CC"), (2, None), (3, "CC")], "molregno long, canonical_smiles string")
    dim = mart.populate_dim_molecule(md, cp, cs)
    assert [r.chembl_id for r in dim.collect()] == ["A"]
    assert "cx_logp" in dim.columns and "molecular_species" in dim.columns
