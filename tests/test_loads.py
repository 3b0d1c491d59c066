"""Conformed loads, scans, sinks and the quality checks."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from setsim import schemas
from setsim.operators import conform, quality
from setsim.session import scratch_path
from setsim.sources import readers, writers


def test_strict_whole_numbers(spark):
    raw = spark.createDataFrame([(1, 7.0), (2, float("nan")), (3, None), (4, 12.0)], "k int, v double")
    from setsim.functions import strict_whole_number
    from pyspark.sql import types as T
    got = [r.v for r in raw.select(strict_whole_number("v", T.IntegerType()).alias("v")).orderBy(F.asc_nulls_last("v")).collect()]
    assert got == [7, 12, None, None]


def test_fraction_is_an_error(spark):
    from setsim.functions import strict_whole_number
    from pyspark.sql import types as T
    raw = spark.createDataFrame([(24.5,)], "v double")
    with pytest.raises(PySparkException, match="non-integral"):
        raw.select(strict_whole_number("v", T.IntegerType())).collect()


def _lookup(spark, rows):
    return spark.createDataFrame(rows, "chembl_id string, entity_type string, entity_id double, status string")


def test_blank_to_null_keeps_whitespace(spark):
    out = conform.load_chembl_id_lookup(_lookup(spark, [("C1", "", 1.0, "  ")])).first()
    assert out.entity_type is None and out.status == "  " and out.entity_id == 1


def test_load_count(spark):
    raw = _lookup(spark, [(f"C{i}", "COMPOUND", float(i), "ACTIVE") for i in range(10)])
    _, n = conform.load_table(raw, schemas.ID_LOOKUP, scratch_path(spark, "t_load"))
    assert n == 10


def test_varchar_overflow_fails_drops_or_reports(spark):
    raw = _lookup(spark, [("C" * 21, "X", 1.0, "ACTIVE"), ("C1", "X", 2.0, "ACTIVE")])
    with pytest.raises(Exception):
        conform.load_chembl_id_lookup(raw).collect()
    assert conform.load_chembl_id_lookup(raw, on_violation="drop").count() == 1
    assert conform.load_chembl_id_lookup(raw, on_violation="report").count() == 2


def test_add_column_if_missing(spark):
    df = spark.createDataFrame([(1,)], "molregno long")
    from pyspark.sql import types as T
    out = conform.add_column_if_missing(df, "full_mwt", T.DoubleType())
    assert out.columns == ["molregno", "full_mwt"] and out.first().full_mwt is None
    assert conform.add_column_if_missing(out, "full_mwt", T.DoubleType()).columns == out.columns


def _release(spark):
    return {
        "chembl_id_lookup": _lookup(spark, [(f"C{i}", "A", float(i), "X") for i in range(4)]),
        "molecule_dictionary": spark.createDataFrame(
            [(i, f"C{i}", "n", "t", 1.0, 0.0, 0.0) for i in range(5)],
            "molregno long, chembl_id string, pref_name string, molecule_type string, max_phase double, "
            "therapeutic_flag double, withdrawn_flag double"),
        "compound_properties": spark.createDataFrame(
            [(i, 1.0, 2.0, 0.5, 1.0, 1.0, 3.0, 1.0, 10.0, 0.3) for i in range(6)],
            "molregno long, mw_freebase double, full_mwt double, alogp double, hba double, hbd double, psa double, "
            "aromatic_rings double, heavy_atoms double, qed_weighted double"),
        "compound_structures": spark.createDataFrame(
            [(1, "CCO", "I", "K"), (2, None, "I", "K"), (3, "NO", "I", "K")],
            "molregno long, canonical_smiles string, standard_inchi string, standard_inchi_key string"),
    }


def test_scan_limit_and_null_filter(spark):
    rel = _release(spark)
    assert [r.chembl_id for r in readers.scan_extract(rel, "chembl_id_lookup", limit=2).collect()] == ["C0", "C1"]
    assert readers.scan_extract(rel, "chembl_id_lookup").count() == 4
    assert {r.molregno for r in readers.scan_extract(rel, "compound_structures").collect()} == {1, 3}


def test_ingest_report_counts(spark):
    report = writers.run_ingestion(_release(spark), scratch_path(spark, "t_ingest"))
    assert {k: v[1] for k, v in report.items()} == {
        "chembl_id_lookup.parquet": 4, "molecule_dictionary.parquet": 5,
        "compound_properties.parquet": 6, "compound_structures.parquet": 2}


def test_parquet_roundtrip_new_dir(spark):
    df = spark.createDataFrame([("C1", "CCO"), ("C2", "CCN")], "chembl_id string, canonical_smiles string")
    path = writers.save_to_parquet(df, scratch_path(spark, "t_new_dir") + "/nested", "x.parquet")
    assert sorted(spark.read.parquet(path).collect()) == sorted(df.collect())


def test_csv_roundtrip_keeps_whitespace(spark):
    df = spark.createDataFrame([("C1", "  "), ("C2", "C C")], "chembl_id string, canonical_smiles string")
    path = writers.save_csv(df, scratch_path(spark, "t_csv"))
    assert sorted(readers.load_molecules_csv(spark, path).collect()) == sorted(df.collect())


def test_page_offset_limit(spark):
    md = spark.createDataFrame([(i, f"C{i:02d}") for i in range(10)], "molregno long, chembl_id string")
    cs = spark.createDataFrame([(i, "CC") for i in range(10)], "molregno long, canonical_smiles string")
    page = readers.fetch_structures_page(md, cs, offset=2, batch_size=3).collect()
    assert [r.chembl_id for r in page] == ["C02", "C03", "C04"]
    after = readers.fetch_structures_after(md, cs, "C01", batch_size=3).collect()
    assert after == page
    assert [r.chembl_id for r in readers.fetch_structures(md, cs, ordered=True).collect()] == [f"C{i:02d}" for i in range(10)]


def test_pk_and_fk_checks(spark):
    fact = spark.createDataFrame([("A", "B", 0.5, False), ("A", "B", 0.4, False), ("A", "Z", 0.1, False)],
                                 "source_chembl_id string, target_chembl_id string, similarity_score double, "
                                 "has_duplicates_of_last_largest_score boolean")
    dim = spark.createDataFrame([("A",), ("B",)], "chembl_id string")
    pk = quality.pk_violations({"fact_similarity": fact}).first()
    assert (pk.duplicate_keys, pk.null_key_rows) == (1, 0)
    fk = quality.fk_violations(fact, dim).collect()
    assert [(r.fk_column, r.target_chembl_id) for r in fk] == [("target_chembl_id", "Z")]
    with pytest.raises(ValueError):
        quality.enforce(quality.fk_violations(fact, dim), what="FK")


def test_cli_refresh_reports_counts(spark, capsys):
    import json
    from conftest import SF_SMOKE
    from setsim.__main__ import main
    assert main(["--sf-dir", SF_SMOKE, "--fk-mode", "report", "--no-full-tables"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"]["gold.fact_similarity"] == 1000
    # Every fetched structure is either fingerprinted or counted as failed; the
    # fetch is a subset of the bronze structures (NULL structures never fetch).
    assert 0 < out["rows"]["fingerprints"]
    assert out["rows"]["fingerprints"] + out["fingerprint_failures"] <= out["rows"]["bronze.compound_structures"]
    assert "full_similarity" not in out["rows"]


def test_not_null_and_length_reports(spark):
    md = spark.createDataFrame(
        [(1, "C1", "n", "t", None, None, None), (None, None, "x" * 300, "t", None, None, None)],
        "molregno long, chembl_id string, pref_name string, molecule_type string, max_phase double, "
        "therapeutic_flag smallint, withdrawn_flag smallint")
    nn = {r.column_name: r.null_count for r in quality.not_null_violations({"molecule_dictionary": md}).collect()}
    assert nn == {"molregno": 1, "chembl_id": 1}
    ln = {r.column_name: (r.max_length, r.too_long) for r in quality.length_violations({"molecule_dictionary": md}).collect()}
    assert ln == {"chembl_id": (20, 0), "pref_name": (255, 1), "molecule_type": (50, 0)}


def test_not_null_drop_mode(spark):
    raw = spark.createDataFrame([(1, "C1", "n", "t", 1.0, 0.0, 0.0), (2, "", "n", "t", 1.0, 0.0, 0.0)],
                                "molregno long, chembl_id string, pref_name string, molecule_type string, "
                                "max_phase double, therapeutic_flag double, withdrawn_flag double")
    # '' loads as NULL, which breaks NOT NULL on chembl_id: dropped, reported, or an error.
    assert [r.molregno for r in conform.load_molecule_dictionary(raw, on_violation="drop").collect()] == [1]
    assert conform.load_molecule_dictionary(raw, on_violation="report").count() == 2
    with pytest.raises(Exception):
        conform.load_molecule_dictionary(raw).collect()


def test_refresh_fails_on_fk_gaps_by_default(spark):
    # The fixture has structures without properties (no dimension row), some of
    # which rank among the top-k: the store's FK would reject the fact.
    from conftest import SF_SMOKE
    from setsim import fixtures
    from setsim.plans.refresh import full_refresh
    with pytest.raises(ValueError, match="FK"):
        full_refresh(spark, fixtures.raw_release(spark, SF_SMOKE), full_tables=False)


def test_object_store_uri_and_release_roundtrip(spark):
    assert writers.upload_uri("bucket", "/refresh/fingerprints.parquet") == "s3a://bucket/refresh/fingerprints.parquet"
    out = scratch_path(spark, "t_release")
    writers.run_ingestion(_release(spark), out)
    back = readers.read_release(spark, out)
    assert {t: back[t].count() for t in back} == {
        "chembl_id_lookup": 4, "molecule_dictionary": 5, "compound_properties": 6, "compound_structures": 2}
    cols = readers.read_parquet_columns(spark, f"{out}/compound_properties.parquet", ["molregno", "alogp"])
    assert cols.columns == ["molregno", "alogp"] and cols.count() == 6


def test_text_ranges_cover_each_key_once(spark):
    keys = spark.createDataFrame([(k,) for k in ["A", "C1", "C1x", "D'", "D'z", "Z", "", None]], "chembl_id string")
    for bounds in ([], ["C1"], ["D'", "C1", "D'"]):
        hits = [keys.filter(p).count() for p in readers.text_ranges("chembl_id", bounds)]
        assert sum(hits) == 8 and len(hits) == len(set(bounds)) + 1


def _dictionary(spark, rows):
    return spark.createDataFrame(rows, "molregno double, chembl_id string, pref_name string, molecule_type string, "
                                       "max_phase double, therapeutic_flag double, withdrawn_flag double")


def test_no_projection_or_count_passes_a_violation(spark):
    good = (1.0, "C1", "n", "t", 1.0, 0.0, 0.0)
    for bad in ((2.0, "C" * 21, "n", "t", 1.0, 0.0, 0.0), (2.0, None, "n", "t", 1.0, 0.0, 0.0),
                (2.5, "C2", "n", "t", 1.0, 0.0, 0.0), (2.0, "C2", "n", "t", 1.0, 0.5, 0.0)):
        table = conform.load_molecule_dictionary(_dictionary(spark, [good, bad]))
        for use in (lambda t: t.count(), lambda t: t.select("pref_name").collect(), lambda t: t.select("max_phase").collect()):
            with pytest.raises(PySparkException):
                use(table)


def test_keys_fail_drop_or_report_at_the_load(spark):
    raw = _dictionary(spark, [(1.0, "B", "n", "t", 1.0, 0.0, 0.0), (1.0, "A", "n", "t", 1.0, 0.0, 0.0),
                              (2.0, "C", "n", "t", 1.0, 0.0, 0.0)])
    load = lambda mode: conform.load_table(raw, schemas.MOLECULE_DICTIONARY, scratch_path(spark, "t_keys"), mode)
    with pytest.raises(ValueError, match="primary key"):
        load("fail")
    table, rows = load("drop")
    assert rows == 2 and sorted((r.molregno, r.chembl_id) for r in table.collect()) == [(1, "A"), (2, "C")]
    table, rows = load("report")
    assert rows == 3 and quality.pk_violations({"molecule_dictionary": table}).first().duplicate_keys == 1


def _small_release(spark, ids, structures=None):
    n = len(ids)
    return {
        "chembl_id_lookup": _lookup(spark, [(i, "A", 1.0, "X") for i in ids]),
        "molecule_dictionary": _dictionary(spark, [(float(k), i, "n", "t", 1.0, 0.0, 0.0) for k, i in enumerate(ids)]),
        "compound_properties": spark.createDataFrame(
            [(k, 1.0, 2.0, k / 8, 1.0, 1.0, 3.0, 1.0, 10.0, 0.25) for k in range(n)],
            "molregno long, mw_freebase double, full_mwt double, alogp double, hba double, hbd double, psa double, "
            "aromatic_rings double, heavy_atoms double, qed_weighted double"),
        "compound_structures": spark.createDataFrame(
            [(k, (structures or [f"CC{'ON'[k % 2]}C{'C' * k}" for k in range(n)])[k], "I", "K") for k in range(n)],
            "molregno long, canonical_smiles string, standard_inchi string, standard_inchi_key string"),
    }


def test_refresh_keeps_ids_that_look_like_numbers_or_dates(spark):
    from setsim.plans.refresh import current_refresh, full_refresh
    ids = ["007", "010", "7", "2024-01-02", "1e3", "true", "00"]
    base = scratch_path(spark, "t_refresh")
    res = full_refresh(spark, _small_release(spark, ids), base, count=4, k=3)
    sources = sorted(ids)[:4]
    full = res.tables["full_similarity"].collect()
    assert {(r.source_chembl_id, r.target_chembl_id) for r in full} == {(a, b) for a in sources for b in ids if a != b}
    fact = res.tables["gold.fact_similarity"].collect()
    assert {r.source_chembl_id for r in fact} == set(sources) and len(fact) == 12
    assert res.views["similarity_chain"].count() == 4 and spark.table("similarity_chain").count() == 4
    assert current_refresh(spark, base) == res.out_dir
    # A later refresh that fails leaves the finished one in place.
    broken = _small_release(spark, [*ids, "007"])
    broken["molecule_dictionary"] = broken["molecule_dictionary"].withColumn("molregno", F.lit(1.0))
    with pytest.raises(ValueError):
        full_refresh(spark, broken, base)
    assert current_refresh(spark, base) == res.out_dir
    again = full_refresh(spark, _small_release(spark, ids[:3]), base, count=2, k=1, valid_pattern="^[CON]+$", method="xxhash64")
    assert current_refresh(spark, base) == again.out_dir != res.out_dir


def test_refresh_without_a_usable_structure_has_empty_tables(spark):
    from setsim.plans.refresh import full_refresh
    res = full_refresh(spark, _small_release(spark, ["A", "B"], [" ", "\t"]))
    assert res.counts["fingerprints"] == res.counts["gold.fact_similarity"] == res.counts["full_similarity"] == 0
    assert res.tables["full_similarity"].count() == res.tables["gold.fact_similarity"].count() == 0
    assert all(v.filter("source_chembl_id <> 'TOTAL'" if "source_chembl_id" in v.columns else "true").count() == 0
               for v in res.views.values())


def test_refresh_takes_a_limit(spark):
    from setsim.plans.refresh import full_refresh
    res = full_refresh(spark, _small_release(spark, [f"M{i}" for i in range(9)]), limit=4, fk_mode="drop", full_tables=False)
    assert res.counts["ingested/molecule_dictionary.parquet"] == 4


def test_a_cluster_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    from setsim import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.checkpoint_dir(Session())


def test_audit_counts_what_a_load_writes(spark):
    rows = [(1.0, "B", "n", "t", 1.0, 0.0, 0.0), (1.0, "A", "n", "t", 1.0, 0.0, 0.0), (2.0, "C" * 21, "n", "t", 1.0, 0.0, 0.0),
            (None, "D", "n", "t", 1.0, 0.0, 0.0), (3.0, None, "n", "t", 1.0, 0.0, 0.0), (None, "E", "n", "t", 1.0, 0.0, 0.0)]
    raw = _dictionary(spark, rows)
    load = lambda mode: conform.load_audited(raw, schemas.MOLECULE_DICTIONARY, scratch_path(spark, "t_audit"), mode)
    kept = load("report")
    assert kept.rows == 6 and kept.buckets is None
    assert {k: v for k, v in kept.audit.items() if v} == {"rows": 6, "null:molregno": 2, "null:chembl_id": 1, "long:chembl_id": 1,
                                                          "duplicate_keys": 1, "null_key_rows": 2}
    dropped = load("drop")
    assert dropped.rows == 1 and {k: v for k, v in dropped.audit.items() if v} == {"rows": 1, "duplicate_keys": 1}
    assert [tuple(r)[:2] for r in dropped.table.collect()] == [(1, "A")]
    report = conform.audit_report(spark, {"molecule_dictionary": kept})
    assert {(r.check_name, r.column_name, r.violations) for r in report.filter("violations > 0").collect()} == {
        ("not_null", "molregno", 2), ("not_null", "chembl_id", 1), ("length", "chembl_id", 1), ("duplicate_keys", None, 1),
        ("null_key_rows", None, 2)}


def test_a_repeated_key_is_found_wherever_its_rows_are(spark):
    raw = _dictionary(spark, [(float(i % 500), f"C{i}", "n", "t", 1.0, 0.0, 0.0) for i in range(501)]).repartition(7)
    with pytest.raises(ValueError, match="1 keys repeat"):
        conform.load_table(raw, schemas.MOLECULE_DICTIONARY, scratch_path(spark, "t_repeat"), buckets=3)


def test_refresh_takes_up_an_unfinished_run(spark, monkeypatch):
    from setsim.operators import similarity
    from setsim.plans import refresh
    release, base = _small_release(spark, [f"M{i}" for i in range(9)]), scratch_path(spark, "t_resume")
    pack = similarity.pack_fingerprints

    def killed(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(similarity, "pack_fingerprints", killed)
    with pytest.raises(KeyboardInterrupt):
        refresh.full_refresh(spark, release, base, count=3, k=2)
    monkeypatch.setattr(similarity, "pack_fingerprints", pack)
    started = refresh._read_text(spark, f"{base}/{refresh.STARTED}").split("\n")[0]
    with pytest.raises(FileNotFoundError):
        refresh.current_refresh(spark, base)
    # Other parameters, or no wish to resume: a run of its own.
    other = refresh.full_refresh(spark, release, scratch_path(spark, "t_resume"), count=3, k=2, resume=True)
    assert other.resumed == []
    done = refresh.full_refresh(spark, release, base, count=3, k=2, resume=True)
    assert done.out_dir.endswith(started) and done.resumed == ["ingest", "load_bronze", "dim_molecule", "fingerprints"]
    assert set(done.seconds) == {"pack", "full_similarity", "top_k_fact", "views"}
    assert done.counts == other.counts and refresh.current_refresh(spark, base) == done.out_dir
    for name, table in done.tables.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, other.tables[name].collect())), name
    # A finished run is not taken up again.
    assert refresh.full_refresh(spark, release, base, count=3, k=2, resume=True).resumed == []


def test_ids_that_look_like_numbers_are_never_cut(spark, tmp_path):
    """Keys of six and of seven digits: 100000 and 1000001 are two molecules."""
    from setsim.plans import catalog
    keys = [100_000, 1_000_001, 7, 12_345_678]
    spark.createDataFrame([(k, f"part {k}", "Brand#1", "STEEL", 5, 1.5) for k in keys],
                          "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
                          ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1,)], "s_suppkey bigint").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1,)], "c_custkey bigint").write.parquet(f"{tmp_path}/customer.parquet")
    ids = {"000007", "100000", "1000001", "12345678"}
    rows = catalog.q_refresh_full_similarity(spark, str(tmp_path)).collect()
    assert {(r.source_chembl_id, r.target_chembl_id) for r in rows} == {(a, b) for a in ids for b in ids if a != b}
    assert catalog.q_refresh_fact(spark, str(tmp_path)).count() == 12
