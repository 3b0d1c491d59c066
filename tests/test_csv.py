"""CSV by column name, with a quarantine for broken records."""

import os

import pytest

from setsim.sources import readers, writers


def _write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_columns_are_bound_by_name(spark, tmp_path):
    path = _write(tmp_path, a="molregno,chembl_id,note,canonical_smiles\n1,P1,x,C\n2,P2,,\"O\"\"\nN\"\n")
    assert [tuple(r) for r in readers.load_molecules_csv(spark, path).collect()] == [("P1", "C"), ("P2", 'O"\nN')]


def test_broken_records_are_set_aside_and_counted(spark, tmp_path):
    path = _write(tmp_path, a="chembl_id,canonical_smiles\nP1,C\nP2\nP3,C,O\n,\n\"\",x\n", b="chembl_id,canonical_smiles\nP4,a\\b\n")
    got = readers.read_csv_by_name(spark, path, ["canonical_smiles", "chembl_id"])
    assert sorted((tuple(r) for r in got.good.collect()), key=str) == [("C", "P1"), ("a\\b", "P4"), ("x", None), (None, None)]
    assert sorted(r.record for r in got.broken.collect()) == ["P2", "P3,C,O"]
    assert got.good.count() == 4 and got.broken.count() == 2 and got.good.select("chembl_id").count() == 4


def test_missing_columns_and_other_headers_are_errors(spark, tmp_path):
    path = _write(tmp_path, a="id,canonical_smiles\n1,C\n")
    with pytest.raises(ValueError, match="no column chembl_id"):
        readers.load_molecules_csv(spark, path)
    os.mkdir(tmp_path / "two")
    path = _write(tmp_path / "two", a="chembl_id,canonical_smiles\nP1,C\n", b="canonical_smiles,chembl_id\nC,P2\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        readers.load_molecules_csv(spark, path).collect()


def test_a_column_may_have_the_name_of_the_record_column(spark, tmp_path):
    path = _write(tmp_path, a="_record,chembl_id,canonical_smiles\nr,P1,C\nr\n")
    got = readers.read_csv_by_name(spark, path, ["_record", "chembl_id"])
    assert [tuple(r) for r in got.good.collect()] == [("r", "P1")] and [r.record for r in got.broken.collect()] == ["r"]


def test_what_save_csv_writes_comes_back(spark, tmp_path):
    rows = [("P1", 'a"b'), ("P2", "a\\"), ("P3", "a\\\"b,c\nd"), ("P4", " x "), ("P5", None)]
    df = spark.createDataFrame(rows, "chembl_id string, canonical_smiles string")
    path = writers.save_csv(df, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in readers.load_molecules_csv(spark, path).collect()) == rows
