"""Table schemas of the conformed (bronze) and mart (gold) layers.

Each table is described once: Spark type, nullability, the VARCHAR limit that
the store would enforce, the key, and which columns must be whole numbers.
NUMERIC maps to DOUBLE on purpose: scores are exact quotients and tie tests
compare them with ``=``; a DECIMAL would round 1/3.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Col:
    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None      # VARCHAR(n)


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...] = ()
    int_columns: tuple[str, ...] = ()   # loaded with a strict whole-number cast
    foreign_keys: tuple[tuple[str, str, str], ...] = field(default=())  # (col, table, col)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.dtype, c.nullable) for c in self.columns])

    def col(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


S, I, L, D, H, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.ShortType(), T.BooleanType()

# Table names, column names, types, keys, VARCHAR limits and
# whole-number columns of the conformed and mart tables, as the reference
# defines them (NUMERIC as DOUBLE, see the module docstring).

ID_LOOKUP = TableSpec(
    "chembl_id_lookup",
    (Col("chembl_id", S, max_len=20), Col("entity_type", S, max_len=50),
     Col("entity_id", I), Col("status", S, max_len=20)),
    int_columns=("entity_id",),
)

MOLECULE_DICTIONARY = TableSpec(
    "molecule_dictionary",
    (Col("molregno", L, False), Col("chembl_id", S, False, 20), Col("pref_name", S, max_len=255),
     Col("molecule_type", S, max_len=50), Col("max_phase", D),
     Col("therapeutic_flag", H), Col("withdrawn_flag", H)),
    key=("molregno",),
    int_columns=("therapeutic_flag", "withdrawn_flag"),
)

COMPOUND_PROPERTIES = TableSpec(
    "compound_properties",
    (Col("molregno", L, False), Col("mw_freebase", D), Col("full_mwt", D), Col("alogp", D),
     Col("hba", I), Col("hbd", I), Col("psa", D), Col("aromatic_rings", I),
     Col("heavy_atoms", I), Col("qed_weighted", D)),
    key=("molregno",),
    int_columns=("hba", "hbd", "aromatic_rings", "heavy_atoms"),
)

COMPOUND_STRUCTURES = TableSpec(
    "compound_structures",
    (Col("molregno", L, False), Col("canonical_smiles", S), Col("standard_inchi", S),
     Col("standard_inchi_key", S, max_len=27)),
    key=("molregno",),
)

DIM_MOLECULE = TableSpec(
    "dim_molecule",
    (Col("chembl_id", S, False, 20), Col("molecule_type", S, max_len=50), Col("mw_freebase", D),
     Col("alogp", D), Col("psa", D), Col("cx_logp", D), Col("molecular_species", S, max_len=50),
     Col("full_mwt", D), Col("aromatic_rings", I), Col("heavy_atoms", I)),
    key=("chembl_id",),
)

FACT_SIMILARITY = TableSpec(
    "fact_similarity",
    (Col("source_chembl_id", S, False, 20), Col("target_chembl_id", S, False, 20),
     Col("similarity_score", D, False), Col("has_duplicates_of_last_largest_score", B, False)),
    key=("source_chembl_id", "target_chembl_id"),
    foreign_keys=(("source_chembl_id", "dim_molecule", "chembl_id"),
                  ("target_chembl_id", "dim_molecule", "chembl_id")),
)

FINGERPRINTS = T.StructType([
    T.StructField("chembl_id", S, False),
    T.StructField("fingerprint_on_bits", T.ArrayType(L, False), False),
])

FULL_SCORES = T.StructType([
    T.StructField("source_chembl_id", S, False),
    T.StructField("target_chembl_id", S, False),
    T.StructField("similarity_score", D, False),
])

BRONZE = {t.name: t for t in (ID_LOOKUP, MOLECULE_DICTIONARY, COMPOUND_PROPERTIES, COMPOUND_STRUCTURES)}
GOLD = {t.name: t for t in (DIM_MOLECULE, FACT_SIMILARITY)}
ALL_TABLES = {**BRONZE, **GOLD}
