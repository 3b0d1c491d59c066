"""DuckDB oracles: an independent SQL statement of every registered query.

Each oracle is one ``WITH … SELECT`` over the driver's pre-registered views.
The bindings are the fixture texts (shared with Spark); everything after
them — conformance, fingerprints, search, mart, views — is restated here in
SQL, so a Spark-side bug does not cancel out.
"""

from __future__ import annotations

from setsim.fixtures import oracle_ctes
from setsim.functions.columns import BLANK_PATTERN

N_BITS = 2048
RADIUS = 2
COUNT = 100
K = 10
SAMPLE = 500

# The ten pivot sources of the similarity pivot view (the first
# ten fingerprintable ids in text order at sf0.01).
PIVOT_IDS = ["P10", "P100", "P1000", "P1001", "P1002", "P1003", "P1004", "P1005", "P1006", "P1007"]


def _h28(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 7))::BIGINT"


_T = "canonical_smiles"
_WINDOW_KEY = f"r || ':' || substr({_T}, greatest(i - r, 1), least(i + r, length({_T})) - greatest(i - r, 1) + 1)"
_FP = (f"list_sort(list_distinct(flatten(list_transform(range(0, {RADIUS + 1}), lambda r: "
       f"list_transform(range(1, length({_T}) + 1), lambda i: {_h28(_WINDOW_KEY)} % {N_BITS})))))")

_VALID = f"NOT regexp_matches({_T}, '{BLANK_PATTERN}')"


def _tanimoto(a: str, b: str) -> str:
    inter = f"len(list_intersect({a}, {b}))"
    union = f"(len({a}) + len({b}) - {inter})"
    return f"CASE WHEN {union} = 0 THEN 1.0 ELSE CAST({inter} AS DOUBLE) / {union} END"


def _bits_text(expr: str) -> str:
    return f"array_to_string({expr}, ',')"


CTE: dict[str, str] = dict(oracle_ctes())
CTE.update({
    # conformed bronze (blank -> NULL, NaN -> NULL, whole-number casts)
    "chembl_id_lookup": (
        "SELECT nullif(chembl_id, '') AS chembl_id, nullif(entity_type, '') AS entity_type, "
        "CAST(entity_id AS INT) AS entity_id, nullif(status, '') AS status FROM raw_chembl_id_lookup"),
    "molecule_dictionary": (
        "SELECT molregno, nullif(chembl_id, '') AS chembl_id, nullif(pref_name, '') AS pref_name, "
        "nullif(molecule_type, '') AS molecule_type, "
        "CASE WHEN isnan(max_phase) THEN NULL ELSE max_phase END AS max_phase, "
        "CAST(therapeutic_flag AS SMALLINT) AS therapeutic_flag, "
        "CAST(withdrawn_flag AS SMALLINT) AS withdrawn_flag FROM raw_molecule_dictionary"),
    "compound_properties": (
        "SELECT molregno, mw_freebase, full_mwt, CASE WHEN isnan(alogp) THEN NULL ELSE alogp END AS alogp, "
        "CAST(hba AS INT) AS hba, CAST(hbd AS INT) AS hbd, psa, CAST(aromatic_rings AS INT) AS aromatic_rings, "
        "CAST(heavy_atoms AS INT) AS heavy_atoms, qed_weighted FROM raw_compound_properties"),
    "compound_structures": (
        "SELECT molregno, nullif(canonical_smiles, '') AS canonical_smiles, "
        "nullif(standard_inchi, '') AS standard_inchi, "
        "nullif(standard_inchi_key, '') AS standard_inchi_key FROM raw_compound_structures"),
    "structures": (
        "SELECT md.chembl_id, cs.canonical_smiles FROM molecule_dictionary md "
        "JOIN compound_structures cs ON md.molregno = cs.molregno WHERE cs.canonical_smiles IS NOT NULL"),
    "fp_all": f"SELECT chembl_id, CASE WHEN {_VALID} THEN {_FP} END AS bits FROM structures",
    "sample": f"SELECT chembl_id, canonical_smiles FROM structures ORDER BY chembl_id LIMIT {SAMPLE}",
    "sample_fp": f"SELECT chembl_id, {_FP} AS bits FROM sample WHERE {_VALID}",
    "fp": "SELECT chembl_id, bits FROM fp_all WHERE bits IS NOT NULL",
    # windows hashed by arithmetic: one list for each radius
    "ring0": (
        "SELECT *, list_transform(c, lambda x: (x * 69621 + 1) % 2147483647) AS h0 FROM (SELECT chembl_id, "
        f"list_transform(string_split({_T}, ''), lambda x: unicode(x)::BIGINT) AS c FROM structures WHERE {_VALID})"),
    "src": f"SELECT chembl_id, bits FROM fp ORDER BY chembl_id LIMIT {COUNT}",
    "scored": (
        "SELECT s.chembl_id AS source_chembl_id, t.chembl_id AS target_chembl_id, "
        f"{_tanimoto('s.bits', 't.bits')} AS similarity_score FROM src s JOIN fp t ON s.chembl_id <> t.chembl_id"),
    "ranked": (
        "SELECT source_chembl_id, target_chembl_id, similarity_score, row_number() OVER "
        "(PARTITION BY source_chembl_id ORDER BY similarity_score DESC, target_chembl_id) AS rk FROM scored"),
    "flagged": (
        "SELECT source_chembl_id, target_chembl_id, similarity_score, rk, "
        f"max(CASE WHEN rk = {K} THEN similarity_score END) OVER (PARTITION BY source_chembl_id) AS kth, "
        f"max(CASE WHEN rk = {K + 1} THEN similarity_score END) OVER (PARTITION BY source_chembl_id) AS nxt "
        f"FROM ranked WHERE rk <= {K + 1}"),
    "fact": (
        "SELECT source_chembl_id, target_chembl_id, similarity_score, "
        "COALESCE(similarity_score = kth AND nxt = kth, false) AS has_duplicates_of_last_largest_score "
        f"FROM flagged WHERE rk <= {K}"),
    # What a molecule needs: a property row and a structure; its own columns come from two tables.
    "structured": "SELECT DISTINCT molregno FROM compound_structures WHERE canonical_smiles IS NOT NULL",
    "dim": (
        "SELECT chembl_id, molecule_type, mw_freebase, alogp, psa, NULL::DOUBLE AS cx_logp, NULL::VARCHAR AS molecular_species, "
        "full_mwt, aromatic_rings, heavy_atoms FROM molecule_dictionary NATURAL JOIN compound_properties "
        "WHERE molregno IN (FROM structured)"),
    "best": (
        "SELECT source_chembl_id, target_chembl_id, similarity_score FROM (SELECT *, row_number() OVER "
        "(PARTITION BY source_chembl_id ORDER BY similarity_score DESC, target_chembl_id) AS r FROM fact) WHERE r = 1"),
    "hop_scored": (
        "SELECT m.chembl_id AS source_chembl_id, t.chembl_id AS target_chembl_id, "
        f"{_tanimoto('m.bits', 't.bits')} AS similarity_score "
        "FROM (SELECT chembl_id, bits FROM fp WHERE chembl_id IN (SELECT target_chembl_id FROM best)) m "
        "JOIN fp t ON m.chembl_id <> t.chembl_id"),
    "hop": (
        "SELECT source_chembl_id, target_chembl_id, similarity_score FROM (SELECT *, row_number() OVER "
        "(PARTITION BY source_chembl_id ORDER BY similarity_score DESC, target_chembl_id) AS r FROM hop_scored) "
        "WHERE r = 1"),
    "fact_fk_ok": (
        "SELECT f.* FROM fact f WHERE f.source_chembl_id IN (SELECT chembl_id FROM dim) "
        "AND f.target_chembl_id IN (SELECT chembl_id FROM dim)"),
    # graph fingerprint rounds
    "both_edges": ("SELECT graph_id, a AS node_id, b AS nbr FROM graph_edges "
                   "UNION ALL SELECT graph_id, b AS node_id, a AS nbr FROM graph_edges"),
    "h0": f"SELECT graph_id, node_id, {_h28(chr(39) + '0|' + chr(39) + ' || label')} AS h FROM graph_nodes",
})

_DEPS: dict[str, tuple[str, ...]] = {
    "graph_nodes": (), "graph_edges": ("graph_nodes",), "compare_pairs": (), "csv_records": (),
    "raw_chembl_id_lookup": (), "raw_molecule_dictionary": (), "raw_compound_properties": (),
    "raw_compound_structures": (), "raw_dictionary_with_faults": ("raw_molecule_dictionary",),
    "chembl_id_lookup": ("raw_chembl_id_lookup",),
    "molecule_dictionary": ("raw_molecule_dictionary",),
    "compound_properties": ("raw_compound_properties",),
    "compound_structures": ("raw_compound_structures",),
    "structures": ("molecule_dictionary", "compound_structures"),
    "fp_all": ("structures",), "fp": ("fp_all",), "sample": ("structures",), "sample_fp": ("sample",), "src": ("fp",), "scored": ("src", "fp"),
    "ranked": ("scored",), "flagged": ("ranked",), "fact": ("flagged",),
    "structured": ("compound_structures",), "dim": ("molecule_dictionary", "compound_properties", "structured"),
    "best": ("fact",), "hop_scored": ("best", "fp"), "hop": ("hop_scored",),
    "fact_fk_ok": ("fact", "dim"),
    "both_edges": ("graph_edges",), "h0": ("graph_nodes",),
}

_DEPS["ring0"] = ("structures",)
for _k in range(1, RADIUS + 1):
    CTE[f"ring{_k}"] = (
        f"SELECT *, list_transform(h{_k - 1}, lambda h, i: (h * 48271 + CASE WHEN i > {_k} THEN c[i - {_k}] + 1 ELSE 0 END * 69621 "
        f"+ CASE WHEN i + {_k} <= len(c) THEN c[i + {_k}] + 1 ELSE 0 END * 1583458089 + {_k}) % 2147483647) AS h{_k} FROM ring{_k - 1}")
    _DEPS[f"ring{_k}"] = (f"ring{_k - 1}",)

for _k in range(1, RADIUS + 1):
    _prev = f"h{_k - 1}"
    CTE[f"agg{_k}"] = (
        "SELECT b.graph_id, b.node_id, count(*) AS deg, "
        f"sum({_h28('lpad(CAST(n.h AS VARCHAR), 10, ' + chr(39) + '0' + chr(39) + ')')}) AS nsum "
        f"FROM both_edges b JOIN {_prev} n ON b.graph_id = n.graph_id AND b.nbr = n.node_id GROUP BY b.graph_id, b.node_id")
    _key = (f"'{_k}' || '|' || CAST(c.h AS VARCHAR) || '|' || CAST(coalesce(a.deg, 0) AS VARCHAR) "
            "|| '|' || CAST(coalesce(a.nsum, 0) AS VARCHAR)")
    CTE[f"h{_k}"] = (f"SELECT c.graph_id, c.node_id, {_h28(_key)} AS h FROM {_prev} c "
                     f"LEFT JOIN agg{_k} a ON c.graph_id = a.graph_id AND c.node_id = a.node_id")
    _DEPS[f"agg{_k}"] = ("both_edges", _prev)
    _DEPS[f"h{_k}"] = (_prev, f"agg{_k}")
CTE["graph_all_h"] = " UNION ALL ".join(f"SELECT graph_id, h FROM h{_k}" for _k in range(RADIUS + 1))
_DEPS["graph_all_h"] = tuple(f"h{_k}" for _k in range(RADIUS + 1))


def with_ctes(final: str, *names: str) -> str:
    """``WITH`` the named fragments (and what they read, in order) + ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTE[n]})" for n in order)
    return f"WITH {body}\n{final}"


def _round(expr: str) -> str:
    return f"round({expr}, 10)"


def _count_rows(items: list[tuple[str, str]], label_col: str = "table_name") -> str:
    return " UNION ALL ".join(f"SELECT '{label}' AS {label_col}, CAST(count(*) AS BIGINT) AS row_count FROM {src}"
                              for label, src in items)


def _extract(table: str, cols: str, where: str = "") -> str:
    return with_ctes(f"SELECT {cols} FROM raw_{table}{where}", f"raw_{table}")


# The columns of each extract, and below the VARCHAR limits, keys
# and NOT NULL columns of the tables.
_COLS = {
    "chembl_id_lookup": "chembl_id, entity_type, entity_id, status",
    "molecule_dictionary": "molregno, chembl_id, pref_name, molecule_type, max_phase, therapeutic_flag, withdrawn_flag",
    "compound_properties": ("molregno, mw_freebase, full_mwt, alogp, hba, hbd, psa, aromatic_rings, heavy_atoms, "
                            "qed_weighted"),
    "compound_structures": "molregno, canonical_smiles, standard_inchi, standard_inchi_key",
}

_FACT_FULL = ("SELECT source_chembl_id, target_chembl_id, similarity_score, has_duplicates_of_last_largest_score "
              "FROM fact")

_VARCHAR = {
    "chembl_id_lookup": [("chembl_id", 20), ("entity_type", 50), ("status", 20)],
    "molecule_dictionary": [("chembl_id", 20), ("pref_name", 255), ("molecule_type", 50)],
    "compound_structures": [("standard_inchi_key", 27)],
    "dim_molecule": [("chembl_id", 20), ("molecule_type", 50), ("molecular_species", 50)],
    "fact_similarity": [("source_chembl_id", 20), ("target_chembl_id", 20)],
}
_TABLE_CTE = {"chembl_id_lookup": "chembl_id_lookup", "molecule_dictionary": "molecule_dictionary",
              "compound_properties": "compound_properties", "compound_structures": "compound_structures",
              "dim_molecule": "dim", "fact_similarity": "fact"}
_KEYS = {"molecule_dictionary": ["molregno"], "compound_properties": ["molregno"],
         "compound_structures": ["molregno"], "dim_molecule": ["chembl_id"],
         "fact_similarity": ["source_chembl_id", "target_chembl_id"]}
_NOT_NULL = {"molecule_dictionary": ["molregno", "chembl_id"], "compound_properties": ["molregno"],
             "compound_structures": ["molregno"], "dim_molecule": ["chembl_id"],
             "fact_similarity": ["source_chembl_id", "target_chembl_id", "similarity_score",
                                 "has_duplicates_of_last_largest_score"]}


def _pk_sql() -> str:
    parts = []
    for table, key in _KEYS.items():
        keys = ", ".join(key)
        any_null = " OR ".join(f"{k} IS NULL" for k in key)
        parts.append(
            f"SELECT '{table}' AS table_name, "
            f"CAST(count(CASE WHEN n > 1 AND NOT ({any_null}) THEN 1 END) AS BIGINT) AS duplicate_keys, "
            f"CAST(coalesce(sum(CASE WHEN {any_null} THEN n END), 0) AS BIGINT) AS null_key_rows "
            f"FROM (SELECT {keys}, count(*) AS n FROM {_TABLE_CTE[table]} GROUP BY {keys})")
    return with_ctes(" UNION ALL ".join(parts), *[_TABLE_CTE[t] for t in _KEYS])


def _not_null_sql() -> str:
    parts = []
    for table, cols in _NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                         f"CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {_TABLE_CTE[table]}")
    return with_ctes(" UNION ALL ".join(parts), *[_TABLE_CTE[t] for t in _NOT_NULL])


def _length_sql() -> str:
    parts = []
    for table, cols in _VARCHAR.items():
        for c, n in cols:
            parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({n} AS INT) AS max_length, "
                         f"CAST(count(CASE WHEN length({c}) > {n} THEN 1 END) AS BIGINT) AS too_long "
                         f"FROM {_TABLE_CTE[table]}")
    return with_ctes(" UNION ALL ".join(parts), *[_TABLE_CTE[t] for t in _VARCHAR])


def _pivot_sql(ids: list[str]) -> str:
    cols = ", ".join(f"max(CASE WHEN source_chembl_id = '{i}' THEN similarity_score END) AS \"{i}\"" for i in ids)
    in_list = ", ".join(f"'{i}'" for i in ids)
    return with_ctes(f"SELECT target_chembl_id, {cols} FROM fact WHERE source_chembl_id IN ({in_list}) "
                     "GROUP BY target_chembl_id", "fact")


# The fractional columns of the extracts.
_FRACTIONS = {"entity_id", "max_phase", "therapeutic_flag", "withdrawn_flag", "mw_freebase", "full_mwt", "alogp", "hba",
              "hbd", "psa", "aromatic_rings", "heavy_atoms", "qed_weighted"}


def _grouped_sql() -> str:
    """One statement for each level: a source, both attributes, one, none."""
    known = ("SELECT chembl_id AS id, heavy_atoms AS h, aromatic_rings + heavy_atoms AS rh, aromatic_rings AS r, "
             "similarity_score AS score FROM fact JOIN dim ON chembl_id = source_chembl_id")
    level = lambda i, rh, h, keys: (
        f"SELECT {i} AS source_chembl_id, {rh} AS aromatic_rings_plus_heavy_atoms, {h} AS heavy_atoms, "
        f"{_round('avg(score)')} AS avg_similarity_score FROM ({known}){' GROUP BY ' + keys if keys else ''}")
    text = "ifnull({}::VARCHAR, 'TOTAL')".format
    return with_ctes(" UNION ALL ".join((
        level("id", "'TOTAL'", "'TOTAL'", "id"), level("'TOTAL'", text("any_value(rh)"), text("h"), "h, r"),
        level("'TOTAL'", "'TOTAL'", text("h"), "h"), level("'TOTAL'", "'TOTAL'", "'TOTAL'", ""))), "fact", "dim")


def _preview_sql() -> str:
    parts = []
    for table, cols in _COLS.items():
        key = "chembl_id" if table == "chembl_id_lookup" else "molregno"
        where = " WHERE canonical_smiles IS NOT NULL" if table == "compound_structures" else ""
        for c in cols.split(", "):
            value = (f"CASE WHEN isfinite({c}) THEN {c}::DECIMAL(38,4) END" if c in _FRACTIONS else c)
            parts.append(f"SELECT '{table}' AS table_name, {key}::VARCHAR AS row_key, '{c}' AS column_name, "
                         f"({value})::VARCHAR AS value FROM (FROM raw_{table}{where} ORDER BY {key} LIMIT 5)")
    return with_ctes(" UNION ALL ".join(parts), *(f"raw_{t}" for t in _COLS))


def _numbered(sql: str) -> str:
    """The same statement over a dictionary whose ids look like numbers."""
    return sql.replace("'P' || p_partkey AS chembl_id, CASE", "lpad(p_partkey::VARCHAR, 6, '0') AS chembl_id, CASE")


def oracle_sql() -> dict[str, str]:
    fp_text = _bits_text("bits")
    return {
        # sources
        "scan_id_lookup": _extract("chembl_id_lookup", _COLS["chembl_id_lookup"]),
        "scan_dictionary": _extract("molecule_dictionary", _COLS["molecule_dictionary"]),
        "scan_properties": _extract("compound_properties", _COLS["compound_properties"]),
        "scan_structures": _extract("compound_structures", _COLS["compound_structures"],
                                    " WHERE canonical_smiles IS NOT NULL"),
        "sample_structures": with_ctes("FROM sample", "sample"),
        "fetch_structures": with_ctes("SELECT chembl_id, canonical_smiles FROM structures", "structures"),
        "structures_page": with_ctes("SELECT chembl_id, canonical_smiles FROM structures "
                                     "ORDER BY chembl_id LIMIT 500 OFFSET 100", "structures"),
        "structures_offset": with_ctes("SELECT chembl_id, canonical_smiles FROM structures "
                                       "ORDER BY chembl_id LIMIT 500 OFFSET 100", "structures"),
        "structures_after": with_ctes("SELECT chembl_id, canonical_smiles FROM structures WHERE chembl_id > 'P1500' "
                                      "ORDER BY chembl_id LIMIT 300", "structures"),
        "csv_roundtrip": with_ctes("FROM sample", "sample"),
        "csv_by_name": with_ctes("SELECT chembl_id, canonical_smiles FROM csv_records WHERE NOT broken", "csv_records"),
        "csv_quarantine": with_ctes(
            "SELECT concat_ws(',', note, replace(canonical_smiles, chr(10), ' '), molregno, chembl_id) AS record "
            "FROM csv_records WHERE broken", "csv_records"),
        "preview_tables": _preview_sql(),
        # sinks / loads
        "parquet_roundtrip": with_ctes(f"SELECT {_COLS['molecule_dictionary']} FROM molecule_dictionary",
                                       "molecule_dictionary"),
        "ingest_counts": with_ctes(_count_rows([
            ("chembl_id_lookup.parquet", "raw_chembl_id_lookup"),
            ("molecule_dictionary.parquet", "raw_molecule_dictionary"),
            ("compound_properties.parquet", "raw_compound_properties"),
            ("compound_structures.parquet", "raw_compound_structures WHERE canonical_smiles IS NOT NULL")],
            "file_name"),
            "raw_chembl_id_lookup", "raw_molecule_dictionary", "raw_compound_properties", "raw_compound_structures"),
        "bronze_id_lookup": with_ctes(f"SELECT {_COLS['chembl_id_lookup']} FROM chembl_id_lookup", "chembl_id_lookup"),
        "bronze_dictionary": with_ctes(f"SELECT {_COLS['molecule_dictionary']} FROM molecule_dictionary",
                                       "molecule_dictionary"),
        "bronze_properties": with_ctes(f"SELECT {_COLS['compound_properties']} FROM compound_properties",
                                       "compound_properties"),
        "bronze_structures": with_ctes(f"SELECT {_COLS['compound_structures']} FROM compound_structures",
                                       "compound_structures"),
        "bronze_counts": with_ctes(_count_rows([(t, t) for t in _COLS]), *_COLS),
        "load_drop_dictionary": with_ctes(
            f"SELECT {_COLS['molecule_dictionary']} FROM (SELECT molregno, min(chembl_id) AS chembl_id, "
            "min(nullif(pref_name, '')) AS pref_name, min(nullif(molecule_type, '')) AS molecule_type, "
            "min(CASE WHEN isfinite(max_phase) THEN max_phase END) AS max_phase, "
            "min(therapeutic_flag)::SMALLINT AS therapeutic_flag, min(withdrawn_flag)::SMALLINT AS withdrawn_flag "
            "FROM raw_dictionary_with_faults WHERE chembl_id <> '' GROUP BY molregno)", "raw_dictionary_with_faults"),
        "load_audit": with_ctes(
            "SELECT 'molecule_dictionary' AS table_name, c AS check_name, k AS column_name, "
            "CASE c WHEN 'duplicate_keys' THEN repeated ELSE 0 END::BIGINT AS violations "
            "FROM (SELECT count(*) AS repeated FROM (SELECT molregno FROM raw_dictionary_with_faults WHERE chembl_id <> '' "
            "GROUP BY molregno HAVING count(*) > 1)), (VALUES ('not_null', 'molregno'), ('not_null', 'chembl_id'), "
            "('length', 'chembl_id'), ('length', 'pref_name'), ('length', 'molecule_type'), ('duplicate_keys', NULL), "
            "('null_key_rows', NULL)) AS checks(c, k) UNION ALL "
            "SELECT 'compound_structures', c, k, CASE c WHEN 'not_null' THEN no_key WHEN 'length' THEN long_key "
            "WHEN 'duplicate_keys' THEN n - n_keys ELSE no_key END::BIGINT "
            "FROM (SELECT count(*) AS n, count(DISTINCT molregno) AS n_keys, count(*) - count(molregno) AS no_key, "
            "count(*) FILTER (length(standard_inchi_key) > 27) AS long_key FROM compound_structures), "
            "(VALUES ('not_null', 'molregno'), ('length', 'standard_inchi_key'), ('duplicate_keys', NULL), "
            "('null_key_rows', NULL)) AS checks(c, k)", "raw_dictionary_with_faults", "compound_structures"),
        "dim_molecule": with_ctes("SELECT * FROM dim", "dim"),
        "fact_similarity": with_ctes(_FACT_FULL, "fact"),
        "fingerprints_export": with_ctes(f"SELECT chembl_id, {fp_text} AS fingerprint_on_bits FROM fp", "fp"),
        "full_similarity_partitioned": with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score FROM scored", "scored"),
        "full_similarity_clustered": with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score FROM scored", "scored"),
        "add_missing_column": with_ctes(
            "SELECT molregno, mw_freebase, CAST(NULL AS DOUBLE) AS full_mwt, alogp, hba, hbd, psa, aromatic_rings, "
            "heavy_atoms, qed_weighted FROM compound_properties", "compound_properties"),
        # quality
        "pk_violations": _pk_sql(),
        "not_null_violations": _not_null_sql(),
        "fk_violations": with_ctes(
            "SELECT 'source_chembl_id' AS fk_column, source_chembl_id, target_chembl_id FROM fact "
            "WHERE source_chembl_id NOT IN (SELECT chembl_id FROM dim) UNION ALL "
            "SELECT 'target_chembl_id', source_chembl_id, target_chembl_id FROM fact "
            "WHERE target_chembl_id NOT IN (SELECT chembl_id FROM dim)", "fact", "dim"),
        "length_violations": _length_sql(),
        # fingerprints
        "string_fingerprint": with_ctes(f"SELECT chembl_id, {fp_text} AS fingerprint_on_bits FROM fp_all", "fp_all"),
        "fingerprint_rolling": with_ctes(
            f"SELECT chembl_id, {_bits_text(f'list_sort(list_distinct(list_transform(h0 || h1 || h2, lambda h: h % {N_BITS})))')} "
            "AS fingerprint_on_bits FROM ring2", "ring2"),
        "fingerprint_structures": with_ctes(f"SELECT chembl_id, {fp_text} AS fingerprint_on_bits FROM fp", "fp"),
        "fingerprint_failures": with_ctes(
            "SELECT CAST(count(bits) AS BIGINT) AS written, CAST(count(*) - count(bits) AS BIGINT) AS failed "
            "FROM fp_all", "fp_all"),
        "fingerprint_bit_counts": with_ctes(
            f"SELECT chembl_id, CAST(len(bits) AS INT) AS num_on_bits, CAST({N_BITS} AS INT) AS n_bits, "
            "list_max(bits) AS max_bit FROM fp", "fp"),
        "fingerprint_documents": (
            "WITH chars AS (SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i "
            f"FROM documents WHERE NOT regexp_matches(text, '{BLANK_PATTERN}')), "
            "near AS (SELECT doc_id, c, coalesce(lag(c, 1) OVER w, '') AS b1, coalesce(lag(c, 2) OVER w, '') AS b2, "
            "coalesce(lead(c, 1) OVER w, '') AS a1, coalesce(lead(c, 2) OVER w, '') AS a2 FROM chars "
            "WINDOW w AS (PARTITION BY doc_id ORDER BY i)), "
            "keys AS (SELECT DISTINCT doc_id, unnest(['0:' || c, '1:' || b1 || c || a1, '2:' || b2 || b1 || c || a1 || a2]) AS k "
            "FROM near), "
            f"bits AS (SELECT doc_id, list_sort(list(DISTINCT {_h28('k')} % {N_BITS})) AS b FROM keys GROUP BY doc_id) "
            f"SELECT d.doc_id, {_bits_text('b')} AS fingerprint_on_bits FROM documents d LEFT JOIN bits USING (doc_id)"),
        "graph_fingerprint": with_ctes(
            f"SELECT graph_id, {_bits_text(f'list_sort(list_distinct(list(h % {N_BITS})))')} AS fingerprint_on_bits "
            "FROM graph_all_h GROUP BY graph_id", "graph_all_h"),
        # search
        "tanimoto_pairs": with_ctes(
            f"SELECT p.id_a, p.id_b, {_tanimoto('a.bits', 'b.bits')} AS similarity_score FROM compare_pairs p "
            "JOIN fp a ON a.chembl_id = p.id_a JOIN fp b ON b.chembl_id = p.id_b", "compare_pairs", "fp"),
        "select_sources": with_ctes("SELECT chembl_id FROM src", "src"),
        "full_similarity": with_ctes("SELECT source_chembl_id, target_chembl_id, similarity_score FROM scored",
                                     "scored"),
        "topk_similarity": with_ctes(_FACT_FULL, "fact"),
        "topk_single_source": with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score, CAST(r AS INT) AS rank FROM ("
            "SELECT s.chembl_id AS source_chembl_id, t.chembl_id AS target_chembl_id, "
            f"{_tanimoto('s.bits', 't.bits')} AS similarity_score, row_number() OVER "
            f"(ORDER BY {_tanimoto('s.bits', 't.bits')} DESC, t.chembl_id) AS r "
            "FROM (SELECT * FROM fp ORDER BY chembl_id LIMIT 1) s JOIN fp t ON s.chembl_id <> t.chembl_id) "
            "WHERE r <= 5", "fp"),
        "sample_csv_top5": with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score, CAST(r AS INT) AS rank FROM ("
            "SELECT s.chembl_id AS source_chembl_id, t.chembl_id AS target_chembl_id, "
            f"{_tanimoto('s.bits', 't.bits')} AS similarity_score, row_number() OVER "
            f"(ORDER BY {_tanimoto('s.bits', 't.bits')} DESC, t.chembl_id) AS r "
            "FROM (SELECT * FROM sample_fp ORDER BY chembl_id LIMIT 1) s JOIN sample_fp t ON s.chembl_id <> t.chembl_id) "
            "WHERE r <= 5", "sample_fp"),
        # views
        "avg_similarity_per_source": with_ctes(
            f"SELECT source_chembl_id, {_round('avg(similarity_score)')} AS avg_similarity_score FROM fact "
            "GROUP BY source_chembl_id", "fact"),
        "avg_alogp_deviation_per_source": with_ctes(
            "SELECT source_chembl_id, " + _round("avg(gap)") + " AS avg_alogp_deviation FROM ("
            "SELECT source_chembl_id, abs(value[target_chembl_id] - value[source_chembl_id]) AS gap FROM fact, "
            "(SELECT map(list(chembl_id), list(alogp)) AS value FROM dim WHERE alogp IS NOT NULL)) "
            "WHERE gap IS NOT NULL GROUP BY source_chembl_id", "fact", "dim"),
        "similarity_pivot": _pivot_sql(PIVOT_IDS),
        "similarity_chain": with_ctes(
            "SELECT source_chembl_id, best[1].t AS most_similar_target, -best[1].s AS most_similar_score, "
            "best[2].t AS next_most_similar_target, -best[2].s AS next_most_similar_score FROM ("
            "SELECT source_chembl_id, list_sort(list({'s': -similarity_score, 't': target_chembl_id}))[1:2] AS best "
            "FROM fact GROUP BY source_chembl_id)", "fact"),
        "similarity_two_hop": with_ctes(
            "SELECT b.source_chembl_id, b.target_chembl_id AS most_similar_target, b.similarity_score AS "
            "most_similar_score, h.target_chembl_id AS next_most_similar_target, h.similarity_score AS "
            "next_most_similar_score FROM best b LEFT JOIN hop h ON b.target_chembl_id = h.source_chembl_id",
            "best", "hop"),
        "avg_similarity_grouped": _grouped_sql(),
        "published_pivot": _pivot_sql(PIVOT_IDS),
        # end to end
        "refresh_fact": _numbered(with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score, has_duplicates_of_last_largest_score "
            "FROM fact_fk_ok", "fact_fk_ok")),
        "refresh_full_similarity": _numbered(with_ctes(
            "SELECT source_chembl_id, target_chembl_id, similarity_score FROM scored", "scored")),
        "refresh_report": with_ctes(_count_rows([
            ("ingested/chembl_id_lookup.parquet", "raw_chembl_id_lookup"),
            ("ingested/molecule_dictionary.parquet", "raw_molecule_dictionary"),
            ("ingested/compound_properties.parquet", "raw_compound_properties"),
            ("ingested/compound_structures.parquet", "raw_compound_structures WHERE canonical_smiles IS NOT NULL"),
            ("bronze.chembl_id_lookup", "chembl_id_lookup"),
            ("bronze.molecule_dictionary", "molecule_dictionary"),
            ("bronze.compound_properties", "compound_properties"),
            ("bronze.compound_structures", "raw_compound_structures WHERE canonical_smiles IS NOT NULL"),
            ("gold.dim_molecule", "dim"),
            ("fingerprints", "fp"),
            ("gold.fact_similarity", "fact_fk_ok"),
            ("full_similarity", "scored")]),
            "raw_chembl_id_lookup", "raw_molecule_dictionary", "raw_compound_properties",
            "raw_compound_structures", "chembl_id_lookup", "molecule_dictionary", "compound_properties",
            "dim", "fp", "fact_fk_ok", "scored"),
    }
