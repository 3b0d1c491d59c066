"""Fingerprint operators: validity, determinism, width, counts, graph rounds."""

import hashlib

from setsim import schemas
from setsim.operators import fingerprint
from setsim.sources import writers
from setsim.session import scratch_path


def _structs(spark, rows):
    return spark.createDataFrame(rows, "chembl_id string, canonical_smiles string")


def _bits(spark, text, **kw):
    df = fingerprint.string_fingerprint(_structs(spark, [("X", text)]), **kw)
    return df.first()[fingerprint.BITS_COL]


def _py_ring_bits(text, radius=2, n_bits=2048):
    out = set()
    n = len(text)
    for r in range(radius + 1):
        for i in range(1, n + 1):
            lo, hi = max(i - r, 1), min(i + r, n)
            key = f"{r}:{text[lo - 1:hi]}"
            out.add(int(hashlib.md5(key.encode()).hexdigest()[:7], 16) % n_bits)
    return sorted(out)


def test_valid_string_gets_bits(spark):
    assert _bits(spark, "C1CCOC(=N)C1Cl")


def test_bits_follow_the_ring_window_rule(spark):
    for text in ["C1CCOC(=N)C1Cl", "x", "ab c"]:
        assert _bits(spark, text) == _py_ring_bits(text)


def test_blank_and_null_are_invalid(spark):
    assert _bits(spark, "") is None
    assert _bits(spark, "   \t") is None
    assert _bits(spark, None) is None


def test_pattern_rejects_unparsable(spark):
    assert _bits(spark, "this is not valid", valid_pattern=r"^[A-Za-z0-9()=#@+\-\[\]\\/%.]+$") is None


def test_deterministic(spark):
    assert _bits(spark, "N#CC(F)(Br)c1ccccc1O") == _bits(spark, "N#CC(F)(Br)c1ccccc1O")


def test_width_respected(spark):
    for n_bits in (1024, 2048):
        bits = _bits(spark, "N#CC(F)(Br)c1ccccc1O" * 3, n_bits=n_bits)
        assert max(bits) < n_bits and bits == sorted(set(bits))


def test_skip_invalid_and_count(spark):
    df = _structs(spark, [("CHEMBL1", "CC(=O)O"), ("CHEMBL2", "  ")])
    fps = fingerprint.fingerprint_structures(df).collect()
    assert [r.chembl_id for r in fps] == ["CHEMBL1"]
    counts = fingerprint.fingerprint_counts(df).first()
    assert (counts.written, counts.failed) == (1, 1)


def test_export_five_rows(spark):
    df = _structs(spark, [(f"C{i}", "CCO" + "C" * i) for i in range(5)])
    path = scratch_path(spark, "t_export")
    assert writers.export_fingerprints(df, path, partitions=2) == (5, 0)
    back = spark.read.parquet(path)
    assert back.count() == 5 and back.columns == ["chembl_id", "fingerprint_on_bits"]


def test_export_without_a_valid_row_is_an_empty_table(spark):
    df = _structs(spark, [("C1", ""), ("C2", None)])
    path = scratch_path(spark, "t_export_empty")
    assert writers.export_fingerprints(df, path) == (0, 2)
    assert spark.read.schema(schemas.FINGERPRINTS).parquet(path).count() == 0


def test_unicode_space_and_separators_are_blank(spark):
    for text in ("\x1c\x1d\x1e\x1f", "\u00a0\u2003", "\x85\u3000 \t", "\u1680\u2028\u2029\u202f\u205f"):
        assert text.strip() == "" and _bits(spark, text) is None
    assert _bits(spark, "\x1b") and _bits(spark, "\u200b")


def test_repeated_ids_keep_one_fingerprint_for_each_row(spark):
    rows = [("A", "CCO"), ("A", "CCO"), ("A", "NNN")]
    got = sorted(r.fingerprint_on_bits for r in fingerprint.fingerprint_structures(_structs(spark, rows)).collect())
    assert got == sorted(_py_ring_bits(t) for _, t in rows)


def test_time_follows_the_length(spark):
    import time
    took = []
    for n in (20_000, 160_000):
        df = _structs(spark, [("X", "".join(chr(97 + (i * i + i // 7) % 26) for i in range(n)))])
        once = []
        for _ in range(3):
            start = time.perf_counter()
            assert len(fingerprint.string_fingerprint(df).first()[fingerprint.BITS_COL]) > 10
            once.append(time.perf_counter() - start)
        took.append(min(once))
    assert took[1] < 8 * 3 * took[0]  # eight times the text; a quadratic rule would take 64 times


def test_written_plus_failed_is_input(spark):
    rows = [(f"C{i}", None if i % 3 == 0 else ("  " if i % 3 == 1 else "CCN")) for i in range(30)]
    c = fingerprint.fingerprint_counts(_structs(spark, rows)).first()
    assert c.written + c.failed == 30


def test_bit_counts(spark):
    fps = spark.createDataFrame([("A", [1, 5, 2047])], "chembl_id string, fingerprint_on_bits array<bigint>")
    r = fingerprint.bit_counts(fps).first()
    assert (r.num_on_bits, r.n_bits, r.max_bit) == (3, 2048, 2047)


def _h28(s):
    return int(hashlib.md5(s.encode()).hexdigest()[:7], 16)


def test_graph_fingerprint_matches_python(spark):
    nodes = [(1, 1, "A"), (1, 2, "B"), (1, 3, "A"), (2, 1, "C")]
    edges = [(1, 1, 2), (1, 2, 3)]
    nd = spark.createDataFrame(nodes, "graph_id long, node_id int, label string")
    ed = spark.createDataFrame(edges, "graph_id long, a int, b int")
    got = {r.graph_id: r.fingerprint_on_bits for r in fingerprint.graph_fingerprint(nd, ed, 2, 2048).collect()}

    h = {(g, n): _h28("0|" + lab) for g, n, lab in nodes}
    allh = {g: {v % 2048 for (gg, _), v in h.items() if gg == g} for g in (1, 2)}
    nbrs = {}
    for g, a, b in edges:
        nbrs.setdefault((g, a), []).append((g, b))
        nbrs.setdefault((g, b), []).append((g, a))
    for k in (1, 2):
        new = {}
        for node, own in h.items():
            ns = nbrs.get(node, [])
            s = sum(_h28(str(h[m]).zfill(10)) for m in ns)
            new[node] = _h28(f"{k}|{own}|{len(ns)}|{s}")
        h = new
        for (g, _), v in h.items():
            allh[g].add(v % 2048)
    assert got == {g: sorted(v) for g, v in allh.items()}


def test_graph_fingerprint_lazy_equals_materialized(spark):
    nd = spark.createDataFrame([(1, i, "L" + str(i % 3)) for i in range(1, 8)], "graph_id long, node_id int, label string")
    ed = spark.createDataFrame([(1, i, i + 1) for i in range(1, 7)], "graph_id long, a int, b int")
    a = fingerprint.graph_fingerprint(nd, ed, materialize_rounds=True).collect()
    b = fingerprint.graph_fingerprint(nd, ed, materialize_rounds=False).collect()
    assert a == b


def _py_graph_bits(nodes, edges, radius=2, n_bits=2048):
    h = {(g, n): _h28("0|" + lab) for g, n, lab in nodes}
    allh = {}
    for (g, _), v in h.items():
        allh.setdefault(g, set()).add(v % n_bits)
    nbrs = {}
    for g, a, b in edges:
        nbrs.setdefault((g, a), []).append((g, b))
        nbrs.setdefault((g, b), []).append((g, a))
    for k in range(1, radius + 1):
        h = {node: _h28(f"{k}|{own}|{len(nbrs.get(node, []))}|"
                        f"{sum(_h28(str(h[m]).zfill(10)) for m in nbrs.get(node, []))}")
             for node, own in h.items()}
        for (g, _), v in h.items():
            allh[g].add(v % n_bits)
    return {g: sorted(v) for g, v in allh.items()}


def test_graph_hub_node(spark):
    # One hub with 200 neighbours: its neighbourhood is a partial sum/count,
    # not a collected list; the result must still follow the rule exactly.
    nodes = [(7, 0, "HUB")] + [(7, i, f"L{i % 4}") for i in range(1, 201)]
    edges = [(7, 0, i) for i in range(1, 201)]
    nd = spark.createDataFrame(nodes, "graph_id long, node_id int, label string")
    ed = spark.createDataFrame(edges, "graph_id long, a int, b int")
    got = {r.graph_id: r.fingerprint_on_bits for r in fingerprint.graph_fingerprint(nd, ed).collect()}
    assert got == _py_graph_bits(nodes, edges)


def _odd_graphs(spark):
    """Chains and hubs of 1 to 40 nodes; repeated node ids, edges without a node or
    with a null end, a null label, and rows without a graph id."""
    nodes = [(g, i, f"L{(g * i) % 5}") for g in range(12) for i in range(1, 2 + g * g % 41)]
    nodes += [(3, 2, "again"), (3, 2, "L9"), (5, 1, None), (6, None, "L1"), (None, 1, "L1"), (None, 2, "L2")]
    edges = [(g, i, i + 1) for g in range(12) for i in range(1, 1 + g * g % 41)]
    edges += [(11, 1, i) for i in range(2, 30)]
    edges += [(3, 1, 2), (4, 1, 99), (4, 99, 98), (20, 1, 2), (6, None, 1), (5, 2, None), (None, 1, 2)]
    return (spark.createDataFrame(nodes, "graph_id long, node_id int, label string"),
            spark.createDataFrame(edges, "graph_id long, a int, b int"))


def test_small_and_large_graphs_follow_one_rule(spark):
    nd, ed = _odd_graphs(spark)

    def rows(**kw):
        return sorted(fingerprint.graph_fingerprint(nd, ed, **kw).collect(), key=str)
    for radius, bounds in ((2, (0, 10, 256)), (3, (10,))):  # all large, both kinds, all small
        expected = rows(radius=radius, materialize_rounds=False)
        assert len(expected) == 13
        for bound in bounds:
            assert rows(radius=radius, small_graph=bound) == expected


def test_rounds_of_small_graphs_find_their_rows_in_place(spark):
    nd, ed = _odd_graphs(spark)
    plan = fingerprint.graph_fingerprint(nd, ed)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(graph_id" in plan
    assert "ENSURE_REQUIREMENTS" not in plan  # no exchange for the join or a grouping


def test_column_helper_equals_exploded_operator(spark):
    from setsim.functions import ring_window_bits
    df = _structs(spark, [("A", "C1CCOC(=N)C1Cl"), ("B", "x"), ("C", "ab c")])
    col_form = {r.chembl_id: r.b for r in df.select("chembl_id", ring_window_bits("canonical_smiles", 2, 2048).alias("b")).collect()}
    op_form = {r.chembl_id: r.fingerprint_on_bits for r in fingerprint.fingerprint_structures(df).collect()}
    assert col_form == op_form
