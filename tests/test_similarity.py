"""Search semantics: Tanimoto, self-exclusion, ordering, top-k tie flag."""

import pytest
from pyspark.sql import functions as F

from conftest import fps_frame, scored_frame
from setsim.functions import tanimoto
from setsim.operators import similarity

# Three bit sets: MANY and SOME share four bits, OTHER shares none with either.
MANY = [0, 7, 63, 64, 190, 512, 1023, 1024, 2046, 2047]
SOME = [0, 63, 64, 2047, 300, 301]
OTHER = [3, 4, 5, 6, 70, 71, 72]


def _pairs(spark, rows, src_id, **kw):
    fps = fps_frame(spark, rows)
    return similarity.score_pairs(fps.filter(F.col("chembl_id") == src_id).limit(1), fps, **kw)


def test_identical_sets_score_one(spark):
    df = fps_frame(spark, [("A", MANY)])
    assert df.select(tanimoto("fingerprint_on_bits", "fingerprint_on_bits")).first()[0] == 1.0


def test_tanimoto_is_symmetric_and_bounded(spark):
    df = fps_frame(spark, [("A", MANY)]).crossJoin(
        fps_frame(spark, [("B", SOME)]).withColumnRenamed("chembl_id", "b")
        .withColumnRenamed("fingerprint_on_bits", "bits_b"))
    ab, ba = df.select(tanimoto("fingerprint_on_bits", "bits_b"), tanimoto("bits_b", "fingerprint_on_bits")).first()
    assert ab == ba == 4 / 12


def test_packed_score_equals_set_intersection(spark):
    rows = [("A", MANY), ("B", SOME), ("C", OTHER), ("D", [63, 64, 127, 1983, 2047]), ("E", [0])]
    got = {r.target_chembl_id: r.similarity_score for r in _pairs(spark, rows, "A").collect()}
    for tid, bits in rows[1:]:
        a, b = set(MANY), set(bits)
        assert got[tid] == len(a & b) / len(a | b)


def test_self_excluded_by_id(spark):
    assert _pairs(spark, [("SRC", MANY), ("SRC", MANY)], "SRC").collect() == []


def test_same_bits_other_id_scores_one(spark):
    out = _pairs(spark, [("SRC", MANY), ("TWIN", MANY)], "SRC").collect()
    assert [(r.target_chembl_id, r.similarity_score) for r in out] == [("TWIN", 1.0)]


def test_near_ranks_before_unrelated_and_zero_is_kept(spark):
    fps = fps_frame(spark, [("Q", MANY), ("NEAR", SOME), ("FAR", OTHER)])
    rows = similarity.compute_top_k(fps.filter("chembl_id = 'Q'"), fps, k=10).orderBy(F.desc("similarity_score")).collect()
    assert [(r.target_chembl_id, r.similarity_score) for r in rows] == [("NEAR", 4 / 12), ("FAR", 0.0)]


def _flags(spark, scores, k=10):
    # Ids are zero-padded so that text order (the tie order, M7) equals list order.
    rows = [("SRC", f"T{i:02d}", s) for i, s in enumerate(scores)]
    out = similarity.rank_top_k(scored_frame(spark, rows), k=k).collect()
    return {r.target_chembl_id: r.has_duplicates_of_last_largest_score for r in out}


def _expected_flags(scores, k):
    """The rule restated: rows that equal the k-th score, if a later row does too."""
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i))
    top = order[:k]
    tied = len(order) > k and scores[order[k]] == scores[order[k - 1]]
    return {f"T{i:02d}": tied and scores[i] == scores[order[k - 1]] for i in top}


@pytest.mark.parametrize("k,scores", [
    (10, [i / 64 for i in range(40, 20, -1)]),                       # all differ
    (10, [0.75] * 3 + [0.5] * 4 + [0.25] * 9),                       # the cut falls inside ties
    (10, [0.875, 0.875] + [i / 32 for i in range(20, 9, -1)]),       # ties above the cut only
    (10, [0.125] * 10), (10, [0.125] * 4), (10, [0.125] * 11), (10, []),
    (1, [0.5, 0.5]), (3, [0.25, 0.5, 0.5, 0.5, 0.5]), (3, [0.0, 0.0, 0.0, 0.0]),
])
def test_tie_flag_rule(spark, k, scores):
    assert _flags(spark, scores, k) == _expected_flags(scores, k)


def test_tie_order_is_target_id(spark):
    rows = [("SRC", t, 0.5) for t in ["T3", "T1", "T2"]]
    out = similarity.rank_top_k(scored_frame(spark, rows), k=2, flag=False).orderBy("rank").collect()
    assert [r.target_chembl_id for r in out] == ["T1", "T2"]


def test_every_row_ties_when_all_fingerprints_are_equal(spark):
    fps = fps_frame(spark, [(f"X{i:02d}", SOME) for i in range(23)])
    top = similarity.compute_top_k(similarity.select_source_molecules(fps, 3), fps, k=7).collect()
    assert {r.source_chembl_id for r in top} == {"X00", "X01", "X02"} and len(top) == 21
    assert all(r.has_duplicates_of_last_largest_score and r.similarity_score == 1.0 for r in top)


def test_source_selection_is_first_ids_in_text_order(spark):
    ids = [f"N{i}" for i in range(150)]
    got = [r.chembl_id for r in similarity.select_source_molecules(fps_frame(spark, [(i, [1]) for i in ids]), 70).collect()]
    assert got == sorted(ids)[:70]


def test_source_selection_of_repeated_ids_is_decided(spark):
    rows = [("A", [9]), ("A", [1]), ("A", [5]), ("B", [2])]
    for part in (rows, rows[::-1]):
        got = similarity.select_source_molecules(fps_frame(spark, part), 2).collect()
        assert [(r.chembl_id, r.fingerprint_on_bits) for r in got] == [("A", [1]), ("A", [5])]


@pytest.mark.parametrize("n", [17, 40])
def test_full_table_keeps_every_other_row(spark, n):
    fps = fps_frame(spark, [(f"X{i}", OTHER) for i in range(n)])
    full = similarity.compute_full_similarity(fps.filter("chembl_id = 'X0'"), fps)
    assert full.count() == n - 1
    assert full.columns == ["source_chembl_id", "target_chembl_id", "similarity_score"]


def _many(n, width=2048):
    return [(f"ID{i:03d}", sorted({(i * 7 + j * 13 + j * j * (i % 5)) % width for j in range(5 + i % 23)})) for i in range(n)]


@pytest.mark.parametrize("blocks", [similarity.Blocks(1, 1, 1), similarity.Blocks(5, 3, 4), similarity.Blocks(30, 50, 7)])
def test_blocks_change_no_pair(spark, blocks):
    rows = _many(40)
    fps = fps_frame(spark, rows)
    sources = similarity.select_source_molecules(fps, 12)
    got = {(r[0], r[1]): r[2] for r in similarity.score_pairs(sources, fps, blocks=blocks).collect()}
    bits = {i: set(b) for i, b in rows}
    assert got == {(s, t): len(bits[s] & bits[t]) / len(bits[s] | bits[t])
                   for s in sorted(bits)[:12] for t in bits if s != t}


@pytest.mark.parametrize("n,k", [(200, 10), (60, 1), (9, 10)])
def test_top_k_matches_brute_force(spark, n, k):
    rows = _many(n, 64)
    fps = fps_frame(spark, rows)
    got = similarity.compute_top_k(similarity.select_source_molecules(fps, 15), fps, k).collect()
    bits = {i: set(b) for i, b in rows}
    want = set()
    for s in sorted(bits)[:15]:
        scores = sorted((-len(bits[s] & bits[t]) / len(bits[s] | bits[t]), t) for t in bits if t != s)
        tied = len(scores) > k and scores[k][0] == scores[k - 1][0]
        want |= {(s, t, -x, tied and x == scores[k - 1][0]) for x, t in scores[:k]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_two_hop_matches_brute_force(spark):
    rows = [(f"M{i}", sorted({(i * i + j * 5) % 300 for j in range(12)})) for i in range(30)]
    fps = fps_frame(spark, rows)
    from setsim.operators import mart
    sources = similarity.select_source_molecules(fps, 5)
    fact = similarity.compute_top_k(sources, fps, k=3)
    got = {r.source_chembl_id: tuple(r)[1:] for r in mart.similarity_two_hop(fact, fps).collect()}

    bits = dict(rows)

    def best(i):
        cand = [(-(len(set(bits[i]) & set(bits[t])) / len(set(bits[i]) | set(bits[t]))), t) for t in bits if t != i]
        s, t = min(cand)
        return t, -s

    for src in sorted(bits)[:5]:
        m, ms = best(src)
        n, ns = best(m)
        assert got[src] == (m, ms, n, ns)
