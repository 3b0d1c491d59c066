"""Property tests: packed-word Tanimoto equals the set formula on random sets."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import fps_frame
from setsim.operators import similarity

bitsets = st.sets(st.integers(min_value=0, max_value=2047), min_size=1, max_size=120)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(bitsets, min_size=2, max_size=12))
def test_packed_scores_equal_set_formula(spark, sets):
    # Sign bits (63, 127, …) and the last bit 2047 are the packing's edge cases.
    sets = [s | {63} if i % 3 == 0 else s for i, s in enumerate(sets)]
    rows = [(f"ID{i:02d}", sorted(s)) for i, s in enumerate(sets)]
    fps = fps_frame(spark, rows)
    got = {(r.source_chembl_id, r.target_chembl_id): r.similarity_score
           for r in similarity.score_pairs(fps, fps).collect()}
    assert len(got) == len(rows) * (len(rows) - 1)
    for a_id, a in rows:
        for b_id, b in rows:
            if a_id == b_id:
                continue
            sa, sb = set(a), set(b)
            want = len(sa & sb) / len(sa | sb)
            assert got[(a_id, b_id)] == want
            assert got[(a_id, b_id)] == got[(b_id, a_id)]
            assert 0.0 <= want <= 1.0
