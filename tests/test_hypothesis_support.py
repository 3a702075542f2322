"""Hypothesis: support equals the brute-force merge for any intervals, collar and chunk width;
islands are disjoint and cover exactly the union of the input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from annolake.operators.intervals import support
from tests.test_intervals_props import brute_support

intervals = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(-20, 300), st.integers(0, 60)),
    min_size=0, max_size=60)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ivs=intervals, collar=st.sampled_from([0, 1, 7]), chunk=st.sampled_from([1, 13, 1000]))
def test_support_property(spark, ivs, collar, chunk):
    rows = [(k, s, s + ln) for k, s, ln in ivs]
    df = spark.createDataFrame(rows, "rec string, start long, end long")
    got = sorted(tuple(r) for r in support(df, ["rec"], collar=collar, chunk=chunk).collect())
    assert got == brute_support(rows, collar)
    for k in {r[0] for r in got}:
        isl = [(s, e) for kk, s, e in got if kk == k]
        assert all(isl[i][1] < isl[i + 1][0] for i in range(len(isl) - 1))       # disjoint, gaps > 0
        if collar == 0:
            cover = {p for kk, s, e in rows if kk == k for p in range(s, e)}
            assert cover == {p for s, e in isl for p in range(s, e)}            # cover unchanged


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ivs=intervals, chunk=st.sampled_from([1, 13, 1000]))
def test_support_then_crop_equals_crop_then_support(spark, ivs, chunk):
    from annolake.operators.intervals import support_in_recording
    dur = {"a": 100, "b": 250, "hot": 0}                   # "hot" has no room: everything vanishes
    rows = [(k, s - 30, s - 30 + ln) for k, s, ln in ivs]   # starts from -50, some past the end
    cropped = [(k, max(s, 0), min(e, dur[k])) for k, s, e in rows]
    expect = brute_support([r for r in cropped if r[1] < r[2]], 0)
    df = spark.createDataFrame(rows, "recording string, start long, end long")
    rec = spark.createDataFrame(list(dur.items()), "recording string, duration long")
    got = sorted(tuple(r) for r in support_in_recording(df, rec, chunk=chunk).collect())
    assert got == expect
