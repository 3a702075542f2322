"""Stats, manifests and small checks on inline tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from annolake.operators import curate as CU
from annolake.operators import intervals as I
from annolake.operators import merge as U
from annolake.operators import stats as S


def test_subject_summary_and_ages(spark):
    ch = spark.createDataFrame(
        [("d", "A", "F", "en;fr", "Y", dt.date(2020, 1, 1), None),
         ("d", "B", "m", "en", "N", dt.date(2021, 1, 1), None),
         ("d", "C", "F", "es", "Y", dt.date(2021, 1, 1), "1")],
        "dataset string, child_id string, child_sex string, languages string, normative string, "
        "child_dob date, discard string")
    rec = spark.createDataFrame([("A", dt.date(2021, 1, 1), None), ("A", dt.date(2020, 7, 1), None),
                                 ("B", dt.date(2021, 7, 2), None), ("B", dt.date(2022, 1, 1), "1")],
                                "child_id string, date_iso date, discard string")
    r = S.subject_summary(ch, rec).first()
    assert (r.n_children, r.languages, r.monolingual, r.multilingual, r.normative, r.non_normative,
            r.male, r.female) == (2, 2, 1, 1, 1, 1, 1, 1)
    assert (r.min_age_months, r.max_age_months) == (5.98, 12.02)
    ages = {x.child_id: x.age_months for x in S.child_age(C_drop(rec), ch).collect()}
    assert ages["A"] == 5.98 and ages["C"] is None


def C_drop(df):
    from annolake.functions.columns import drop_discarded
    return drop_discarded(df)


def test_cut_manifest_skips_existing(spark):
    clips = spark.createDataFrame([("r.wav", 0, 10), ("r.wav", 20, 30)], "recording_filename string, start long, end long")
    existing = spark.createDataFrame([("r-0to10.wav",)], "path string")
    jobs = I.cut_manifest(clips, existing=existing)
    assert [(j.source, j.start, j.end, j.output) for j in jobs.collect()] == [("r.wav", 20, 30, "r-20to30.wav")]


def test_copy_manifest_targets(spark):
    fi = spark.createDataFrame([("c1", "/data/c1/annotations/s/converted/a.csv"),
                                ("c1", "/data/c1/annotations/s/converted/a.csv")], "dataset string, p string")
    man = U.copy_manifest(fi, "out", items=[("annotation", F.col("p"), "annotations", ["annotations"])])
    assert [(m.kind, m.target) for m in man.collect()] == [("annotation", "out/annotations/c1/s/converted/a.csv")]
    none = U.copy_manifest(fi, "out", items=[("annotation", F.col("p"), "annotations", ["annotations"])],
                           existing=man.select("target"))
    assert none.count() == 0


def test_unmapped_sets_and_axes(spark):
    files = spark.createDataFrame([("d", "s1"), ("d", "s2")], "dataset string, set_name string")
    idx = spark.createDataFrame([("d", "s1", "vtc_cols", "st")], "dataset string, set_name string, category string, column string")
    assert [r.set_name for r in CU.unmapped_sets(files, idx).collect()] == ["s2"]
    S.check_axes("child_age", "recording")
    with pytest.raises(ValueError):
        S.check_axes("speaker_type", "recording")


def test_distribution_axis_labels_and_sort(spark):
    df = spark.createDataFrame([("d", 1.04, 10), ("d", 1.01, 20), ("d", None, 5), ("d", 2.0, 1)],
                               "dataset string, child_age double, duration long")
    out = S.distribution(df, "child_age", "duration", sort_by_y=True, metrics=["duration_total", "count"],
                         total_unit=1)
    got = [(r.child_age, r.duration_total, r["count"]) for r in out.collect()]
    assert got == [("1.0", 30.0, 2), ("N/A", 5.0, 1), ("2.0", 1.0, 1)]


def _shop(spark):
    from datetime import date
    ch = spark.createDataFrame([("A", 1, "F", date(2020, 1, 1), None), ("A", 2, None, date(2020, 1, 1), None),
                                ("A", 3, "M", date(2020, 1, 1), "1")],
                               "dataset string, child_id long, child_sex string, child_dob date, discard string")
    rec = spark.createDataFrame([("r1", 1, date(2021, 1, 1), 3_600_000, None), ("r2", 2, date(2022, 1, 1), 7_200_000, None),
                                 ("r3", 2, date(2023, 1, 1), 1, "1"), ("r4", 3, date(2021, 1, 1), 1, None)],
                                "recording string, child_id long, date_iso date, duration long, discard string")
    seg = spark.createDataFrame([("r1", "m", 0, 1000, "CHI", "a"), ("r1", "m", 0, 3000, None, "b"), ("r2", "m", 5, 505, "CHI", "a"),
                                 ("r1", "auto", 0, 9000, "CHI", "a"), ("r4", "m", 0, 9000, "CHI", "a")],
                                "recording string, set_name string, segment_onset long, segment_offset long, speaker_type string, speaker_id string")
    side = spark.createDataFrame([("m", "manual"), ("auto", "automated")], "set_name string, method string")
    return ch, rec, seg, side


def test_describe_axes(spark):
    from annolake.plans.describe import ALL, describe
    t = _shop(spark)
    rows = lambda *a, **k: [tuple(r) for r in describe(*t, *a, **k).collect()]
    assert rows("child_id", metric="count", sort_by_y=True) == [("A", "1", 2), ("A", "2", 1)]
    assert rows("child_sex", metric="duration_mean", sort_by_y=False) == [("A", "F", 2000.0, 2), ("A", "N/A", 500.0, 1)]
    assert set(rows("speaker_type", metric="count")) == {("A", "CHI", 2), ("A", "N/A", 1)}
    assert set(rows("speaker_id", metric="count", aggregate=True)) == {(ALL, "a", 2), (ALL, "b", 1)}
    assert rows("child_age", metric="count", sort_by_y=False) == [("A", "12.0", 2), ("A", "24.0", 1)]
    got = rows("child_age", "recording", "duration_total", sort_by_y=False)
    assert [(r[1][:2], r[2]) for r in got] == [("01", 1.0), ("10", 2.0)]
    with pytest.raises(ValueError):
        describe(*t, "speaker_id", "recording")


def test_subject_table_keeps_what_is_there(spark):
    ch, rec, _, _ = _shop(spark)
    got = S.subject_table(ch.withColumn("normative", F.lit("Y")), rec)
    assert got.columns == ["dataset", "child_id", "child_sex", "normative", "age_months"]
    assert sorted((r.child_id, r.age_months) for r in got.collect()) == [(1, 12.02), (2, 24.02)]


@pytest.mark.parametrize("collar", [0, 15])
def test_support_dense_chunk_null_key_and_bridges(spark, collar):
    # equal starts, an interval that reaches over many chunks, chunks without an opening of their own, a null key
    rows = [("a", 5, 6 + k % 30) for k in range(300)] + [("a", 40, 1000), ("a", 45, 50), ("a", 60, 70), ("a", 990, 1001),
                                                         ("a", 1010, 1020), ("a", 1035, 1040), (None, 1, 2), (None, 2, 3), ("a", 7, 7)]
    want = []
    for key in ("a", None):
        cur = None
        for s, e in sorted((s, e) for k, s, e in rows if k == key and s < e):
            if cur and not (s > cur[1] and s - cur[1] >= collar):
                cur[1] = max(cur[1], e)
            else:
                cur = [s, e]
                want.append((key, cur))
    df = spark.createDataFrame(rows, "k string, start long, end long").repartition(7)
    got = {(r.k, r.start, r.end) for r in I.support(df, ["k"], collar=collar, chunk=10).collect()}
    assert got == {(k, s, e) for k, (s, e) in want}


def test_support_reads_its_rows_once(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id * 10 AS start", "id * 10 + id % 15 + 1 AS end")
    out = I.support(df, ["k"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Range (") == 1 and "ReusedExchange" in final


def test_segments_are_not_shuffled_by_set(spark, monkeypatch):
    """One manual set may hold most segments: neither flow may send a set's segments to one task, whatever the broadcast limit."""
    from annolake import session
    from annolake.plans.describe import describe, describe_all
    ch, rec, seg, side = _shop(spark)
    side = side.union(side).union(spark.createDataFrame([(None, "manual")], side.schema))     # repeated and null sets change nothing
    seg = seg.union(spark.createDataFrame([("r1", None, 0, 9000, "CHI", "a")], seg.schema))
    plans, cut = [], session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df, name="table": plans.append(df) or cut(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {(r.dataset, r.axis, r.x): r["count"] for r in describe_all(ch, rec, seg, side).collect()}
        plans.append(describe(ch, rec, seg, side, "speaker_id"))
        for df in plans:
            semi = [x for x in df._jdf.queryExecution().sparkPlan().toString().splitlines() if "LeftSemi" in x]
            assert semi and all("BroadcastHashJoin" in x for x in semi), semi
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(plans) == 2 and got["A", "speaker_id", "a"] == 2 and got["A", "child_id", "1"] == 2 and got["A", "speaker_id", "b"] == 1
