"""Profiles, sampled durations and validation checks on inline tables."""

from annolake.operators import checks as K
from annolake.operators import profile as A
from annolake.sources.sidecars import typed_sidecars


def test_label_profile_null_counts_as_value(spark):
    rows = [("d", "s", "st", v, 0, 10) for v in ["CHI", "FEM", None, None]] + \
           [("d", "s", "words", None, 0, 5)] + [("d", "s", "k", str(i), 0, 1) for i in range(25)]
    lab = spark.createDataFrame(rows, "dataset string, set_name string, label string, value string, "
                                      "onset long, offset_ms long")
    p = {r.column: r for r in A.label_profile(lab).collect()}
    assert (p["st"].annotated_ms, p["st"].num_non_empty, p["st"].n_values, p["st"].categorical) == (20, 2, 3, True)
    assert p["st"].values == ["CHI", "FEM"]
    assert (p["words"].annotated_ms, p["words"].n_values, p["words"].values) == (0, 1, [])
    assert p["k"].categorical is False and p["k"].values is None


def test_sampled_duration_fallbacks(spark):
    files = spark.createDataFrame([("d", "a", "x_0_100.csv"), ("d", "a", "x_100_300.csv"),
                                   ("d", "b", "y_0_50.csv"), ("d", "c", "z_0_70.csv")],
                                  "dataset string, set_name string, annotation_filename string")
    raw = spark.createDataFrame([("d", "a", {"sampling_count": "0", "sampling_unit_duration": "10"}),
                                 ("d", "b", {"sampling_count": "4", "sampling_unit_duration": "10"})],
                                "dataset string, set_name string, raw map<string,string>")
    sd = {r.set_name: (r.duration_from_samples_ms, r.number_of_samples)
          for r in A.sampled_duration(files, typed_sidecars(raw)).collect()}
    assert sd == {"a": (300, 0), "b": (40, 4)}      # zero count falls back for time, stays 0 for samples; no sidecar -> no row


def test_sidecar_value_check(spark):
    raw = spark.createDataFrame([("d", "s", {"method": "manual", "sampling_count": "x", "has_words": "maybe",
                                             "date_annotation": "2024-02-30", "extra": "ok"})],
                                "dataset string, set_name string, raw map<string,string>")
    bad = sorted(r.detail for r in K.check_sidecar_values(raw).collect())
    assert bad == ["date_annotation=2024-02-30", "has_words=maybe", "sampling_count=x"]


def test_flags(spark):
    idx = spark.createDataFrame([("d", "s", "vtc_cols", "st"), ("d", "s", "addressee_cols", "ad")],
                                "dataset string, set_name string, category string, column string")
    prof = spark.createDataFrame([("d", "s", "st", 10), ("d", "s", "ad", 0)],
                                 "dataset string, set_name string, column string, annotated_duration_ms long")
    raw = spark.createDataFrame([("d", "s", {"has_addressee": "y"})], "dataset string, set_name string, raw map<string,string>")
    assert [r.detail for r in K.check_missing_flag(idx, prof, raw).collect()] == ["has_speaker_type missing (10 ms)"]
    assert [r.detail for r in K.check_false_flag(idx, prof, raw).collect()] == ["has_addressee set but 0 ms"]


def test_all_rules_in_one_pass_equal_the_checks(spark, tmp_path):
    import random

    from annolake.operators.merge import union_all
    from annolake.plans.profiling import validation_report, write_validation
    rng = random.Random(6)
    corpora, sets, columns = ["c1", "c2", "c3"], ["s1", "s2", "s3", "s4"], ["a", "b", "c", "d"]
    lists = [*K.INDEX_LISTS, "ignore"]
    index = [(d, s, rng.choice(lists), c) for d in corpora[:2] + ["lost"] for s in sets if rng.random() < 0.8 for c in [*columns, None] if rng.random() < 0.6]
    index += index[:2]
    profile = [(d, s, c, rng.choice([0, 0, 5, 70])) for d in corpora for s in sets if rng.random() < 0.8 for c in columns if rng.random() < 0.6]
    raw = [(d, s, {f: rng.choice(["Y", "y", "N", "?"]) for f in ("has_speaker_type", "has_addressee", "has_vcm_type", "has_words") if rng.random() < 0.6}
            | ({"sampling_count": "many"} if rng.random() < 0.2 else {})) for d in [*corpora, "lost"] for s in sets if rng.random() < 0.7]
    i = spark.createDataFrame(index, "dataset string, set_name string, category string, column string")
    p = spark.createDataFrame(profile, "dataset string, set_name string, column string, annotated_duration_ms long")
    r = spark.createDataFrame(raw, "dataset string, set_name string, raw map<string,string>")
    n = K.nest_index(i).unionByName(spark.createDataFrame([("c2", None, ["x"])], "dataset string, set_name string, other array<string>"), allowMissingColumns=True)
    want = sorted(map(str, union_all([
        K.check_sidecar_values(r), K.check_index_columns(i, p), K.check_index_sets(i, p), K.check_missing_flag(i, p, r),
        K.check_false_flag(i, p, r), K.check_sidecar_missing(i, r), K.check_index_fields(n)]).collect()))
    report = validation_report(i, n, p, r)
    assert sorted(map(str, report.collect())) == want and len(want) > 40
    counts = write_validation(i, n, p, r, str(tmp_path))
    assert sum(counts.values()) == len(want) and {"unknown_corpus", "missing_flag", "index_field"} <= counts.keys()
    bad = {(x.dataset, x.set_name) for x in report.collect()}
    quarantined = spark.read.parquet(str(tmp_path / "quarantine")).collect()
    assert sorted((x.dataset, x.set_name) for x in quarantined) == sorted((d, s) for d, s, _ in raw if (d, s) in bad)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 6      # one for each input; the nested index is made from two here
