"""S1-S8 on a small corpus tree written to a temporary folder."""

import json
import os

from pyspark.sql import functions as F

from annolake.sources.index import scan_index, scan_segments, segments_long
from annolake.sources.profiles import scan_category_index, scan_profiles, write_profiles
from annolake.sources.sidecars import scan_sidecars
from annolake.sources.sinks import write_table


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _tree(root):
    # two corpora, different recordings headers (other order + extra column)
    _w(f"{root}/c1/metadata/recordings.csv",
       "recording_filename,child_id,duration\nr1.wav,A,1000\nr2.wav,B,NA\n")
    _w(f"{root}/c2/metadata/recordings.csv",
       "child_id,recording_filename,duration,discard\nZ,z1.wav,5,1\nY,\"y,1.wav\",7,\n")
    # segments: set s1 has speaker_type; set s2 has speaker_type + addressee (all null)
    _w(f"{root}/c1/annotations/s1/converted/r1_0_1000.csv",
       "segment_onset,segment_offset,speaker_type\n0,10,CHI\n10,30,\n")
    _w(f"{root}/c1/annotations/s2/converted/r1_0_500.csv",
       "segment_onset,segment_offset,speaker_type,addressee\n0,5,FEM,NA\n")
    _w(f"{root}/c1/annotations/s1/metannots.yml",
       "method: manual\nsampling_count: 3  # three samples\nsampling_unit_duration: 60000\nhas_speaker_type: Y\n")
    _w(f"{root}/c1/annotations/s2/metannots.yml",
       "method: 'automated'\nsampling_target: xyz\ndate_annotation: 2024-01-05\nnotes: ~\n")


def test_scan_index_heterogeneous_headers(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _tree(root)
    df = scan_index(spark, root, "recordings")
    rows = sorted((r.dataset, r.recording_filename, r.child_id, r.duration, r.discard) for r in df.collect())
    assert rows == [("c1", "r1.wav", "A", 1000, None), ("c1", "r2.wav", "B", None, None),
                    ("c2", "y,1.wav", "Y", 7, None), ("c2", "z1.wav", "Z", 5, "1")]
    only = scan_index(spark, root, "recordings", datasets=["c2"])
    assert {r.dataset for r in only.collect()} == {"c2"}


def test_scan_segments_label_maps(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _tree(root)
    seg = scan_segments(spark, root)
    got = sorted((r.set, r.segment_onset, sorted(r.labels.items())) for r in seg.collect())
    assert got == [("s1", 0, [("speaker_type", "CHI")]), ("s1", 10, [("speaker_type", None)]),
                   ("s2", 0, [("addressee", None), ("speaker_type", "FEM")])]
    long = segments_long(seg)
    assert long.filter(F.col("label") == "addressee").count() == 1   # all-null column is still data
    # a column present in only some files of a set gives null rows for the others
    _w(f"{root}/c1/annotations/s1/converted/r2_0_50.csv", "segment_onset,segment_offset,speaker_type,vcm_type\n0,5,CHI,C\n")
    long = segments_long(scan_segments(spark, root)).filter("set = 's1'")
    got = sorted((r.annotation_filename, r.segment_onset, r.label, r.value) for r in long.collect())
    assert got == [("r1_0_1000.csv", 0, "speaker_type", "CHI"), ("r1_0_1000.csv", 0, "vcm_type", None),
                   ("r1_0_1000.csv", 10, "speaker_type", None), ("r1_0_1000.csv", 10, "vcm_type", None),
                   ("r2_0_50.csv", 0, "speaker_type", "CHI"), ("r2_0_50.csv", 0, "vcm_type", "C")]


def test_scan_sidecars(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _tree(root)
    sc = {(r.dataset, r.set_name): r for r in scan_sidecars(spark, root).collect()}
    s1, s2 = sc[("c1", "s1")], sc[("c1", "s2")]
    assert s1.sampling_count == 3 and s1.sampling_unit_duration == 60000 and s1.has_speaker_type == "Y"
    assert s2.method == "automated" and s2.sampling_target is None and s2.raw["sampling_target"] == "xyz"
    assert str(s2.date_annotation) == "2024-01-05" and "notes" not in s2.raw


def test_profiles_roundtrip(spark, tmp_path):
    d = tmp_path / "profiles"
    d.mkdir()
    doc = {"name": "c1", "sets": [{"name": "s1", "columns": [
        {"column": "speaker_type", "categorical": True, "annotated_duration_ms": 10,
         "duration_from_samples_ms": 180000, "number_of_samples": 3, "num_of_non_empty_segments": 1}]}]}
    (d / "human_annotation_data-c1.json").write_text(json.dumps(doc, indent=2))
    prof = scan_profiles(spark, str(d))
    assert [tuple(r) for r in prof.collect()] == [("c1", "s1", "speaker_type", True, 10, 180000, 3, 1)]
    out = str(tmp_path / "out")
    write_profiles(prof, out)
    back = scan_profiles(spark, out + "/corpus=c1")
    assert [tuple(r) for r in back.collect()] == [("c1", "s1", "speaker_type", True, 10, 180000, 3, 1)]


def test_category_index(spark, tmp_path):
    p = tmp_path / "index.json"
    p.write_text(json.dumps({"datasets": [{"name": "c1", "sets": [
        {"name": "s1", "addressee_cols": [], "vcm_cols": [], "vtc_cols": ["speaker_type"],
         "transcription_cols": [], "other": ["words"]},
        {"name": "s2", "vtc_cols": ["speaker_type"]}]}]}))
    long, nested = scan_category_index(spark, str(p))
    assert sorted(tuple(r) for r in long.collect()) == [
        ("c1", "s1", "other", "words"), ("c1", "s1", "vtc_cols", "speaker_type"),
        ("c1", "s2", "vtc_cols", "speaker_type")]
    from annolake.operators.checks import check_index_fields
    bad = sorted(r.detail for r in check_index_fields(nested).collect())
    assert bad == ["missing addressee_cols", "missing other", "missing transcription_cols", "missing vcm_cols"]


def test_write_table_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "dataset string, x int")
    p = write_table(df, str(tmp_path / "t"), partition_by=["dataset"], suffix="has_x")
    assert sorted(x for x in os.listdir(p) if x.startswith("dataset=")) == ["dataset=a", "dataset=b"]
    back = spark.read.parquet(p).filter("dataset = 'b'")
    assert [r.x for r in back.collect()] == [2]
    write_table(df, str(tmp_path / "c"), fmt="csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2


def test_sidecar_values_with_colons_and_hashes(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _w(f"{root}/c9/annotations/x/y/metannots.yml",
       "annotation_algorithm_repo: https://example.org/a#frag   # trailing comment\n"
       "notes: \"see: here\"\n# full-line comment\nsampling_unit_duration: 500\n")
    r = scan_sidecars(spark, root).collect()[0]
    assert (r.dataset, r.set_name) == ("c9", "x/y")
    assert r.annotation_algorithm_repo == "https://example.org/a#frag"
    assert r.notes == "see: here" and r.sampling_unit_duration == 500


def test_merge_replace_null_keys(spark):
    from annolake.operators.merge import merge_replace
    old = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    new = spark.createDataFrame([(None, 9), ("a", 8)], "k string, v int")
    got = sorted((str(r.k), r.v) for r in merge_replace(old, new, "k").collect())
    assert got == [("None", 9), ("a", 8), ("b", 3)]


def test_cells_with_line_breaks(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _w(f"{root}/c1/annotations/s/converted/a_0_9.csv",
       'segment_onset,segment_offset,transcription\n0,5,"one\ntwo, ""three"""\n\n5,9\n')
    got = sorted((r.segment_onset, r.segment_offset, r.labels["transcription"]) for r in scan_segments(spark, root).collect())
    assert got == [(0, 5, 'one\ntwo, "three"'), (5, 9, None)]


def test_repeated_sidecar_key_has_its_last_value(spark, tmp_path):
    root = str(tmp_path / "corpora")
    _w(f"{root}/c1/annotations/s/metannots.yml", "method: manual\nhas_words: N\nmethod: mixed\n")
    _w(f"{root}/c1/annotations/t/metannots.yml", "# nothing\n")
    got = {r.set_name: (r.method, r.has_words) for r in scan_sidecars(spark, root).collect()}
    assert got == {"s": ("mixed", "N"), "t": (None, None)}


def test_selection_prunes_files(spark, tmp_path):
    from annolake.plans.ingest import ingest, read_ingested
    root = str(tmp_path / "corpora")
    _tree(root)
    _w(f"{root}/c2/annotations/s1/converted/z_0_5.csv", "segment_onset,segment_offset,speaker_type\n0,5,CHI\n")
    _w(f"{root}/c2/annotations/s1/metannots.yml", "method: manual\n")
    for t in ("children", "annotations"):
        _w(f"{root}/c2/metadata/{t}.csv", "child_id\nZ\n")
    out = str(tmp_path / "out")
    ingest(spark, root, out, datasets=["c2"])
    for t in ("recordings", "segments", "sidecars"):
        assert {r.dataset for r in read_ingested(spark, out, t).collect()} == {"c2"}, t
    index = spark.createDataFrame([("c1", "s2", "r1_0_500.csv")], "dataset string, set string, annotation_filename string")
    assert [r.annotation_filename for r in scan_segments(spark, root, index).collect()] == ["r1_0_500.csv"]


def test_age_of_a_malformed_date_is_null(spark):
    from annolake.functions.columns import age_months
    df = spark.createDataFrame([("2024-13-01", "2020-01-01"), ("2021-01-01", "2020-01-01")], "d string, b string")
    assert [r.a for r in df.select(age_months("d", "b").alias("a")).collect()] == [None, 12.02]


def test_slice_payload_cuts_inside_rows(spark):
    from annolake.operators.intervals import slice_payload
    text = spark.createDataFrame([("r", 1, 0, 10, "abcdefghij"), ("r", 2, 10, 12, "kl"), ("r", 3, 12, 12, "")],
                                 "recording string, turn int, onset long, offset_ms long, text string")
    clips = spark.createDataFrame([("r", 2, 4), ("r", 6, 9), ("q", 0, 9)], "recording string, start long, end long")
    for chunk in (1, 3, 60_000):
        out, gone = slice_payload(text, clips, chunk=chunk)
        assert sorted((r.clip_start, r.piece_start, r.piece_end, r.text) for r in out.collect()) == [(2, 0, 2, "cd"), (6, 0, 3, "ghi")]
        assert sorted(r.turn for r in gone.collect()) == [2, 3]
    raw = text.selectExpr("recording", "turn", "onset", "offset_ms", "cast(text as binary) text")
    assert sorted(bytes(r.text) for r in slice_payload(raw, clips)[0].collect()) == [b"cd", b"ghi"]
