"""E1 and E3 from files: a corpus tree on disk -> scans -> profile -> category
filter -> cut -> rebased corpus, additions to it, and the profile JSON round trip."""

import json
import os

import pytest

from annolake.operators import profile as A
from annolake.plans.create_dataset import Corpus, create_dataset
from annolake.plans.flows import build_corpus, profile_root, read_corpus, read_root
from annolake.plans.profiling import profile_corpora, validation_report
from annolake.sources.profiles import scan_category_index, scan_profiles, write_profiles


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def build_tree(root):
    """One child with two recordings and one with one. A nested manual set with two touching files, a file without any
    transcription and a whole recording; a small manual set; an automated set over everything."""
    meta = f"{root}/coast/metadata"
    _w(f"{meta}/children.csv", "child_id,child_sex,child_dob,notes\nP1,M,2018-07-30,\nP2,F,2019-01-11,\n")
    _w(f"{meta}/recordings.csv", "recording_filename,duration,child_id,date_iso,device\n"
       "r5.wav,90000,P1,2020-09-01,NA\nr6.wav,30000,P1,2020-10-01,NA\nr7.wav,45000,P2,2021-02-02,NA\n")
    files = [("eaf/an1", "r5", 2000, 8000), ("eaf/an1", "r5", 8000, 15000), ("eaf/an1", "r5", 60000, 75000), ("eaf/an1", "r7", 0, 45000),
             ("words", "r6", 5000, 9000), ("vtc", "r5", 0, 90000), ("vtc", "r6", 0, 30000)]
    _w(f"{meta}/annotations.csv", "annotation_filename,set,raw_filename,recording_filename,range_onset,range_offset,time_seek\n" + "".join(
        f"{r}_{a}_{b}.csv,{s},{r}.eaf,{r}.wav,{a},{b},0\n" for s, r, a, b in files))
    both = "segment_onset,segment_offset,transcription,speaker_type\n"
    text = {("eaf/an1", "r5_2000_8000"): both + "2100,2600,ba da,CHI\n3000,3400,NA,CHI\n",
            ("eaf/an1", "r5_8000_15000"): both + "9000,9800,da,FEM\n",
            ("eaf/an1", "r5_60000_75000"): both + "61000,61500,NA,OCH\n",
            ("eaf/an1", "r7_0_45000"): both + "100,1100,,MAL\n40000,40250,,NA\n",
            ("words", "r6_5000_9000"): "segment_onset,segment_offset,words\n5200,5900,moo\n",
            ("vtc", "r5_0_90000"): "segment_onset,segment_offset,speaker_type\n10,20,CHI\n",
            ("vtc", "r6_0_30000"): "segment_onset,segment_offset,speaker_type\n30,40,FEM\n"}
    for (s, name), t in text.items():
        _w(f"{root}/coast/annotations/{s}/converted/{name}.csv", t)
    for s, t in {"eaf/an1": "method: manual\nhas_speaker_type: Y\nhas_transcription: Y\n", "vtc": "method: automated\n",
                 "words": "method: manual\nhas_transcription: Y\nsampling_count: 2\nsampling_unit_duration: 3000\n"}.items():
        _w(f"{root}/coast/annotations/{s}/metannots.yml", t)


def index_file(path, **more):
    empty = {k: [] for k in ("addressee_cols", "vcm_cols", "vtc_cols", "transcription_cols", "other")}
    sets = {"eaf/an1": {"vtc_cols": ["speaker_type"], "transcription_cols": ["transcription"]}, "words": {"transcription_cols": ["words"]}, **more}
    path.write_text(json.dumps({"datasets": [{"name": "coast", "sets": [{"name": n, **empty, **s} for n, s in sets.items()]}]}))
    return str(path)


AUTO = {"vtc": {"vtc_cols": ["speaker_type"]}}


@pytest.fixture
def root(tmp_path):
    build_tree(str(tmp_path / "c"))
    return str(tmp_path / "c")


def test_create_dataset_from_files(spark, tmp_path, root):
    r = read_root(spark, root)
    idx, _ = scan_category_index(spark, index_file(tmp_path / "i.json", **AUTO))
    # only files with a transcription survive; the touching two share a clip
    res = create_dataset(r.corpus, r.labels, idx, "transcription")
    out = sorted((x.set, x.recording_filename, x.range_onset, x.range_offset, x.annotation_filename) for x in res.corpus.annotations.collect())
    assert out == [("coast/eaf/an1", "coast/r5-2000to15000.wav", 0, 6000, "r5-2000to15000_0_6000.csv"),
                   ("coast/eaf/an1", "coast/r5-2000to15000.wav", 6000, 13000, "r5-2000to15000_6000_13000.csv"),
                   ("coast/words", "coast/r6-5000to9000.wav", 0, 4000, "r6-5000to9000_0_4000.csv")]
    recs = sorted((x.recording_filename, x.duration, x.child_id, x.experiment) for x in res.corpus.recordings.collect())
    assert recs == [("coast/r5-2000to15000.wav", 13000, "coast_P1", "benchmarking"), ("coast/r6-5000to9000.wav", 4000, "coast_P1", "benchmarking")]
    assert [x.child_id for x in res.corpus.children.collect()] == ["coast_P1"]
    assert res.discarded.count() == 0
    # columns without a value in what was kept are gone
    assert "notes" not in res.corpus.children.columns and "device" not in res.corpus.recordings.columns
    kept = create_dataset(r.corpus, r.labels, idx, "transcription", drop_empty=False)
    assert "notes" in kept.corpus.children.columns and "device" in kept.corpus.recordings.columns


def test_a_corpus_is_built_and_added_to(spark, tmp_path, root):
    from annolake.session import drop_tables
    drop_tables(spark)
    index, first, second = index_file(tmp_path / "i.json", **AUTO), str(tmp_path / "one"), str(tmp_path / "two")
    build_corpus(spark, root, index, "transcription", first)
    base = f"{root}/coast/annotations/words"
    _w(f"{base}/converted/r6_5000_9000.csv", "segment_onset,segment_offset,words\n6000,6100,moo\n")
    _w(f"{base}/converted/r6_20000_29000.csv", "segment_onset,segment_offset,words\n21000,21500,baa\n")
    with open(f"{root}/coast/metadata/annotations.csv", "a") as f:
        f.write("r6_20000_29000.csv,words,r6.eaf,r6.wav,20000,29000,0\n")
    _w(f"{root}/coast/annotations/eaf/an1/metannots.yml", "method: converted\n")        # not built anew: stays as it is
    build_corpus(spark, root, index, "transcription", second, existing=first)
    got = sorted((r.set, r.recording_filename) for r in read_corpus(spark, second).annotations.collect())
    assert got == [("coast/eaf/an1", "coast/r5-2000to15000.wav")] * 2 + [("coast/words", "coast/r6-20000to29000.wav"), ("coast/words", "coast/r6-5000to9000.wav")]
    with pytest.raises(ValueError):
        build_corpus(spark, root, index, "transcription", second, existing=second + "/")
    build_corpus(spark, root, index, "vtc", str(tmp_path / "three"), children_expr="child_sex == 'X'")
    assert read_corpus(spark, str(tmp_path / "three")).annotations.count() == 0
    from annolake.session import _WRITTEN
    assert not [p for p in _WRITTEN if "csv_lines" in p]         # intermediate tables are gone


def test_profile_round_trip_and_checks(spark, tmp_path, root):
    r = read_root(spark, root)
    prof = profile_corpora(r.labels, r.corpus.annotations.withColumnRenamed("set", "set_name"), r.sidecars)        # manual sets only
    got = sorted((x.set_name, x.column, x.annotated_duration_ms, x.num_of_non_empty_segments,
                  x.duration_from_samples_ms, x.number_of_samples) for x in prof.collect())
    assert got == [("eaf/an1", "speaker_type", 3200, 5, 73000, 4), ("eaf/an1", "transcription", 1300, 2, 73000, 4),
                   ("words", "words", 700, 1, 6000, 2)]
    out = str(tmp_path / "profiles")
    write_profiles(prof, out)
    back = scan_profiles(spark, out)
    assert sorted(tuple(x) for x in back.collect()) == sorted(tuple(x) for x in prof.select(*back.columns).collect())
    index = index_file(tmp_path / "index.json", ghost={})
    long, nested = scan_category_index(spark, index)
    assert [(x.set_name, x.annotated_total_duration_min, x.num_of_segments_non_empty) for x in A.category_summary(back, long, "vtc").collect()] == \
        [("eaf/an1", 0.053, 5)]
    want = [("ghost", "index_sets", "set not in profile"), ("ghost", "sidecar_missing", "no sidecar")]
    rep = validation_report(long, nested, back, r.sidecars.select("dataset", "set_name", "raw"))
    assert sorted((x.set_name, x.check, x.detail) for x in rep.collect()) == want
    assert profile_root(spark, root, index, str(tmp_path / "flow")) == {"index_sets": 1, "sidecar_missing": 1}
    flow = spark.read.parquet(str(tmp_path / "flow/violations"))
    assert sorted((x.set_name, x.check, x.detail) for x in flow.collect()) == want
    assert scan_profiles(spark, str(tmp_path / "flow/profiles")).count() == 3


def test_ingest_to_parquet(spark, tmp_path, root):
    from annolake.plans.ingest import ingest, read_ingested
    _w(f"{root}/other/metadata/recordings.csv", "recording_filename,duration\nq.wav,5\n")
    out = str(tmp_path / "pq")
    paths = ingest(spark, root, out)
    assert set(paths) == {"children", "recordings", "annotations", "segments", "sidecars"}
    rec = read_ingested(spark, out, "recordings", ["other"])
    assert [r.recording_filename for r in rec.collect()] == ["q.wav"]
    plan = rec._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset" in plan
    seg = read_ingested(spark, out, "segments")
    assert seg.count() == 9 and dict(seg.dtypes)["labels"] == "map<string,string>"


def test_write_corpus(spark, tmp_path, root):
    from annolake.plans.create_dataset import write_corpus
    r = read_root(spark, root)
    idx, _ = scan_category_index(spark, index_file(tmp_path / "i.json", **AUTO))
    res = create_dataset(r.corpus, r.labels, idx, "vtc")
    paths = write_corpus(res, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(paths["metadata/annotations"])
    assert back.count() == res.corpus.annotations.count() == 6   # the set of words has no speakers
    jobs = spark.read.option("header", True).csv(paths["manifests/cut_jobs"])
    assert sorted(x.output for x in jobs.collect()) == sorted(
        "recordings/converted/standard/" + x.recording_filename for x in res.corpus.recordings.collect())


def test_copy_manifest_of_flagship(spark, tmp_path, root):
    r = read_root(spark, root)
    idx, _ = scan_category_index(spark, index_file(tmp_path / "i.json"))
    res = create_dataset(r.corpus, r.labels, idx, "transcription", datasets_root=root, sidecars=r.sidecars)
    got = sorted((x.kind, x.target) for x in res.copies.collect())
    assert got == [
        ("annotation", "./annotations/coast/eaf/an1/converted/r5_2000_8000.csv"),
        ("annotation", "./annotations/coast/eaf/an1/converted/r5_8000_15000.csv"),
        ("annotation", "./annotations/coast/words/converted/r6_5000_9000.csv"),
        ("raw", "./recordings/raw/coast/r5.wav"), ("raw", "./recordings/raw/coast/r6.wav"),
        ("sidecar", "./annotations/coast/eaf/an1/metannots.yml"), ("sidecar", "./annotations/coast/words/metannots.yml"),
        ("standard", "./recordings/converted/standard/coast/r5.wav"), ("standard", "./recordings/converted/standard/coast/r6.wav")]


def test_flagship_selects_files(spark, tmp_path):
    """Discarded children and recordings, sets that are not manual and sets without a sidecar do not come out;
    a set that the index does not know is an error."""
    kids = spark.createDataFrame([("d", "a", None, 1), ("d", "b", "1", 2), ("d", "c", None, 3)],
                                 "dataset string, child_id string, discard string, age int")
    recs = spark.createDataFrame([("d", "a.wav", "a", 100, None), ("d", "a2.wav", "a", 100, "1"), ("d", "b.wav", "b", 100, None),
                                  ("d", "c.wav", "c", 100, None)],
                                 "dataset string, recording_filename string, child_id string, duration long, discard string")
    ann = spark.createDataFrame([("d", s, f"{r}.wav", f"{r}.wav", 0, 0, 50, f"{s}_{r}_0_50.csv") for s in ("man", "auto", "bare")
                                 for r in ("a", "a2", "b", "c")],
                                "dataset string, set string, recording_filename string, raw_filename string, time_seek long, "
                                "range_onset long, range_offset long, annotation_filename string")
    lab = ann.selectExpr("dataset", "set set_name", "annotation_filename", "'x' label", "'v' value")
    side = spark.createDataFrame([("d", "man", "manual"), ("d", "auto", "automated")], "dataset string, set_name string, method string")
    idx = spark.createDataFrame([("d", "man", "vtc_cols", "x")], "dataset string, set_name string, category string, column string")
    res = create_dataset(Corpus(kids, recs, ann), lab, idx, "vtc", sidecars=side, children_expr="age < 3")
    assert [(r.set, r.recording_filename) for r in res.corpus.annotations.collect()] == [("d/man", "d/a-0to50.wav")]
    assert [r.child_id for r in res.corpus.children.collect()] == ["d_a"]
    with pytest.raises(ValueError, match="auto"):
        create_dataset(Corpus(kids, recs, ann), lab, idx, "vtc")


def test_written_tables_are_dropped(spark):
    import os

    from annolake.session import cut_lineage, drop_tables
    drop_tables(spark)
    path = cut_lineage(spark.range(3).toDF("x"), "t").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and drop_tables(spark) == 1 and not os.path.exists(path)
