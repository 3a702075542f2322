"""Support and containment against brute force, under skew and repartitioning."""

import random

import pytest

from annolake.operators.intervals import assign_to_clip, rebase, support


def brute_support(rows, collar=0):
    out = {}
    for rec in sorted({r[0] for r in rows}):
        ivs = sorted((s, e) for k, s, e in rows if k == rec and s < e)
        cur = None
        isl = []
        for s, e in ivs:
            if cur is None:
                cur = [s, e]
                continue
            gap = s - cur[1]
            if gap > 0 and gap >= collar:
                isl.append(tuple(cur))
                cur = [s, e]
            else:
                cur[1] = max(cur[1], e)
        if cur:
            isl.append(tuple(cur))
        out[rec] = isl
    return sorted((k, s, e) for k, v in out.items() for s, e in v)


def make_rows(seed, n=600, hot_share=0.6):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rec = "hot" if rnd.random() < hot_share else f"r{rnd.randint(0, 9)}"
        s = rnd.randint(-50, 5000)
        ln = rnd.choice([0, 0, 1, 3, 10, 40, 200])
        rows.append((rec, s, s + ln))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk", [7, 100, 10_000])
@pytest.mark.parametrize("collar", [0, 5])
def test_support_matches_brute_force(spark, seed, chunk, collar):
    rows = make_rows(seed)
    df = spark.createDataFrame(rows, "rec string, start long, end long").repartition(7)
    got = sorted(tuple(r) for r in support(df, ["rec"], collar=collar, chunk=chunk).collect())
    assert got == brute_support(rows, collar)


def test_support_null_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 0, 5), (None, 5, 9), ("a", 1, 2)], "rec string, start long, end long")
    got = sorted((str(r.rec), r.start, r.end) for r in support(df, ["rec"], chunk=3).collect())
    assert got == [("None", 0, 9), ("a", 1, 2)]


def brute_assign(ann, clips):
    out = {}
    for aid, rec, on, off in ann:
        hit = next(((cs, ce) for k, cs, ce in clips if k == rec and cs <= on and off <= ce), None)
        out[aid] = hit
    return out


@pytest.mark.parametrize("chunk", [5, 100, 100_000])
def test_assign_matches_brute_force(spark, chunk):
    rows = make_rows(3, n=400)
    clips = brute_support(rows, 0)
    rnd = random.Random(9)
    ann = []
    for i, (rec, s, e) in enumerate(rows):
        ann.append((i, rec, s + rnd.choice([0, 0, 1]), e - rnd.choice([0, 0, 1])))
    ann += [(10_000 + i, "hot", p, p) for i, p in enumerate(range(-20, 5100, 37))]   # zero-length probes
    adf = spark.createDataFrame(ann, "aid long, rec string, range_onset long, range_offset long").repartition(5)
    cdf = spark.createDataFrame(clips, "rec string, start long, end long")
    a, d = assign_to_clip(adf, cdf, key="rec", chunk=chunk)
    got = {r.aid: (r.clip_start, r.clip_end) for r in a.collect()}
    gone = {r.aid for r in d.collect()}
    exp = brute_assign(ann, clips)
    assert got == {k: v for k, v in exp.items() if v is not None}
    assert gone == {k for k, v in exp.items() if v is None}


def test_rebase_time_seek_and_names(spark, annotations, recordings):
    from annolake.operators.intervals import clip_list
    clips = clip_list(annotations, recordings, pad_ms=0)          # time_seek honoured
    a, d = assign_to_clip(annotations, clips)
    assert d.count() == 0
    r = {x.original_annotation_filename + str(x.range_onset): x for x in rebase(a).collect()}
    rec2 = r["recording_2_15000_450000"]
    assert (rec2.recording_filename, rec2.range_onset, rec2.range_offset, rec2.time_seek) == \
        ("recording_2-20000to50000.wav", 0, 30000, 0)
    assert rec2.annotation_filename == "recording_2-20000to50000_0_30000"
    assert rec2.raw_filename == "recording_2-20000to50000.mp3"


def test_orphans_side_output(spark, recordings):
    from annolake.operators.intervals import clip_to_recording, shift
    a = spark.createDataFrame([("nope.wav", 0, 10), ("recording_1.wav", 61000, 70000)],
                              "recording_filename string, range_onset long, range_offset long")
    c, orphans = clip_to_recording(shift(a), recordings, "recording_filename")
    assert [r.recording_filename for r in orphans.collect()] == ["nope.wav"]
    assert [(r.start, r.end) for r in c.collect()] == [(61000, 62000)]


def test_gap_equal_to_collar_opens_island(spark):
    df = spark.createDataFrame([("r", 0, 10), ("r", 15, 20), ("r", 24, 30)], "rec string, start long, end long")
    got = sorted(tuple(r) for r in support(df, ["rec"], collar=5, chunk=7).collect())
    assert got == [("r", 0, 10), ("r", 15, 30)]        # gap 5 == collar splits, gap 4 merges


def test_rebase_keeps_length_and_stays_inside(spark):
    rows = make_rows(11, n=300)
    clips = brute_support(rows, 0)
    ann = [(i, rec, s, e) for i, (rec, s, e) in enumerate(rows)]
    adf = spark.createDataFrame(ann, "aid long, rec string, range_onset long, range_offset long")
    cdf = spark.createDataFrame(clips, "rec string, start long, end long")
    a, _ = assign_to_clip(adf, cdf, key="rec", chunk=50)
    r = rebase(a, key="rec", annotation_name=None, raw_name=None)
    for x in r.collect():
        src = ann[x.aid]
        assert x.range_offset - x.range_onset == src[3] - src[2]
        assert 0 <= x.range_onset <= x.range_offset <= x.clip_end - x.clip_start
