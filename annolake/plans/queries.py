"""Registered queries: one per operator family of the blueprint, each over the
whole driver tables (through the corpus-shaped views of ``sources.tables``).

Every callable takes (spark, sf_dir) and returns a lazy DataFrame whose column
names equal the matching SQL in ``plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators import intervals as I
from annolake.sources import tables as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

PAD = 1_800_000      # 30 minutes
COLLAR = 600_000     # 10 minutes


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- intervals -------------------------------------------------------------------

def _ev_padded(spark, sf, pad_ms):
    return I.pad(I.shift(V.ev_segments(spark, sf), "onset", "offset_ms"), pad_ms)


@query
def interval_support(spark, sf):
    """Merged annotated stretches per recording (support, then crop the islands)."""
    sup = I.support_in_recording(_ev_padded(spark, sf, 0), V.ev_recordings(spark, sf), "recording")
    return sup.select("recording", F.col("start").alias("clip_start"), F.col("end").alias("clip_end"))


@query
def interval_support_collar(spark, sf):
    """I4 with a collar: gaps shorter than 10 minutes merge (crop first, then merge)."""
    sup = I.support_in_recording(_ev_padded(spark, sf, 0), V.ev_recordings(spark, sf), "recording", collar=COLLAR)
    return sup.select("recording", F.col("start").alias("clip_start"), F.col("end").alias("clip_end"))


@query
def interval_support_batches(spark, sf):
    """I4 kept up to date: three batches of segments into a store of partial islands, then the islands of all."""
    from annolake.operators.island_store import IslandStore
    from annolake.session import scratch_path
    seg = _ev_padded(spark, sf, 0).where(F.col("recording").isNotNull()).select("recording", "seg_id", "start", "end")
    store = IslandStore(spark, scratch_path(spark, "islands"))
    for k in range(3):
        store.add(seg.where(F.col("seg_id") % 3 == k), k)
    inside, _ = I.clip_to_recording(store.islands(), V.ev_recordings(spark, sf))
    return inside.select("recording", F.col("start").alias("clip_start"), F.col("end").alias("clip_end"))


@query
def interval_covered(spark, sf):
    """Covered milliseconds and clip count per recording (30 min padding)."""
    return I.covered(I.support_in_recording(_ev_padded(spark, sf, PAD), V.ev_recordings(spark, sf), "recording"),
                     ["recording"])


def _ev_clips(spark, sf):
    # the clip list (one row per island) feeds containment, recordings and cut
    # jobs: written once to the checkpoint folder instead of recomputed per use
    from annolake.session import cut_lineage
    return cut_lineage(I.clip_list(V.ev_files(spark, sf), V.ev_file_recordings(spark, sf), pad_ms=PAD,
                                   ignore_time_seek=True), "clips")


@query
def clip_list(spark, sf):
    """I5 + P6: clip list with clip file names."""
    return _ev_clips(spark, sf).select("recording_filename", F.col("start").alias("clip_start"),
                                       F.col("end").alias("clip_end"), "clip_filename")


@query
def clip_list_seek(spark, sf):
    """I1 + I5: clips of files that lie 0 to 40 minutes into their recording (``time_seek`` counts)."""
    files = V.ev_files(spark, sf).withColumn("time_seek", F.col("seg_id") % 5 * 600_000)
    return I.clip_list(files, V.ev_file_recordings(spark, sf)).select(
        "recording_filename", F.col("start").alias("clip_start"), F.col("end").alias("clip_end"), "clip_filename")


@query
def cut_manifest(spark, sf):
    """I8: distinct cut jobs for raw and standard versions of every clipped recording."""
    clips = _ev_clips(spark, sf)
    raw = F.concat(F.lit("recordings/raw/"), F.regexp_replace("recording_filename", r"\.wav$", ".mp3"))
    std = F.concat(F.lit("recordings/converted/standard/"), F.col("recording_filename"))
    return I.cut_manifest(clips, sources=[("raw", raw), ("standard", std)])


def _ev_assigned(spark, sf):
    files = V.ev_files(spark, sf)
    clips = _ev_clips(spark, sf)
    return I.assign_to_clip(files, clips, ignore_time_seek=True)


@query
def clip_assign_rebase(spark, sf):
    """J6 + I6 + P7: annotations moved onto their clip's clock and renamed."""
    assigned, _ = _ev_assigned(spark, sf)
    r = I.rebase(assigned)
    return r.select("seg_id", "set", "recording_filename", "original_recording_filename", "range_onset",
                    "range_offset", "time_seek", "annotation_filename", "original_annotation_filename",
                    "raw_filename")


@query
def clip_discarded(spark, sf):
    """J6 side output: annotations that fit no clip (outside the recording)."""
    _, discarded = _ev_assigned(spark, sf)
    return discarded.select("seg_id", "recording_filename", "range_onset", "range_offset")


@query
def clip_superseded(spark, sf):
    """Full recordings replaced by clips."""
    assigned, _ = _ev_assigned(spark, sf)
    return I.superseded(I.rebase(assigned))


@query
def clip_renames(spark, sf):
    """Distinct annotation renames."""
    assigned, _ = _ev_assigned(spark, sf)
    return I.rename_manifest(I.rebase(assigned))


@query
def recordings_on_clips(spark, sf):
    """J7 + P12: one recording row per clip with the clip length as duration."""
    return I.recordings_on_clips(V.ev_file_recordings(spark, sf), _ev_clips(spark, sf)) \
            .select("recording_filename", "child_id", "duration", "experiment")


@query
def slice_payload(spark, sf):
    """Conversation text cut to clips that begin and end inside turns (every second turn, moved by
    some characters). Offsets and clips are narrow rows; the text joins once, on (conversation, turn)."""
    from annolake.session import cut_lineage
    # narrow positions (recording, turn, onset, offset) written once: the clip
    # list and the assignment both read them instead of redoing the prefix sums
    t = cut_lineage(V.turns(spark, sf, with_text=False), "turn_positions")
    every = t.filter(F.col("turn") % 2 == 0).select(
        "recording", (F.col("onset") + 10).alias("start"), (F.col("offset_ms") + 15).alias("end"))
    clips = I.support(every, ["recording"])
    texts = V.table(spark, sf, "conversations").select(F.col("conv_id").alias("recording"), "turn", "text")
    pieces, _ = I.slice_payload(t, clips, key="recording", onset="onset", offset="offset_ms", col="text",
                                texts=texts, text_keys=["recording", "turn"])
    return pieces.select("recording", "turn", "clip_start", "clip_end", "piece_start", "piece_end", "text")

FLAGSHIP = "create_dataset"


# --- splitting --------------------------------------------------------------------

from annolake.operators import split as T  # noqa: E402
from annolake.functions import columns as C  # noqa: E402

_DOC_COLS = ["key", "dataset", "set_name", "entity", "weight", "split"]


@query
def weighted_split(spark, sf):
    """Seeded duration-weighted split per corpus (two-level running sum)."""
    return T.weighted_split(V.docs_index(spark, sf), "key", "weight", (800, 100, 100), by=["dataset"],
                            seed=0).select(*_DOC_COLS)


@query
def weighted_split_stratified(spark, sf):
    """Stratified by corpus and set."""
    return T.weighted_split(V.docs_index(spark, sf), "key", "weight", (0.7, 0.2, 0.1),
                            by=["dataset", "set_name"], seed=1).select(*_DOC_COLS)


@query
def weighted_split_two_level(spark, sf):
    """O4 two-level: 4096 md5 buckets per stratum."""
    return T.weighted_split(V.docs_index(spark, sf), "key", "weight", (600, 300, 100), by=["dataset"],
                            seed=7, hex_digits=3).select(*_DOC_COLS)


@query
def entity_split(spark, sf):
    """T4: entity-exclusive split, heavy entities greedily, the others by running weight."""
    return T.entity_split(V.docs_index(spark, sf), "entity", "weight", (800, 100, 100), seed=0) \
            .select("key", "entity", "weight", "split")


@query
def entity_split_sharded(spark, sf):
    """T4 inside 4 hash shards (each with its share of the targets)."""
    return T.entity_split(V.docs_index(spark, sf), "entity", "weight", (800, 100, 100), seed=0, shards=4) \
            .select("key", "entity", "weight", "split")


@query
def split_exclusive_check(spark, sf):
    """T5: entities that a row-level split put into more than one split."""
    rows = T.weighted_split(V.docs_index(spark, sf), "key", "weight", (800, 100, 100), by=["dataset"], seed=0)
    return T.check_exclusive(rows, "entity").select("entity", "n_splits")


@query
def split_report(spark, sf):
    """A10: desired vs reached weight per split of the entity split."""
    rows = T.entity_split(V.docs_index(spark, sf), "entity", "weight", (800, 100, 100), seed=0)
    return T.split_report(rows, "weight", (800, 100, 100)).select("split", "desired_weight", "reached_weight")


def _shop_split_input(spark, sf, paths=True):
    from annolake.operators.curate import split_input
    return split_input(V.shop_annotations(spark, sf), V.shop_recordings(spark, sf), V.shop_children(spark, sf), paths=paths)


@query
def split_input(spark, sf):
    """J3 + F1 + P3 + P10 + P13: annotations with child, corpus, age and paths."""
    return _shop_split_input(spark, sf)


@query
def split_finalize(spark, sf):
    """Split input -> weighted split per corpus -> T7 final shape."""
    from annolake.operators.curate import with_split_paths
    si = _shop_split_input(spark, sf, paths=False)
    si = si.withColumn("_key", F.concat_ws(":", "recording", "line", "set_name", "range_offset"))
    sp = T.weighted_split(si, "_key", "duration_ms", (800, 100, 100), by=["dataset"], seed=0).drop("_key")
    return T.finalize_split(sp, path_col="recording_path", drop=["age_months"], derive=with_split_paths)


# --- profiling -----------------------------------------------------------------------

from annolake.operators import profile as A  # noqa: E402

_PROFILE_COLS = ["dataset", "set_name", "column", "categorical", "annotated_duration_ms",
                 "duration_from_samples_ms", "number_of_samples", "num_of_non_empty_segments"]


@query
def label_profile(spark, sf):
    """A1 + A2 + F6: label coverage of the sparse document labels."""
    return A.label_profile(V.doc_labels(spark, sf)).select(
        "dataset", "set_name", "column", "annotated_ms", "num_non_empty", "n_values", "categorical", "values")


@query
def label_profile_replaced(spark, sf):
    """A1 + A2 + U2: the stored profile after some sets, stale at first, were replaced."""
    from annolake.operators.profile_store import ProfileStore
    from annolake.session import scratch_path
    labels = V.doc_labels(spark, sf).where("dataset is not null and set_name is not null")
    late = F.col("set_name").endswith("1")
    store = ProfileStore(spark, scratch_path(spark, "profile"))
    store.replace(labels.withColumn("value", F.when(late, F.lit("stale")).otherwise(F.col("value"))))
    store.replace(labels.where(late))
    return store.profile().select("dataset", "set_name", "column", "annotated_ms", "num_non_empty", "n_values", "categorical", "values")


@query
def label_categorical(spark, sf):
    """A2: categorical test on the event labels (speaker_type small, k large)."""
    return A.label_profile(V.ev_labels(spark, sf), by=["set_name"]).select(
        "set_name", "column", "annotated_ms", "num_non_empty", "n_values", "categorical", "values")


@query
def sampled_duration(spark, sf):
    """A3 + A4: sampled duration and sample count per set (sidecar or file-name spans)."""
    return A.sampled_duration(V.doc_files(spark, sf), V.doc_sidecars(spark, sf))


def _doc_profile(spark, sf):
    # the generated profile (one row per set and column) is the E3 artifact the
    # summaries and checks read: written once, like the profile JSON
    from annolake.session import cut_lineage
    from annolake.plans.profiling import profile_corpora
    return cut_lineage(profile_corpora(V.doc_labels(spark, sf), V.doc_files(spark, sf),
                                       V.doc_sidecars(spark, sf)), "profile")


@query
def generated_profile(spark, sf):
    """The generated profile (dataset, set, column) over manual sets."""
    return _doc_profile(spark, sf).select(*_PROFILE_COLS)


@query
def category_summary(spark, sf):
    """A5 + O1: vtc category summary per set."""
    return A.category_summary(_doc_profile(spark, sf), V.doc_category_index(spark, sf), "vtc")


@query
def corpora_info(spark, sf):
    """A6 + J4: addressee corpora table, flag Y in any case."""
    return A.corpora_info(_doc_profile(spark, sf), V.doc_sidecars(spark, sf), V.doc_category_index(spark, sf),
                          "addressee")


# --- validation ----------------------------------------------------------------------

from annolake.operators import checks as K  # noqa: E402


def _doc_columns(spark, sf):
    return A.profile_columns(V.doc_labels(spark, sf), CU.gold_sets(V.doc_sidecars(spark, sf)))


@query
def check_sidecar_values(spark, sf):
    """V1: enum / integer / date / Y-N fields of every sidecar."""
    return K.check_sidecar_values(V.doc_sidecars_raw(spark, sf))


@query
def check_index_columns(spark, sf):
    """V2: index columns of a set equal the profile's."""
    return K.check_index_columns(V.doc_category_index(spark, sf), _doc_columns(spark, sf))


@query
def check_index_sets(spark, sf):
    """V3: indexed sets equal the profile's; unknown corpora."""
    return K.check_index_sets(V.doc_category_index(spark, sf), _doc_columns(spark, sf))


@query
def check_missing_flag(spark, sf):
    """V4: annotated category without its sidecar flag (all four categories)."""
    return K.check_missing_flag(V.doc_category_index(spark, sf), _doc_profile(spark, sf),
                                V.doc_sidecars_raw(spark, sf))


@query
def check_false_flag(spark, sf):
    """V5: sidecar flag set but nothing annotated (all four categories)."""
    return K.check_false_flag(V.doc_category_index(spark, sf), _doc_profile(spark, sf),
                              V.doc_sidecars_raw(spark, sf))


@query
def check_sidecar_missing(spark, sf):
    """V6: indexed set without sidecar."""
    return K.check_sidecar_missing(V.doc_category_index(spark, sf), V.doc_sidecars_raw(spark, sf))


@query
def check_index_fields(spark, sf):
    """V7: required lists of each index entry."""
    return K.check_index_fields(K.nest_index(V.doc_category_index(spark, sf)))


# --- statistics ------------------------------------------------------------------------

from annolake.operators import stats as S  # noqa: E402
from annolake.operators import curate as CU  # noqa: E402


def _shop_segments(spark, sf):
    # manual sets only
    gold = CU.gold_sets(V.shop_sidecars(spark, sf)).select("set_name")
    seg = CU.in_sets(V.shop_annotations(spark, sf), gold, ["set_name"]) \
        .withColumn("seg_ms", F.col("range_offset") - F.col("range_onset"))
    return CU.child_segments(V.shop_children(spark, sf), V.shop_recordings(spark, sf), seg)


def _shop_metric(spark, sf, metric):
    seg = _shop_segments(spark, sf)
    # totals in hours, mean / std in ms
    return S.distribution(seg, "child_sex", "seg_ms", by=["dataset"], metrics=[metric], total_unit=3_600_000)


@query
def distribution_mean(spark, sf):
    """A8 + J5: mean segment duration (ms) per corpus and child_sex."""
    return _shop_metric(spark, sf, "duration_mean")


@query
def distribution_std(spark, sf):
    """Sample std of segment duration (ms)."""
    return _shop_metric(spark, sf, "duration_std")


@query
def distribution_total(spark, sf):
    """A8 + P10: total annotated hours."""
    return _shop_metric(spark, sf, "duration_total")


@query
def distribution_count(spark, sf):
    """Segment count."""
    return _shop_metric(spark, sf, "count")


@query
def pooled_mean(spark, sf):
    """Count-weighted mean over corpora."""
    return S.pooled(_shop_metric(spark, sf, "duration_mean"), "child_sex", "duration_mean")


@query
def pooled_std(spark, sf):
    """Pooled std over corpora, sqrt(sum(n s^2) / sum(n))."""
    return S.pooled(_shop_metric(spark, sf, "duration_std"), "child_sex", "duration_std")


@query
def subject_age_bins(spark, sf):
    """P13 + P14 + A8: recording hours per corpus and 10 equal-width age bins."""
    ch = V.shop_children(spark, sf)
    rec = S.with_age(C.drop_discarded(V.shop_recordings(spark, sf)), ch)
    rec = rec.join(ch.select("child_id", "dataset"), "child_id", "inner")
    b = S.equal_width_bins(rec, "age_months", 10, by=["dataset"], out="age_bin")
    return b.groupBy("dataset", "age_bin").agg(
        F.round(F.min("age_bin_lo"), 6).alias("age_bin_lo"), F.round(F.max("age_bin_hi"), 6).alias("age_bin_hi"),
        F.count(F.lit(1)).alias("count"),
        (F.sum("duration").cast("double") / F.lit(3_600_000.0)).alias("duration_total"))


@query
def subject_summary(spark, sf):
    """Per-corpus subject summary."""
    return S.subject_summary(V.shop_subjects(spark, sf), V.shop_recordings(spark, sf))


@query
def child_ages(spark, sf):
    """P13 (D9), A7: subjects with the columns kept, a child's age is its age at the first kept recording."""
    return S.subject_table(V.shop_subjects(spark, sf), V.shop_recordings(spark, sf))


def _describe(spark, sf, *args, **kw):
    from annolake.plans.describe import describe as run
    return run(V.shop_subjects(spark, sf), V.shop_recordings(spark, sf), V.shop_segments(spark, sf),
               V.shop_sidecars(spark, sf), *args, **kw)


@query
def describe_child_id(spark, sf):
    """Annotated hours per child, most first in each corpus."""
    return _describe(spark, sf, "child_id", metric="duration_total", sort_by_y=True)


@query
def describe_child_age(spark, sf):
    """Mean segment length (ms) by age label, sorted by age."""
    return _describe(spark, sf, "child_age", metric="duration_mean", sort_by_y=False)


@query
def describe_speaker_type(spark, sf):
    """Spread of segment lengths by a segment-level axis with nulls."""
    return _describe(spark, sf, "speaker_type", metric="duration_std")


@query
def describe_speaker_id(spark, sf):
    """A8 + A9: segments per speaker over all corpora."""
    return _describe(spark, sf, "speaker_id", metric="count", aggregate=True, sort_by_y=True)


@query
def describe_age_bins(spark, sf):
    """Recorded hours per age bin of each corpus."""
    return _describe(spark, sf, "child_age", "recording", "duration_total")


@query
def describe_age_bins_pooled(spark, sf):
    """A9, P14 (D11): mean recorded hours over all corpora in common age bins."""
    return _describe(spark, sf, "child_age", "recording", "duration_mean", aggregate=True, sort_by_y=False)


@query
def describe_all_axes(spark, sf):
    """A8 + A9 + P15: every metric along every axis, per corpus and over all, from one pass and mergeable states."""
    from annolake.plans.describe import describe_all
    return describe_all(V.shop_subjects(spark, sf), V.shop_recordings(spark, sf), V.shop_segments(spark, sf), V.shop_sidecars(spark, sf))


# --- incremental merge ------------------------------------------------------------------

from annolake.operators import merge as U  # noqa: E402
from annolake.sources.sidecars import SIDECAR_FILE  # noqa: E402

DAY_MS = 86_400_000


def _halves(spark, sf):
    # days [0, 20) and [15, 30) of the event clock, cut on the raw timestamp so
    # the predicate is pushed to the parquet scan
    return (V.ev_files(spark, sf, F.col("ts") < F.lit("2024-01-21 00:00:00").cast("timestamp_ntz")),
            V.ev_files(spark, sf, F.col("ts") >= F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")))


@query
def merge_append(spark, sf):
    """U1 + U3: two overlapping batches appended with whole-row de-duplication."""
    old, new = _halves(spark, sf)
    return U.merge_append(old, new)


@query
def merge_replace(spark, sf):
    """The files of a set and recording in the new batch replace those of the same day (the days both hold)."""
    old, new = (h.withColumn("day", F.expr(f"range_onset div {DAY_MS}")) for h in _halves(spark, sf))
    return U.merge_replace(old, new, ["set", "recording_filename", "day"])


def _ev_copy(df, existing=None):
    src_ann = F.concat(F.lit("datasets/events/annotations/"), F.col("set"), F.lit("/converted/"),
                       F.col("annotation_filename"))
    src_side = F.concat(F.lit("datasets/events/annotations/"), F.col("set"), F.lit("/" + SIDECAR_FILE))
    src_std = F.concat(F.lit("datasets/events/recordings/converted/standard/"), F.col("recording_filename"))
    src_raw = F.concat(F.lit("datasets/events/recordings/raw/"), F.col("raw_filename"))
    return U.copy_manifest(df.withColumn("dataset", F.lit("events")), "out", items=[
        ("annotation", src_ann, "annotations", ["annotations"]),
        ("sidecar", src_side, "annotations", ["annotations"]),
        ("standard", src_std, "standard", ["recordings", "converted", "standard"]),
        ("raw", src_raw, "raw", ["recordings", "raw"])], existing=existing)


@query
def copy_manifest(spark, sf):
    """U4 + P4: copies of the new batch whose targets the first batch has not made."""
    old, new = _halves(spark, sf)
    return _ev_copy(new, existing=_ev_copy(old).select("target"))


# --- curation and projections ------------------------------------------------------------


@query
def filter_category(spark, sf):
    """files with a non-null value in a column the index maps to 'addressee'."""
    return CU.filter_category(V.doc_files(spark, sf), V.doc_labels(spark, sf), V.doc_category_index(spark, sf),
                              "addressee").select("dataset", "set_name", "file_key")


@query
def gold_sets(spark, sf):
    """manual sets of the document corpus."""
    return CU.gold_sets(V.doc_sidecars(spark, sf)).select("dataset", "set_name")


def _shop_file_index(spark, sf, children_expr=None):
    ch = CU.filter_expr(V.shop_children(spark, sf), children_expr)
    return CU.build_file_index(V.shop_annotations(spark, sf), V.shop_recordings(spark, sf), ch,
                               CU.gold_sets(V.shop_sidecars(spark, sf)), rec_key=["recording"],
                               child_key=["child_id"], set_key=["set_name"])


@query
def file_index(spark, sf):
    """J1 + F1 + F3: annotations of gold sets with kept recordings and children."""
    return _shop_file_index(spark, sf).select("recording", "set_name", "line", "range_onset", "range_offset",
                                              "child_id", "date_iso", "duration")


@query
def filter_children(spark, sf):
    """F2 + J1: file index restricted by a children filter expression."""
    return _shop_file_index(spark, sf, "child_sex in ['BUILDING'] & '1991-01-01' <= child_dob < '2100-01-01'") \
        .select("recording", "set_name", "line", "child_id")


@query
def propagate_children(spark, sf):
    """J2 + P9: children that keep at least one file (all-null columns dropped)."""
    return CU.propagate(_shop_file_index(spark, sf), V.shop_children(spark, sf), ["child_id"])


def _shop_recordings_ds(spark, sf):
    rec = V.shop_recordings(spark, sf).join(V.shop_children(spark, sf).select("child_id", "dataset"), "child_id")
    return rec.withColumn("recording_filename", F.concat(F.col("recording").cast("string"), F.lit(".wav")))


@query
def namespace_keys(spark, sf):
    """Recordings with corpus-qualified file names and child ids."""
    ch, rc, an = CU.namespace_keys(V.shop_children(spark, sf), _shop_recordings_ds(spark, sf),
                                   V.shop_annotations(spark, sf).withColumn("dataset", F.lit("shop"))
                                   .withColumnRenamed("set_name", "set"))
    return rc.select("recording", "recording_filename", "child_id", "date_iso", "duration", "discard")


@query
def namespace_annotations(spark, sf):
    """P1 on annotations: ``set`` -> ``<corpus>/<set>``."""
    an = V.shop_annotations(spark, sf).join(
        V.shop_recordings(spark, sf).select("recording", "child_id"), "recording") \
        .join(V.shop_children(spark, sf).select("child_id", "dataset"), "child_id") \
        .withColumnRenamed("set_name", "set")
    _, _, out = CU.namespace_keys(V.shop_children(spark, sf), _shop_recordings_ds(spark, sf), an)
    return out.select("recording", "line", "set", "range_onset", "range_offset")


@query
def span_from_name(spark, sf):
    """Onset / offset written in the annotation file name."""
    f = V.ev_files(spark, sf)
    s, e = C.span_from_name("annotation_filename")
    return f.select("seg_id", "annotation_filename", s.alias("span_start"), e.alias("span_end"),
                    (e - s).alias("span_ms"))


@query
def paths(spark, sf):
    """P3 + P4 + P5 + P11 + P12: source and target paths of the annotation copies."""
    si = _shop_split_input(spark, sf).filter(F.col("dataset").isNotNull())
    set_ns = F.concat(F.col("dataset"), F.lit("/"), F.col("set_name"))
    return si.select(
        "recording", "line", "annotation_path",
        C.dest_path("annotation_path", "annotations", "out", F.col("dataset"), ["annotations"]).alias("target_path"),
        C.with_suffix("recording_path", ".wav").alias("wav_path"),
        C.dataset_of_set(set_ns).alias("dataset_of_set"),
        F.lit("benchmarking").alias("experiment"))


@query
def align_drop_null(spark, sf):
    """P8 + P9 + F5: labels aligned to a fixed schema, null words nulled, empty columns dropped."""
    lab = V.doc_labels(spark, sf).withColumn("value", C.nullify("value"))
    aligned = C.align(lab, [("dataset", "string"), ("set_name", "string"), ("file_key", "bigint"),
                            ("label", "string"), ("value", "string"), ("annotator", "string"),
                            ("confidence", "double")])
    return C.drop_null_columns(aligned)


@query
def select_datasets(spark, sf):
    """Two corpora by name."""
    d = V.docs_index(spark, sf)
    return CU.select_datasets(d, ["de", "es"], known=d).select("key", "dataset", "set_name")


# --- flagship ---------------------------------------------------------------------------------

def _ev_corpus(spark, sf):
    from annolake.plans.create_dataset import Corpus
    ann = V.ev_files(spark, sf).withColumn("dataset", F.lit("events"))
    rec = V.ev_file_recordings(spark, sf).withColumn("dataset", F.lit("events"))
    # users whose number ends in 3: recording discarded; in 7: child discarded
    last = F.regexp_extract("child_id", "([0-9])$", 1)
    kids = rec.select("dataset", "child_id", F.when(last == "7", "1").alias("discard")).distinct()
    rec = rec.withColumn("discard", F.when(last == "3", "1"))
    return Corpus(kids, rec, ann)


def _ev_sidecars(spark, sf):
    """Sidecars of the event sets: ``signup`` has none, ``purchase`` is automated."""
    sets = V.table(spark, sf, "events").select(F.lit("events").alias("dataset"), F.col("event_type").alias("set")).distinct()
    return sets.filter("set <> 'signup'").withColumn(
        "method", F.when(F.col("set") == "purchase", "automated").otherwise("manual"))


def _ev_labels_keyed(spark, sf):
    return V.ev_labels(spark, sf).withColumn("dataset", F.lit("events"))


@query
def create_dataset(spark, sf):
    """E1 flagship: vtc files (non-null speaker_type) -> namespaced -> cut to clips -> rebased annotations."""
    from annolake.plans.create_dataset import create_dataset as build
    res = build(_ev_corpus(spark, sf), _ev_labels_keyed(spark, sf), V.ev_category_index(spark, sf), "vtc",
                file_key=("dataset", "set", "seg_id"),
                sidecars=_ev_sidecars(spark, sf))
    return res.corpus.annotations.select("seg_id", "set", "recording_filename", "range_onset", "range_offset",
                                         "time_seek", "annotation_filename", "raw_filename")


@query
def create_dataset_recordings(spark, sf):
    """The clip recordings table of the flagship corpus."""
    from annolake.plans.create_dataset import create_dataset as build
    res = build(_ev_corpus(spark, sf), _ev_labels_keyed(spark, sf), V.ev_category_index(spark, sf), "vtc",
                file_key=("dataset", "set", "seg_id"),
                sidecars=_ev_sidecars(spark, sf))
    return res.corpus.recordings.select("recording_filename", "child_id", "duration", "experiment")


def _ev_build(spark, sf, which=None, existing=None):
    from annolake.plans.create_dataset import Corpus
    from annolake.plans.create_dataset import create_dataset as build
    c = _ev_corpus(spark, sf)
    return build(Corpus(c.children, c.recordings, c.annotations.where(which) if which else c.annotations), _ev_labels_keyed(spark, sf),
                 V.ev_category_index(spark, sf), "vtc", existing=existing, file_key=("dataset", "set", "seg_id"), sidecars=_ev_sidecars(spark, sf))


def _ev_merged(spark, sf):
    """An older state of the corpus (two thirds of the files), to which two sets are added anew."""
    from annolake.plans.create_dataset import Corpus
    from annolake.session import cut_lineage
    old = _ev_build(spark, sf, "seg_id % 3 <> 0").corpus
    stored = Corpus(*(cut_lineage(t, "existing") for t in (old.children, old.recordings, old.annotations)))
    return _ev_build(spark, sf, "`set` in ('view', 'click') and seg_id % 5 <> 0", existing=stored).corpus


@query
def create_dataset_merged(spark, sf):
    """E1 + U1 / U2: sets built anew replace those of an existing corpus, its other sets stay."""
    return _ev_merged(spark, sf).annotations.select("seg_id", "set", "recording_filename", "range_onset", "range_offset",
                                                    "time_seek", "annotation_filename", "raw_filename")


@query
def create_dataset_merged_recordings(spark, sf):
    """E1 + U2: the recordings of children that are built anew replace theirs."""
    return _ev_merged(spark, sf).recordings.select("recording_filename", "child_id", "duration", "experiment")


@query
def cut_manifest_existing(spark, sf):
    """I8 with ``existing``: the cut jobs of all clips whose outputs an earlier run (two thirds of the files) has not made."""
    raw = F.concat(F.lit("recordings/raw/"), F.col("recording_filename"))
    files, rec = V.ev_files(spark, sf), V.ev_file_recordings(spark, sf)
    done = I.cut_manifest(I.clip_list(files.where("seg_id % 3 <> 0"), rec, ignore_time_seek=True), sources=[("raw", raw)])
    return I.cut_manifest(I.clip_list(files, rec, ignore_time_seek=True), sources=[("raw", raw)], existing=done.select("output"))


# --- plan-level queries -------------------------------------------------------------------------


@query
def split_same_child(spark, sf):
    """E2 with --same-child: weighted split then entity-exclusive reassignment by (child, corpus)."""
    from annolake.plans.splits import make_splits
    si = _shop_split_input(spark, sf).withColumn(
        "_key", F.concat_ws(":", "recording", "line", "set_name", "range_offset"))
    res = make_splits(si, "_key", same_child=True)
    return res.rows.drop("_key")


@query
def validation_report(spark, sf):
    """Every validation check as one violations table."""
    from annolake.plans.profiling import validation_report as report
    idx = V.doc_category_index(spark, sf)
    return report(idx, K.nest_index(idx), _doc_profile(spark, sf), V.doc_sidecars_raw(spark, sf))


@query
def clip_orphans(spark, sf):
    """I3 side output: annotations whose recording is not among the kept (non-discarded) recordings."""
    ann = I.shift(V.shop_annotations(spark, sf))
    _, orphans = I.clip_to_recording(ann, C.drop_discarded(V.shop_recordings(spark, sf)), "recording")
    return orphans.select("recording", "set_name", "line", "range_onset", "range_offset")


@query
def propagate_recordings(spark, sf):
    """J2 + P9: recordings that keep at least one file of the gold-set file index."""
    return CU.propagate(_shop_file_index(spark, sf), V.shop_recordings(spark, sf), ["recording"])


@query
def propagate_annotations(spark, sf):
    """Annotation rows of the file index (distinct keys, no fan-out from repeated keys)."""
    fi = _shop_file_index(spark, sf)
    return CU.propagate(fi.select("recording", "set_name", "line").distinct(), V.shop_annotations(spark, sf),
                        ["recording", "set_name", "line"])


@query
def overall_std(spark, sf):
    """A9 companion (D14): the true sample std over all corpora per axis value, beside the pooled one."""
    seg = _shop_segments(spark, sf)
    return S.distribution(seg, "child_sex", "seg_ms", by=[], metrics=["duration_std"])


@query
def filter_sidecars(spark, sf):
    """F2 on sidecars: sets whose sidecar satisfies a user expression."""
    return CU.filter_expr(V.doc_sidecars(spark, sf), "method.str.lower() == 'manual' and ~(has_speaker_type != 'Y')") \
             .select("dataset", "set_name")


@query
def split_curated(spark, sf):
    """E1 curation (vtc files) then E2: split stratified by set, weighted by annotation length."""
    from annolake.plans.splits import split_curated as run
    res = run(_ev_corpus(spark, sf), _ev_labels_keyed(spark, sf), V.ev_category_index(spark, sf), "vtc",
              key="seg_id", fractions=(700, 200, 100), stratify_set=True, file_key=("dataset", "set", "seg_id"),
                sidecars=_ev_sidecars(spark, sf))
    return res.rows.select("seg_id", "set", "child_id", "duration_ms", "annotation_path", "recording_path", "split")


@query
def distribution_recordings(spark, sf):
    """A8 on the recording axis: mean and total recording hours per corpus and child_sex
    (discarded recordings dropped; hours for every metric on this axis)."""
    S.check_axes("child_sex", "recording")
    ch = V.shop_children(spark, sf)
    rec = C.drop_discarded(V.shop_recordings(spark, sf)).join(ch.select("child_id", "dataset", "child_sex"),
                                                             "child_id", "inner")
    # mean of the exact millisecond counts, then one division to hours
    out = S.distribution(rec, "child_sex", "duration", by=["dataset"], metrics=["duration_mean", "count"])
    return out.withColumn("duration_mean", F.col("duration_mean") / F.lit(3_600_000.0))


@query
def split_created(spark, sf):
    """E2 on a built corpus: corpus from the set prefix (P11), annotations joined to the
    clip recordings (J3), split per corpus weighted by annotation length."""
    from annolake.plans.create_dataset import create_dataset as build
    res = build(_ev_corpus(spark, sf), _ev_labels_keyed(spark, sf), V.ev_category_index(spark, sf), "vtc",
                file_key=("dataset", "set", "seg_id"),
                sidecars=_ev_sidecars(spark, sf))
    ann = res.corpus.annotations.select("seg_id", "set", "recording_filename", "range_onset", "range_offset")
    rec = res.corpus.recordings.select("recording_filename", "child_id")
    si = (ann.join(rec, "recording_filename", "left")
             .withColumn("dataset", C.dataset_of_set("set"))
             .withColumn("duration_ms", F.col("range_offset") - F.col("range_onset")))
    return T.weighted_split(si, "seg_id", "duration_ms", (800, 100, 100), by=["dataset"], seed=0) \
            .select("seg_id", "dataset", "child_id", "duration_ms", "split")


@query
def create_dataset_copies(spark, sf):
    """E1 + U4: files the flagship corpus copies (annotations, sidecars, raw and standard recordings)."""
    from annolake.plans.create_dataset import create_dataset as build
    res = build(_ev_corpus(spark, sf), _ev_labels_keyed(spark, sf), V.ev_category_index(spark, sf), "vtc",
                file_key=("dataset", "set", "seg_id"),
                sidecars=_ev_sidecars(spark, sf))
    return res.copies.select("kind", "source", "target")


@query
def cut_recordings(spark, sf):
    """I8 / I9 on WAV content: each document's bytes as the 16-bit samples of a recording, cut to three clips."""
    from annolake.operators import audio
    docs = V.table(spark, sf, "documents").where("text is not null").select(
        F.concat(F.lit("d"), F.col("doc_id"), F.lit(".wav")).alias("recording_filename"), F.encode("text", "UTF-8").alias("samples"))
    n = F.length("samples")
    word = lambda h: F.unhex(F.lit(h))
    files = docs.select("recording_filename", F.concat(
        word("52494646"), audio.to_little_endian(n + 48, 4), word("57415645"), word("4C49535403000000414243" + "00"),      # RIFF, WAVE, an odd LIST chunk
        word("666D7420" + "10000000" + "0100" + "0100" + "E8030000" + "D0070000" + "0200" + "1000"),                      # fmt: mono, 1,000 frames of 2 bytes a second
        word("64617461"), audio.to_little_endian(n, 4), F.col("samples")).alias("content"))
    ends = F.array(*[F.struct(F.lit(a).alias("start"), b.alias("end")) for a, b in (
        (10, F.lit(60)), (100, 100 + F.floor(n / 4)), (10_000_000, F.lit(10_000_005)))])
    clips = docs.select("recording_filename", F.explode(ends).alias("c")).select("recording_filename", "c.*")
    pieces, _ = audio.cut_wav(files, clips)
    size = audio.little_endian(F.col("content"), 40, 4)
    return pieces.select("output", size.alias("n_bytes"), F.md5(F.hex(F.substring(F.col("content"), F.lit(45), size.cast("int")))).alias("samples_md5"))


# --- file sources -----------------------------------------------------------------

def _csv(df, path, *by):
    (df.write.partitionBy(*by).option("header", "true").option("quoteAll", "true").option("escape", '"')
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    return path


@query
def scan_index_files(spark, sf):
    """The documents as CSV index tables, one folder a corpus (quotes and line breaks in cells), scanned back."""
    from annolake.session import scratch_path
    from annolake.sources.index import scan_index
    docs = V.table(spark, sf, "documents")
    path = _csv(docs.select(F.col("lang").alias("dataset"), "doc_id", "source", F.col("n_chars").alias("duration"), F.col("text").alias("notes")),
                scratch_path(spark, "index_files"), "dataset")
    return scan_index(spark, path, "documents", layout=r"/dataset=([^/]+)/[^/]+\.csv$").select("dataset", "doc_id", "source", "duration", "notes")


@query
def scan_segment_files(spark, sf):
    """S2 + F6: turns as segment CSVs whose label columns differ by set, chosen by corpus, as a long label map."""
    from annolake.session import scratch_path
    from annolake.sources.index import scan_segments, segments_long
    t = V.table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id") % 4).alias("dataset"), F.col("role").alias("set"),
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("segment_onset"), F.length("text").alias("segment_offset"), F.col("text").alias("transcription"))
    path = scratch_path(spark, "segment_files")
    for users, kinds in ((True, []), (False, [F.when(F.col("segment_offset") % 2 == 0, F.lit("NA")).otherwise(F.col("set")).alias("speaker_type")])):
        _csv(t.where((F.col("set") == "user") == users).select("dataset", "set", "segment_onset", *kinds, "segment_offset", "transcription"),
             f"{path}/{int(users)}", "dataset", "set")
    seg = scan_segments(spark, path, datasets=["c0", "c2", "c3"], layout=r"/dataset=([^/]+)/set=([^/]+)/([^/]+)$")
    return segments_long(seg).select("dataset", "set", "segment_onset", "segment_offset", "label", "value")
