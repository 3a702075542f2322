"""Interval operators: shift, pad, clip, support (merge), clip lists, containment,
rebasing onto the clip clock, and the manifests of the cutting step.

Intervals are two long columns (ms, or characters for text). Boundary rules of
the support: empty intervals are dropped; touching intervals merge; with a
collar ``c`` a gap merges unless ``gap > 0 and gap >= c``.

Scale: every per-recording scan is chunked along the time axis
(:func:`annolake.operators.scan.running_agg`), so a recording holding a third
of all segments is still spread over many tasks. No range join and no pairing
of rows inside a recording is ever built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annolake.functions.columns import clip_name, stem_of, with_stem
from annolake.operators.scan import CHUNK, KEY, running_agg

# Width of one chunk of the time axis: one minute of milliseconds. Rows per
# chunk are then bounded by how many segments can start within one minute of
# one recording (whatever the recording's share of all rows), and the carry
# scan of a recording holds one row per minute of it (a year = 525,600 rows).
DEFAULT_CHUNK = 60_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- I1 / I2 / I3 ------------------------------------------------------------

def shift(df: DataFrame, onset: str = "range_onset", offset: str = "range_offset",
          time_seek: str = "time_seek", ignore: bool = False,
          start: str = "start", end: str = "end") -> DataFrame:
    """Place an annotation on the recording clock (``+ time_seek``).

    ``ignore=True`` treats time_seek as 0 (converted recordings). The input is
    not modified; new columns ``start``/``end`` are added.
    """
    ts = F.lit(0) if (ignore or time_seek not in df.columns) else F.coalesce(F.col(time_seek), F.lit(0))
    return df.withColumn(start, (_c(onset) + ts).cast("long")).withColumn(end, (_c(offset) + ts).cast("long"))


def pad(df: DataFrame, ms: int, start: str = "start", end: str = "end") -> DataFrame:
    """Widen both sides."""
    if not ms:
        return df
    return df.withColumn(start, F.col(start) - F.lit(ms)).withColumn(end, F.col(end) + F.lit(ms))


def clip_to_recording(df: DataFrame, recordings: DataFrame, key: str = "recording",
                      duration: str = "duration", start: str = "start", end: str = "end"
                      ) -> tuple[DataFrame, DataFrame]:
    """Crop to ``[0, duration]``; what falls outside (or is empty) vanishes.

    Returns (clipped, orphans): orphans are rows whose recording is unknown
    (side output instead of an index error). The recordings table is one row per
    recording; the join is left to AQE (broadcast only when measured small).
    """
    rec = recordings.select(key, F.col(duration).cast("long").alias("_dur"))
    j = df.join(rec, key, "inner")
    clipped = (j.withColumn(start, F.greatest(F.col(start), F.lit(0).cast("long")))
                .withColumn(end, F.least(F.col(end), F.col("_dur")))
                .filter(F.col(start) < F.col(end))
                .drop("_dur"))
    orphans = df.join(rec, key, "left_anti")
    return clipped, orphans


# --- I4 support -----------------------------------------------------------------

def support(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end",
            collar: int = 0, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """I4: merge overlapping / touching intervals per ``by`` key.

    Support is associative. Equal starts fold to their largest end first, on (key, start), so a
    stretch of the clock that holds a third of all rows is spread over all tasks and a chunk has at most
    ``chunk`` rows left, however many intervals start in it. Then see ``partial_islands`` and ``join_islands``.
    Output: ``by`` + [start, end].
    """
    return join_islands(partial_islands(df, by, start, end, collar, chunk), by, start, end, collar)


def _gap_opens(gap: Column, collar: int) -> Column:
    return (gap > 0) & (gap >= F.lit(collar))


def partial_islands(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end",
                    collar: int = 0, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """The islands of each (key, time chunk) alone: (KEY, CHUNK, _ps, _pe). A running max of ends finds them."""
    d = (df.select(F.struct(*[F.col(b) for b in by]).alias(KEY), F.col(start).cast("long").alias("_s"),
                   F.col(end).cast("long").alias("_e"))
         .filter(F.col("_s") < F.col("_e"))
         .groupBy(KEY, "_s").agg(F.max("_e").alias("_e"))
         .withColumn(CHUNK, F.struct(F.floor(F.col("_s") / F.lit(chunk)).alias("c"))))
    w = Window.partitionBy(KEY, CHUNK).orderBy("_s")
    d = d.withColumn("_prev", F.max("_e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.col("_prev").isNull() | _gap_opens(F.col("_s") - F.col("_prev"), collar)
    d = d.withColumn("_ps", F.max(F.when(new, F.col("_s"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy(KEY, CHUNK, "_ps").agg(F.max("_e").alias("_pe"))


def join_islands(partial: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", collar: int = 0) -> DataFrame:
    """Partial islands, disjoint and ordered inside each chunk, joined to whole ones.

    What an earlier chunk reaches over is then a leading run of partial islands: with the largest end of all
    earlier chunks (``_m``, one row a chunk), a partial island either opens an island of its own or
    continues the last one opened before its chunk (``_open``). A final aggregate (map-side
    combined) gives one row per island.
    """
    # both branches below read the one exchange of the partial islands; its column order differs
    # from that of the islands' window so that it is not taken for the same partitioning and left out
    partial = partial.repartition(CHUNK, KEY)
    per_chunk = partial.groupBy(KEY, CHUNK).agg(F.max("_ps").alias("_last"), F.max("_pe").alias("_reach"))
    wc = Window.partitionBy(KEY).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    opens = lambda at: F.col("_m").isNull() | _gap_opens(F.col(at) - F.col("_m"), collar)
    carry = (per_chunk.withColumn("_m", F.max("_reach").over(wc))
             .withColumn("_open", F.max(F.when(opens("_last"), F.col("_last"))).over(wc))
             .select(KEY, CHUNK, "_m", "_open"))
    islands = (partial.join(carry, [KEY, CHUNK], "inner")
               .select(KEY, "_ps", "_pe", F.when(opens("_ps"), F.col("_ps")).otherwise(F.col("_open")).alias("_is"))
               .groupBy(KEY, "_is").agg(F.min("_ps").alias(start), F.max("_pe").alias(end)))
    return islands.select(*[F.col(f"{KEY}.{b}").alias(b) for b in by], start, end)


def support_in_recording(df: DataFrame, recordings: DataFrame, key: str = "recording", duration: str = "duration",
                         start: str = "start", end: str = "end", collar: int = 0,
                         chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """I3 + I4: islands of the intervals inside ``[0, duration]`` of their recording.

    The islands of the cropped intervals are the cropped islands
    of the raw intervals (cropping keeps overlaps and touches inside the
    window), so the support runs first and only the islands meet the
    recordings table: a recording with a third of all segments never passes
    through a join on its key. A collar merges the cropped islands in a second step (a gap
    outside the window must not bridge two of them).
    """
    # null keys have no recording; said here, both branches of the support read the same rows and share their exchange
    known = df.where(F.col(key).isNotNull())
    islands = support(known.select(key, start, end), [key], start, end, chunk=chunk)
    c, _ = clip_to_recording(islands, recordings, key, duration, start, end)
    return support(c, [key], start, end, collar=collar, chunk=chunk) if collar else c


def covered(clips: DataFrame, by: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Covered length and number of clips per key."""
    return clips.groupBy(*by).agg(
        F.sum(F.col(end) - F.col(start)).cast("long").alias("covered_ms"),
        F.count(F.lit(1)).alias("n_clips"),
    )


# --- I5 clip list ---------------------------------------------------------------

def clip_list(annotations: DataFrame, recordings: DataFrame, key: str = "recording_filename",
              pad_ms: int = 0, ignore_time_seek: bool = False, onset: str = "range_onset",
              offset: str = "range_offset", time_seek: str = "time_seek", duration: str = "duration",
              collar: int = 0, chunk: int = DEFAULT_CHUNK, name: bool = True) -> DataFrame:
    """Shift, pad, crop, merge -> (key, start, end[, clip_filename])."""
    s = shift(annotations.select(*{key, onset, offset} | ({time_seek} & set(annotations.columns))),
              onset, offset, time_seek, ignore_time_seek)
    s = pad(s, pad_ms)
    clips = support_in_recording(s, recordings, key, duration, collar=collar, chunk=chunk)
    if name:
        clips = clips.withColumn("clip_filename", clip_name(F.col(key).cast("string"), "start", "end"))
    return clips


# --- J6 containment ---------------------------------------------------------------

def assign_to_clip(df: DataFrame, clips: DataFrame, key: str = "recording_filename",
                   onset: str = "range_onset", offset: str = "range_offset",
                   time_seek: str = "time_seek", ignore_time_seek: bool = False,
                   clip_start: str = "start", clip_end: str = "end",
                   chunk: int = DEFAULT_CHUNK) -> tuple[DataFrame, DataFrame]:
    """The clip of the same recording that contains the annotation.

    Clips of a recording are disjoint, so the only candidate is the clip with the
    largest start <= onset (an as-of lookup); the annotation is inside iff its
    offset <= that clip's end. The lookup is a chunked running max over the union
    of clip starts and the distinct onsets (no range join and no pairs; a chunk holds at most
    ``chunk`` onsets, however many annotations begin in it), and the clips found are joined
    back on (recording, onset), where adaptive execution splits an onset that very many share.
    Returns (assigned + clip_start/clip_end columns, discarded).
    """
    ts = F.lit(0) if (ignore_time_seek or time_seek not in df.columns) else F.coalesce(F.col(time_seek), F.lit(0))
    probes = df.withColumn("_on", (F.col(onset) + ts).cast("long")).withColumn("_off", (F.col(offset) + ts).cast("long"))
    at = F.struct(F.col(key), F.col("_on"))                  # in a struct, nulls meet like other values
    none = F.lit(None).cast("struct<cs:bigint,ce:bigint>")
    onsets = probes.select(key, "_on").distinct().withColumn("_kind", F.lit(1)).withColumn("_ref", none)
    refs = clips.select(
        F.col(key), F.col(clip_start).cast("long").alias("_on"), F.lit(0).alias("_kind"),
        F.struct(F.col(clip_start).cast("long").alias("cs"), F.col(clip_end).cast("long").alias("ce")).alias("_ref"))
    # disjoint clips: max by start also has the max end, so one struct max carries both
    u = running_agg(onsets.unionByName(refs), [key], ["_on", "_kind"], "_ref", "_cand", fn="max",
                    chunk_of=F.floor(F.col("_on") / F.lit(chunk)), inclusive=True)
    found = u.filter(F.col("_kind") == 1).select(at.alias("_at"), "_cand")
    p = probes.withColumn("_at", at).join(found, "_at").drop("_at")
    inside = F.col("_cand").isNotNull() & (F.col("_off") <= F.col("_cand.ce"))
    p = p.withColumn("_in", F.coalesce(inside, F.lit(False)))
    assigned = (p.filter("_in")
                 .withColumn("clip_start", F.col("_cand.cs"))
                 .withColumn("clip_end", F.col("_cand.ce"))
                 .drop("_cand", "_in"))
    discarded = p.filter(~F.col("_in")).drop("_cand", "_in", "_on", "_off")
    return assigned, discarded


# --- I6 / P7 rebase -------------------------------------------------------------------

def rebase(assigned: DataFrame, key: str = "recording_filename", onset: str = "range_onset",
           offset: str = "range_offset", time_seek: str = "time_seek",
           annotation_name: str | None = "annotation_filename",
           raw_name: str | None = "raw_filename") -> DataFrame:
    """I6 + P7: move an assigned annotation onto its clip's clock and rename.

    Uses ``_on``/``_off``/``clip_start``/``clip_end`` from :func:`assign_to_clip`.
    Keeps ``original_*`` names; ``time_seek`` becomes 0.
    """
    new_rec = clip_name(F.col(key).cast("string"), "clip_start", "clip_end")
    d = (assigned
         .withColumn(f"original_{key}", F.col(key))
         .withColumn(onset, F.col("_on") - F.col("clip_start"))
         .withColumn(offset, F.col("_off") - F.col("clip_start"))
         .withColumn(key, new_rec))
    if time_seek in d.columns:
        d = d.withColumn(time_seek, F.lit(0).cast(d.schema[time_seek].dataType))
    clip_stem = stem_of(F.col(key))
    if annotation_name and annotation_name in d.columns:
        d = (d.withColumn(f"original_{annotation_name}", F.col(annotation_name))
              .withColumn(annotation_name, with_stem(F.col(annotation_name), F.concat_ws(
                  "_", clip_stem, F.col(onset).cast("string"), F.col(offset).cast("string")))))
    if raw_name and raw_name in d.columns:
        d = d.withColumn(raw_name, with_stem(F.col(raw_name), clip_stem))
    return d.drop("_on", "_off")


# --- J7 / I8 / I10 / I11 manifests ----------------------------------------------------------

def recordings_on_clips(recordings: DataFrame, clips: DataFrame, key: str = "recording_filename",
                        duration: str = "duration", stamp: str | None = "benchmarking") -> DataFrame:
    """One recording row per clip; the clip name replaces the file name and the
    duration becomes the clip length. Recordings without clips are dropped."""
    c = clips.select(key, F.col("start").alias("_cs"), F.col("end").alias("_ce"))
    j = recordings.join(c, key, "inner")
    j = (j.withColumn(key, clip_name(F.col(key).cast("string"), "_cs", "_ce"))
          .withColumn(duration, (F.col("_ce") - F.col("_cs")).cast("long"))
          .drop("_cs", "_ce"))
    if stamp is not None:
        j = j.withColumn("experiment", F.lit(stamp))
    return j.dropDuplicates()


def cut_manifest(clips: DataFrame, key: str = "recording_filename", existing: DataFrame | None = None,
                 sources: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """I8: distinct cut jobs (source, start, end, output); outputs already present are skipped.

    ``sources`` lists (version, path column) pairs, e.g. raw and standard
    recordings; default is the recording name itself.
    """
    srcs = list(sources) or [("standard", F.col(key).cast("string"))]
    # one row per (clip, version) from a single pass over the clips
    versions = F.array(*[F.struct(F.lit(v).alias("version"), p.alias("source")) for v, p in srcs])
    jobs = clips.select(F.explode(versions).alias("v"), F.col("start").cast("long").alias("start"),
                        F.col("end").cast("long").alias("end")) \
                .select("v.version", "v.source", "start", "end")
    jobs = jobs.withColumn("output", clip_name(F.col("source"), "start", "end")).dropDuplicates()
    if existing is not None:
        jobs = jobs.join(existing.select(F.col(existing.columns[0]).alias("output")), "output", "left_anti")
    return jobs


def superseded(rebased: DataFrame, key: str = "recording_filename") -> DataFrame:
    """Full recordings that the clips replace (to remove)."""
    return rebased.select(F.col(f"original_{key}").alias(key)).distinct()


def rename_manifest(rebased: DataFrame, name: str = "annotation_filename",
                    set_col: str = "set") -> DataFrame:
    """Distinct (set, old name, new name) moves."""
    cols = ([set_col] if set_col in rebased.columns else [])
    return rebased.select(*cols, F.col(f"original_{name}").alias("old_name"),
                          F.col(name).alias("new_name")).distinct()


# --- I9 payload slicing -----------------------------------------------------------------------

def slice_payload(payload: DataFrame, clips: DataFrame, key: str = "recording",
                  onset: str = "onset", offset: str = "offset_ms", col: str = "text",
                  chunk: int = DEFAULT_CHUNK, texts: DataFrame | None = None,
                  text_keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Cut a payload (text by character, or binary by byte) to the clips.

    One piece for each payload row and clip that overlap: the part of the payload
    inside the clip, placed on the clip's clock. Rows that overlap no clip are
    returned as discarded. Both sides are spread over the chunks of the clock
    they touch and joined on (key, chunk); a pair is kept in the chunk where
    its overlap begins, so it is found once and no range join is planned.
    With ``texts`` the positions in ``payload`` are narrow rows and the payload
    column comes from ``texts`` joined once on ``text_keys`` after the cut.
    """
    def spread(df: DataFrame, lo: str, hi: str) -> DataFrame:
        return df.filter(F.col(lo) < F.col(hi)).withColumn("_ck", F.explode(F.sequence(
            F.floor(F.col(lo) / F.lit(chunk)), F.floor((F.col(hi) - 1) / F.lit(chunk)))))

    p = payload.withColumn("_on", _c(onset).cast("long")).withColumn("_off", _c(offset).cast("long"))
    c = clips.select(key, F.col("start").cast("long").alias("clip_start"), F.col("end").cast("long").alias("clip_end"))
    lo, hi = F.greatest("_on", "clip_start"), F.least("_off", "clip_end")
    found = (spread(p, "_on", "_off").join(spread(c, "clip_start", "clip_end"), [key, "_ck"])
             .filter((lo < hi) & (F.floor(lo / F.lit(chunk)) == F.col("_ck"))).drop("_ck"))
    same = list(text_keys) or [x for x in payload.columns if x != col]
    discarded = payload.join(found.select(*same).distinct(), same, "left_anti")
    if texts is not None:
        found = found.join(texts.select(*text_keys, col), list(text_keys), "inner")
    out = (found
           .withColumn("piece_start", lo - F.col("clip_start"))
           .withColumn("piece_end", hi - F.col("clip_start"))
           .withColumn(col, F.col(col).substr((lo - F.col("_on") + 1).cast("int"), (hi - lo).cast("int")))
           .drop("_on", "_off"))
    return out, discarded
