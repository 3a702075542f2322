"""Driver tables and the corpus-shaped views over them.

The driver ships TPC-H-like tables plus ``events``, ``documents``, ``labels`` and
``conversations``. The views below give them the shape of our data model
(recordings, segments, label maps, split inputs, children). They are plain lazy
DataFrames: Catalyst prunes the parquet columns and pushes filters to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annolake.operators.scan import prefix_sum

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values shared with the DuckDB oracles (see annolake/plans/oracles.py).
EVENT_EPOCH = "2024-01-01 00:00:00"
EVENT_RECORDING_MS = 2505600000  # 29 days; events span 30, so clipping has work to do


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_ms(ts: Column) -> Column:
    """Milliseconds since the event epoch. Timestamps are stored without zone;
    the difference of two zone-less timestamps does not depend on the session
    time zone (no daylight-saving shifts)."""
    us = F.timestamp_diff("MICROSECOND", F.lit(EVENT_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))
    return F.floor(us / F.lit(1000)).cast("long")


def ev_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recording per user, all of the same length."""
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.col("user_id").alias("recording")).distinct()
            .withColumn("duration", F.lit(EVENT_RECORDING_MS).cast("long")))


def ev_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as annotated intervals: onset = ms since epoch, length = value minutes."""
    ev = table(spark, sf_dir, "events")
    onset = _epoch_ms(F.col("ts"))
    return ev.select(
        F.col("user_id").alias("recording"),
        F.col("event_id").alias("seg_id"),
        F.col("event_type").alias("set_name"),
        onset.alias("onset"),
        (onset + F.round(F.col("value") * 60000).cast("long")).alias("offset_ms"),
    )


def ev_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with a long label map: ``speaker_type`` (categorical) and ``k``."""
    ev = table(spark, sf_dir, "events")
    onset = _epoch_ms(F.col("ts"))
    base = ev.select(
        F.col("user_id").alias("recording"),
        F.col("event_id").alias("seg_id"),
        F.col("event_type").alias("set_name"),
        onset.alias("onset"),
        (onset + F.round(F.col("value") * 60000).cast("long")).alias("offset_ms"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("_st"),
        F.get_json_object("props", "$.k").alias("_k"),
    )
    # one row per (segment, label); stack keeps null values (a column that exists is data)
    return base.select(
        "recording", "seg_id", "set_name", "onset", "offset_ms",
        F.expr("stack(2, 'speaker_type', _st, 'k', _k) AS (label, value)"),
    )


def docs_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split input: one weighted row per document."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("key"),
        F.col("lang").alias("dataset"),
        F.col("source").alias("set_name"),
        F.concat_ws("/", "source", "lang").alias("entity"),
        F.col("n_chars").alias("weight"),
    )


def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse labels: every document gets a ``quality`` and a ``toxic`` row, null when unlabelled."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("lang").alias("dataset"),
        F.col("source").alias("set_name"),
        F.col("doc_id").alias("file_key"),
        F.lit(0).cast("long").alias("onset"),
        F.col("n_chars").alias("offset_ms"),
        F.expr("stack(2, 'quality', cast(quality AS string), 'toxic', cast(toxic AS string)) AS (label, value)"),
    )


def turns(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Conversation turns laid end to end on a character clock."""
    c = table(spark, sf_dir, "conversations")
    cols = ["conv_id", "turn", "role"] + (["text"] if with_text else [])
    base = c.select(*cols, F.length("text").cast("long").alias("_len"))
    ps = prefix_sum(base, by=["conv_id"], order=["turn"], value="_len", out="offset_ms",
                    chunk_of=F.floor(F.col("turn") / 1024))
    out = ps.select(
        F.col("conv_id").alias("recording"), "turn", F.col("role").alias("set_name"),
        (F.col("offset_ms") - F.col("_len")).alias("onset"), "offset_ms",
        *(["text"] if with_text else []),
    )
    return out


def shop_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("dataset"),
        F.col("c_custkey").alias("child_id"),
        F.col("c_mktsegment").alias("child_sex"),
        F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("child_dob"),
    )


def shop_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The children with what a subject table holds: sex, languages, norm and its criteria, discarded ones among them."""
    seg = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("child_id"), F.col("c_mktsegment").alias("_m"))
    k = F.col("child_id")
    return shop_children(spark, sf_dir).drop("child_sex").join(seg, "child_id").select(
        "dataset", "child_id", "child_dob",
        F.when(k % 7 == 0, None).when(k % 3 == 0, "F").when(k % 3 == 1, "m").otherwise("Male").alias("child_sex"),
        F.when(F.col("_m") == "BUILDING", "en; fr").when(F.col("_m") == "MACHINERY", None)
         .otherwise(F.lower(F.substring("_m", 1, 2))).alias("languages"),
        F.when(k % 5 == 0, "N").when(k % 5 < 4, "Y").alias("normative"),
        F.when(k % 5 == 0, F.lower("_m")).alias("normative_criterion"),
        F.lit("extrapolated").alias("dob_criterion"),
        F.when(k % 2 == 0, "day").otherwise("month").alias("dob_accuracy"),
        F.when(k % 11 == 0, "1").alias("discard"))


def shop_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("recording"),
        F.col("o_custkey").alias("child_id"),
        F.col("o_orderdate").cast("date").alias("date_iso"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("duration"),
        F.when(F.col("o_orderstatus") == "P", F.lit("1")).alias("discard"),
    )


def shop_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("recording"),
        F.col("l_returnflag").alias("set_name"),
        F.col("l_linenumber").alias("line"),
        F.lit(0).cast("long").alias("range_onset"),
        F.round(F.col("l_quantity") * 1000).cast("long").alias("range_offset"),
    )


def shop_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines as segments with a speaker: type by line status (null for the first line), one speaker a supplier of 20."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("recording"), F.col("l_returnflag").alias("set_name"),
        F.lit(0).cast("long").alias("segment_onset"), F.round(F.col("l_quantity") * 1000).cast("long").alias("segment_offset"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linestatus")).alias("speaker_type"),
        (F.col("l_suppkey") % 20).cast("string").alias("speaker_id"))


def ev_files(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Events as an annotation index with file names (``u<user>.wav``,
    ``u<user>_<onset>_<offset>.csv``), the shape the cutting step works on.
    ``where`` filters the raw events (so it reaches the parquet scan)."""
    ev = table(spark, sf_dir, "events")
    if where is not None:
        ev = ev.filter(where)
    onset = _epoch_ms(F.col("ts"))
    offset = onset + F.round(F.col("value") * 60000).cast("long")
    user = F.col("user_id").cast("string")
    return ev.select(
        F.col("event_type").alias("set"),
        F.concat(F.lit("u"), user, F.lit(".wav")).alias("recording_filename"),
        F.concat(F.lit("u"), user, F.lit(".its")).alias("raw_filename"),
        F.lit(0).cast("long").alias("time_seek"),
        onset.alias("range_onset"),
        offset.alias("range_offset"),
        F.concat(F.lit("u"), user, F.lit("_"), onset.cast("string"), F.lit("_"), offset.cast("string"),
                 F.lit(".csv")).alias("annotation_filename"),
        F.col("event_id").alias("seg_id"),
    )


def ev_file_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    return (ev.select("user_id").distinct().select(
        F.concat(F.lit("u"), user, F.lit(".wav")).alias("recording_filename"),
        F.lit(EVENT_RECORDING_MS).cast("long").alias("duration"),
        F.concat(F.lit("u"), user).alias("child_id")))


# --- corpus metadata derived from the documents table ---------------------------------
# Each (lang, source) pair of ``documents`` plays one annotation set of one corpus.
# Its sidecar and its line in the category index are derived from the rows of
# the set by the rules below, so their size follows the data.

def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotation index of the document corpus: one file per document."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("lang").alias("dataset"), F.col("source").alias("set_name"), F.col("doc_id").alias("file_key"),
        F.concat(F.col("doc_id").cast("string"), F.lit("_0_"), F.col("n_chars").cast("string"),
                 F.lit(".csv")).alias("annotation_filename"))


def doc_sidecars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sidecar map per set. Rules: 'src18' sets have no sidecar; 'src19' is
    automated; English sets carry a sample count, Spanish a zero count; the
    unit is one minute except for French; German sets deny speaker types;
    French sets have an invalid sampling target."""
    d = table(spark, sf_dir, "documents").select("lang", "source")
    g = d.filter(F.col("source") != "src18").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    lang = F.col("lang")
    entries = [
        ("segmentation", F.col("source")),
        ("method", F.when(F.col("source") == "src19", "automated").otherwise("manual")),
        ("sampling_method", F.lit("random")),
        ("sampling_target", F.when(lang == "fr", "xyz").otherwise("chi")),
        ("sampling_count", F.when(lang == "en", F.col("n").cast("string")).when(lang == "es", F.lit("0"))),
        ("sampling_unit_duration", F.when(lang != "fr", F.lit("60000"))),
        ("date_annotation", F.when(lang == "de", F.lit("2024-13-01")).otherwise(F.lit("2024-02-01"))),
        ("has_speaker_type", F.when(lang == "de", "N").otherwise("Y")),
        ("has_addressee", F.when(lang == "fr", "y").when(lang == "es", "Y")),
    ]
    kv = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in entries])
    kv = F.filter(kv, lambda e: e["value"].isNotNull())
    return g.select(F.col("lang").alias("dataset"), F.col("source").alias("set_name"),
                    F.map_from_entries(kv).alias("raw"))


def doc_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from annolake.sources.sidecars import typed_sidecars
    return typed_sidecars(doc_sidecars_raw(spark, sf_dir))


def doc_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long category index (dataset, set_name, category, column): ``quality`` is a
    vtc column everywhere; ``toxic`` is addressee in English and French sets and
    'other' elsewhere."""
    d = table(spark, sf_dir, "documents").select("lang", "source").distinct()
    toxic_cat = F.when(F.col("lang").isin("en", "fr"), F.lit("addressee_cols")).otherwise(F.lit("other"))
    return d.select(F.col("lang").alias("dataset"), F.col("source").alias("set_name"),
                    F.explode(F.array(
                        F.struct(F.lit("vtc_cols").alias("category"), F.lit("quality").alias("column")),
                        F.struct(toxic_cat.alias("category"), F.lit("toxic").alias("column")))).alias("e")) \
            .select("dataset", "set_name", "e.category", "e.column")


def shop_sidecars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of the shop corpus with a sidecar: every return flag but 'N'; 'R' is automated."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("set_name"))
    s = li.filter(F.col("set_name") != "N").distinct()
    return s.withColumn("method", F.when(F.col("set_name") == "R", "automated").otherwise("manual"))


def ev_category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long category index of the event corpus: every event set maps
    ``speaker_type`` to vtc and keeps ``k`` as 'other'."""
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("set_name")).distinct()
    return ev.select(F.lit("events").alias("dataset"), "set_name", F.explode(F.array(
        F.struct(F.lit("vtc_cols").alias("category"), F.lit("speaker_type").alias("column")),
        F.struct(F.lit("other").alias("category"), F.lit("k").alias("column")))).alias("e")) \
        .select("dataset", "set_name", "e.category", "e.column")
