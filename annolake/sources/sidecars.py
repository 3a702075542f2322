"""S3: per-set sidecar files (flat ``key: value`` YAML) -> one row per set.

Layout: ``<root>/<dataset>/annotations/<set...>/<SIDECAR_FILE>`` (a set name may
contain '/'). Files are read whole by Spark (one row per file, many files per
task), split into lines and folded into a ``MAP<STRING,STRING>`` with
``map_from_entries``; typed columns come from that map with ``try_cast`` and
enum tests, so an invalid sidecar is kept (raw map) with nulls in the bad fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sidecar fields, their kind and allowed values.
SIDECAR_FIELDS: list[tuple[str, str, tuple[str, ...]]] = [
    ("segmentation", "str", ()),
    ("segmentation_type", "enum", ("permissive", "restrictive")),
    ("method", "enum", ("automated", "manual", "mixed", "derivation", "citizen-scientists")),
    ("sampling_method", "enum", ("none", "manual", "periodic", "random", "high-volubility", "high-energy")),
    ("sampling_target", "enum", ("chi", "fem", "mal", "och")),
    ("sampling_count", "int", ()),
    ("sampling_unit_duration", "int", ()),
    ("recording_selection", "str", ()),
    ("participant_selection", "str", ()),
    ("annotator_name", "str", ()),
    ("annotator_experience", "enum", ("1", "2", "3", "4", "5")),
    ("annotation_algorithm_name", "enum", ("VTC", "ALICE", "VCM", "ITS")),
    ("annotation_algorithm_publication", "str", ()),
    ("annotation_algorithm_version", "str", ()),
    ("annotation_algorithm_repo", "str", ()),
    ("date_annotation", "date", ()),
    ("has_speaker_type", "yn", ("Y", "N")),
    ("has_transcription", "yn", ("Y", "N")),
    ("has_interactions", "yn", ("Y", "N")),
    ("has_acoustics", "yn", ("Y", "N")),
    ("has_addressee", "yn", ("Y", "N")),
    ("has_vcm_type", "yn", ("Y", "N")),
    ("has_words", "yn", ("Y", "N")),
    ("notes", "str", ()),
]
# Fixed value: file name of a set's sidecar.
SIDECAR_FILE = "metannots.yml"
# Category -> sidecar flag.
CATEGORY_FLAG = {
    "addressee": "has_addressee",
    "transcription": "has_transcription",
    "vcm": "has_vcm_type",
    "vtc": "has_speaker_type",
}

_YAML_NULL = ("", "~", "null", "Null", "NULL")


def _typed(raw: Column, name: str, kind: str, allowed: tuple[str, ...]) -> Column:
    v = raw[name]
    if kind == "int":
        return v.try_cast("long")
    if kind == "date":
        return v.try_cast("date")
    if kind in ("enum", "yn"):
        return F.when(v.isin(*allowed), v)
    return v


def typed_sidecars(raw: DataFrame, keys=("dataset", "set_name"), map_col: str = "raw") -> DataFrame:
    """Typed sidecar columns from the raw map (invalid values become null)."""
    m = F.col(map_col)
    return raw.select(*keys, *[_typed(m, n, k, a).alias(n) for n, k, a in SIDECAR_FIELDS], map_col)


def parse_sidecar_text(text: Column) -> Column:
    """``key: value`` lines -> MAP<STRING,STRING>; comments, blanks and YAML nulls dropped."""
    lines = F.split(text, r"\r?\n")
    kv = F.filter(
        F.transform(lines, lambda ln: F.struct(
            F.trim(F.regexp_extract(ln, r"^\s*([^#:\s][^:]*?)\s*:", 1)).alias("k"),
            F.regexp_replace(F.trim(F.regexp_extract(ln, r"^[^:]*:\s*(.*?)(\s+#.*)?\s*$", 1)),
                             r"^(['\"])(.*)\1$", "$2").alias("v"))),
        lambda e: (e["k"] != "") & ~e["v"].isin(*_YAML_NULL))
    # a key given twice has its last value
    last = F.filter(kv, lambda e, i: ~F.exists(F.slice(kv, i + 2, F.size(kv)), lambda x: x["k"] == e["k"]))
    return F.map_from_entries(last)


def scan_sidecars(spark: SparkSession, root: str, file_name: str = SIDECAR_FILE) -> DataFrame:
    """S3: read every sidecar under ``root``; dataset and set come from the path."""
    df = (spark.read.option("recursiveFileLookup", "true")
          .option("pathGlobFilter", file_name).text(root, wholetext=True)
          .select(F.col("value"), F.col("_metadata.file_path").alias("path")))
    rx = rf"/([^/]+)/annotations/(.+)/{file_name.replace('.', '[.]')}$"
    raw = df.select(
        F.regexp_extract("path", rx, 1).alias("dataset"),
        F.regexp_extract("path", rx, 2).alias("set_name"),
        parse_sidecar_text(F.col("value")).alias("raw"))
    return typed_sidecars(raw)
