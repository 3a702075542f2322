"""The flows from a folder of corpora to their written results, each as one call.

``build_corpus``: E1, a benchmark corpus of one label category. ``profile_root``: E3, the profiles and the
validation report. Both read ``<root>/<dataset>/...`` (S1-S3) and the category index (S5).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from annolake.plans.create_dataset import Corpus, create_dataset, write_corpus
from annolake.plans.profiling import profile_corpora, write_validation
from annolake.session import cut_lineage, temporary_tables
from annolake.sources.index import scan_index, scan_segments, segments_long
from annolake.sources.profiles import scan_category_index, write_profiles
from annolake.sources.sidecars import scan_sidecars


@dataclass
class Root:
    corpus: Corpus
    labels: DataFrame       # long label map (dataset, set_name, annotation_filename, onset, offset_ms, label, value)
    sidecars: DataFrame


def read_root(spark: SparkSession, root: str, datasets: Sequence[str] | None = None) -> Root:
    """The index tables, segments and sidecars of the corpora under ``root``."""
    children, recordings, annotations = (scan_index(spark, root, t, datasets) for t in ("children", "recordings", "annotations"))
    labels = segments_long(scan_segments(spark, root, datasets=datasets)).withColumnsRenamed(
        {"set": "set_name", "segment_onset": "onset", "segment_offset": "offset_ms"})
    sidecars = scan_sidecars(spark, root)
    if datasets:
        sidecars = sidecars.where(sidecars["dataset"].isin(list(datasets)))
    return Root(Corpus(children, recordings, annotations), labels, sidecars)


def read_corpus(spark: SparkSession, path: str) -> Corpus:
    """A corpus written by ``build_corpus``."""
    return Corpus(*(spark.read.parquet(f"{path.rstrip('/')}/metadata/{t}") for t in ("children", "recordings", "annotations")))


def build_corpus(spark: SparkSession, root: str, index: str, category: str, out: str, datasets: Sequence[str] | None = None,
                 children_expr: str | None = None, on_error: str = "raise", pad_ms: int = 0, existing: str | None = None) -> dict[str, str]:
    """E1 from files to files: select, curate, cut, and write the corpus and its manifests under ``out``; returns their
    folders. Intermediate tables are deleted.

    ``existing``: the folder of an earlier result; its sets and recordings stay unless this
    call builds them anew (U1 / U2). It must not be ``out``.
    """
    if existing and existing.rstrip("/") == out.rstrip("/"):
        raise ValueError("a corpus cannot be read and overwritten in one step: give another folder")
    with temporary_tables(spark):
        r = read_root(spark, root, datasets)
        long, _ = scan_category_index(spark, index)
        res = create_dataset(r.corpus, r.labels, long, category, pad_ms, read_corpus(spark, existing) if existing else None,
                             datasets_root=root, sidecars=r.sidecars, children_expr=children_expr, on_error=on_error)
        return write_corpus(res, out, fmt="parquet")


def profile_root(spark: SparkSession, root: str, index: str, out: str, datasets: Sequence[str] | None = None) -> dict[str, int]:
    """E3 from files to files: one profile JSON per corpus under ``out/profiles``, the violations of its index and sidecars under
    ``out/violations`` and the sidecars concerned under ``out/quarantine``. Returns the number of violations of each check (none:
    everything fits)."""
    with temporary_tables(spark):
        r = read_root(spark, root, datasets)
        profile = cut_lineage(profile_corpora(r.labels, r.corpus.annotations.withColumnRenamed("set", "set_name"), r.sidecars), "profile")
        write_profiles(profile, f"{out.rstrip('/')}/profiles")
        long, nested = scan_category_index(spark, index)
        return write_validation(long, nested, profile, r.sidecars.select("dataset", "set_name", "raw"), out)
