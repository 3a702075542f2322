"""Train / test / validate split of a curated corpus.

split input (J3) -> weighted split per corpus or per set (T1-T3) -> optional
entity-exclusive reassignment (T4) -> exclusivity check (T5, only when asked)
-> final shape (T7) -> report (A10).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.operators import split as T


@dataclass
class SplitResult:
    rows: DataFrame
    report: DataFrame
    offenders: DataFrame | None


def make_splits(split_input: DataFrame, key: str, weight: str = "duration_ms", fractions=(800, 100, 100),
                stratify_set: bool = False, same_child: bool = False, seed: int = 0,
                entity: tuple[str, ...] = ("child_id", "dataset"), path_col: str = "recording_path",
                drop: tuple[str, ...] = ("age_months",),
                derive: Callable[[DataFrame], DataFrame] | None = None) -> SplitResult:
    by = ["dataset", "set_name"] if stratify_set else ["dataset"]
    offenders = None
    if same_child:
        # the entity-exclusive assignment replaces the row-level split entirely,
        # so the row-level running sum is not computed at all
        rows = T.entity_split(split_input, list(entity), weight, fractions, seed=seed)
        offenders = T.check_exclusive(rows, list(entity))
    else:
        rows = T.weighted_split(split_input, key, weight, fractions, by=by, seed=seed)
    final = T.finalize_split(rows, path_col=path_col, drop=drop, derive=derive)
    report = T.split_report(rows, weight, fractions)
    return SplitResult(final, report, offenders)


def assert_exclusive(res: SplitResult) -> None:
    """Fail when an entity sits in two splits (only meaningful with ``same_child``)."""
    if res.offenders is not None and res.offenders.limit(1).count():
        raise AssertionError("an entity is in more than one split")


def split_curated(corpus, labels: DataFrame, index_long: DataFrame, category: str, key: str,
                  fractions=(800, 100, 100), stratify_set: bool = False, same_child: bool = False, seed: int = 0,
                  file_key=("dataset", "set", "annotation_filename"), sidecars: DataFrame | None = None,
                  children_expr: str | None = None) -> SplitResult:
    """E1 selection and curation (manual sets, discarded rows, category) followed by E2."""
    from annolake.operators.curate import file_split_input, with_file_paths
    from annolake.plans.create_dataset import curate, select_files

    cur = curate(select_files(corpus, sidecars, children_expr), labels, index_long, category, file_key)
    si = file_split_input(cur.annotations, cur.recordings, cur.children, paths=False).withColumnRenamed("set", "set_name")
    res = make_splits(si, key, "duration_ms", fractions, stratify_set=stratify_set, same_child=same_child,
                      seed=seed, path_col="recording_path", derive=lambda d: with_file_paths(d, "set_name"))
    res.rows = res.rows.withColumnRenamed("set_name", "set")
    return res
