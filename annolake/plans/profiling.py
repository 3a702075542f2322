"""Profile -> nested JSON -> category tables -> validation report.

gold sets (F3) -> segments long label map (S2) -> label profile + sampled
durations (A1-A4) -> profile JSON per corpus (S7); then the category summary
(A5), the corpora table (A6, J4) and all validation checks (V1-V7) as one
violations table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from annolake.operators import checks as K
from annolake.operators import profile as A
from annolake.operators.curate import gold_sets
from annolake.sources.sinks import write_table


def profile_corpora(labels: DataFrame, files: DataFrame, sidecars: DataFrame) -> DataFrame:
    gold = gold_sets(sidecars)
    return A.build_profile(labels, files, gold)


def validation_report(index_long: DataFrame, index_nested: DataFrame, profile: DataFrame,
                      sidecars_raw: DataFrame) -> DataFrame:
    """All checks in one table (dataset, set_name, check, detail); empty = good. Each input is read once."""
    return K.apply_rules(K.set_facts(index_long, index_nested, profile, sidecars_raw))


def write_validation(index_long: DataFrame, index_nested: DataFrame, profile: DataFrame, sidecars_raw: DataFrame,
                     out: str) -> dict[str, int]:
    """Write the violations under ``out/violations`` and the sidecars of the sets that have any under ``out/quarantine``.
    Returns the number of violations of each check, counted while they are written."""
    report = validation_report(index_long, index_nested, profile, sidecars_raw)
    seen = Observation("violations")
    report = report.observe(seen, *[F.count_if(F.col("check") == name).alias(name) for name, _ in K.rules()])
    path = write_table(report, f"{out.rstrip('/')}/violations")
    bad = sidecars_raw.sparkSession.read.parquet(path).select("dataset", "set_name").distinct()
    write_table(sidecars_raw.join(bad, ["dataset", "set_name"], "left_semi"), f"{out.rstrip('/')}/quarantine")
    return {k: v for k, v in seen.get.items() if v}
