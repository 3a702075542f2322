"""Incremental corpus merge: append, replace by key, copy manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import after_marker, lit_path


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate per-corpus frames with differing columns (missing -> null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def merge_append(existing: DataFrame, new: DataFrame, stamp: str | None = None) -> DataFrame:
    """U1 + U3: union by name and drop whole-row duplicates; optional
    ``experiment`` stamp (P12) applied after the union, as the source tool does."""
    out = existing.unionByName(new, allowMissingColumns=True)
    if stamp is not None:
        out = out.withColumn("experiment", F.lit(stamp))
    return out.distinct()


def merge_replace(existing: DataFrame, new: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Drop existing rows whose key occurs in the new batch (a null key
    matches a null key), then U1. The new batch's distinct keys are small next
    to the corpus; AQE broadcasts them when they measure small."""
    keys = [key] if isinstance(key, str) else list(key)
    nk = new.select(*[F.col(k).alias(f"_nk_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        c = existing[k].eqNullSafe(nk[f"_nk_{k}"])
        cond = c if cond is None else cond & c
    kept = existing.join(nk, cond, "left_anti")
    return merge_append(new, kept)


def copy_manifest(file_infos: DataFrame, out_root: str, corpus: str = "dataset",
                  items: Sequence[tuple[str, Column, str, Sequence[str]]] = (),
                  existing: DataFrame | None = None) -> DataFrame:
    """U4: distinct (kind, source, target) copies; targets already present are skipped.

    ``items`` lists (kind, source path column, marker directory, target middle
    parts): the target is ``out_root/<middle..>/<corpus>/<path after marker>`` (P4).
    ``existing`` is a listing whose first column holds present target paths.
    """
    # every row yields all its (kind, source, target) pairs: one scan, one explode
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("kind"), src.alias("source"),
                 lit_path(out_root, *middle, F.col(corpus), after_marker(src, marker)).alias("target"))
        for kind, src, marker, middle in items])
    man = file_infos.select(F.explode(pairs).alias("p")).select("p.kind", "p.source", "p.target").distinct()
    if existing is not None:
        man = man.join(existing.select(F.col(existing.columns[0]).alias("target")), "target", "left_anti")
    return man
