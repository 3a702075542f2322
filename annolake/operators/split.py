"""Seeded, weighted, stratified and entity-exclusive train/test/validate splits.

Fractions are integers per mille summing to 1000 (no float drift: 0.7+0.2+0.1
is exactly 1000). Order is the md5 of ``seed:key`` with the key as tie-break,
so the split does not depend on partitioning and equals the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.functions.columns import shuffle_key
from annolake.operators.scan import running_agg

SPLITS = ("train", "test", "validate")


def per_mille(fractions: Sequence[float | int]) -> tuple[int, ...]:
    """Check fractions and turn them into integers per mille summing to 1000.

    Integers summing to 1000 are taken as per mille; otherwise each value is a
    fraction in [0, 1] (0.7 + 0.2 + 0.1 is accepted: no float sum is compared).
    """
    if len(fractions) != len(SPLITS):
        raise ValueError(f"need {len(SPLITS)} fractions")
    if all(isinstance(f, int) for f in fractions) and sum(fractions) == 1000:
        pm = tuple(int(f) for f in fractions)
    else:
        if any(not 0 <= f <= 1 for f in fractions):
            raise ValueError("fractions must lie in [0, 1]")
        pm = tuple(int(round(f * 1000)) for f in fractions)
    if any(p < 0 for p in pm) or sum(pm) != 1000:
        raise ValueError("train, test, validate fractions must add up to 1")
    return pm


def _case_split(cum_x1000, tot, pm) -> F.Column:
    """First split whose cumulative bound holds; the last split takes the rest."""
    expr = F.lit(SPLITS[-1])
    for i in reversed(range(len(pm) - 1)):
        expr = F.when(cum_x1000 <= tot * F.lit(sum(pm[:i + 1])), F.lit(SPLITS[i])).otherwise(expr)
    return expr


HEX_DIGITS = 2     # 256 buckets a stratum: the answer does not depend on it
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _weight(df: DataFrame, weight: str) -> F.Column:
    """Weight column, null -> 0; integral weights are longs, others decimals, so that sums are exact in any order."""
    t = dict(df.dtypes)[weight]
    kind = "long" if t in _INTEGRAL else "decimal(24,6)"
    return F.coalesce(F.col(weight).cast(kind), F.lit(0).cast(kind))


def weighted_split(df: DataFrame, key: str, weight: str, fractions=(800, 100, 100),
                   by: Sequence[str] = ("dataset",), seed: int = 0, hex_digits: int | None = HEX_DIGITS,
                   out: str = "split") -> DataFrame:
    """Shuffled running sum of ``weight`` against the stratum total.

    A row is train while ``cum * 1000 <= total * train``, then test up to
    ``train + test``; the last split takes the rest. With ``hex_digits`` the
    running sum is two-level: the md5 order is cut into 16**hex_digits buckets
    per stratum, so a stratum holding a third of all rows is still scanned by
    many tasks (see ``scan.running_agg``); the stratum total is computed from the
    chunk sums. ``hex_digits=None`` is the plain window.
    """
    pm = per_mille(fractions)
    by = list(by)
    d = df.withColumn("_sk", shuffle_key(seed, key)).withColumn("_w", _weight(df, weight))
    chunk = F.substring("_sk", 1, hex_digits) if hex_digits else None
    # the stratum total comes with the carry (from the chunk rows), so rows are
    # never joined or shuffled on the bare stratum key
    d = running_agg(d, by, ["_sk", key], "_w", "_cum", "sum", chunk_of=chunk, total_out="_tot")
    d = d.withColumn(out, _case_split(F.col("_cum") * F.lit(1000), F.col("_tot"), pm))
    return d.drop("_sk", "_w", "_cum", "_tot")


HEADS = 1000       # an entity of more than total / HEADS is placed greedily: fewer than HEADS entities can be that heavy


def _place_heads(pm: tuple[int, ...]):
    """For each shard: its heavy entities in shuffled order, each to the split with the largest gap, and
    the bounds that the running weight of the others is cut at.

    What the others weigh levels the gaps from the largest down, as the greedy would with
    infinitely small entities: split i gets ``max(gap_i - level, 0)``, where the level makes these add up.
    Everything is scaled by 6000 (per mille, and the level may be a half or a third), so it stays exact.
    """
    from decimal import Decimal

    import pandas as pd

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        heads = pdf[pdf["_entity"].notna()].sort_values(["_sk", "_entity"], kind="mergesort")
        tot = sum(pdf.loc[pdf["_entity"].isna(), "_w"].tolist(), 0)
        weights = heads["_w"].tolist()
        gaps = [tot * p for p in pm]
        picks = []
        for w in weights:   # exact: ints, or decimals for weights with a fraction
            best = max(range(len(pm)), key=lambda i: (gaps[i], -i))
            gaps[best] -= 1000 * w
            picks.append(SPLITS[best])
        rest, down = 1000 * (tot - sum(weights, 0)), sorted(gaps, reverse=True)
        for m in range(1, len(pm) + 1):
            level6 = 6 // m * (sum(down[:m]) - rest)
            if m == len(pm) or level6 >= 6 * down[m]:
                break
        quota = [max(6 * g - level6, 0) for g in gaps]
        bounds = [Decimal(int(q) if q == int(q) else q) for q in (quota[0], quota[0] + quota[1])]
        n = len(picks)
        return pd.DataFrame({"_shard": [pdf["_shard"].iloc[0]] * (n + 1), "_entity": [*heads["_entity"], None], "_split": [*picks, None],
                             "_b1": [None] * n + bounds[:1], "_b2": [None] * n + bounds[1:]})

    return place


def entity_split(df: DataFrame, entity: str | Sequence[str], weight: str, fractions=(800, 100, 100),
                 seed: int = 0, shards: int = 1, out: str = "split", salt: int = 32, heads: int = HEADS) -> DataFrame:
    """T4: entity-exclusive split (one split per entity; rows with a null entity are one entity, D18).

    Rows are first aggregated to one (entity, weight) row per entity (partial
    aggregation, so a hot entity costs nothing extra). Entities of more than total / ``heads``, of which
    there are fewer than ``heads``, are the head: in md5 order each goes to the split with the largest
    gap to its target. The tail, however long, levels the gaps that are left: its running weight in
    md5 order is cut at the resulting bounds, which is parallel. Where all entities are
    heavy this is the sequential greedy; ``heads`` decides how long it is followed.

    How near it comes: the gaps add up to what is still to be placed, so an entity of weight w meets a gap of w / 3 at
    least and no split passes its target by more than 2 / 3 of the heaviest entity. With W the heaviest, two
    splits together pass theirs by 4 / 3 W at most, which is the most that the third can lack; and each cut of the tail is
    missed by less than one entity of the tail, total / ``heads`` at most. The greedy itself is
    bound by the same first two terms.

    With ``shards`` (a fixed number) the rule is applied inside that many md5 shards, each aiming at its own
    share of the targets. The assignment goes back to the rows through a salted join: a row's salt
    is a hash of its own values (stable under retries), every entity's
    assignment is repeated once per salt, so an entity holding a third of all
    rows is joined by ``salt`` tasks.
    """
    pm = per_mille(fractions)
    ents = [entity] if isinstance(entity, str) else list(entity)
    ent_col = F.concat_ws("\u0001", *[F.coalesce(F.col(e).cast("string"), F.lit("\u0000")) for e in ents]) \
        if len(ents) > 1 else F.coalesce(F.col(ents[0]).cast("string"), F.lit("\u0000"))
    # shard = first 32 bits of md5(entity) mod shards: stable, uniform, and the same in any SQL engine
    shard = F.conv(F.substring(F.md5("_entity"), 1, 8), 16, 10).cast("long") % F.lit(shards) if shards > 1 else F.lit(0).cast("long")
    per_entity = (df.groupBy(*ents)
                    .agg(F.sum(_weight(df, weight)).alias("_w"))
                    .withColumn("_entity", ent_col)
                    .withColumn("_sk", shuffle_key(seed, *ents))
                    .select(shard.alias("_shard"), "_entity", "_sk", "_w"))
    kind = dict(per_entity.dtypes)["_w"]
    total = per_entity.groupBy("_shard").agg(F.sum("_w").cast(kind).alias("_tot"), F.sum(F.abs("_w")).alias("_size"))
    sized = per_entity.join(F.broadcast(total), "_shard")          # one row for each shard
    heavy = F.abs("_w").cast("decimal(38,6)") * heads > F.col("_size").cast("decimal(38,6)")
    none = F.lit(None).cast("string")
    placed = (sized.where(heavy).select("_shard", "_entity", "_sk", "_w")
              .unionByName(total.select("_shard", none.alias("_entity"), none.alias("_sk"), F.col("_tot").alias("_w")))
              .groupBy("_shard")
              .applyInPandas(_place_heads(pm), schema="_shard long, _entity string, _split string, _b1 decimal(38,6), _b2 decimal(38,6)"))
    tail = running_agg(sized.where(~heavy).select("_shard", "_entity", "_sk", "_w"), ["_shard"], ["_sk", "_entity"], "_w", "_cum", "sum",
                       chunk_of=F.substring("_sk", 1, HEX_DIGITS))
    at = F.col("_cum").cast("decimal(32,6)") * F.lit(6000)
    cut = (F.when(at <= F.col("_b1"), F.lit(SPLITS[0])).when(at <= F.col("_b2"), F.lit(SPLITS[1])).otherwise(F.lit(SPLITS[2])))
    bounds = placed.where("_entity is null").select("_shard", "_b1", "_b2")
    assigned = (placed.where("_entity is not null").select("_entity", "_split")
                .unionByName(tail.join(F.broadcast(bounds), "_shard").select("_entity", cut.alias("_split"))))
    rows = df.withColumn("_entity", ent_col)
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salt)).cast("int"))
    assigned = assigned.select("_entity", "_split", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_salt"))
    joined = rows.join(assigned, ["_entity", "_salt"], "left").drop("_salt")
    return joined.withColumnRenamed("_split", out).drop("_entity")


def check_exclusive(df: DataFrame, entity: str | Sequence[str], split: str = "split") -> DataFrame:
    """T5: entities found in more than one split (empty = exclusive)."""
    ents = [entity] if isinstance(entity, str) else list(entity)
    return (df.groupBy(*ents).agg(F.countDistinct(split).alias("n_splits"),
                                  F.array_sort(F.collect_set(split)).alias("splits"))
              .filter(F.col("n_splits") > 1))


def split_report(df: DataFrame, weight: str, fractions=(800, 100, 100), split: str = "split",
                 by: Sequence[str] = ()) -> DataFrame:
    """A10: desired and reached weight per split (and per stratum when ``by``)."""
    pm = per_mille(fractions)
    by = list(by)
    w = _weight(df, weight)
    reached = df.groupBy(*by, split).agg(F.sum(w).alias("reached_weight"))
    total = df.groupBy(*by).agg(F.sum(w).alias("_tot"))
    # one row per (stratum, split) from the fixed split list: an explode, not a join
    grid = total.select(*by, "_tot", F.explode(F.array(*[
        F.struct(F.lit(n).alias(split), F.lit(p).alias("_pm")) for n, p in zip(SPLITS, pm)])).alias("_g")) \
        .select(*by, "_tot", F.col(f"_g.{split}").alias(split), F.col("_g._pm").alias("_pm"))
    rep = grid.join(reached, by + [split], "left")
    return rep.select(*by, split,
                      (F.col("_tot").cast("double") * F.col("_pm") / 1000.0).alias("desired_weight"),
                      F.coalesce(F.col("reached_weight"), F.lit(0).cast(dict(total.dtypes)["_tot"]))
                      .alias("reached_weight"))


def finalize_split(df: DataFrame, path_col: str = "full recording path",
                   drop: Sequence[str] = ("age (months)",), suffix: str = ".wav",
                   derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Drop the age, de-duplicate, point the recording path at the .wav file.

    ``derive`` adds columns that follow from the others (the paths) after the
    de-duplication, whose shuffle then carries narrow rows.
    """
    from annolake.functions.columns import with_suffix

    d = df.drop(*[c for c in drop if c in df.columns]).dropDuplicates()
    if derive is not None:
        d = derive(d)
    if path_col in d.columns:
        d = d.withColumn(path_col, with_suffix(F.col(f"`{path_col}`"), suffix))
    return d
