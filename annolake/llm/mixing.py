"""Operator 9, mixing sources to target weights by entropy balancing.

Targets: sources in code point order weigh 5, 2, 1 in turn and share ``budget``
times all words; a target above ``limit`` times its source's words stops there and
the excess is shared again by weight.

Rates: among all document rates in [0, limit] whose words meet the targets, those
nearest to 1 in relative entropy are min(limit, exp(lambda * size / mean size)),
one lambda a source. The lambdas maximise a concave dual; each Newton step sums
words, gradient and curvature by source over (source, size) counts as one
distributed job, kept inside a bracket so that it cannot diverge.

Copies: rates are rounded by error feedback from the largest document to the
smallest within shards of a source, so a shard's words miss its expectation by about
half its smallest document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import fresh, word_count
from annolake.session import cut_lineage

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
LIMIT = 2
SHARD_ROWS = 2000     # rows a rounding shard holds on average
ROUNDS = 60
TOLERANCE = 1e-10


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, limit: float = LIMIT) -> DataFrame:
    """(source, n, source_size, target) of (source, size) rows; one row a source, null is a source."""
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # rank over the cluster: sorted partitions, and the numbers of rows of the partitions before
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranked = cut_lineage(per.withColumn("last", F.col("source").isNull())
                         .repartitionByRange(parts, "last", "source").sortWithinPartitions("last", "source")
                         .withColumn("at", F.monotonically_increasing_id()), "sources")
    part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    before, upto = {}, 0
    for r in ranked.groupBy(part.alias("p")).count().orderBy("p").collect():     # one row a partition
        before[r["p"]], upto = upto, upto + r["count"]
    if not before:
        return ranked.select("source", "n", "source_size", F.lit(0.0).alias("target"))
    offset = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in before.items() for x in kv]), part.cast("bigint"))
    rank = (offset + row) % len(weights)
    per = ranked.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int")))
    cap = F.col("source_size") * float(limit)
    total = float(per.agg(F.sum("source_size")).first()[0] or 0) * budget
    # level: what one unit of weight gets from what the capped sources leave
    level, capped = 0.0, -1
    while True:
        full = F.col("w") * level >= cap if capped >= 0 else F.lit(False)
        r = per.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("w"))),
                    F.sum(full.cast("int"))).first()
        if r[2] == capped or not r[1]:
            break
        capped = r[2]
        level = (total - r[0]) / r[1]
    return per.select("source", "n", "source_size", F.least(F.col("w") * level, cap).alias("target"))


def tilts(sizes: DataFrame, targets: DataFrame, limit: float = LIMIT, rounds: int = ROUNDS) -> DataFrame:
    """(source, lam, mean): the dual solution. ``lam`` is null where every rate is ``limit`` (the
    target takes all that may be taken)."""
    hist = cut_lineage(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("m")), "size_counts")
    state = targets.select(
        F.col("source").alias("s"), "target", (F.col("source_size") / F.col("n")).alias("mean"),
        F.lit(0.0).alias("lam"), F.lit(-64.0).alias("lo"), F.lit(64.0).alias("hi"),
        ((F.col("target") >= F.col("source_size") * float(limit)) | (F.col("source_size") == 0)).alias("full"))
    state = cut_lineage(state, "tilts")
    x = F.col("size") / F.col("mean")
    free = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
    rate = F.least(F.lit(float(limit)), free)
    words = F.col("size") * F.col("m")
    for _ in range(rounds):
        sums = (hist.join(state.where("not full").select("s", "lam", "mean"), F.col("source").eqNullSafe(F.col("s")))
                .groupBy("s").agg(F.sum(words * rate).alias("g"),
                                  F.sum(F.when(free < limit, words * x * free).otherwise(0.0)).alias("h"))
                .withColumnRenamed("s", "s2"))
        nxt = state.join(sums, F.col("s").eqNullSafe(F.col("s2")), "left")
        over = F.col("g") > F.col("target")
        lo = F.when(over, F.col("lo")).otherwise(F.col("lam"))
        hi = F.when(over, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") + (F.col("target") - F.col("g")) / F.col("h")
        inside = (F.col("h") > 0) & (newton > lo) & (newton < hi)
        miss = F.abs(F.col("g") - F.col("target")) / F.col("target")
        settled = F.col("full") | (miss < TOLERANCE)
        state = cut_lineage(nxt.select(
            "s", "target", "mean", F.when(settled, F.col("lam")).when(inside, newton).otherwise((lo + hi) / 2).alias("lam"),
            F.when(settled, F.col("lo")).otherwise(lo).alias("lo"), F.when(settled, F.col("hi")).otherwise(hi).alias("hi"),
            "full", settled.alias("settled")), "tilts")
        if state.where("not settled and hi - lo > 1e-13").isEmpty():
            break
        state = state.drop("settled")
    return state.select(F.col("s").alias("source"), F.when(~F.col("full"), F.col("lam")).alias("lam"), "mean")


def _round(pdf: pd.DataFrame) -> pd.DataFrame:
    """Copies of one shard: largest first, each takes the whole number of copies nearest to
    what its own rate and the words missed so far ask for."""
    pdf = pdf.sort_values(["size", "u", "key", "tie", "row"], ascending=[False, True, True, True, True], kind="stable")
    size, want = pdf["size"].to_numpy(), pdf["rate"].to_numpy() * pdf["size"].to_numpy()
    copies, missed = np.zeros(len(pdf), np.int64), 0.0
    for k in range(len(pdf)):
        if size[k]:
            missed += want[k]
            copies[k] = min(LIMIT, max(0, int(np.floor(missed / size[k] + 0.5))))
            missed -= copies[k] * size[k]
    return pdf.assign(copies=copies)[["source", "key", "row", "size", "copies"]]


def _copies(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, limit: int = LIMIT) -> DataFrame:
    """(key, row, size, source_size, target, copies) of (key, source, size, tie, row): ``key``, ``size`` and ``tie``
    say how a row is rounded; ``row`` is passed on."""
    if limit != LIMIT:
        raise ValueError(f"rounding holds for a limit of {LIMIT}")
    per = cut_lineage(source_targets(sized, weights, budget, limit), "mix_targets")
    lam = tilts(sized, per, limit)
    info = per.join(lam.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), "n", "source_size", "target", "lam", "mean")
    info = cut_lineage(info, "mix_rates")
    shard = F.pmod(F.xxhash64("key", "size", "tie"), F.greatest(F.lit(1), F.ceil(F.col("n") / SHARD_ROWS)))
    rated = sized.join(info, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "key", "size", "tie", "row", shard.alias("shard"), F.xxhash64("key").alias("u"),
        F.when(F.col("lam").isNull(), float(limit)).otherwise(
            F.least(F.lit(float(limit)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(700.0))))).alias("rate"))
    kind = sized.schema["key"].dataType.simpleString()
    source_kind = sized.schema["source"].dataType.simpleString()
    got = rated.groupBy("source", "shard").applyInPandas(
        _round, f"source {source_kind}, key {kind}, row bigint, size bigint, copies bigint")
    return got.join(info, F.col("source").eqNullSafe(F.col("s"))).select(
        "key", "row", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, budget: float = BUDGET, limit: int = LIMIT) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row for each row of ``docs``.

    ``taken`` is copies (0 to ``limit``) times size. Null and empty texts have size 0 and are not
    taken. A null source is the last source. Repeated rows are documents of their own: how many
    of them are taken is fixed, which of the equal rows is not. A null id is an id like others.
    Empty table: empty result. Other columns are not read. The order of rounding is by size
    and a hash of the id, so reruns agree.
    """
    none = F.lit(None).cast("bigint")      # hashes of columns pass over nulls
    sized = cut_lineage(docs.select(F.col(doc_id).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"),
                                    none.alias("tie"), none.alias("row")), "mix_sizes")
    return _copies(sized, weights, budget, limit).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (0 to LIMIT times); rows without words are not taken.

    Every row is a document of its own, whatever its id: ``docs`` is written once with a number for
    each row, and the copies are joined back on it. Ids and texts, not these numbers, order the
    rounding, so reruns agree but for which of several equal rows is taken.
    """
    row, copies = fresh(docs, "_row", "_copies")
    kept = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()), "mix_rows")
    sized = cut_lineage(kept.select(F.col(doc_id).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"),
                                    F.xxhash64(text).alias("tie"), F.col(row).alias("row")), "mix_sizes")
    taken = _copies(sized).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(copies))
    return (kept.join(taken, row).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
            .select(*docs.columns))
