"""Operator 11, exact top-k inner products by pivot-table elimination.

Equal vectors are one class that keeps its k + 1 smallest ids, so a vector that fills a
third of the table is one row. A few hundred sampled vectors give the pivots, farthest first;
each class gets its distances to all of them (the pivot table). With
<q, c> = (|q|^2 + |c|^2 - |q - c|^2) / 2 and |q - c| >= max over pivots of |d(q, p) - d(c, p)|,
the table gives an upper bound of each inner product.

The classes are sorted over the cluster by nearest pivot and distance to it and cut into
shards of bounded size. A shard first searches for the queries that lie in it, which sets each query's bar:
the score that k + 1 classes reach. Then groups of queries, with the box that
holds their distances, go to the shards whose box can reach the group's lowest bar (heads meet in a
fragment-and-replicate grid, bodies follow for the pairs left). Inside, blocks of a shard are bounded by their boxes, the rows
left by their own pivot distances, and rows are evaluated in the order of their bounds until the next bound is
below the bar. Scores are whole numbers, and what is not evaluated cannot reach the bar: the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annolake.llm.common import text_batches
from annolake.session import cut_lineage

SCALE = 256
PIVOTS = 32
PIVOT_SAMPLE = 2048      # vectors that pivots are chosen from; they only steer the search
SHARD_ROWS = 16384
SHARD_BYTES = 8 << 20
BLOCK_ROWS = 256         # rows of a shard that share a box
GROUP_QUERIES = 512
STEP = 256               # rows evaluated between two looks at the bar
UNIT_GROUPS = 64         # query groups that one copy of a shard serves
EXACT = 1 << 52          # squared lengths below this are exact in double precision throughout


def whole_numbers(vectors: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, dim, vec): floor(scale * component) as little-endian 64-bit. Vectors that are null, hold null or non-finite
    components, or whose squared length does not fit in a long (so scores need not either), are left out."""
    def run(batches):
        for b in batches:
            ids, col = b.column(0), b.column(1)
            keep, dims, raw = [], [], []
            for k, v in enumerate(col):
                if not v.is_valid:
                    continue
                x = v.values
                if x.null_count:
                    continue
                x = np.asarray(x.to_numpy(zero_copy_only=False), float)
                with np.errstate(over="ignore"):
                    x = np.floor(scale * x)
                    if not np.isfinite(x).all() or float(x @ x) >= 2.0 ** 62:
                        continue
                keep.append(k)
                dims.append(len(x))
                raw.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(keep, pa.int64())), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                                             names=["vec_id", "dim", "vec"])

    v = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    text_batches(v.sparkSession)
    return v.mapInArrow(run, "vec_id bigint, dim int, vec binary")


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of whole-number rows to the pivots and, last, to the origin."""
    y = x.astype(float)
    if len(pivots) and max(int(squares(x).max(initial=0)), int(squares(pivots).max())) < EXACT // 4:
        p = pivots.astype(float)
        d = squares(y)[:, None] + squares(p)[None, :] - 2 * (y @ p.T)
        out = np.sqrt(np.maximum(d, 0.0))
    else:
        out = np.stack([np.sqrt(squares(y - p)) for p in pivots.astype(float)], axis=1) if len(pivots) else np.zeros((len(x), 0))
    return np.concatenate([out, np.sqrt(squares(y))[:, None]], axis=1)


def choose_pivots(classes: DataFrame, pivots: int, sample: int) -> tuple[int, np.ndarray]:
    """The commonest length of vectors and pivots of that length: from ``sample`` classes (those of smallest hash), each the
    farthest from those before."""
    row = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if row is None:
        return 0, np.zeros((0, 0), np.int64)
    some = classes.where(F.col("dim") == row["dim"]).orderBy(F.xxhash64("vec"), "vec").limit(sample).select("vec").collect()
    x = np.array([np.frombuffer(r["vec"], "<i8") for r in some])
    y, out = x.astype(float), []
    near = np.sqrt(squares(y - y.mean(axis=0)))
    for _ in range(min(pivots, len(x))):
        k = int(near.argmax())
        if out and near[k] == 0:
            break
        d = np.sqrt(squares(y - y[k]))
        near = np.minimum(near, d) if out else d
        out.append(x[k])
    return row["dim"], np.array(out)


def narrow(x: np.ndarray) -> bytes:
    """The smallest of three whole-number widths that holds ``x``."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def wide(raw: bytes, rows: int, dim: int) -> np.ndarray:
    if not rows * dim:
        return np.zeros((rows, dim), np.int64)
    return np.frombuffer(raw, f"<i{len(raw) // (rows * dim)}").reshape(rows, dim).astype(np.int64)


class Bars:
    """The best classes of each query so far, by score, then smallest id (null last)."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.best: list[list[tuple]] = [[] for _ in range(n)]

    def bar(self, q: int) -> int | None:
        return -self.best[q][-1][0] if len(self.best[q]) >= self.k else None

    def add(self, q: int, score: np.ndarray, low: np.ndarray, null: np.ndarray, cid: np.ndarray) -> None:
        have = self.bar(q)
        if have is not None:
            at = np.flatnonzero(score >= have)
            score, low, null, cid = score[at], low[at], null[at], cid[at]
        if len(score) > self.k:
            at = np.lexsort((low, null, -score))[:self.k]
            score, low, null, cid = score[at], low[at], null[at], cid[at]
        self.best[q] = sorted([*self.best[q], *zip((-score).tolist(), null.tolist(), low.tolist(), cid.tolist())])[:self.k]


class Shard:
    """Classes with their pivot distances, searched for one query at a time."""

    def __init__(self, cid, low, null, x, dist):
        self.cid, self.low, self.null, self.x, self.dist = cid, low, null, x, dist
        self.norm = squares(x)
        self.exact = int(self.norm.max(initial=0)) < EXACT
        self.y = x.astype(float) if self.exact else x
        cuts = np.arange(0, len(x), BLOCK_ROWS)
        self.lo, self.hi = np.minimum.reduceat(dist, cuts), np.maximum.reduceat(dist, cuts)
        self.most = np.maximum.reduceat(self.norm, cuts)
        self.cuts = np.append(cuts, len(x))
        self.evaluated = 0

    def search(self, x: np.ndarray, dist: np.ndarray, bars: Bars, q: int, floor: int | None) -> None:
        """Add to ``bars`` the classes that can be among the best of query ``q``; ``floor``: a score already reached by enough."""
        norm, small = float(x @ x), int(x @ x) < EXACT

        def bound(gap, norms):
            return (norm + norms - gap * gap) / 2 + slack(norm, norms)

        gap = np.maximum(np.maximum(self.lo - dist, dist - self.hi), 0).max(axis=1)
        top = bound(gap, self.most)
        blocks = np.arange(len(top)) if floor is None else np.flatnonzero(top >= floor)
        if not len(blocks):
            return
        rows = np.concatenate([np.arange(self.cuts[b], self.cuts[b + 1]) for b in blocks])
        top = bound(np.abs(self.dist[rows] - dist).max(axis=1), self.norm[rows])
        order = np.argsort(-top, kind="stable")
        rows, top = rows[order], top[order]
        y = x.astype(float) if self.exact and small else x
        for s in range(0, len(rows), STEP):
            have = bars.bar(q)
            bar = max((b for b in (have, floor) if b is not None), default=None)
            if bar is not None and top[s] < bar:
                return                      # no later row can reach the bar
            at = rows[s:s + STEP]
            self.evaluated += len(at)
            score = ((self.y if self.exact and small else self.x)[at] @ y).astype(np.int64)
            if floor is not None:
                ok = score >= floor
                at, score = at[ok], score[ok]
            if len(at):
                bars.add(q, score, self.low[at], self.null[at], self.cid[at])


def slack(norm, norms):
    """Room for the rounding of single-precision distances and of the bound itself."""
    return 1 + 1e-6 * (norm + norms)


HEAD = "lo array<float>, hi array<float>, norm double"
_BODY = ["cids", "lows", "nulls", "vecs", "dist"]
BODY = ", ".join(f"{c} binary" for c in _BODY)


def _body(cid, low, null, x, dist):
    return [cid.astype("<i8").tobytes(), low.astype("<i8").tobytes(), null.astype("i1").tobytes(), narrow(x), dist.astype("<f4").tobytes()]


def _unpack(r: dict):
    cid, low, null = np.frombuffer(r["cids"], "<i8"), np.frombuffer(r["lows"], "<i8"), np.frombuffer(r["nulls"], "i1")
    return cid, low, null, wide(r["vecs"], len(cid), r["dim"]), np.frombuffer(r["dist"], "<f4").reshape(len(cid), -1)


def shards_of(classes: DataFrame, dim: int, pivots: np.ndarray, most: int) -> DataFrame:
    """(shard, dim, head, body, asked): ``classes`` (cid, dim, vec, low, asked) with their pivot distances, near ones together."""
    none = np.zeros((0, 0), np.int64)

    def place(batches):
        for b in batches:
            dims, raw = b.column(1).to_numpy(), b.column(2).to_pylist()
            near, far = np.zeros(len(raw), np.int32), np.zeros(len(raw))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.stack([np.frombuffer(raw[k], "<i8") for k in at])
                dist = distances(x, pivots if d == dim else none)
                near[at] = dist.argmin(axis=1)
                far[at] = dist.min(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(far)], names=[*b.schema.names, "near", "far"])

    c = classes.select("cid", "dim", "vec", "low", "asked")
    text_batches(c.sparkSession)
    placed = c.mapInArrow(place, "cid bigint, dim int, vec binary, low bigint, asked boolean, near int, far double")
    order = ["dim", "near", "far", "cid"]
    placed = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches):
        from pyspark import TaskContext

        shard, now, key, room = TaskContext.get().partitionId() << 32, [], None, 0

        def out():
            x = np.stack([np.frombuffer(r["vec"], "<i8") for r in now])
            dist = distances(x, pivots if key == dim else none).astype("f4")
            null = np.array([r["low"] is None for r in now])
            low = np.array([0 if r["low"] is None else r["low"] for r in now], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([key], pa.int32()), *_head(dist, squares(x)),
                 *[pa.array([v], pa.binary()) for v in _body(np.array([r["cid"] for r in now], np.int64), low, null, x, dist)],
                 pa.array([np.flatnonzero([r["asked"] for r in now]).astype("<i4").tobytes()], pa.binary())],
                names=["shard", "dim", "lo", "hi", "norm", *_BODY, "asked"])

        for b in batches:
            for r in b.to_pylist():
                if now and (r["dim"] != key or len(now) >= room):
                    yield out()
                    shard, now = shard + 1, []
                key = r["dim"]
                room = max(1, min(most, SHARD_BYTES // (8 * max(1, key))))
                now.append(r)
        if now:
            yield out()

    return placed.mapInArrow(cut, f"shard bigint, dim int, {HEAD}, {BODY}, asked binary")


def _head(dist, norm):
    return [pa.array([dist.min(axis=0).tolist()], pa.list_(pa.float32())), pa.array([dist.max(axis=0).tolist()], pa.list_(pa.float32())),
            pa.array([float(norm.max())], pa.float64())]


HITS = "hits array<struct<query:bigint,score:bigint,low:bigint,cid:bigint>>"
_HIT = pa.list_(pa.struct([(n, pa.int64()) for n in ("query", "score", "low", "cid")]))


def _hits(cids: np.ndarray, bars: Bars) -> pa.Array:
    return pa.array([[{"query": q, "score": -s, "low": None if null else low, "cid": c}
                      for q, best in zip(cids.tolist(), bars.best) for s, null, low, c in best]], _HIT)


def own_search(shards: DataFrame, k: int, group: int) -> DataFrame:
    """The queries of each shard searched in the shard itself: one row for each group of them, with the box, the body, the score
    that each has reached (``floor``; ``bar``: the lowest of them, null where a query has none) and the hits."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                asked = np.frombuffer(r["asked"], "<i4")
                if not len(asked):
                    continue
                cid, low, null, x, dist = _unpack(r)
                shard = Shard(cid, low, null, x, dist)
                for s in range(0, len(asked), group):
                    at = asked[s:s + group]
                    bars = Bars(len(at), k)
                    for q, row in enumerate(at):
                        shard.search(x[row], dist[row], bars, q, None)
                    floor = [bars.bar(q) for q in range(len(at))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["shard"]]), pa.array([s // group], pa.int32()), pa.array([r["dim"]], pa.int32()), *_head(dist[at], shard.norm[at]),
                         *[pa.array([v], pa.binary()) for v in _body(cid[at], low[at], null[at], x[at], dist[at])],
                         pa.array([floor], pa.list_(pa.int64())), pa.array([None if None in floor else min(floor)], pa.int64()), _hits(cid[at], bars)],
                        names=["home", "part", "dim", "lo", "hi", "norm", *_BODY, "floor", "bar", "hits"])

    return shards.mapInArrow(run, f"home bigint, part int, dim int, {HEAD}, {BODY}, floor array<bigint>, bar bigint, {HITS}")


def meetings(groups: DataFrame, shards: DataFrame, grid: int) -> DataFrame:
    """(home, part, shard): the groups and shards, other than their own, whose boxes do not rule out a score at the group's bar."""
    cells = F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
    q = groups.select("home", "part", "dim", F.col("lo").alias("qlo"), F.col("hi").alias("qhi"), F.col("norm").alias("qnorm"), "bar",
                      F.pmod(F.xxhash64("home", "part"), F.lit(grid)).cast("int").alias("r"), cells.alias("c"))
    s = shards.select("shard", "dim", "lo", "hi", "norm", F.pmod(F.xxhash64("shard"), F.lit(grid)).cast("int").alias("c"), cells.alias("r"))
    gap = ("greatest(0d, array_max(zip_with(lo, qhi, (x, y) -> double(x) - y)), array_max(zip_with(qlo, hi, (x, y) -> double(x) - y)))")
    bound = f"(qnorm + norm - {gap} * {gap}) / 2 + 1 + 1e-6 * (qnorm + norm)"
    return q.join(s, ["dim", "r", "c"]).where(f"home <> shard and (bar is null or {bound} >= bar)").select("home", "part", "shard")


def other_search(shards: DataFrame, groups: DataFrame, pairs: DataFrame, copies: int, k: int) -> DataFrame:
    """(hits): each group of queries searched in each shard that it meets. A shard comes first in its key's rows and is held,
    its groups stream past; a shard that many groups need is copied, ``UNIT_GROUPS`` groups to a copy."""
    pairs = pairs.withColumn("copy", F.pmod(F.xxhash64("home", "part"), F.lit(copies)).cast("int"))
    held = shards.join(pairs.select("shard", "copy").distinct(), "shard").select(
        "shard", "copy", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("home"), F.lit(0).alias("part"), "dim", *_BODY,
        F.lit(None).cast("array<bigint>").alias("floor"))
    come = groups.join(pairs, ["home", "part"]).select("shard", "copy", F.lit(1).alias("kind"), "home", "part", "dim", *_BODY, "floor")
    rows = held.unionByName(come).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind", "home", "part")

    def run(batches):
        shard = None
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                if r["kind"] == 0:
                    shard = Shard(*_unpack(r))
                    continue
                cid, _, _, x, dist = _unpack(r)
                bars = Bars(len(cid), k)
                for q in range(len(cid)):
                    shard.search(x[q], dist[q], bars, q, r["floor"][q])
                yield pa.RecordBatch.from_arrays([_hits(cid, bars)], names=["hits"])

    text_batches(rows.sparkSession)
    return rows.mapInArrow(run, HITS)


def top_k(vectors: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", queries: str = "vec_id % 50 = 0",
          scale: int = SCALE, pivots: int = PIVOTS, shard_rows: int = SHARD_ROWS, group: int = GROUP_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that fulfils ``queries`` (a condition on vec_id) the ``k`` other rows of the
    highest inner product of floor(``scale`` * component), all if there are fewer; rank from 1, ties by smaller vec_id (null last).

    Vectors that are null or hold null or non-finite components take no part; nor do those whose squared length exceeds a long, as
    their scores would too. Vectors of different length have no inner product and are not compared. A row is never its
    own candidate, a repeated row is one of its copies'; repeated query rows are repeated. Rows with a null id are candidates only.
    Empty table: empty result; other columns are not read. ``pivots``, ``shard_rows`` and ``group`` change the work, never the result.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(whole_numbers(vectors, vec_id, vector, scale).withColumn("asked", F.coalesce(F.expr(queries), F.lit(False))), "whole_vectors")
    first = Window.partitionBy("dim", "vec", "asked").orderBy(F.col("vec_id").asc_nulls_last())
    few = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    ids = F.transform(F.slice(F.array_sort(F.collect_list(F.struct(F.col("vec_id").isNull().alias("n"), "vec_id"))), 1, k + 1), lambda e: e["vec_id"])
    classes = cut_lineage(few.groupBy("dim", "vec").agg(F.max("asked").alias("asked"), ids.alias("ids"))
                          .withColumn("low", F.get("ids", 0)).withColumn("cid", F.monotonically_increasing_id()), "vector_classes")
    dim, chosen = choose_pivots(classes, pivots, PIVOT_SAMPLE)
    shards = cut_lineage(shards_of(classes, dim, chosen, shard_rows), "pivot_table")
    groups = cut_lineage(own_search(shards, k + 1, group), "query_groups")
    grid = max(4, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    copies = max(1, math.ceil(groups.count() / UNIT_GROUPS))
    pairs = cut_lineage(meetings(groups, shards, grid), "meetings")
    found = groups.select("hits").unionByName(other_search(shards, groups, pairs, copies, k + 1)).select(F.inline("hits"))
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.col("low").asc_nulls_last(), "cid")
    found = found.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= k + 1)
    named = found.select("query", "score", "cid").join(classes.select("cid", "ids"), "cid")
    each = F.expr("transform(ids, i -> named_struct('neg', -score, 'n', i is null, 'vec_id', i, 'cid', cid))")
    best = named.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list(each))), 1, k + 1).alias("best"))
    asked = (rows.where("asked").join(classes.select("dim", "vec", "cid"), ["dim", "vec"]).select(F.col("vec_id").alias("query_id"), "cid")
             .join(best.withColumnRenamed("query", "cid"), "cid"))
    own = "array_position(transform(best, e -> e.cid = cid and e.vec_id = query_id), true)"
    rest = F.expr(f"case when {own} > 0 then concat(slice(best, 1, int({own} - 1)), slice(best, int({own} + 1), {k + 1})) else best end")
    return (asked.withColumn("rest", F.slice(rest, 1, k)).select("query_id", F.posexplode("rest").alias("pos", "e"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.neg")).alias("score")))
