"""Operator 4, near-duplicate embeddings by PCA-ordered tiled comparison.

Equal vectors of a label are one representative with a count. The unit vectors are
turned into the basis of their second-moment matrix (an orthonormal change, so
cosines stay), sorted over the cluster by label and leading coordinate and cut into
tiles. A pair of tiles of a label is compared when their leading coordinates can be
near enough; inside, the product over the leading dimensions plus the product of
the remaining (suffix) norms bounds the cosine, pairs that cannot reach the
threshold stop there, and the rest adds the next dimensions. What remains is
decided by the cosine of the original vectors in double precision.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.llm.common import small_batches
from annolake.llm.forest import Forest, connected_components
from annolake.session import cut_lineage

THRESHOLD = 0.98
TILE = 2048
STRIP = 512      # rows of a tile compared at once
LEAD = 16        # dimensions added at a time
SLACK = 1e-9     # bounds are widened by this; the decision itself is exact


def unit(v: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled first so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def basis(reps: DataFrame) -> tuple[int, np.ndarray]:
    """The commonest vector length and its PCA basis, leading direction first. Each task sends
    one matrix of length x length. Vectors of other lengths keep their own order of dimensions."""
    row = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if row is None:
        return 0, np.zeros((0, 0))
    d = row["dim"]

    def sums(batches):
        total = np.zeros((d, d))
        for b in batches:
            v = np.array(b.column(0).flatten(), float).reshape(-1, d)
            u = unit(v)
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    got = reps.where(F.col("dim") == d).select("embedding").mapInArrow(sums, "m binary").collect()
    total = sum((np.frombuffer(r["m"]).reshape(d, d) for r in got), np.zeros((d, d)))
    w, v = np.linalg.eigh(total)
    return d, np.ascontiguousarray(v[:, np.argsort(-w, kind="stable")])


def _tiles(reps: DataFrame, d: int, turn: np.ndarray, tile: int) -> DataFrame:
    """(label, dim, tile, lo, hi, ids, m, vecs): runs of at most ``tile`` representatives of one label
    and length in the order of the leading coordinate."""
    lead = turn[:, :1] if d else turn

    def place(batches):
        for b in batches:
            dims = b.column(b.schema.get_field_index("dim")).to_pylist()
            vecs = b.column(b.schema.get_field_index("embedding")).to_pylist()
            first = [float((unit(np.array([v], float)) @ lead)[0, 0]) if k == d else v[0] / math.sqrt(sum(x * x for x in v) or 1.0)
                     for k, v in zip(dims, vecs)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first, pa.float64())], names=[*b.schema.names, "x"])

    n = reps.count()
    rows = reps.mapInArrow(place, reps.selectExpr("*", "0D x").schema)
    rows = rows.repartitionByRange(max(1, math.ceil(n / tile)), "label", "dim", "x").sortWithinPartitions("label", "dim", "x")

    def cut(batches):
        from pyspark import TaskContext

        piece, now, key = TaskContext.get().partitionId() << 32, [], None

        def out():
            v = np.array([r["embedding"] for r in now], float)
            return pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (key[0], key[1], piece, now[0]["x"], now[-1]["x"])]
                + [pa.array([x.tobytes()], pa.binary()) for x in (
                    np.array([r["rid"] for r in now], np.int64), np.array([r["m"] for r in now], np.int64),
                    v.astype("f4") if (v == v.astype("f4")).all() else v)],
                names=["label", "dim", "tile", "lo", "hi", "ids", "m", "vecs"])

        for b in batches:
            for r in b.to_pylist():
                k = (r["label"], r["dim"])
                if now and (k != key or len(now) >= tile):
                    yield out()
                    piece, now = piece + 1, []
                key = k
                now.append(r)
        if now:
            yield out()

    return rows.mapInArrow(cut, "label bigint, dim bigint, tile bigint, lo double, hi double, ids binary, m binary, vecs binary")


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool, turn: np.ndarray | None, threshold: float):
    """Index pairs (i, j) of rows of ``a`` and ``b`` with cosine >= ``threshold``; ``same``: i < j."""
    ua = unit(a)
    ub = ua if same else unit(b)
    ra, rb = (ua, ub) if turn is None else (ua @ turn, ub @ turn)
    d = ra.shape[1]
    stops = [*range(LEAD, d, LEAD), d]

    def suffix(r):
        return [np.sqrt(np.maximum(0.0, np.einsum("ij,ij->i", r[:, s:], r[:, s:]))) for s in stops]

    sa, sb = suffix(ra), suffix(rb)
    for s in range(0, len(ra), STRIP):
        part = ra[s:s + STRIP, :stops[0]] @ rb[:, :stops[0]].T
        i, j = np.nonzero(part + np.outer(sa[0][s:s + STRIP], sb[0]) >= threshold - SLACK)
        got = part[i, j]
        i = i + s
        if same:
            ok = i < j
            i, j, got = i[ok], j[ok], got[ok]
        for c in range(0, len(i), 1 << 18):
            ci, cj, cg = i[c:c + (1 << 18)], j[c:c + (1 << 18)], got[c:c + (1 << 18)]
            for k in range(1, len(stops)):
                cg = cg + np.einsum("ij,ij->i", ra[ci, stops[k - 1]:stops[k]], rb[cj, stops[k - 1]:stops[k]])
                ok = cg + sa[k][ci] * sb[k][cj] >= threshold - SLACK
                ci, cj, cg = ci[ok], cj[ok], cg[ok]
            if len(ci):
                ok = np.einsum("ij,ij->i", ua[ci], ub[cj]) >= threshold
                yield ci[ok], cj[ok]


def embedding_components(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                         threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors without a label, link with nothing: 0 links, a component of their own.
    Vectors of different length never link. Equal vectors of a label link with each
    other, repeated rows too. Ids may repeat; a component whose ids are all null has a null id.
    ``kept``: the id is the component's (null is null's). Empty table: empty result. Other columns are not read.
    """
    v = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding"), F.col(label).cast("bigint").alias("label"))
    v = v.withColumn("fit", F.col("label").isNotNull() & (F.size("embedding") > 0)
                     & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                     & F.exists("embedding", lambda x: x != 0))
    v = v.withColumn("fit", F.coalesce("fit", F.lit(False)))
    small_batches(v.sparkSession)
    fit = v.where("fit")
    reps = cut_lineage(fit.groupBy("label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("m"))
                       .withColumn("dim", F.size("embedding").cast("bigint"))
                       .withColumn("rid", F.monotonically_increasing_id()), "vector_reps")
    member = fit.join(reps.select(F.col("label").alias("l2"), F.col("embedding").alias("e2"), "rid", "m"),
                      (F.col("label") == F.col("l2")) & (F.col("embedding") == F.col("e2"))).select("vec_id", "rid", "m")
    d, turn = basis(reps)
    tiles = cut_lineage(_tiles(reps.select("rid", "label", "dim", "m", "embedding"), d, turn, tile), "vector_tiles")
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    a, b = tiles.select("label", "dim", F.col("tile").alias("ta"), F.col("lo").alias("la"), F.col("hi").alias("ha")), \
        tiles.select("label", "dim", F.col("tile").alias("tb"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
    pairs = a.join(b, ["label", "dim"]).where(
        (F.col("ta") <= F.col("tb")) & (F.col("lb") - F.col("ha") <= reach) & (F.col("la") - F.col("hb") <= reach))
    body = ["ids", "m", "vecs"]
    work = (pairs.select("ta", "tb", "dim")
            .join(tiles.select(F.col("tile").alias("ta"), *[F.col(c).alias(c + "_a") for c in body]), "ta")
            .join(tiles.select(F.col("tile").alias("tb"), *[F.col(c).alias(c + "_b") for c in body]), "tb"))

    def compare(batches):
        def matrix(raw, rows, dim):
            return np.frombuffer(raw, "f4" if len(raw) == 4 * rows * dim else "f8").reshape(rows, dim).astype(float)

        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                same = r["ta"] == r["tb"]
                ids, m = np.frombuffer(r["ids_a"], np.int64), np.frombuffer(r["m_a"], np.int64)
                x = matrix(r["vecs_a"], len(ids), r["dim"])
                y, shift = x, 0
                if not same:
                    more = np.frombuffer(r["ids_b"], np.int64)
                    y, shift = matrix(r["vecs_b"], len(more), r["dim"]), len(ids)
                    ids, m = np.concatenate([ids, more]), np.concatenate([m, np.frombuffer(r["m_b"], np.int64)])
                forest, links = Forest(len(ids)), np.zeros(len(ids), np.int64)
                for i, j in near_pairs(x, y, same, turn if r["dim"] == d else None, threshold):
                    j = j + shift
                    forest.link(i, j)
                    links += np.bincount(i, m[j], len(ids)).astype(np.int64) + np.bincount(j, m[i], len(ids)).astype(np.int64)
                at = np.flatnonzero(links)
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[at], links[at], ids[forest.parent[at]])],
                                                     names=["node", "n", "root"])

    found = cut_lineage(work.mapInArrow(compare, "node bigint, n bigint, root bigint"), "vector_links")
    linked = found.groupBy("node").agg(F.sum("n").alias("n")).withColumnRenamed("node", "rid")
    roots = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    named = (reps.select("rid", "low").join(linked, "rid", "left")
             .join(roots.withColumnRenamed("node", "rid"), "rid", "left").withColumn("root", F.coalesce("root", "rid")))
    named = cut_lineage(named, "vector_classes")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    info = named.join(lows, "root").select("rid", "n", "component_id")
    out = member.join(info, "rid").select("vec_id", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    alone = v.where("not fit").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
