"""Links to components: a numpy union-find for one task, star contraction for the whole."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolake.session import cut_lineage


class Forest:
    """Union-find over 0..n-1 that takes links in bulk; the root is the smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        p = self.parent
        while len(i):
            a, b = p[i], p[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(p, np.maximum(a, b), np.minimum(a, b))
            while True:
                q = p[p]
                if np.array_equal(q, p):
                    break
                p[:] = q

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """One link from each member to its root."""
        n = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return n, self.parent[n]


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` (u, v) -> (node, root): each node that is not itself the smallest of its
    component, with that smallest node.

    Alternating large-star and small-star steps: every step points nodes at the
    smallest neighbour, so the number of rounds is logarithmic. A step is a
    map-side combined minimum by node and an equi-join back, which adaptive
    execution splits when one node has very many links. Each round is written to
    the shared folder; the driver only sees a count and a checksum.
    """
    cur = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    cur = cut_lineage(cur, "links")
    mark = None
    for _ in range(rounds):
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        both = cur.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
                          .alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        cur = cut_lineage(small, "links")
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
