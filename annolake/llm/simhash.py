"""Operator 3, SimHash near-duplicates by a binary trie self-join.

Distinct fingerprints are kept in two orders, as they are and with their halves
swapped. Two fingerprints at most ``max_bits`` apart differ in at most half of
that in one half, so a trie over the first order needs that smaller budget for
its first 32 levels and the second order takes the other case. Each order is
sorted over the cluster and cut into trie nodes ("leaves") of at most
``leaf_rows`` fingerprints. Leaf pairs whose prefixes are within the budget are
found with an equi-join on the prefixes reachable by flipping bits; a task walks
the two sub-tries of one leaf pair together, node pair by node pair, adds up
differing bits and drops a pair beyond the budget. Links leave a task as a
spanning forest, never as all pairs of a group.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import fresh, small_batches, text_columns, with_text_columns
from annolake.llm.forest import Forest, connected_components
from annolake.session import cut_lineage

SHINGLE = 4
MAX_BITS = 4
LEAF_ROWS = 4096
LEVELS = tuple(range(0, 33, 2))   # depths at which the trie may be cut into leaves
SEED = 42
BRUTE = 64                        # node pairs of at most so many row pairs are compared outright


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a text; no words: 0."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()   # bytes: lower-cases A-Z, splits at \x20 and \x09-\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *[e + 1 for e in ends[:-shingle]]]
    ones, total = np.zeros(64, np.int64), len(starts)
    for k in range(0, total, 1 << 16):
        cuts = [joined[a:b] for a, b in zip(starts[k:k + (1 << 16)], ends[shingle - 1 + k:shingle - 1 + k + (1 << 16)])]
        h = np.fromiter(map(xxh64_intdigest, cuts, repeat(SEED)), np.uint64, len(cuts))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def _maker(shingle: int):
    def make():
        def f(texts):
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            return [pa.array(fps.view(np.int64), pa.int64())]
        return f
    return make


def trie_links(a: np.ndarray, b: np.ndarray, same: bool, depth: int, err: int, first: int, max_bits: int):
    """Index pairs (i, j) with at most ``max_bits`` differing bits, by walking two sorted
    uint64 arrays as sub-tries of ``depth`` common levels that already differ in ``err`` bits.
    ``first`` is the budget of the top 32 levels. ``same``: one array, pairs i < j."""
    a0, a1 = np.array([0]), np.array([len(a)])
    b0, b1 = np.array([0]), np.array([len(b)])
    e = np.array([err])
    done: list[tuple[np.ndarray, ...]] = []
    for bit in range(63 - depth, -2, -1):
        few = (a1 - a0) * (b1 - b0) <= (BRUTE if bit >= 0 else 1 << 62)
        if few.any():
            done.append((a0[few], a1[few], b0[few], b1[few]))
            rest = ~few
            a0, a1, b0, b1, e = a0[rest], a1[rest], b0[rest], b1[rest], e[rest]
        if not len(a0):
            break
        one = np.uint64(1 << bit)
        high = np.uint64((0xFFFFFFFFFFFFFFFF << (bit + 1)) & 0xFFFFFFFFFFFFFFFF)
        am = np.clip(np.searchsorted(a, (a[a0] & high) | one), a0, a1)
        bm = np.clip(np.searchsorted(b, (b[b0] & high) | one), b0, b1)
        n0 = (np.concatenate([a0, am, a0, am]), np.concatenate([am, a1, am, a1]),
              np.concatenate([b0, bm, bm, b0]), np.concatenate([bm, b1, b1, bm]), np.concatenate([e, e, e + 1, e + 1]))
        ok = (n0[1] > n0[0]) & (n0[3] > n0[2]) & (n0[4] <= (first if 63 - bit < 32 else max_bits))
        if same:
            ok &= n0[0] <= n0[2]
        a0, a1, b0, b1, e = (x[ok] for x in n0)
    if not done:
        return
    a0, a1, b0, b1 = (np.concatenate(x) for x in zip(*done))
    size = (a1 - a0) * (b1 - b0)
    upto = np.cumsum(size)
    k = 0
    while k < len(size):
        stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + (1 << 20), side="right")))
        n = size[k:stop]
        at = np.repeat(np.arange(k, stop), n)
        off = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        w = (b1 - b0)[at]
        i, j = a0[at] + off // w, b0[at] + off % w
        ok = np.bitwise_count(a[i] ^ b[j]) <= max_bits
        if same:
            ok &= i < j
        yield i[ok], j[ok]
        k = stop


def _swap(k: np.ndarray) -> np.ndarray:
    return (k << np.uint64(32)) | (k >> np.uint64(32))


def _leaves(fps: DataFrame, least: int, leaf_rows: int) -> DataFrame:
    """(o, depth, prefix, piece, rows, keys): trie nodes of both orders, each at most
    ``leaf_rows`` sorted keys and at least ``least`` levels deep."""
    swapped = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    rows = fps.select(F.explode(F.array(F.struct(F.lit(0).alias("o"), F.col("fp").alias("k")),
                                        F.struct(F.lit(1).alias("o"), swapped.alias("k")))).alias("r")).select("r.*")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # signed order of the key with its top bit flipped is unsigned order
    rows = rows.withColumn("k", F.col("k").bitwiseXOR(F.lit(-(1 << 63))))
    rows = rows.repartitionByRange(parts, "o", "k").sortWithinPartitions("o", "k")

    def cut(batches):
        from pyspark import TaskContext

        got = [(b.column("o").to_numpy(zero_copy_only=False), b.column("k").to_numpy(zero_copy_only=False)) for b in batches]
        if not got:
            return
        o_all = np.concatenate([x for x, _ in got])
        k_all = np.concatenate([x for _, x in got]).astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        piece = TaskContext.get().partitionId() << 32
        for o in (0, 1):
            keys = k_all[o_all == o]
            todo = [(0, len(keys), 0)]
            out = []
            while todo:
                lo, hi, level = todo.pop()
                if hi == lo:
                    continue
                depth = LEVELS[level]
                if (hi - lo <= leaf_rows and depth >= least) or level == len(LEVELS) - 1:
                    for s in range(lo, hi, leaf_rows):
                        k = keys[s:min(hi, s + leaf_rows)]
                        prefix = int(k[0]) >> (64 - depth)
                        out.append((o, depth, prefix, piece, len(k), k.tobytes()))
                        piece += 1
                    continue
                below = keys[lo:hi] >> np.uint64(64 - LEVELS[level + 1])
                ends = [*(np.flatnonzero(below[1:] != below[:-1]) + 1 + lo), hi]
                todo += [(s, e, level + 1) for s, e in zip([lo, *ends[:-1]], ends)]
            for s in range(0, len(out), 256):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*out[s:s + 256]), (pa.int32(), pa.int32(), pa.int64(),
                                                                               pa.int64(), pa.int64(), pa.binary()))],
                    names=["o", "depth", "prefix", "piece", "rows", "keys"])

    return rows.mapInArrow(cut, "o int, depth int, prefix bigint, piece bigint, rows bigint, keys binary")


def _leaf_pairs(heads: DataFrame, depths: list[int], first: tuple[int, int]) -> DataFrame:
    """(o, pa, pb, err, depth): pieces whose prefixes differ in at most the budget over their common depth."""
    wide = T.StructType.fromDDL("o int, depth int, prefix bigint, piece bigint, err int, at int, q bigint")

    def near(frames):
        flips = {(level, n): [sum(1 << x for x in c) for c in combinations(range(level), n)]
                 for level in depths for n in range(max(first) + 1)}
        for f in frames:
            rows = []
            for r in f.itertuples(index=False):
                for level in depths:
                    if level <= r.depth:
                        base = r.prefix >> (r.depth - level)
                        rows += [(r.o, r.depth, r.prefix, r.piece, n, level, base ^ m)
                                 for n in range(first[r.o] + 1) for m in flips[level, n]]
            yield pd.DataFrame(rows, columns=wide.names)

    small_batches(heads.sparkSession)
    cand = heads.mapInPandas(near, wide)
    other = heads.select(F.col("o").alias("o2"), F.col("depth").alias("at2"), F.col("prefix").alias("q2"),
                         F.col("piece").alias("pb"))
    j = cand.join(other, (F.col("o") == F.col("o2")) & (F.col("at") == F.col("at2")) & (F.col("q") == F.col("q2")))
    j = j.where((F.col("at") < F.col("depth")) | (F.col("piece") <= F.col("pb")))
    return j.select("o", F.col("piece").alias("pa"), "pb", "err", F.col("at").alias("depth"))


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Distinct ``fp`` bigint -> links (u, v) that span each task's near pairs."""
    spark = fps.sparkSession
    n = fps.count()
    least = min([d for d in LEVELS if leaf_rows << d >= 2 * n] or [LEVELS[-1]])
    small_batches(spark)
    leaves = cut_lineage(_leaves(fps, least, leaf_rows), "trie_leaves")
    heads = leaves.drop("keys", "rows")
    depths = sorted(r[0] for r in heads.select("depth").distinct().collect())   # at most len(LEVELS) values
    first = (max_bits // 2, (max_bits - 1) // 2)
    pairs = _leaf_pairs(heads, depths, first)
    body = leaves.select("piece", "keys")
    work = (pairs.join(body.select(F.col("piece").alias("pa"), F.col("keys").alias("ka")), "pa")
            .join(body.select(F.col("piece").alias("pb"), F.col("keys").alias("kb")), "pb")
            .select("o", "pa", "pb", "err", "depth", "ka", "kb"))

    def walk(batches):
        for batch in batches:
            us, vs = [], []
            for r in batch.to_pylist():
                a, b = np.frombuffer(r["ka"], np.uint64), np.frombuffer(r["kb"], np.uint64)
                same = r["pa"] == r["pb"]
                keys = a if same else np.concatenate([a, b])
                shift = 0 if same else len(a)
                forest = Forest(len(keys))
                for i, j in trie_links(a, b, same, r["depth"], r["err"], first[r["o"]], max_bits):
                    forest.link(i, j + shift)
                i, j = forest.edges()
                if len(i):
                    u, v = keys[i], keys[j]
                    us.append(_swap(u) if r["o"] else u)
                    vs.append(_swap(v) if r["o"] else v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"])

    return work.mapInArrow(walk, "u bigint, v bigint")


def _classes(narrow: DataFrame, max_bits: int) -> DataFrame:
    """(doc_id, fp) -> (fp, root, component_id); root: the smallest fingerprint of the component."""
    fps = cut_lineage(narrow.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprints")
    roots = connected_components(near_links(fps.select("fp"), max_bits))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return named.join(lows, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Texts of up
    to ``shingle`` words are one shingle. Repeated rows are repeated in the result. A
    component whose rows all have a null id has a null ``component_id``; otherwise
    null ids count for nothing. Empty table: empty result. Other columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    narrow = cut_lineage(text_columns(d, "text", [("fp", T.LongType())], _maker(shingle)), "simhash")
    return narrow.join(_classes(narrow, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when one row of each component stays: the one of the
    smallest id. A component without ids keeps one row too. Where ids repeat, the row
    is told by id and fingerprint, and one of the rows that agree in both stays."""
    mark, = fresh(docs, "_fp")
    spark = docs.sparkSession
    narrow = cut_lineage(text_columns(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text",
                                      [("fp", T.LongType())], _maker(shingle)), "simhash")
    classes = narrow.join(_classes(narrow, max_bits), "fp")
    # the row of the smallest id (nulls only where there is no id), then the smallest fingerprint
    keep = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("component_id").alias("doc_id"), F.min("fp").alias("fp"))
    many = narrow.groupBy("doc_id").agg((F.count("*") > 1).alias("many"))
    keep = cut_lineage(keep.join(many.withColumnRenamed("doc_id", "_d"), F.col("doc_id").eqNullSafe(F.col("_d")))
                       .select("doc_id", "fp", "many"), "simhash_kept")
    single = keep.where("not many").select(F.col("doc_id").alias("_k")).hint("shuffle_merge")
    out = docs.join(single, docs[doc_id].eqNullSafe(F.col("_k")), "left_semi")
    repeated = keep.where("many")
    if repeated.isEmpty():
        return out
    ids = repeated.select(F.col("doc_id").alias("_k")).distinct()
    rows = with_text_columns(docs.join(ids, docs[doc_id].eqNullSafe(F.col("_k")), "left_semi"), text,
                             [(mark, T.LongType())], _maker(shingle))
    rows = rows.join(repeated.select(F.col("doc_id").alias("_k"), F.col("fp").alias("_kf")),
                     rows[doc_id].eqNullSafe(F.col("_k")) & (rows[mark] == F.col("_kf")), "left_semi")
    return out.unionByName(rows.dropDuplicates([doc_id, mark]).drop(mark))
