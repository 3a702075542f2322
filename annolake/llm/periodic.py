"""Operator 13, periodic runs of words by recursive frequency splitting.

A run is a stretch of words with smallest period q and a length of at least
max(24, 3 q) that no neighbouring word extends. Each of its words occurs three
times in it at least, so a word that occurs less often in a segment lies in no
run there and splits it; what is left is counted again until nothing changes.
The smaller parts of a split are counted anew, the largest by subtraction, and
only words whose count fell are looked at again: n log n steps in all.

The segments that survive are scanned for lags. For each width W = 1, 2, 4, ...
the next place of the same W words gives each position its lag, and a stretch of
positions of one lag q with W / 2 < q <= W is a run of period q: in a run, the W
words at a position recur after q words and not before, since W >= q and the
period is the smallest, and three periods leave room for W + q words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import text_batches, text_columns

LEAST = 24      # words of a run at least
TIMES = 3       # periods of a run at least

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def segments(words: list, least: int = LEAST, times: int = TIMES):
    """[lo, hi) of the stretches of ``words`` in which every word occurs ``times`` times or more; every run lies in one."""
    where = None
    todo = [(0, len(words), Counter(words), None)] if len(words) >= least else []
    while todo:
        lo, hi, seen, fell = todo.pop()
        if fell is None:
            rare = {w for w, c in seen.items() if c < times}
            cuts = [i for i in range(lo, hi) if words[i] in rare] if rare else []
        else:
            rare = {w for w in fell if 0 < seen[w] < times}
            if rare and where is None:
                where = defaultdict(list)
                for i, w in enumerate(words):
                    where[w].append(i)
            cuts = sorted(p for w in rare for p in where[w][bisect_left(where[w], lo):bisect_left(where[w], hi)])
        if not cuts:
            yield lo, hi
            continue
        parts = [(a + 1, b) for a, b in zip([lo - 1, *cuts], [*cuts, hi]) if b > a + 1]
        largest = max(parts, key=lambda p: p[1] - p[0], default=(0, 0))
        follow = largest[1] - largest[0] >= least
        for w in rare:
            del seen[w]
        fell = set()
        for a, b in parts:
            if (a, b) == largest or not (follow or b - a >= least):
                continue
            own = Counter(words[a:b])
            if follow:
                seen.subtract(own)
                fell.update(own)
            if b - a >= least:
                todo.append((a, b, own, None))
        if follow:
            todo.append((*largest, seen, fell))


def lag_scan(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs among whole numbers."""
    out, rank, width = [], np.unique(codes, return_inverse=True)[1].astype(np.int64), 1
    while len(rank) and times * (width // 2 + 1) <= len(codes):
        order = np.argsort(rank, kind="stable")
        same = np.flatnonzero(rank[order[1:]] == rank[order[:-1]])
        lag = np.zeros(len(rank), np.int64)
        lag[order[same]] = order[same + 1] - order[same]
        lag[(lag <= width // 2) | (lag > width)] = 0
        edges = np.flatnonzero(np.diff(lag)) + 1
        first, last = np.concatenate([[0], edges]), np.concatenate([edges, [len(lag)]])
        q = lag[first]
        length = last - first - 1 + width + q
        for k in np.flatnonzero((q > 0) & (length >= np.maximum(least, times * q))):
            out.append((int(first[k]), int(length[k]), int(q[k])))
        rank = np.unique(rank[:-width] * (int(rank.max()) + 1) + rank[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2
    return out


def find_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period."""
    if times < 3:
        raise ValueError("a run has three periods at least: fewer leave no room for the lag scan's windows")
    out = []
    for lo, hi in segments(words, least, times):
        code: dict = {}
        codes = np.array([code.setdefault(w, len(code)) for w in words[lo:hi]])
        out += [(lo + s, n, q) for s, n, q in lag_scan(codes, least, times)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for s, n, q in runs:
        keep[s + q:s + n] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row for each row of ``docs``, whole texts.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0; ``runs`` by start, then period, may overlap;
    ``collapsed`` joins the words that stay by one space. Null, empty and white texts have no words, no runs and an
    empty ``collapsed``. Texts of any length take n log n steps, in one task each. Repeated rows are repeated; ids may
    be null; an empty table gives an empty result; other columns, whatever their names, are not read.
    """
    def make():
        def f(texts):
            n, ends, rows, kept = [], [0], [], []
            for t in texts:
                words = t.split()              # of bytes: exactly the six ASCII white characters part words
                runs = find_runs(words, least, times)
                n.append(len(words))
                rows += runs
                ends.append(len(rows))
                kept.append(b" ".join(collapse(words, runs)))
            cols = np.array(rows, np.int64).reshape(-1, 3)
            runs = pa.StructArray.from_arrays([pa.array(cols[:, k]) for k in range(3)], ["start", "length", "period"])
            return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                    pa.array(kept, pa.binary()).cast(pa.string())]
        return f

    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    text_batches(d.sparkSession)
    return text_columns(d, "text", [("n_words", T.LongType()), ("runs", RUNS), ("collapsed", T.StringType())], make)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with runs planted: where h = crc32 of the decimal doc_id is divisible by 10, word i >= a becomes
    original word a + (i - a) % p; g = floor(h / 10), a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), n words. A null
    doc_id has no decimal form: its text stays. A text that changes is its words joined by one space."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def periodic(ws):
        n = F.size(ws).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, (a + (i - a) % p).cast("int")))), " ")

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    new = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, periodic(ws)).otherwise("")), 0)
    return docs.select("doc_id", F.when(h % 10 == 0, new).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Digest of ``periodic_runs``: number of runs, the run of the greatest exact length / period (ties: smallest start, then
    period; nulls without a run) and SHA-256 of all runs and of the words that stay."""
    order = """array_sort(runs, (l, r) -> case when l.length * r.period > r.length * l.period then -1
               when l.length * r.period < r.length * l.period then 1 when l.start < r.start then -1 when l.start > r.start then 1
               when l.period < r.period then -1 when l.period > r.period then 1 else 0 end)"""
    lines = "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))"
    best = found.withColumn("best", F.expr(f"get({order}, 0)"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
