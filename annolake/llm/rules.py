"""Operator 2, quality rules with host verdicts.

Each document is measured (words, symbols, repeated lines and passages); rule
failures are summed by host, the failure rates are shrunk with a beta prior whose
two parameters come from all hosts (method of moments), and a host whose shrunk
rate reaches ``host_limit`` for a rule takes its documents with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import text_columns
from annolake.session import cut_lineage

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
MAX_SYMBOL_PCT = 20
MAX_DUP_LINE_PCT = 30
HOST_LIMIT = 0.5
WINDOW = 5
RULES = ("fail_short", "fail_repeat", "fail_symbols", "fail_dup_lines")
_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONT = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a ``size``-word window found twice or more in the text, first included.

    Windows are numbered exactly (pairs of ranks are ranked again), never hashed.
    """
    n = len(words)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    if len(ids) == n:
        return 0
    rank, base, width = w, len(ids), 1
    while width < size:
        if base * len(ids) >= 2 ** 62:
            _, rank = np.unique(rank, return_inverse=True)
            base = int(rank.max()) + 1
        rank = rank[:-1] * len(ids) + w[width:]
        base *= len(ids)
        width += 1
    order = np.argsort(rank, kind="stable")
    s = rank[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    hit = np.zeros(len(s) + 1, bool)
    hit[:-2] |= same
    hit[1:-1] |= same
    cover = np.zeros(n + 1, np.int64)
    at = order[hit[:-1]]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return int((np.cumsum(cover[:n]) > 0).sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """(words, code points in words, symbols, repeated lines, words in repeated windows)."""
    words = text.split()
    if not words:
        return 0, 0, len(text) - len(text.translate(None, _SYMBOLS)), 0, 0
    chars = len(text.translate(None, _WHITE + _CONT))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    dup = 0
    if b"\n" in text:
        lines = [x for x in text.split(b"\n") if x.strip(_WHITE)]
        dup = len(lines) - len(set(lines))
    return len(words), chars, symbols, dup, repeated_words(words)


def measure_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the five measures and one flag for each rule.

    A null text has no words, like an empty one.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

    def make():
        def f(texts):
            rows = [(*measure(t), t.count(b"\n") + 1) for t in texts]
            return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
        return f

    m = text_columns(docs, text, [(n, T.LongType()) for n in names], make)
    return m.select(
        *[c for c in m.columns if c != "n_lines"],
        (F.col("n_words") < MIN_WORDS).alias("fail_short"),
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")).alias("fail_repeat"),
        (100 * F.col("n_symbols") > MAX_SYMBOL_PCT * F.col("word_chars")).alias("fail_symbols"),
        (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines")).alias("fail_dup_lines"))


def host_verdicts(measured: DataFrame, host: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per non-null host: documents, shrunk failure rate of each rule, ``host_ok``.

    Beta prior by moments over the hosts of one rule: mean m and variance v of the
    raw rates give a + b = m (1 - m) / v - 1 (at least 1, at most 1e6; 1 where the
    rates do not vary), a = m (a + b). Shrunk rate: (failures + a) / (n + a + b).
    """
    per = measured.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("host_docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    prior = per.agg(*[F.avg(F.col(r) / F.col("host_docs")).alias(f"m_{r}") for r in RULES],
                    *[F.var_pop(F.col(r) / F.col("host_docs")).alias(f"v_{r}") for r in RULES]).first()
    rates = []
    for r in RULES:
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        strength = min(1e6, max(1.0, m * (1 - m) / v - 1)) if v > 0 else 1.0
        rates.append(((F.col(r) + F.lit(m * strength)) / (F.col("host_docs") + F.lit(strength))).alias(f"rate_{r[5:]}"))
    out = per.select(host, "host_docs", *rates)
    return out.withColumn("host_ok", F.greatest(*[F.col(f"rate_{r[5:]}") for r in RULES]) < host_limit)


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  host_limit: float = HOST_LIMIT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    host_ok, kept), one row for each row of ``docs``.

    Null or empty text: no words, so the base rules fail. Null host: no verdict, so
    ``host_ok`` is true. Repeated rows count as often as they occur. An empty table
    gives an empty result. Other columns of ``docs`` are not looked at. The measures
    are written once (narrow rows), summed by host and joined with the verdicts; the
    join is by host, where adaptive execution splits a hot host or broadcasts the
    host table when it is measured small.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    m = cut_lineage(measure_documents(d), "rule_measures")
    v = host_verdicts(m, "host", host_limit).select("host", "host_ok")
    base = F.col("fail_short") | F.col("fail_repeat")
    return (m.join(v, "host", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), F.coalesce("host_ok", F.lit(True)).alias("host_ok"))
            .withColumn("kept", ~F.col("base_failed") & F.col("host_ok")))
