"""Operator 5, language of web pages by fusing evidence the Bayesian way.

Four sources of evidence are added as log probabilities, language by language:

* the visible text: a naive Bayes model of hashed byte trigrams within words, fitted on a
  bounded sample of the documents of each language; as trigrams of a text depend on each
  other, a text counts as at most EVIDENCE of them;
* the language that the markup declares, and the suffix of the address (top-level domain and
  a two-letter first path segment): how often each value goes with each language, by grouped counts
  over all pages of the text model's own verdicts;
* the host: its pages' languages, shrunk towards those of its registered domain, which are
  shrunk towards those of all pages; the page's own verdict is left out of its prior.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import CACHE_ENTRIES, CACHE_WORD, text_columns
from annolake.session import cut_lineage

SAMPLE = 2000          # documents of each language that are fitted, at most
BUCKETS = 1 << 14
EVIDENCE = 30.0        # trigrams that a text counts for, at most
SMOOTH = 0.5
SHRINK = 5.0           # pages that the wider level counts for in a host's or domain's prior

_DROP = re.compile(r"(?is)<(script|style|title|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*+>")
_LANG = re.compile(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b")


@dataclass
class Model:
    langs: list[str]
    weight: np.ndarray      # (BUCKETS, languages): log P(trigram | language)


def trigrams(word: bytes) -> list[int]:
    w = b"<" + word + b">"
    return [crc32(w[i:i + 3]) % BUCKETS for i in range(len(w) - 2)]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Trigram counts of at most ``sample`` documents of each language, in the order of a hash of the id; every
    language of the table is in the model, however rare. A null id is an id like others, a repeated id counts once
    in a language, and rows without language are not used. The driver sees bucket counts, not texts."""
    ids = docs.select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang")).where("_lang is not null").distinct()
    langs = ids.groupBy("_lang").agg(F.count("*").alias("_n"))
    # a range of the hash that holds about twice the sample, so that no window sees a whole language
    first = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / F.lit(float(1 << 40)) <= 2.0 * sample / F.col("_n")
    order = Window.partitionBy("_lang").orderBy(F.pmod(F.xxhash64("_id"), F.lit(1 << 40)), "_id")
    few = ids.join(F.broadcast(langs), "_lang").where(first).withColumn("_k", F.row_number().over(order)) \
        .where(F.col("_k") <= sample).select(F.col("_id").alias("_id2"), F.col("_lang").alias("_lang2"))
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).join(
        F.broadcast(few), F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_lang") == F.col("_lang2")))
    d = d.groupBy("_id", "_lang").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_lang", "_text")

    def make():
        def f(texts):
            idx, cnt = [], []
            for t in texts:
                n: dict[int, int] = {}
                for w in t.lower().split():
                    for b in trigrams(w):
                        n[b] = n.get(b, 0) + 1
                idx.append(list(n.keys()))
                cnt.append(list(n.values()))
            return [pa.array(x, pa.list_(pa.int32())) for x in (idx, cnt)]
        return f

    seen = text_columns(d, "_text", [(n, T.ArrayType(T.IntegerType())) for n in ("idx", "cnt")], make)
    # outer: a language whose documents have no trigrams stays in the model
    seen = seen.select("_lang", F.explode_outer(F.arrays_zip("idx", "cnt")).alias("z")) \
        .groupBy("_lang", F.col("z.idx").alias("idx")).agg(F.sum("z.cnt").alias("cnt"))
    rows = seen.toArrow().to_pydict()              # at most BUCKETS rows a language
    names = sorted(set(rows["_lang"])) or ["und"]
    at = {x: k for k, x in enumerate(names)}
    count = np.full((BUCKETS, len(names)), SMOOTH)
    for lang_, idx, cnt in zip(rows["_lang"], rows["idx"], rows["cnt"]):
        if idx is not None:
            count[idx, at[lang_]] += cnt
    return Model(names, np.log(count / count.sum(axis=0)))


class Words(dict):
    """word -> row of the matrix of its summed log likelihoods, remembered."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.sums: list[np.ndarray] = []

    def __missing__(self, word: bytes) -> np.ndarray:
        v = self.model.weight[trigrams(word)].sum(axis=0)
        if len(word) <= CACHE_WORD:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = v
        return v


def visible(page: str) -> str:
    return html.unescape(_DROP.sub(" ", page))


def _evidence(model: Model):
    def make():
        known = Words(model)
        zero = np.zeros(len(model.langs))

        def f(texts):
            like, declared = [], []
            for t in texts:
                page = t.decode()
                m = _LANG.search(page)
                declared.append(m[1].lower() if m else None)
                words = visible(page).lower().encode().split()
                n = sum(map(len, words))            # a word of n bytes has n trigrams
                total = sum(map(known.__getitem__, words), zero)
                like.append((total * (min(n, EVIDENCE) / n) if n else zero).tolist())
            return [pa.array(like, pa.list_(pa.float64())), pa.array(declared, pa.string())]
        return f
    return make


def languages(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, lang, probability, text_lang, declared), one row for each row of ``pages``, whole pages.

    Null and empty pages have no text evidence, and null addresses no suffix and no host: what is missing
    adds nothing. Ties go to the language that sorts first. Repeated rows are repeated (and count as
    often in the priors). Empty table: empty result. Other columns are not read.
    """
    k = len(model.langs)
    d = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    e = text_columns(d, "html", [("like", T.ArrayType(T.DoubleType())), ("declared", T.StringType())], _evidence(model))
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.when(host != "", host)
    path = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1))
    best = F.array_position(F.col("like"), F.array_max("like")).cast("int") - 1
    e = e.select("page_id", "url", "like", "declared", host.alias("host"),
                 F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
                 F.concat_ws("/", F.regexp_extract(host, r"([^.]+)$", 1), path).alias("suffix"),
                 F.when(F.exists("like", lambda x: x != 0), best).alias("best"))
    e = cut_lineage(e, "language_evidence")

    def counts(by: list[str], rows: DataFrame) -> DataFrame:
        return rows.where("best is not null").groupBy(*by).agg(
            F.array(*[F.sum((F.col("best") == i).cast("double")) for i in range(k)]).alias("n"))

    total = counts([], e).first()["n"]
    total = [float(x or 0) for x in total]
    share = [(x + SMOOTH) / (sum(total) + SMOOTH * k) for x in total]
    arr = lambda xs: F.array(*[F.lit(float(x)) for x in xs])

    def given(name: str) -> DataFrame:
        """log P(value | language) for every value of a column, over the number of values plus one unseen."""
        c = counts([name], e.where(F.col(name).isNotNull()))
        values = c.count() + 1
        return c.select(F.col(name).alias(f"_{name}"), F.zip_with("n", arr(total), lambda n, t: F.log(
            (n + SMOOTH) / (t + SMOOTH * values))).alias(f"p_{name}"))

    by_host = counts(["domain", "host"], e.where("host is not null"))
    by_domain = by_host.groupBy("domain").agg(F.array(*[F.sum(F.get("n", F.lit(i))) for i in range(k)]).alias("nd"))
    prior = by_host.join(by_domain, "domain").select(F.col("host").alias("_host"), "n", "nd")
    out = e
    for name in ("declared", "suffix"):
        t = given(name)
        out = out.join(t, F.col(name) == F.col(f"_{name}"), "left")
    out = out.join(prior, F.col("host") == F.col("_host"), "left")
    none = arr([0.0] * k)
    own = F.array(*[F.coalesce((F.col("best") == i).cast("double"), F.lit(0.0)) for i in range(k)])
    total_of = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    minus = lambda a: F.zip_with(F.coalesce(a, none), own, lambda x, o: F.greatest(F.lit(0.0), x - o))
    out = out.withColumn("nh", minus(F.col("n"))).withColumn("nd", minus(F.col("nd")))
    dom = F.zip_with("nd", arr(share), lambda n, p: (n + SHRINK * p) / (F.col("_td") + SHRINK))
    out = out.withColumn("_td", total_of(F.col("nd"))).withColumn("_th", total_of(F.col("nh"))).withColumn("dom", dom)
    out = out.withColumn("prior", F.zip_with("nh", "dom", lambda n, p: F.log((n + SHRINK * p) / (F.col("_th") + SHRINK))))
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    out = out.withColumn("z", add(add("like", "prior"), add(F.coalesce("p_declared", none), F.coalesce("p_suffix", none))))
    out = out.withColumn("top", F.array_max("z"))
    z = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    names = F.array(*[F.lit(x) for x in model.langs])
    return out.select("page_id", "url", F.get(names, F.array_position("z", F.col("top")).cast("int") - 1).alias("lang"),
                      (F.lit(1.0) / z).alias("probability"), F.get(names, F.col("best")).alias("text_lang"), "declared")
