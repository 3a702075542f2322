"""Operator 1, quality classifier: supervised subword embeddings.

A document is the mean of the learned vectors of its features: words, character
n-grams of 3 and 4 bytes of ``<word>``, each hashed to one of BUCKETS vectors, and
one feature for a word that repeats the word before it. A softmax layer on the mean
gives the two classes; vectors and layer are learned together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows. As the layer is
linear in the mean, the fitted model is one number for each bucket (its vector times
the difference of the two output columns), which is all that scoring needs.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolake.llm.common import CACHE_ENTRIES, CACHE_WORD, fresh, text_columns, with_text_columns

BUCKETS = 1 << 17
SIZES = (3, 4)
DIM = 16
EPOCHS = 5
RATE = 0.5
SAMPLE = 1500       # labelled documents of each class, at most, that are fitted
LIMIT = 0.7
FOLDS, HELD_OUT = 4, 2
SAME = 0            # the bucket of "this word repeats the word before it"


def buckets_of(word: bytes, n_buckets: int = BUCKETS) -> list[int]:
    w = b"<" + word + b">"
    return [1 + crc32(word) % (n_buckets - 1),
            *[1 + crc32(w[i:i + n]) % (n_buckets - 1) for n in SIZES for i in range(len(w) - n + 1)]]


def features(text: bytes, n_buckets: int = BUCKETS) -> dict[int, int]:
    """Bucket -> number of features of the whole text that fall into it."""
    words = text.split()
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    out: dict[int, int] = {}
    for w, n in count.items():
        for b in buckets_of(w, n_buckets):
            out[b] = out.get(b, 0) + n
    same = sum(map(eq, words, words[1:]))
    if same:
        out[SAME] = same
    return out


@dataclass
class Model:
    """The log odds of class 1 are bias + the mean of ``weight`` over the features."""

    weight: np.ndarray
    bias: float

    def score(self, total: float, n: int) -> float:
        x = self.bias + (total / n if n else 0.0)
        return float(1 / (1 + np.exp(-x))) if x > -500 else 0.0


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], n_buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Model:
    """Rows of (buckets, counts, class 0 or 1). The classes weigh alike, so a rare class is not outvoted.
    The learning rate falls linearly to zero. Without rows of both classes the score is 1/2."""
    n_of = [max(1, sum(1 for r in rows if r[2] == c)) for c in (0, 1)]
    if not all(any(r[2] == c for r in rows) for c in (0, 1)):
        return Model(np.zeros(n_buckets), 0.0)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (n_buckets, dim))
    out, bias = np.zeros((dim, 2)), np.zeros(2)
    share = [len(rows) / (2 * n) for n in n_of]
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            idx, cnt, y = rows[k]
            lr = rate * (1 - step / steps) * share[y]
            step += 1
            w = cnt / max(1, cnt.sum())
            v = vectors[idx]
            h = w @ v
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(h, p)
            bias -= lr * p
            vectors[idx] = v - (lr * w)[:, None] * back[None, :] * min(len(idx), 50)
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


class Words(dict):
    """word -> (sum of its features' weights, number of features), remembered."""

    def __init__(self, model: Model):
        super().__init__()
        self.weight = model.weight.tolist()
        self.size = len(self.weight)
        self.number: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> float:
        b = buckets_of(word, self.size)
        total = sum(map(self.weight.__getitem__, b))
        if len(word) <= CACHE_WORD:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = total
        return total


def count_features(words: list[bytes]) -> int:
    """Features of the words: 1 for the word and len - n + 3 for each n-gram size that fits into ``<word>``."""
    n = len(words)
    total = n
    sizes = list(map(len, words))
    short = min(sizes, default=9) < max(SIZES) - 2
    for k in SIZES:
        total += sum(max(0, s + 3 - k) for s in sizes) if short else sum(sizes) + n * (3 - k)
    return total


def scorer(model: Model):
    def make():
        known = Words(model)

        def score(text: bytes) -> float:
            words = text.split()
            same = sum(map(eq, words, words[1:]))
            return model.score(sum(map(known.__getitem__, words)) + same * known.weight[SAME],
                               count_features(words) + same)

        return lambda texts: [pa.array([score(t) for t in texts], pa.float64())]
    return make


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text, mod 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def feature_rows(table: pa.Table) -> list[tuple[object, int, np.ndarray, np.ndarray]]:
    """(_id, _y, buckets, counts) of each row: views of the Arrow lists, so the features are held once and as no Python objects."""
    out = []
    for b in table.select(["_id", "_y", "idx", "cnt"]).to_batches():
        ids, ys, (at, idx), (at2, cnt) = b.column(0), b.column(1), *((c.offsets.to_numpy(), c.values.to_numpy()) for c in b.columns[2:])
        out += [(i, y, idx[at[k]:at[k + 1]], cnt[at2[k]:at2[k + 1]]) for k, (i, y) in enumerate(zip(ids.to_pylist(), ys.to_pylist()))]
    return out


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE, **settings) -> Model:
    """Fit on at most ``sample`` labelled documents of each class, taken in the order of a hash of
    the id; ids held out, null labels and ids with two different labels are not used. A repeated id counts once.
    Ids and labels are no inputs. The sample's features, not its texts, come to the driver."""
    lab = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).where(
        F.col("_y").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
    lab = lab.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_z")).where("_y = _z").drop("_z")
    picked = [lab.where(f"_y = {y}").orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))        # at most 2 * sample rows of two numbers
    # one row an id, that of the smallest text hash: rows of a repeated id stay in the cluster, and each id is fitted once
    d = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(few, "_id") \
        .groupBy("_id", "_y").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))

    def make():
        def f(texts):
            got = [features(t) for t in texts]
            return [pa.array([list(g.keys()) for g in got], pa.list_(pa.int32())),
                    pa.array([list(g.values()) for g in got], pa.list_(pa.int32()))]
        return f

    rows = feature_rows(text_columns(d, "_text", [("idx", T.ArrayType(T.IntegerType())), ("cnt", T.ArrayType(T.IntegerType()))],
                                     make).toArrow())
    rows.sort(key=lambda r: str(r[0]))     # a rerun fits the same model
    return train([(i, c, y) for _, y, i, c in rows if len(i)], **settings)


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
                    limit: float = LIMIT) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row for each row of ``docs``.

    Null and empty texts have no features and get the model's bias. Repeated rows are
    scored alike. Empty table: empty result. Other columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    s = text_columns(d, "text", [("score", T.DoubleType())], scorer(model))
    return s.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= limit).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` that score at least ``limit``, with all their columns."""
    name, = fresh(docs, "_score")
    return with_text_columns(docs, text, [(name, T.DoubleType())], scorer(model)).where(F.col(name) >= limit).drop(name)
