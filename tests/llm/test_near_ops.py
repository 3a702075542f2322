"""Near-duplicates of texts and of vectors against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from annolake.llm import simhash, vectors
from annolake.llm.forest import Forest, connected_components
from tests.llm.data import LONG, ODD, SF, SF2, empty, odd, rows


def brute_fp(t):
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))]
    if not w:
        return 0
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    ones = [0] * 64
    for s in sh:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(sh))


def classes(n, links):
    low = list(range(n))

    def root(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def brute_components(docs):
    """{(doc_id, fingerprint): component_id} for (doc_id, text) rows."""
    fp = [brute_fp(t) for _, t in docs]
    c = classes(len(docs), [(i, j) for i in range(len(docs)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 4])
    low = defaultdict(list)
    for (d, _), k in zip(docs, c):
        low[k].append(d)
    return sorted((d is None, d or 0, f"{f:016x}", min((x for x in low[k] if x is not None), default=-1)) for (d, _), f, k in zip(docs, fp, c))


def asked(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in df.collect())


@pytest.mark.parametrize("leaf", [4096, 4])
def test_simhash_equals_brute_force(spark, leaf, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (simhash.MAX_BITS, leaf))
    docs = [(r["doc_id"], r["text"]) for r in rows("documents", SF if leaf == 4 else SF2)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert asked(simhash.simhash_components(df)) == brute_components(docs)


def test_simhash_odd_rows(spark):
    docs = [(r[0], r[1]) for r in ODD if r[1] != LONG]
    df = odd(spark).where("doc_id is null or doc_id <> 4")
    assert asked(simhash.simhash_components(df)) == brute_components(docs)
    assert asked(simhash.simhash_components(odd(spark).where("doc_id = 4"))) == brute_components([(4, LONG)])
    assert simhash.simhash_components(empty(spark)).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 4, 7])
def test_links_between_close_fingerprints(spark, bits):
    rng = random.Random(bits)
    keys = {0, (1 << 64) - 1, 1, 1 << 63}
    for _ in range(40):
        k = rng.getrandbits(64)
        keys.add(k)
        for _ in range(12):
            x = k
            for b in rng.sample(range(64), rng.randint(1, bits + 3)):
                x ^= 1 << b
            keys.add(x)
    keys = sorted(keys)
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    df = spark.createDataFrame([(k,) for k in signed], "fp bigint")
    links = simhash.near_links(df, bits, 8)
    got = {r.node: r.root for r in connected_components(links).collect()}
    c = classes(len(keys), [(i, j) for i in range(len(keys)) for j in range(i) if (keys[i] ^ keys[j]).bit_count() <= bits])
    groups, mine = defaultdict(set), defaultdict(set)
    for k, r in zip(signed, c):
        groups[r].add(k)
        mine[got.get(k, k)].add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_one_document_of_each_group_stays(spark):
    t = [f"{a} quick brown fox jumps over the lazy dog number {a}" for a in ("one", "two")]
    docs = [(3, t[0], "r3"), (1, t[0], "r1"), (9, t[1], "r9"), (9, t[1], "r9"), (9, t[0], "x9"), (None, "no id here at all", "n"),
            (None, "no id here at all", "n"), (None, t[1], "z"), (2, None, "e"), (4, "", "e4")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, _fp string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r._fp) for r in simhash.drop_near_duplicates(df).collect())
    assert got == sorted([(False, 1, t[0], "r1"), (False, 9, t[1], "r9"), (True, 0, "no id here at all", "n"), (False, 2, "", "e")])
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_forest_and_components_of_a_chain(spark):
    f = Forest(6)
    f.link(np.array([5, 4]), np.array([4, 1]))
    assert f.parent.tolist() == [0, 1, 2, 3, 1, 1]
    chain = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 500), (600, 601)], "u bigint, v bigint")
    got = {r.node: r.root for r in connected_components(chain).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, 601: 600}


def brute_vectors(data):
    ok = [i for i, (_, v, lab) in enumerate(data) if lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(i, j) for i in ok for j in ok if j < i and data[i][2] == data[j][2] and len(data[i][1]) == len(data[j][1])
             and np.dot(data[i][1], data[j][1]) / (np.linalg.norm(data[i][1]) * np.linalg.norm(data[j][1])) >= 0.98]
    c, n, low = classes(len(data), links), [0] * len(data), defaultdict(list)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    for (d, _, _), k in zip(data, c):
        low[k].append(d)
    out = []
    for (d, _, _), k, m in zip(data, c, n):
        comp = min((x for x in low[k] if x is not None), default=None)
        out.append((str(d), m, str(comp), d == comp))
    return sorted(out)


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors_equal_brute_force(spark, tile):
    rng = np.random.default_rng(5)
    data = []
    for lab in (0, 1, 1, None):
        for _ in range(6):
            v = rng.normal(size=40)
            for _ in range(8):
                data.append((len(data), (v + rng.normal(size=40) * 0.14).tolist(), lab))
    data += [(500, data[0][1], 0), (500, data[0][1], 0), (None, data[0][1], 0), (501, None, 0), (502, [], 0), (503, [0.0] * 40, 0),
             (504, [float("nan")] * 40, 0), (505, [float("inf"), *[1.0] * 39], 0), (506, [None, *[1.0] * 39], 0), (507, [1.0, 2.0], 0),
             (508, [1.0, 2.0001], 0), (509, [x * 7 for x in data[0][1]], 0), (510, [1e-200] * 40, 1), (511, [2e-200] * 40, 1)]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id bigint, embedding array<double>, label int, kept string")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in vectors.embedding_components(df, tile=tile).collect())
    want = brute_vectors([r for r in data if r[0] not in (510, 511)])
    want = sorted(want + [("510", 1, "510", True), ("511", 1, "510", False)])
    assert got == want


def test_vectors_empty(spark):
    assert vectors.embedding_components(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0
