"""Exact search, tokenizer alignment and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest

from annolake.llm import align, periodic, topk
from annolake.llm.queries import QUERIES
from tests.llm.data import LONG, ODD, SF, empty, odd, rows


def brute_top(data, k=5):
    v = [(d, [int(np.floor(256.0 * y)) for y in e]) for d, e in data
         if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, (d, x) in enumerate(v):
        if d is None or d % 50:
            continue
        found = sorted((-sum(a * b for a, b in zip(x, y)), e is None, e or 0) for j, (e, y) in enumerate(v) if j != i and len(x) == len(y))
        out += [(d, r + 1, None if n else e, -s) for r, (s, n, e) in enumerate(found[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 40, "group": 3, "pivots": 4}])
def test_top_k_equals_brute_force(spark, sizes):
    rng, g = random.Random(1), np.random.default_rng(1)
    base = g.normal(size=(6, 10)) * 0.3
    data = [(rng.choice([i, i, 50 * (i % 7)]), (base[rng.randrange(6)] + g.normal(size=10) * rng.choice([0, 0.02, 0.1])).tolist())
            for i in range(500)]
    data += [(100, data[0][1])] * 9                       # a repeated query, more copies than k
    data += [(None, data[0][1]), (50, None), (50, [None] * 10), (100, [float("nan")] * 10), (100, [1.0, 2.0]), (101, [3.0, 0.5]),
             (150, [float("-inf")] * 10), (200, []), (201, []), (250, [2.0 ** 20, 1.0, 2.0]), (251, [2.0 ** 21, 1.0, -2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "vec_id bigint, embedding array<double>, cid string, rank int")
    assert sorted([tuple(r) for r in topk.top_k(df, **sizes).collect()], key=str) == brute_top(data)


def test_top_k_lengths_beyond_a_long_and_empty(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0]), (50, [1.0, 0.0]), (1, [2.0 ** 20, 0.0])], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(50, 1, 1, 256 * 2 ** 28)]
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_top_k_skips_what_cannot_win():
    g = np.random.default_rng(3)
    centres = g.normal(size=(20, 16)) * 100
    x = np.floor(np.repeat(centres, 200, axis=0) + g.normal(size=(4000, 16))).astype(np.int64)
    dist = topk.distances(x, x[::200]).astype("f4")
    shard = topk.Shard(np.arange(4000), np.arange(4000), np.zeros(4000, bool), x, dist)
    for q in range(0, 4000, 400):
        bars = topk.Bars(1, 6)
        shard.search(x[q], dist[q], bars, 0, None)
        score = x @ x[q]
        assert [(-s, c) for s, _, _, c in bars.best[0]] == [(score[c], c) for c in np.lexsort((np.arange(4000), -score))[:6]]
    assert shard.evaluated < 10 * 4000 / 3


PAIR = align.Pair()


def brute_align(text):
    """(n_a, n_b, groups, {pair: links}) of one text."""
    if not text:
        return 0, 0, [], {}
    raw = (" " + text).encode()
    a, b = PAIR.a.encode(" " + text, add_special_tokens=False).ids, PAIR.b.encode(text)
    if b"".join(PAIR.bytes_a[i] for i in a) != raw or b"".join(PAIR.bytes_b[i] for i in b) != raw:
        return 0, 0, [], {}

    def spans(ids, of):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(of[i]), i))
            at += len(of[i])
        return out

    a, b = spans(a, PAIR.bytes_a), spans(b, PAIR.bytes_b)
    cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
    sides = [[[] for _ in cuts] for _ in (a, b)]
    for side, tokens in zip(sides, (a, b)):
        for _, e, i in tokens:
            side[bisect_left(cuts, e)].append(str(i))
    groups = ["|".join(map(",".join, x)) for x in zip(*sides)]
    links, j = Counter(), 0
    for s, e, i in a:
        while b[j][1] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][0] < e:
            links[i, b[k][2]] += 1
            k += 1
    return len(a), len(b), groups, links


def texts():
    rng = random.Random(4)
    parts = [*"abcXYZ019 .,'!\n\n  \t\r", "the ", " \n", "é", "ß", " ", "　", "中", "\U0001f600", "​", "\x1c", "\x85", "<s>", "'s ",
             "'ll", "\x00", " İ", " ", " ", " <0x41>", "<|endoftext|>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [
        None, "", " ", "\n", "  ", "\n\n", "a ", " a", "a\n", "word " * 50, "a▁b", "▁", LONG[:3000]]


@pytest.mark.parametrize("frame", [align.FRAME, 7])
def test_frames_equal_whole_texts(frame):
    """Units, frames and the memory of units (here a small one) change nothing."""
    ts = texts()
    for t, d in zip(ts, align.align_block(align.Units(PAIR, entries=300), ts, False, frame)):
        n, pairs, times = d.result()
        a, b, groups, links = brute_align(t)
        assert n == [a, b, len(groups), sum(links.values()), ";".join(groups)], t
        assert dict(zip(pairs.tolist(), times.tolist())) == {x * PAIR.size_b + y: c for (x, y), c in links.items()}


@pytest.mark.parametrize("with_groups", [True, False])
def test_alignment_equals_brute_force(spark, with_groups):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents", SF)[:60]] + [(k, t) for k, t in enumerate(texts()[-200:])] + [r[:2] for r in ODD]
    each = [brute_align(t) for _, t in docs]
    held = Counter(p for e in each for p in e[3])
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    want = []
    for (d, _), (a, b, groups, links) in zip(docs, each):
        text = ";".join(groups)
        text = text if with_groups or not text else hashlib.sha256(text.encode()).hexdigest()
        want.append((d, a, b, len(groups), sum(links.values()), sum(c for p, c in links.items() if held[p] == best[p[0]]),
                     sum(c * held[p] for p, c in links.items()), text))
    df = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id bigint, text string, n_a int, block string").repartition(5)
    got = [tuple(r) for r in align.align(df, with_groups=with_groups).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(n == x + y - g for _, x, y, g, n, *_ in got)


def test_alignment_of_an_empty_table(spark):
    assert align.align(empty(spark)).count() == 0


def brute_runs(words, least=24):
    """Every run by its definition: each stretch of equal words at a lag, kept if no smaller period fits it."""
    out = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j + q - i
            if j > i and n >= max(least, 3 * q) and not any(all(words[x] == words[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_their_definition():
    rng = random.Random(3)
    found = 0
    for _ in range(2500):
        kinds, words = rng.choice([1, 2, 2, 3, 4, 6, 10]), []
        for _ in range(rng.randint(0, 9)):
            unit = [rng.randrange(kinds) for _ in range(rng.randint(1, 14))]
            words += unit * rng.choice([1, 1, 2, 3, 4, 6, 12]) + unit[:rng.randint(0, len(unit))]
        if words and rng.random() < 0.5:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.randrange(kinds + 5)
        least = rng.choice([24, 24, 6, 3])
        want = brute_runs(words, least)
        found += len(want)
        assert periodic.find_runs(words, least) == want
        drop = {i for s, n, q in want for i in range(s + q, s + n)}
        assert periodic.collapse(words, want) == [w for i, w in enumerate(words) if i not in drop]
    assert found > 2000


def test_segments_are_stable():
    rng = random.Random(8)
    for _ in range(400):
        words = [rng.randrange(rng.choice([3, 20, 60])) for _ in range(rng.randint(0, 300))]
        got = sorted(periodic.segments(words))

        def split(lo, hi):
            seen = Counter(words[lo:hi])
            cuts = [i for i in range(lo, hi) if seen[words[i]] < 3]
            if not cuts:
                return [(lo, hi)] if hi - lo >= 24 else []
            return [x for a, b in zip([lo - 1, *cuts], [*cuts, hi]) for x in split(a + 1, b)]
        assert got == sorted(split(0, len(words)))


@pytest.mark.parametrize("words", [["a", "b", "c"] * 100_000, [str(k % 50_000) for k in range(300_000)],
                                   [str((k * 7919) % 50 * (k % 3)) for k in range(300_000)]])
def test_very_long_texts(words):
    runs = periodic.find_runs(words)
    assert runs and all(n >= max(24, 3 * q) for _, n, q in runs)
    assert runs[0][:2] == (0, 300_000)


def digest(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = periodic.find_runs(words) if n > 400 else brute_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def test_run_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows("documents", SF)]
    want = sorted(digest(*d) for d in docs)
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect())
    assert got == want and sum(r[1] > 0 for r in got) > 10


def test_runs_of_odd_rows(spark):
    more = spark.createDataFrame([(20 + k, "x y " * k, "en", "a", 0, "x", 1.5, 2, True) for k in range(40)], odd(spark).schema)
    df = odd(spark).unionByName(more)
    got = periodic.run_digests(periodic.periodic_runs(periodic.planted(df))).collect()
    want = [digest(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(empty(spark)).count() == 0
