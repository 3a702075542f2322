"""Weighted, stratified and entity splits against plain-Python versions."""

import hashlib
import random

import pytest

from annolake.operators.split import (SPLITS, check_exclusive, entity_split, per_mille, split_report,
                                      weighted_split)


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def py_weighted(rows, pm, seed):
    out = {}
    for strat in {r[1] for r in rows}:
        g = sorted((r for r in rows if r[1] == strat), key=lambda r: (md5(f"{seed}:{r[0]}"), r[0]))
        tot = sum(r[3] for r in g)
        cum = 0
        for r in g:
            cum += r[3]
            if cum * 1000 <= tot * pm[0]:
                out[r[0]] = "train"
            elif cum * 1000 <= tot * (pm[0] + pm[1]):
                out[r[0]] = "test"
            else:
                out[r[0]] = "validate"
    return out


def py_greedy(rows, pm, seed):
    w = {}
    for r in rows:
        w[r[2]] = w.get(r[2], 0) + r[3]
    order = sorted(w, key=lambda e: (md5(f"{seed}:{e}"), e))
    tot = sum(w.values())
    cur = [0, 0, 0]
    res = {}
    for e in order:
        gaps = [tot * pm[i] - 1000 * cur[i] for i in range(3)]
        best = max(range(3), key=lambda i: (gaps[i], -i))
        cur[best] += w[e]
        res[e] = SPLITS[best]
    return {r[0]: res[r[2]] for r in rows}


def data(spark, n=500, seed=4):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["big", "big", "big", "s1", "s2"]), f"e{rnd.randint(0, 60)}", rnd.randint(0, 900))
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "key long, dataset string, entity string, weight long").repartition(6)


@pytest.mark.parametrize("hex_digits", [None, 1, 2, 3])
def test_weighted_split(spark, hex_digits):
    rows, df = data(spark)
    got = {r.key: r.split for r in weighted_split(df, "key", "weight", (700, 200, 100), by=["dataset"], seed=3,
                                                  hex_digits=hex_digits).collect()}
    assert got == py_weighted(rows, (700, 200, 100), 3)


def reached(rows, split):
    out = dict.fromkeys(SPLITS, 0)
    for r in rows:
        out[split[r[0]]] += r[3]
    return out


def test_entity_split_of_heavy_entities_is_the_greedy(spark):
    rows, df = data(spark)
    got = {r.key: r.split for r in entity_split(df, "entity", "weight", (0.8, 0.1, 0.1), seed=5).collect()}
    assert got == py_greedy(rows, (800, 100, 100), 5)
    sharded = entity_split(df, "entity", "weight", (800, 100, 100), seed=5, shards=4)
    assert sharded.count() == len(rows)
    assert check_exclusive(sharded, "entity").count() == 0
    rep = {r.split: (r.desired_weight, r.reached_weight) for r in split_report(sharded, "weight").collect()}
    assert sum(v[1] for v in rep.values()) == sum(r[3] for r in rows)


@pytest.mark.parametrize("pm", [(800, 100, 100), (500, 300, 200), (0, 500, 500), (1000, 0, 0)])
@pytest.mark.parametrize("heads", [20, 1])
def test_entity_split_comes_as_near_as_the_greedy(spark, pm, heads):
    """A hot entity with a fifth of all weight, some heavy ones and a long tail (``heads=1``: tail only)."""
    rng = random.Random(9)
    rows = [(0, "d", "hot", 40_000)] + [(k, "d", f"h{k % 9}", rng.randint(500, 1500)) for k in range(1, 60)] \
        + [(k, "d", f"t{k}" if k % 50 else None, rng.randint(0, 90)) for k in range(60, 2000)]
    df = spark.createDataFrame(rows, "key long, dataset string, entity string, weight long").repartition(7)
    out = entity_split(df, "entity", "weight", pm, seed=2, heads=heads)
    got = {r.key: r.split for r in out.collect()}
    assert len(got) == len(rows) and len({got[r[0]] for r in rows if r[2] is None}) == 1
    assert check_exclusive(out, "entity").count() == 0
    total, weight = sum(r[3] for r in rows), {}
    for r in rows:
        weight[r[2]] = weight.get(r[2], 0) + r[3]
    bar = max([w for w in weight.values() if w * heads <= total], default=0)
    top = max([w for w in weight.values() if w * heads > total], default=0)
    mine, greedy = reached(rows, got), reached(rows, py_greedy([(r[0], r[1], r[2] or "\0", r[3]) for r in rows], pm, 2))
    for k, n in enumerate(SPLITS):
        target = total * pm[k] / 1000
        assert -4 / 3 * top - bar <= mine[n] - target <= 2 / 3 * top + bar
        if heads > 1:
            assert abs(mine[n] - greedy[n]) <= 2 * max(weight.values()) / 3 + bar
    # the same in any partitioning
    assert got == {r.key: r.split for r in entity_split(df.repartition(3, "weight"), "entity", "weight", pm, seed=2, heads=heads).collect()}


def test_entity_split_without_weight(spark):
    df = spark.createDataFrame([(k, f"e{k}", 0) for k in range(20)], "key long, entity string, weight long")
    assert {r.split for r in entity_split(df, "entity", "weight").collect()} == {"train"}
    assert entity_split(df.limit(0), "entity", "weight").count() == 0


def test_per_mille():
    assert per_mille((0.7, 0.2, 0.1)) == (700, 200, 100)
    assert per_mille((800, 100, 100)) == (800, 100, 100)
    with pytest.raises(ValueError):
        per_mille((0.7, 0.2, 0.2))
    with pytest.raises(ValueError):
        per_mille((1.5, -0.5, 0.0))


def test_check_exclusive_finds_offenders(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train")], "entity string, split string")
    assert [(r.entity, r.n_splits) for r in check_exclusive(df, "entity").collect()] == [("a", 2)]


def test_fractional_weights(spark):
    rows = [(i, "d", f"e{i % 7}", (i % 5) * 0.25 + 0.1) for i in range(60)]
    df = spark.createDataFrame(rows, "key long, dataset string, entity string, weight double")
    ws = {r.key: r.split for r in weighted_split(df, "key", "weight", (600, 200, 200), seed=1).collect()}
    # same decisions as a float running sum in md5 order
    g = sorted(rows, key=lambda r: (md5(f"1:{r[0]}"), r[0]))
    tot, cum, exp = sum(r[3] for r in rows), 0.0, {}
    for r in g:
        cum += r[3]
        exp[r[0]] = "train" if cum * 1000 <= tot * 600 else ("test" if cum * 1000 <= tot * 800 else "validate")
    assert ws == exp
    es = entity_split(df, "entity", "weight", (600, 200, 200), seed=1)
    assert check_exclusive(es, "entity").count() == 0 and es.count() == 60


def test_entity_split_with_nested_map_columns(spark):
    df = spark.createDataFrame([(i, f"e{i % 3}", i, [{"a": "b"}]) for i in range(30)],
                               "key long, entity string, weight long, meta array<map<string,string>>")
    out = entity_split(df, "entity", "weight", (800, 100, 100))
    assert out.count() == 30 and check_exclusive(out, "entity").count() == 0
