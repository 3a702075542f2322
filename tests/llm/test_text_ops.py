"""Quality rules, quality classifier, token counts, packing, mixing against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolake.llm import mixing, packing, quality, rules, viterbi
from tests.llm.data import ODD, SF, SF2, empty, odd, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_measure(t):
    w = WORD.findall(t or "")
    win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit))


def test_measures_equal_brute_force():
    for t in [r["text"] for r in rows("documents")] + [r[1] for r in ODD] + ["a a a a a a a", "a b c d e", "x " * 3000]:
        assert rules.measure((t or "").encode()) == brute_measure(t)


def test_repeated_words_where_ranks_do_not_fit_in_one_number():
    w = [b"%d" % (k % 9000) for k in range(20_000)]
    assert rules.repeated_words(w) == 20_000


def test_rules_query_on_odd_rows(spark):
    got = rules.quality_rules(odd(spark)).collect()
    want = Counter((r[0], *brute_measure(r[1])) for r in ODD)
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.host_ok)
    assert rules.quality_rules(empty(spark)).count() == 0


def test_a_bad_host_takes_its_documents(spark):
    good = " ".join(f"w{k}" for k in range(30))
    docs = [(k, good if h != "bad" or k % 10 == 0 else "short", None, h, 0) for k, h in enumerate(["bad"] * 50 + ["ok1"] * 50 + ["ok2"] * 50)]
    docs += [(999, "short", None, "tiny", 0)]
    got = {r.doc_id: r for r in rules.quality_rules(spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")).collect()}
    assert not got[0].base_failed and not got[0].kept          # a good text on a bad host
    assert got[60].kept and got[120].kept
    assert got[999].host_ok or got[999].base_failed


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet"))


def test_held_out_accuracy(spark, model):
    s = quality.score_documents(spark.read.parquet(f"{SF2}/documents.parquet"), model)
    got = s.join(spark.read.parquet(f"{SF2}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    right = defaultdict(list)
    for r in got:
        right[r.quality].append(r.predicted == r.quality and 0 <= r.score <= 1)
    assert np.mean(right[1]) > 0.95 and np.mean(right[0]) > 0.8


def test_score_is_the_mean_of_feature_weights(spark, model):
    for t in ["the the cat", "a", "", "Ab&& x"]:
        f = quality.features(t.encode())
        n = sum(f.values())
        z = model.bias + (sum(model.weight[b] * c for b, c in f.items()) / n if n else 0)
        got = quality.scorer(model)()([t.encode()])[0].to_pylist()[0]
        assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
        words = t.encode().split()
        assert quality.count_features(words) + sum(a == b for a, b in zip(words, words[1:])) == n


def test_quality_on_odd_and_empty(spark, model):
    got = quality.score_documents(odd(spark), model)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(ODD)
    kept = quality.keep_good(odd(spark), model, limit=0.0)
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD)
    assert quality.score_documents(empty(spark), model).count() == 0
    none = quality.fit(empty(spark), spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert quality.score_documents(odd(spark), none).where("score = 0.5").count() == len(ODD)


def test_training_does_not_see_held_out_rows(spark):
    docs = spark.createDataFrame([(k, f"w{k}") for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    a = quality.fit(docs, labels)
    b = quality.fit(docs, labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert np.array_equal(a.weight, b.weight)


def unigram():
    from tokenizers import Tokenizer, models

    return Tokenizer(models.Unigram(viterbi.vocabulary(), unk_id=0, byte_fallback=True))


def test_viterbi_counts_equal_the_library():
    t, c = unigram(), viterbi.Counter(viterbi.vocabulary())
    texts = [r["text"] for r in rows("documents")][:120] + [r[1] for r in ODD if r[1] and len(r[1]) < 9000] + ["a\n\nb\tc", "  x", "▁▁a"]
    for x in texts:
        assert c.count(x) == len(t.encode("▁" + x.replace(" ", "▁"), add_special_tokens=False).ids), x[:60]


def test_viterbi_equals_an_exhaustive_search():
    pieces = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -3.0), ("aba", -5.0), ("▁", -1.0)]
    c = viterbi.Counter(pieces)
    score = dict(pieces)

    def best(s):     # (score, starts): the best path; among equal scores the earliest start of the last piece, and so on
        if not s:
            return (0.0, 0)
        got = None
        for k in range(len(s)):
            p = s[k:]
            if p in score or len(p) == 1:
                z, n = best(s[:k])
                z += score.get(p, min(score.values()) - 10)
                if got is None or z > got[0]:
                    got = (z, n + (1 if p in score else len(p.encode())))
        return got

    from itertools import product
    for n in range(1, 8):
        for x in product("abé", repeat=n):
            assert c.viterbi("".join(x)) == best("".join(x))[1]


def test_token_counts_on_odd_and_empty(spark):
    got = viterbi.token_counts(odd(spark))
    assert got.count() == len(ODD) and got.where("doc_id in (1, 2)").agg(F.sum("n_tokens")).first()[0] == 0
    assert viterbi.token_counts(empty(spark)).count() == 0


def test_ids_of_words_equal_the_tokenizer():
    import random
    import public_tokenizers
    from tokenizers import Tokenizer

    t, ids = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)), packing.Ids(None)
    rng = random.Random(4)
    some = "abcXYZ019.,!?&$#%*|-_'\"<>()@éÉüÜßÿÞÀ×÷ªµ²½İΣςσ中文\u0301\u00a0\u2028\U0001f600"
    texts = ["".join(rng.choices(some + " \n", k=rng.randint(1, 30))) for _ in range(3000)] + [r["text"] for r in rows("documents")]
    texts += [chr(c) + x for c in range(0x21, 0x180) for x in ("", "a", "1")] + ["don't 's <|endoftext|>x", "A" * 300, "é" * 100]
    for x in texts:
        assert np.frombuffer(ids(x.encode()), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, x[:80]


def check_packed(docs, got, window=4096):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for d, x in docs:
        want[(d, tuple(t.encode(x or "", add_special_tokens=False).ids + [2]))] += 1
    seqs, by = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.ids_crc32 == zlib.crc32(r.ids) and r.length == len(ids) > 0
        seqs[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id, r.doc_tokens].append((r.start, ids))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= window
    ids_of = Counter()
    for (d, n), pieces in by.items():
        # equal rows of one id come as often as they are: take their pieces start by start
        starts = defaultdict(list)
        for s, ids in pieces:
            starts[s].append(ids)
        while starts[0]:
            at, out = 0, []
            while at < n:
                x = starts[at].pop()
                out += x.tolist()
                at += len(x)
            ids_of[(d, tuple(out))] += 1
        assert not any(starts.values())
    assert ids_of == want
    return seqs


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seqs = check_packed([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs, with_ids=True).collect())
    parts = docs.rdd.getNumPartitions()
    assert sum(4096 - sum(n for _, n in s) for s in seqs.values()) < 4096 * parts


def test_packing_odd_rows(spark):
    check_packed([(r[0], r[1]) for r in ODD], packing.pack(odd(spark), with_ids=True).collect())
    assert packing.pack(empty(spark)).count() == 0


def test_sum_of_squares_choice():
    rng = np.random.default_rng(1)
    p = packing.Packer(12, 0)
    for _ in range(400):
        size = int(rng.integers(1, 12))
        n = p.counts.copy()
        best = {}
        for g in range(0, 12):
            if (g == 0 or n[g]) and g + size <= 12:
                m = n.copy()
                if g:
                    m[g] -= 1
                if g + size < 12:
                    m[g + size] += 1
                best[g] = int((m ** 2).sum())
        p.place(size, (0, 0, b"\0" * 4 * size, size))
        assert int((p.counts ** 2).sum()) == min(best.values())
        assert all(p.counts[g] == len(p.open.get(g, [])) for g in range(13))


def targets_of(docs):
    """(source -> target) by the rule's own words: share, stop at twice the size, share the excess again."""
    size = Counter()
    for d in docs:
        size[d[3]] += len(WORD.findall(d[1] or ""))
    names = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in size else [])
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    t, free, left = dict.fromkeys(names, 0.0), set(names), 1.5 * sum(size.values())
    while left > 1e-9 and free:
        total = sum(w[s] for s in free)
        for s in free:
            t[s] += left * w[s] / total
        left = 0.0
        for s in list(free):
            if t[s] >= 2 * size[s]:
                left += t[s] - 2 * size[s]
                t[s] = 2.0 * size[s]
                free.discard(s)
    return size, t


@pytest.mark.parametrize("which", ["sf", "odd"])
def test_mix(spark, which):
    df = spark.read.parquet(f"{SF2}/documents.parquet") if which == "sf" else odd(spark)
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]
    size, target = targets_of(docs)
    got = mixing.mix(df)
    rows_ = got.collect()
    assert Counter((r.doc_id, r.size) for r in rows_) == Counter((d[0], len(WORD.findall(d[1] or ""))) for d in docs)
    by_target = defaultdict(float)
    for r in rows_:
        assert r.taken in (0, r.size, 2 * r.size)
        by_target[r.source_size, round(r.target, 6)] += r.taken
    assert {(size[s], round(t, 6)) for s, t in target.items()} == set(by_target)
    if which == "sf":
        for (s, t), n in by_target.items():
            assert abs(n - t) <= 0.02 * t
    assert Counter(map(tuple, rows_)) == Counter(map(tuple, mixing.mix(df.repartition(3)).collect()))


def test_rates_solve_the_dual(spark):
    """The mean rate of a source is an exponential tilt cut at the limit, and its words meet the target."""
    docs = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "source", mixing.word_count("text").alias("size"))
    per = mixing.source_targets(docs)
    lam = {r.source: r for r in mixing.tilts(docs, per).collect()}
    want = {r.source: r for r in per.collect()}
    size = defaultdict(list)
    for r in docs.collect():
        size[r.source].append(r.size)
    for s, r in lam.items():
        if r.lam is not None:
            x = np.array(size[s], float)
            assert (x * np.minimum(2, np.exp(r.lam * x / r["mean"]))).sum() == pytest.approx(want[s].target, rel=1e-8)


def test_mix_empty_and_copies(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
    df = odd(spark)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    want = sum(r.taken // r.size for r in mixing.mix(df).collect() if r.size)
    assert out.count() == want


def test_fit_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"good text {k}" if k % 2 else f"bad line {k}") for k in range(40)] + [(1, "x y")] * 500 + [(1, "z")] * 500,
                                 "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, **kw: seen.extend(rows))
    quality.fit(docs, labels)
    ids = [r.doc_id for r in labels.where(~quality.held_out("doc_id")).collect()]
    assert 1 in ids and len(seen) == len(ids)


def test_mixed_documents_keeps_rows_that_share_an_id(spark):
    """Many null ids, one id with two texts in two sources, and empty texts among the null ids."""
    data = [(None, f"null id {k} " + "w " * (k % 7), "a", k) for k in range(60)] + [(None, "", "a", 60), (None, None, "b", 61)]
    data += [(1, "one id, first text", "a", 62), (1, "one id, the second and longer text", "b", 63)]
    data += [(10 + k, f"own id {k} " + "v " * (k % 5), "b", 64 + k) for k in range(40)]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, _row int")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = Counter(map(tuple, out.collect()))
    assert set(got) <= set(data) and all(r[1] for r in got) and max(got.values()) <= mixing.LIMIT
    words = Counter()
    for r, n in got.items():
        words[r[2]] += n * len(r[1].split())
    info = {r.source: r for r in mixing.source_targets(df.select("source", mixing.word_count("text").alias("size"))).collect()}
    for s in "ab":
        assert abs(words[s] - info[s].target) <= 10
    assert sum(r[0] is None for r in got) > 20
    assert got == Counter(map(tuple, mixing.mixed_documents(df.repartition(3)).collect()))


def test_fitted_features_come_to_the_driver_once_and_not_as_python_objects(spark, monkeypatch):
    import tracemalloc
    texts = {k: " ".join(f"w{(k * 7919 + j * j) % 99991}x{j}" for j in range(3000)) for k in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in texts], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, **kw: seen.extend(rows))
    quality.fit(docs, labels)      # imports and caches are made
    seen.clear()
    tracemalloc.start()
    quality.fit(docs, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = sorted((r.doc_id for r in labels.where(~quality.held_out("doc_id")).collect()), key=str)
    assert [y for _, _, y in seen] == [k % 2 for k in ids]
    for k, (idx, cnt, _) in zip(ids, seen):
        assert dict(zip(idx.tolist(), cnt.tolist())) == quality.features(texts[k].encode())
    n = sum(len(i) for i, _, _ in seen)
    assert n > 100_000 and peak < 20 * n, (n, peak)      # as Python lists and 64-bit copies: over 40 bytes a feature
