"""The registered queries and the pipeline, stage by stage."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from annolake.llm import quality
from annolake.llm.oracles import ORACLES
from annolake.llm.queries import QUERIES
from tests.llm.data import SF, SF2, empty, odd
from tests.llm.test_near_ops import brute_components
from tests.llm.test_text_ops import check_packed


def test_names():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF2}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF2)
    assert sorted(got.columns) == sorted(want.columns)
    cols = ", ".join(sorted(got.columns))
    assert Counter(map(tuple, got.select(*sorted(got.columns)).collect())) == Counter(map(tuple, con.sql(f"SELECT {cols} FROM ({ORACLES[name]})").fetchall()))


def test_stages(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{SF2}/labels.parquet"))
    score = {r.doc_id: r.predicted for r in quality.score_documents(docs, model).collect()}
    got = dict(corpus_pipeline.STAGES)
    a = got["quality_classifier"](spark, docs, SF2).cache()
    assert a.columns == docs.columns and {r.doc_id for r in a.select("doc_id").collect()} == {d for d, p in score.items() if p}
    b = got["simhash_near_dedup"](spark, a, SF2).cache()
    want = brute_components([(r.doc_id, r.text) for r in a.collect()])
    assert b.columns == docs.columns and sorted(r.doc_id for r in b.select("doc_id").collect()) == sorted({w[3] for w in want})
    c = got["personal_data"](spark, b, SF2).cache()
    assert c.columns == docs.columns and c.count() == b.count()
    d = got["source_mix"](spark, c, SF2).cache()
    assert d.columns == docs.columns
    rows = d.collect()
    have = {r.doc_id: tuple(r) for r in c.collect()}
    assert all(tuple(r) == have[r.doc_id] for r in rows) and max(Counter(r.doc_id for r in rows).values()) == 2
    e = got["packing"](spark, d, SF2)
    check_packed([(r.doc_id, r.text) for r in rows], e.collect())


@pytest.mark.parametrize("make", [odd, empty])
def test_stages_on_odd_rows(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.count()
        if name != "packing":
            assert out.columns == docs.columns
            docs = out


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
