"""Registered corpus queries against their SQL, and the pipeline against its brute-force version."""

import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from inkmill.llm import bpe
from inkmill.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from tests.llm.samples import in_order, jaccard_results, line_results, rule_measures


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, db, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall()
    assert in_order(map(tuple, found.select(*columns).collect())) == in_order(want)


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))


def test_pipeline_stages(spark, db):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "line_dedup", "near_duplicates", "source_mix", "encoding"]

    kept = stage["quality_rules"](spark, docs, SF_DIR)
    verdict = dict(db.sql(f"SELECT doc_id, kept FROM ({ORACLES['op2_quality_rules']})").fetchall())
    rows = [r for r in rows if verdict[r[0]]]
    assert in_order((r.doc_id, r.text, r.source) for r in kept.collect()) == in_order(rows)
    assert all(rule_measures(t)[0] >= 50 for _, t, _ in rows)

    from inkmill.llm.common import saved

    deduped = saved(stage["line_dedup"](spark, saved(kept), SF_DIR))
    rows = [(i, k if d else t, s) for (i, t, s), (_, _, d, k) in zip(rows, line_results(rows), strict=True)]
    assert in_order((r.doc_id, r.text, r.source) for r in deduped.collect()) == in_order(rows)

    single = saved(stage["near_duplicates"](spark, deduped, SF_DIR))
    heads = jaccard_results(rows)
    rows = [r for r in rows if heads[r[0]][1] == r[0]]
    assert in_order((r.doc_id, r.text, r.source) for r in single.collect()) == in_order(rows)

    mix = saved(stage["source_mix"](spark, single, SF_DIR))
    assert mix.columns == docs.columns
    single.toPandas().to_parquet(path := f"/tmp/inkmill-single-{id(db)}.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    times = {i: t // max(1, s) for i, t, s in con.sql(f"SELECT doc_id, taken, size FROM ({ORACLES['op1_mix']})").fetchall()}
    rows = [r for r in rows for _ in range(times[r[0]])]
    assert in_order((r.doc_id, r.text, r.source) for r in mix.collect()) == in_order(rows)

    done = stage["encoding"](spark, mix, SF_DIR).collect()
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert in_order((r.doc_id, r.n_tokens) for r in done) == in_order((i, len(own.encode_ordinary(t))) for i, t, _ in rows)
    assert in_order((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF_DIR).collect()) == in_order((r.doc_id, r.n_tokens) for r in done)
