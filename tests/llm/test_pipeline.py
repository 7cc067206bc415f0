import hashlib

import duckdb
import pytest

import corpus_pipeline
from dqloom.llm import jaccard_join, queries
from dqloom.llm.common import read_table, written

from .helpers import shingles
from .test_decontaminate import brute as brute_hits
from .test_jaccard_join import brute as brute_components
from .test_tokens_and_packing import check_sequences, library

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), name)
        out.append(docs)
    return out


def test_stages_keep_what_they_must(spark, stages):
    docs = read_table(spark, SMALL, "documents")
    identified, distinct, apart, clean, packed = stages
    assert all(s.columns == docs.columns for s in stages[:4])
    assert identified.count() == docs.where(docs.text.rlike(r"\p{L}")).count()
    rows = identified.collect()
    firsts = {}
    for r in rows:
        key = " ".join((r.text or "").replace("\n", " ").replace("\t", " ").split(" "))
        firsts[key] = min(firsts.get(key, r.doc_id), r.doc_id)
    assert {r.doc_id for r in distinct.collect()} == set(firsts.values())
    rows = distinct.collect()
    ids = [r.doc_id for r in rows]
    want = {c for _, n, c in brute_components([r.text for r in rows], ids) if n} | {i for i, r in zip(ids, rows, strict=True) if not shingles(r.text)}
    assert {r.doc_id for r in apart.collect()} == want
    rows = apart.collect()
    items = [(str(r.item_id), r.text) for r in read_table(spark, SMALL, "benchmark").collect()]
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r, b in zip(rows, brute_hits([r.text for r in rows], items), strict=True) if not b[4]}
    rows = clean.collect()
    ids = dict(zip([r.doc_id for r in rows], library("word_bpe_49k.json", [r.text for r in rows]), strict=True))
    pieces = packed.collect()
    assert sum(p.length for p in pieces) == sum(len(x) + 1 for x in ids.values()) and {p.doc_id for p in pieces} == set(ids)
    check_sequences(pieces)


def test_run_is_the_stages(spark, stages):
    digest = lambda df: hashlib.sha256(str(sorted(map(tuple, df.select("doc_id", "start", "length", "ids_crc32").collect()))).encode()).hexdigest()
    assert digest(corpus_pipeline.run(spark, SMALL)) == digest(stages[-1])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.sql(queries.SQL[name])
    got = queries.QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert jaccard_join.PERCENT == 80 and jaccard_join.SHINGLE == 5
