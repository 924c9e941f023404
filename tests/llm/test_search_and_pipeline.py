"""Top-k search, the pipeline and the registered queries."""

import collections
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from lineloom.llm import packing, queries, topk

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not here")


def best(rows, k):
    """{query: [(rank, id, score)]} by comparing all."""
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, a in {(i, tuple(v)) for i, v in sound if i % 5 == 0}:
        found = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in sound if i != q)[:k]
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return out


@pytest.mark.parametrize("per_block, per_query_block", [(4096, 512), (13, 4)])
def test_top_k_equals_brute_force(spark, per_block, per_query_block):
    rng = random.Random(per_block)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.0, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(90)]
    rows += [(200 + i, [0.5] * 6) for i in range(30)] + [(7, rows[7][1]), (10, rows[10][1])]
    rows += [(None, [1.0] * 6), (301, None), (302, [1.0, None]), (305, [float("nan")]), (306, [float("inf")] * 6), (310, []), (311, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"block": F.lit(1), "score": F.lit("x")})
    ints = topk.whole_numbers(df, key="vec_id", vector="embedding")
    found = topk.top_k(ints, ints.where("id % 5 = 0"), k=4, per_block=per_block, per_query_block=per_query_block)
    got = collections.defaultdict(list)
    for r in found.collect():
        got[r.query_id].append((r["rank"], r.id, r.score))
    assert {q: sorted(v) for q, v in got.items()} == best(rows, 4)


def test_top_k_with_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    ints = topk.whole_numbers(df, key="vec_id", vector="embedding")
    assert [(r.query_id, r.id, r.score) for r in topk.top_k(ints, ints.where("id = 0")).collect()] == [(0, 1, 131072)]
    assert topk.top_k(ints.limit(0), ints.limit(0)).count() == 0 == topk.top_k(ints, ints.limit(0)).count()


def test_large_numbers_stay_exact():
    big = np.array([[2**30, 2**30 + 1], [2**30, 2**30]], np.int64)
    (rows, scores), = topk.best_of_block(np.array([[2**30, 1]], np.int64), np.array([-1]), np.array([1, 2]), big, 2)
    assert scores.tolist() == [2**60 + 2**30 + 1, 2**60 + 2**30]


# -- pipeline ------------------------------------------------------------------------


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit(1))


@needs_data
def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = frame(spark, [(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "12 34", None, "s", 5), (10**6, None, None, None, None)])
    docs = docs.unionByName(odd.drop("score"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before = docs.collect()
    quality = corpus_pipeline.quality_stage(spark, docs.withColumn("_score", F.lit("clash")), SF_DIR)
    assert quality.columns == corpus_pipeline.COLUMNS
    kept = {r.doc_id for r in quality.collect()}
    good = [k for k, q in labels.items() if q == 1]
    assert sum(k in kept for k in good) > 0.95 * len(good)
    known = corpus_pipeline.language_stage(spark, docs, SF_DIR).collect()
    texts = {r.doc_id for r in before if r.text and re.search(r"[^\W\d_]", r.text)}
    assert {r.doc_id for r in known} == texts and all(r.lang for r in known)
    lines = corpus_pipeline.line_stage(spark, docs, SF_DIR).collect()
    assert all(r.text is None or r.n_chars == len(r.text) for r in lines if r.doc_id is not None and r.doc_id < 10**6)
    assert sum(r.text is None for r in lines) == 2 and any(r.text == "" for r in lines)
    near = corpus_pipeline.near_stage(spark, docs, SF_DIR).collect()
    texts = [r.text for r in near if r.text]
    assert len(texts) == len(set(texts)) and {r.text for r in before} >= set(texts)
    shingles = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    some = [shingles(t) for t in texts[:120]]
    assert not any(10 * len(a & b) >= 8 * len(a | b) for i, a in enumerate(some) for b in some[:i])
    assert set(corpus_pipeline.packing_stage(spark, docs.limit(3), SF_DIR).columns) == {c.split()[0] for c in packing.PIECE_SCHEMA.split(", ")} | {"ids_crc32"}


@needs_data
def test_run_equals_the_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    wanted = sorted((r.doc_id, r.doc_tokens) for r in docs.where("start = 0").collect())
    assert sorted((r.doc_id, r.doc_tokens) for r in corpus_pipeline.run(spark, SF_DIR).where("start = 0").collect()) == wanted
    assert len(wanted) > 50 and corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_language_stage_judges_by_code_length(spark):
    rng = random.Random(5)
    words = {"en": "the house and this other thing with some words there", "de": "das haus und dieses andere ding mit einigen worten dort"}
    text = lambda lang: " ".join(rng.choice(words[lang].split()) for _ in range(60))
    rows = [(i, text("de" if i % 2 else "en"), "de" if i % 2 else "en", "s", 0) for i in range(120)]
    garbled = ["".join(rng.choice("qxzjkvwyp ") for _ in range(400)), "Этого языка модель не знает совсем. " * 8]
    odd = [(200 + i, t, None, "s", 0) for i, t in enumerate([*garbled, text("en")])]
    known = corpus_pipeline.language_stage(spark, frame(spark, rows + odd), "").collect()
    assert {r.doc_id for r in known} == {*range(120), 202}
    unlabelled = frame(spark, [(i, t, None, "s", 0) for i, t in enumerate([*garbled, None, "a"])])
    assert corpus_pipeline.language_stage(spark, unlabelled, "").count() == 4


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, []).drop("score")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


# -- registered queries -------------------------------------------------------------------


def test_one_query_per_operator():
    names = [n for n in queries.QUERIES if n != "pipeline"]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(queries.QUERIES) <= set(entry_point.queries()) and set(queries.ORACLE) <= set(queries.QUERIES)


@needs_data
@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    cursor = con.execute(queries.ORACLE[key])
    names = [c[0] for c in cursor.description]
    df = queries.QUERIES[key](spark, SF_DIR)
    assert sorted(df.columns) == sorted(names)
    assert collections.Counter(map(tuple, df.select(*names).collect())) == collections.Counter(cursor.fetchall())
