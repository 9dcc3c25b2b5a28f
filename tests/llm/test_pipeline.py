"""The pipeline's stages against plain versions on a small table, and the registered queries on a given one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from rillet.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_stages_on_a_small_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = docs.withColumn("part", F.lit("kept")).unionByName(
        docs.filter("doc_id < 3").withColumn("part", F.lit("again"))).unionByName(
        spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes], F.lit("null").alias("part")))
    for name, stage in corpus_pipeline.STAGES:
        before = docs.select("doc_id", "text").collect()
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = docs.collect()
        if name == "toxicity":
            assert 0.5 * len(before) < len(after) <= len(before)
        if name == "line_dedup":
            kept = sorted((d or -1, h) for d, _, _, h in brute.line_dedup([tuple(r) for r in before]))
            import hashlib
            assert sorted((r.doc_id or -1, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in after) == kept
        if name == "simhash_near_dedup":
            comp = brute.simhash_components([(r.doc_id, r.text) for r in before if r.doc_id is not None])
            assert sorted(r.doc_id for r in after if r.doc_id is not None) == sorted({d for d, _, c in comp if c == d})
        if name == "pii":
            assert all(not brute.pii_spans(r.text) for r in after)
            assert len(after) == len(before)
    assert {"doc_id", "start", "length", "ids"} <= set(docs.columns) and docs.count() > 0


def test_near_duplicates_with_repeated_doc_ids(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, one), (5, two), (5, two), (8, two), (9, one), (3, "another text of its own"), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()]
    assert sorted(got, key=str) == sorted([(5, one), (5, two), (3, "another text of its own"), (None, one)], key=str)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.schema(docs.schema).parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0


@pytest.fixture(scope="module")
def tables():
    import pyarrow.parquet as pq
    return (pq.read_table(f"{SMALL}/documents.parquet").to_pylist(), pq.read_table(f"{SMALL}/embeddings.parquet").to_pylist())


def test_queries_with_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        want = con.sql(sql).df()
        got = queries.QUERIES[name](spark, SMALL).select(*want.columns).toPandas()
        cols = list(want.columns)
        assert got.sort_values(cols).astype(str).values.tolist() == want.sort_values(cols).astype(str).values.tolist(), name


def test_held_out_language(spark, tables):
    lang = {d["doc_id"]: d["lang"] for d in tables[0]}
    got = queries.op1_language_id(spark, SMALL).collect()
    assert len(got) == len(lang)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (brute.fold(r.doc_id, 3) == 1) for r in got)
    right = [r.lang_pred == lang[r.doc_id] for r in held if r.lang_pred != "und" and lang[r.doc_id]]
    assert np.mean(right) > 0.95


def test_personal_data(spark, tables):
    got = {r.doc_id: r for r in queries.op2_pii(spark, SMALL).collect()}
    for d in tables[0]:
        spans = brute.pii_spans(d["text"])
        r = got[d["doc_id"]]
        assert r.base_sha256 == brute.pii_digest(d["text"])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in spans) for x in brute.KINDS]


def test_simhash_components(spark, tables):
    got = sorted(tuple(r) for r in queries.op9_simhash(spark, SMALL).collect())
    assert got == sorted(brute.simhash_components([(d["doc_id"], d["text"]) for d in tables[0]]))


def test_columns(spark):
    want = {"op3_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
            "op4_packing": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
            "op8_toxicity": {"doc_id", "held_out", "score", "predicted"},
            "op10_lattice_dedup": {"vec_id", "n_links", "component_id", "kept"}}
    for name, cols in want.items():
        df = queries.QUERIES[name](spark, SMALL)
        assert cols <= set(df.columns) and df.count() > 0
