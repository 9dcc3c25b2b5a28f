"""Registered queries of the corpus operators, one an operator, with DuckDB SQL where it can say the same.

Each query applies its operator to its whole table and derives digest columns from what the operator returns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, bpe, bytebpe, langid, lattice, linededup, packing, pii, repair, simhash, substring, topk,
               toxicity)
from .common import sha256_hex, table

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def _rest(doc_id, parts: int):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names, matrix = langid.fit(docs.filter(_rest("doc_id", 3) != 1))
    return (langid.predict(docs.select("doc_id", "text"), names, matrix)
            .select("doc_id", (_rest("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "pii")
    counts = [pii.count("pii", k).alias(f"n_{k}") for k in pii.BASE]
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *counts, sha256_hex(pii.listed(base)).alias("base_sha256"),
                        pii.listed(F.col("pii")).alias("spans"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.drop_repeats(table(spark, sf_dir, "documents"), length=13, digest=True)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"), least=10, digest=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (toxicity.score(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
            .select("doc_id", (_rest("doc_id", 5) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def fit_toxicity(docs: DataFrame, labels: DataFrame):
    """The model learned from labelled documents outside the held-out fold."""
    marked = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    return toxicity.fit(docs.filter(_rest("doc_id", 5) != 0).select("doc_id", "text"), labels=marked)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, seed=42, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.93)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"),
                           digest=True).withColumnRenamed("groups", "groups_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(conversations), conversations)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_pii, op3_bpe, op4_packing, op5_substring_dedup, op6_exact_topk, op7_line_dedup,
    op8_toxicity, op9_simhash, op10_lattice_dedup, op11_byte_bpe, op12_token_alignment,
    op13_conversation_repair)}

ORACLE_SQL = {
    "op5_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents),
        win AS (
            SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS p FROM w WHERE len(words) >= 13)),
        low AS (SELECT win, min(doc_id) AS low FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)),
        gone AS (
            SELECT DISTINCT doc_id, p + o AS pos
            FROM (SELECT win.doc_id, win.p FROM win JOIN low ON win.win = low.win AND low.low < win.doc_id) d,
                 (SELECT unnest(range(0, 13)) AS o) s),
        cut AS (SELECT doc_id, list(pos) AS ats, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ')
                           ELSE array_to_string(list_select(words, list_filter(range(1, len(words) + 1),
                                                lambda x: NOT list_contains(ats, x))), ' ') END) AS kept_sha256
        FROM w LEFT JOIN cut ON w.doc_id = cut.doc_id""",
    "op6_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 5""",
    "op7_line_dedup": r"""
        WITH l AS (
            SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
        k AS (
            SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        low AS (SELECT key, min(doc_id) AS low FROM k WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
        j AS (SELECT k.doc_id, k.pos, k.line, coalesce(low.low < k.doc_id, false) AS gone FROM k LEFT JOIN low ON k.key = low.key)
        SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
}
