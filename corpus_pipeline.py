"""Corpus pipeline over ``documents``: toxicity, line dedup, near duplicates, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import linededup, packing, pii, simhash, toxicity
from rillet.llm.common import cut, table
from rillet.llm.queries import fit_toxicity, vocabulary


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text, where ``docs`` has that column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from the labels outside the held-out fold."""
    model = fit_toxicity(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, column="__toxicity")
    return scored.filter("__toxicity < 0.5").drop("__toxicity")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen in a document of a smaller doc_id go; the texts are rewritten."""
    return _with_length(linededup.drop_repeated(docs, least=10).select(*[F.col(f"`{c}`") for c in docs.columns]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component of texts one row stays: that of the smallest doc_id, and
    of several texts of that doc_id the one of the least hash.

    Rows without doc_id stay. Different texts of one doc_id are not tied by it.
    """
    stay = simhash.one_of_each(docs, words=4, seed=42, distance=4).select(
        F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__stay"))
    hashed = docs.filter("doc_id IS NOT NULL").withColumn("__hash", simhash.text_hash())
    left = (hashed.join(stay, (F.col("doc_id").cast("long") == F.col("__doc")) & (F.col("__hash") == F.col("__stay")),
                        "left_semi").dropDuplicates(["doc_id", "__hash"]).drop("__hash"))
    return docs.filter("doc_id IS NULL").unionAll(left)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind in brackets."""
    return _with_length(pii.mask(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document's tokens, with the ids."""
    # workers go on to other stages: half of the usual memo, and none after a task
    return packing.pack(docs, vocabulary(), max_length=4096, memo_words=200_000, keep_memo=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: The toxicity, SimHash and packing stages cannot be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
