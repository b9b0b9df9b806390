"""A training corpus from raw documents, stage by stage.

Each stage gets the session, the documents its predecessor kept and the folder of the
tables, and returns documents with their columns (the last one: token ids and text).
``run`` writes every stage's result as Parquet into the shared folder and reads it
again, so that a lost executor costs one stage at most.

A row without a doc_id is kept by every stage that decides by document; null texts are
empty texts and stay null. Empty tables give empty results. Extra columns travel along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, near_dup, pii, toxicity
from ledgerline.llm.queries import BYTE_BPE, documents
from ledgerline.session import settle, work_dir


def _kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text) ``decided`` keeps; rows without doc_id stay."""
    gone = settle(decided.where("not keep and doc_id is not null").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go. Of rows that share a doc_id one toxic text is enough."""
    scored = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(docs, scored.select("doc_id", (F.col("predicted") == 0).alias("keep")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similar sets of five-word shingles connect, the one with the smallest doc_id stays."""
    found = near_dup.near_duplicates(docs, size=5, percent=80)
    kept = _kept(docs, found.select("doc_id", F.col("kept").alias("keep")))
    # rows that share a doc_id are one document, so repeated rows are its copies
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))


def reject_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go if at least 5 percent of their words are in verbatim windows of benchmark items."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _kept(docs, found.select("doc_id", (~decontaminate.is_contaminated()).alias("keep")))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows where it is a column."""
    masked = pii.masked(docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    changed = F.when(F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", changed)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the ids spell."""
    return bpe.encode_and_decode(docs, BYTE_BPE).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text")
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", reject_benchmark),
    ("personal_data", mask_personal_data),
    ("bpe", encode),
]

#: SQL cannot express the classifier, the sketches or the merges; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
