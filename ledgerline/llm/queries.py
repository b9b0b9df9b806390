"""The registered queries of the text operators, with the digest columns of their results."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import ann, bpe, decontaminate, merkle, near_dup, pii, repeats, signature_join, spelling, token_count, token_files, toxicity, url_filter
from ledgerline.llm.oracles import ORACLES  # noqa: F401
from ledgerline.session import work_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_ids(documents(spark, sf), path, BYTE_BPE, end_id=2)
    return token_files.read_ids(spark, path).select(
        F.col("doc").alias("doc_id"),
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op2_bpe_automaton(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_and_decode(documents(spark, sf), BYTE_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


#: The contract's rules.
URL_RULES = (
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
)


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = url_filter.judge(spark.read.parquet(f"{sf}/pages.parquet"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf), size=2, percent=80)


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf), WORD_BPE)


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op8_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), top=5)


def op9_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    found = repeats.remove_repeats(documents(spark, sf), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.summary(documents(spark, sf))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(drawn, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.manifest(documents(spark, sf), tampered).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("siblings")), 256).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_spelling_groups(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_groups(documents(spark, sf), noise=spelling.DROPPED)


def op13_signature_join(spark: SparkSession, sf: str) -> DataFrame:
    return signature_join.similar_sets(documents(spark, sf), size=5, percent=80)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_bpe_automaton": op2_bpe_automaton,
    "op3_url_filter": op3_url_filter,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_personal_data": op10_personal_data,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_signature_join": op13_signature_join,
}
