"""The registered queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import (collocations, decontaminate, licenses, merkle, permutation_index, pii, quality, sentence_pieces, sentence_spans,
                           simhash, suffix_dedup, token_files, toxicity)
from eventflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 256 bytes: a passage of over 50 words, which 400 bytes may be longer than
    got = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), length=400, passage=256)
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage", "n_passages")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "item_id", "n_tiles", "covered", "item_words", "coverage")


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sentence_spans.deduplicate(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", "n_pieces", "n_pieces_removed",
                      F.sha2("kept", 256).alias("kept_sha256"))


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    got = sentence_pieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.find_pii(table(spark, sf_dir, "documents"))
    counts = [pii.count_kind(F.col("base_spans"), k).alias(f"n_{k}") for k in pii.BASE_KINDS]
    return got.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    got = token_files.read(spark, path, docs.schema["doc_id"].dataType, tokens=False)
    return got.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    got = merkle.manifest(docs, tampered={"n_chars": more}, when=F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return got.select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.proof(F.col("path"))).alias("proof_sha256"),
                      "folded_root", "verified")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = collocations.collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000)
    return got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_toxicity": op5_toxicity,
    "op6_decontaminate": op6_decontaminate,
    "op7_sentence_spans": op7_sentence_spans,
    "op8_sentence_pieces": op8_sentence_pieces,
    "op9_pii": op9_pii,
    "op10_permutation_index": op10_permutation_index,
    "op11_token_files": op11_token_files,
    "op12_merkle": op12_merkle,
    "op13_collocations": op13_collocations,
}

ORACLE: dict[str, str] = {
    "op4_licenses": licenses.oracle_sql(),
    "op12_merkle": merkle.oracle_sql(),
    "op13_collocations": collocations.oracle_sql(),
}
