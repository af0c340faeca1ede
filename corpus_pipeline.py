"""Training-data pipeline over ``documents``: five stages, each over all that the one before kept.

Every stage but the last returns the columns of documents; a null text leaves
the first stage as the empty text. Stages are written as Parquet in the shared
scratch folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.llm import decontaminate, pii, sentence_pieces, simhash, toxicity
from eventflow.llm.common import col, only, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = [c for c in COLUMNS if c not in ("doc_id", "text")]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the operator's threshold go."""
    rated = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=OTHERS, keep_text=True)
    return rated.where(F.col("predicted") == 0).select(*[col(rated, c) for c in COLUMNS])


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (four-word shingles, four bits) the document with the smallest id stays.

    Rows that share that id: the one with the smallest text digest, then the smallest row.
    """
    found = simhash.near_duplicates(docs, shingle=4, max_bits=4, carry=OTHERS, keep_text=True)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    least = first.groupBy("component_fp").agg(F.min(F.struct(F.xxhash64("text").alias("tk"), *COLUMNS)).alias("row"))
    return least.select(*[F.col(f"row.{c}") for c in COLUMNS])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = staged(found.select(F.col("doc_id").alias("bad_id"), "text_key").distinct(), "pipeline-contaminated")
    marked = only(docs, COLUMNS).select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_key"))
    return (marked.join(found, marked["doc_id"].eqNullSafe(found["bad_id"]) & (marked["_key"] == found["text_key"]), "left_anti")
            .select(*COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows."""
    done = pii.redact_pii(only(docs, COLUMNS))
    return done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document that is left."""
    import public_tokenizers
    got = sentence_pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["lang", "source"])
    return got.select("doc_id", "lang", "source", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", keep_one_near_copy),
    ("benchmark decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("sentence pieces", encode),
]

#: SQL cannot express the stages; tests hold each against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
