"""Corpus cleaning in five stages over the table documents.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; each is written as
Parquet and read again.  All but the last return the columns of documents:

1. toxicity: documents that the classifier chain finds toxic go;
2. near_duplicates: of documents linked by the Jaccard similarity of their shingles one stays, that with the smallest id;
3. decontamination: documents that hold a passage of the benchmark go;
4. personal_data: confirmed spans are masked in the text, and n_chars follows it;
5. bpe: the token ids of every document, with a digest of their decoding.

SQL cannot express the classifier, so there is no SQL for the whole; tests hold every stage
against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.llm import codec, decontaminate, jaccard, pii, toxicity
from seriesmill.session import scratch_path

ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, _table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    both = codec.decode(codec.encode(docs), keep=("doc_id", "ids"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
