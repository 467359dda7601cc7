"""Documents made ready for training: one operator after another, each on all that the one before kept.

Quality, near copies, benchmark passages, secrets, token ids. Every stage takes
the documents that the stage before wrote and returns documents; the last returns
their tokens. Fitting and statistics see the stage's own documents only, the
label and benchmark tables are read from ``sf_dir``.

The operators' rules for nulls, empty texts, repeated rows and empty tables hold
here too: a null text scores like an empty one, near copies of nothing are one
group, and what is left keeps all its columns. ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.bpe import encode_documents
from tillflow.llm.decontaminate import decontaminate
from tillflow.llm.quality import fit_quality, score_quality
from tillflow.llm.secret_scan import redact_live
from tillflow.llm.simhash import drop_near_duplicates
from tillflow.llm.tables import scratch_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "word_bpe_49k.json"


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.5 or more."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs.select(*COLUMNS), model).where("_score >= 0.5").drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each component of three-word fingerprints within two bits."""
    return drop_near_duplicates(docs.select(*COLUMNS), words=3, radius=2)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; those that are mostly such passages go."""
    return _documents(decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with live-looking credentials struck out."""
    return _documents(redact_live(docs.select(*COLUMNS)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of each document, and digests of them."""
    encoded = encode_documents(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY))
    return encoded.select(
        "doc_id",
        F.expr("octet_length(_ids) div 4").cast("long").alias("n_tokens"),
        F.col("_ids").alias("ids"),
        F.sha2("_ids", 256).alias("ids_sha256"),
        F.sha2("_decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", contamination),
    ("secret scans", secrets),
    ("BPE encoding and decoding", tokens),
]

# Classifiers, fingerprints and merges are beyond SQL; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_folder(spark, f"stage-{number}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
