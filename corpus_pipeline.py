"""The training-data pipeline: five stages over ``documents``, each written and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what the next one reads.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.llm import bpe, decontaminate, jaccard, quality, secrets
from creatorlens.llm.common import table, written

QUALITY_LEAST = 0.5
NEAR_WORDS, NEAR_PERCENT = 5, 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the factorisation machine scores ``QUALITY_LEAST`` or more.

    The score lies beside the documents under a name that they don't have."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = "score"
    while score in docs.columns:
        score = f"_{score}"
    return quality.scored(docs, model, out=score).filter(F.col(score) >= QUALITY_LEAST).select(*docs.columns)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies (5-word shingles, Jaccard 0.8)."""
    return jaccard.one_of_each(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents into which a benchmark item leaks."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; all documents stay."""
    return secrets.redact(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of every document."""
    import public_tokenizers
    encoded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: SQL can't express the classifier; ``tests/llm`` hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
