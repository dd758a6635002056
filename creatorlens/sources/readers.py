"""Readers with explicit schemas.

* S1/S2/S3: header CSV with a declared schema - no inference pass over the data.
* S4: all post files in ONE text scan; the owning user is taken from the file
  name (``_metadata.file_path``) instead of one scan per user.
* S5: JSON documents (one per file, or one per line) as raw strings for
  ``parse_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

INFLUENCER_SCHEMA = StructType([
    StructField("username", StringType()),
    StructField("category", StringType()),
    StructField("followers", StringType()),
])

FEATURE_SCHEMA = StructType([
    StructField("username", StringType()),
    StructField("engagement_rate", DoubleType()),
    StructField("alignment_genZ", DoubleType()),
    StructField("category", StringType()),
    StructField("hashtag_score", DoubleType()),
])


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Parquet table of the test data set (column pruning and filters reach the scan)."""
    return spark.read.parquet(table_path(base, name))


def read_influencers(spark: SparkSession, path: str, schema: StructType = INFLUENCER_SCHEMA) -> DataFrame:
    """S1 + P2 + P3: header CSV of influencers; the third column becomes
    ``followers`` whatever its header says.  Numeric text (also ``"12.0"``) is
    truncated to an int; malformed or out-of-range text becomes NULL."""
    raw = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    third = raw.columns[2]
    return raw.withColumnRenamed(third, "followers").withColumn(
        "followers", F.trim(F.col("followers")).try_cast("double").try_cast(IntegerType()))


def read_features_csv(spark: SparkSession, path: str, schema: StructType | None = FEATURE_SCHEMA,
                      infer: bool = False) -> DataFrame:
    """Header CSV; declared schema by default, ``infer=True`` for an inference pass."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


POST_FILE_KEY = r"([^/]+?)(?:\.(?:txt|json|jsonl|ndjson))?(?:\.gz)?$"


def read_post_files(spark: SparkSession, path: str, key_pattern: str = POST_FILE_KEY) -> DataFrame:
    """Every post line of every file under ``path`` in one scan.

    Output ``file_key, value``: ``file_key`` is the file name without a text
    or JSON extension (dots of user names stay), which J2 matches to user names exactly or by
    prefix.  One JSON document per line, as the post metadata is written.
    """
    df = spark.read.option("recursiveFileLookup", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), key_pattern, 1)
    # the path is percent-encoded; a plus sign in it is a plus sign
    return df.select(F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("file_key"), F.col("value"))


def read_json_documents(spark: SparkSession, path: str, whole_file: bool = True) -> DataFrame:
    """Raw JSON documents, one per file (``wholetext``) or one per line.
    Output ``doc_id`` (file path, or path and the line's hash) and ``json``."""
    if whole_file:
        df = spark.read.text(path, wholetext=True)
        return df.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("json"))
    df = spark.read.text(path)
    return df.select(F.concat_ws(":", F.col("_metadata.file_path"),
                                 F.sha2(F.col("value"), 256)).alias("doc_id"),
                     F.col("value").alias("json"))
