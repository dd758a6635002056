"""Sinks (S6-S8, S10).  One write of the whole result; ``overwrite`` by
default because ``append`` re-runs duplicate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """Header CSV directory."""
    df.write.mode(mode).option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink; ``partition_by=["category"]`` lets category filters prune files."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


GROUPS = 64


def write_user_folders(posts: DataFrame, path: str, owner: str) -> None:
    """Text lines (every column but ``owner``) as one folder and one file per user, ``group=<hash>/<owner>=<user>/``.

    Each user's rows meet in one task, so there are as many files as users, not users times tasks; the number of tasks
    is stated, as the cost is in the files and not in the bytes that Spark would join them by.  The folders lie below
    ``GROUPS`` others, so that a reader lists them in that many tasks instead of one for each user; a task writes a whole
    group, which the driver then moves into place as one folder instead of user by user."""
    group = F.pmod(F.xxhash64(owner), F.lit(GROUPS)).cast("int")
    rows = posts.withColumn("group", group).repartitionById(GROUPS, "group")
    rows.write.mode("overwrite").partitionBy("group", owner).text(path)


def as_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON record string (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("record"))
