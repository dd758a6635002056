"""Session helpers: a local builder for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "creatorlens") -> SparkSession:
    """Local-mode session with the settings the library assumes (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CREATORLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is; there
    it must be set.  Only on a ``local`` master, where executors and driver are
    one process, a fresh folder under the system temp dir stands in for it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="creatorlens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def literal_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small DataFrame from Python literals, built JVM-side (``inline`` of a
    literal array) so that no Python worker is needed to scan it.

    ``schema`` is a DDL string such as ``"word string, polarity double"``.
    """
    fields = [f.strip().split()[:2] for f in schema.split(",")]
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for (n, t), v in zip(fields, row, strict=True)])
               for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a result that later steps scan several times.

    Reliable ``checkpoint()`` into the shared folder named by
    ``spark.checkpoint.dir`` (executor loss cannot lose it, unlike
    ``localCheckpoint``); the returned DataFrame reads the written copy, so the
    upstream plan runs once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Settings for large inputs (hundreds of TB on ~1000 executors).  AQE picks the
# final shuffle partition count from the advisory size, splits skewed join
# partitions and coalesces small ones; file splits stay at 128 MB.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}

# Settings that only the launch of a session can make.
LAUNCH_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def apply_cluster_settings(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Apply :data:`CLUSTER_SETTINGS` (runtime SQL settings) to a session whose
    cluster and ``spark.checkpoint.dir`` are configured by the platform."""
    for k, v in {**CLUSTER_SETTINGS, **(overrides or {})}.items():
        spark.conf.set(k, v)
    return spark
