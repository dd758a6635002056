"""One folder and one file per user, below few others; vectors of a fit that are not written."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from creatorlens.operators import classify as cls
from creatorlens.sources import readers as rd
from creatorlens.sources import sinks as sk
from creatorlens.streaming.engagement import engagement_stream, engagement_table, run_engagement_stream


def test_one_file_per_user_whatever_the_tasks(spark):
    d = tempfile.mkdtemp(prefix="cl-folders-") + "/posts"
    rows = spark.range(4000, numPartitions=16).select((F.col("id") % 40).cast("string").alias("owner"), F.concat(F.lit("line "), "id").alias("value"))
    sk.write_user_folders(rows, d, "owner")
    files = glob.glob(f"{d}/group=*/owner=*/part-*")
    assert len(files) == 40 and len({os.path.dirname(f) for f in files}) == 40
    got = rd.read_post_files(spark, d, key_pattern=r"owner=([^/]+)/").select("file_key", "value").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows.collect()))
    stream = engagement_stream(spark, f"{d}/*/", key_pattern=r"owner=([^/]+)/", recursive=True)
    q = stream.writeStream.outputMode("complete").format("memory").queryName("post_folders").trigger(availableNow=True).option(
        "checkpointLocation", tempfile.mkdtemp(prefix="cl-folders-ckpt-")).start()
    q.awaitTermination(120)
    seen = {r.file_key: r.n_posts for r in spark.table("post_folders").collect()}
    assert seen == {str(i): 100 for i in range(40)}


def test_a_task_writes_whole_groups(spark):
    d = tempfile.mkdtemp(prefix="cl-groups-") + "/posts"
    rows = spark.range(900, numPartitions=7).select(F.when(F.col("id") % 300 > 0, (F.col("id") % 300).cast("string")).alias("owner"), F.concat(F.lit("line "), "id").alias("value"))
    sk.write_user_folders(rows, d, "owner")
    groups = glob.glob(f"{d}/group=*")
    assert len(groups) > 50 and len(glob.glob(f"{d}/group=*/owner=*/part-*")) == 300
    for group in groups:
        assert len({os.path.basename(f).split("-")[1] for f in glob.glob(f"{group}/owner=*/part-*")}) == 1
    got = rd.read_post_files(spark, d, key_pattern=r"owner=([^/]+)/").select("file_key", "value").collect()
    want = rows.fillna("__HIVE_DEFAULT_PARTITION__", "owner").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_stream_lists_and_reads_many_files_in_few_tasks(spark):
    """A batch listed its files in as many tasks, and read 32 in one; the session's own settings stay as they are."""
    d = tempfile.mkdtemp(prefix="cl-many-")
    rows = spark.range(600, numPartitions=3).select((F.col("id") % 300).cast("string").alias("owner"), F.concat(F.lit('{"like_count": '), "id", F.lit("}")).alias("value"))
    sk.write_user_folders(rows, f"{d}/posts", "owner")
    infl = spark.range(300).select(F.col("id").alias("username"), F.lit(100).alias("followers"))
    names = ("spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    q = run_engagement_stream(spark, f"{d}/posts/*/", infl, f"{d}/out", key_pattern=r"owner=([^/]+)/", recursive=True, key_type="bigint", checkpoint=f"{d}/ckpt")
    assert [spark.conf.get(name) for name in names] == before
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(str(q.runId)) for s in tracker.getJobInfo(job).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= 64
    got = {r.username: r.engagement_rate for r in engagement_table(spark, f"{d}/out").collect()}
    assert got == pytest.approx({i: i + 150.0 for i in range(300)})


def test_wide_vectors_are_not_written(spark):
    """The checkpoints of a fit hold the titles; its rbf vectors (2 KB a row) are gone when it ends."""
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    size = lambda: sum(os.path.getsize(f) for f in glob.glob(f"{base}/**/part-*", recursive=True))
    train = spark.range(2000).selectExpr("id", "concat(elt(1 + id % 3, 'red', 'blue', 'green'), ' ring') AS title", "concat('c', id % 3) AS category")
    before = size()
    model = cls.fit_svm(train, kernel="rbf")
    assert size() - before < 2000 * 256
    assert cls.predict(model, train).where("prediction = category").count() == 2000
    assert not [i for i in spark.sparkContext._jsc.getPersistentRDDs()]
