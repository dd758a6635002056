"""Readers, sinks and the streaming engagement job on small files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from creatorlens.operators.features import engagement_rates
from creatorlens.sources import readers as rd
from creatorlens.sources import sinks as sk
from creatorlens.streaming import engagement_table, run_engagement_stream


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_influencer_csv_third_column_and_bad_followers(spark):
    d = tempfile.mkdtemp(prefix="cl-src-")
    _write(f"{d}/inf/influencers.txt", "username,category,_c2\nanna,fashion,100\nbob,pet,abc\ncarl,food,12.9\ndora,pet,\n")
    got = {r["username"]: r["followers"] for r in rd.read_influencers(spark, f"{d}/inf").collect()}
    assert got == {"anna": 100, "bob": None, "carl": 12, "dora": None}


def test_post_files_one_scan_keyed_by_file_name(spark):
    d = tempfile.mkdtemp(prefix="cl-posts-")
    _write(f"{d}/anna.json", '{"like_count": 10}\n{"like_count": "30"}\n')
    _write(f"{d}/annabel.json", '{"like_count": 5}\nbroken\n')
    posts = rd.read_post_files(spark, d)
    assert sorted(r["file_key"] for r in posts.collect()) == ["anna", "anna", "annabel", "annabel"]
    infl = spark.createDataFrame([("anna", 10), ("annabel", 5)], "username string, followers int")
    got = {r["username"]: r["engagement_rate"] for r in
           engagement_rates(infl, posts.withColumnRenamed("file_key", "username")).collect()}
    assert got["anna"] == pytest.approx(200.0) and got["annabel"] == pytest.approx(50.0)


def test_records_sink(spark):
    df = spark.createDataFrame([("a", 0.5)], "username string, similarity_score double")
    assert sk.as_records(df).first()[0] == '{"username":"a","similarity_score":0.5}'


def test_streaming_engagement_matches_batch(spark):
    d = tempfile.mkdtemp(prefix="cl-stream-")
    _write(f"{d}/in/owner=anna/p1.txt", '{"like_count": 10}\n{"like_count": 20}\n')
    _write(f"{d}/in/owner=bob/p1.txt", "oops\n")
    infl = spark.createDataFrame([("anna", 10), ("bob", 4), ("carl", 3)], "username string, followers int")
    run_engagement_stream(spark, f"{d}/in/*/", infl, f"{d}/out", key_pattern=r"owner=([^/]+)/",
                          checkpoint=f"{d}/ckpt")
    got = {r["username"]: r["engagement_rate"] for r in engagement_table(spark, f"{d}/out").collect()}
    assert got == {"anna": pytest.approx(150.0), "bob": 0.0, "carl": None}


def test_streaming_resumes_from_checkpoint(spark):
    """A second run with the same checkpoint only reads the new files and the
    state carries the earlier sums (restart after a failure behaves the same)."""
    d = tempfile.mkdtemp(prefix="cl-stream2-")
    infl = spark.createDataFrame([("anna", 10)], "username string, followers int")
    _write(f"{d}/in/owner=anna/p1.txt", '{"like_count": 10}\n')
    kw = dict(key_pattern=r"owner=([^/]+)/", checkpoint=f"{d}/ckpt")
    run_engagement_stream(spark, f"{d}/in/*/", infl, f"{d}/out", **kw)
    assert engagement_table(spark, f"{d}/out").first()["engagement_rate"] == pytest.approx(100.0)
    _write(f"{d}/in/owner=anna/p2.txt", '{"like_count": 30}\n')
    run_engagement_stream(spark, f"{d}/in/*/", infl, f"{d}/out", **kw)
    assert engagement_table(spark, f"{d}/out").first()["engagement_rate"] == pytest.approx(200.0)


def test_whole_file_json_documents_flatten(spark):
    from creatorlens.operators import catalog as cat
    d = tempfile.mkdtemp(prefix="cl-json-")
    _write(f"{d}/a.json", '{"navigation": [{"content": {"title": "A"},\n "children": [{"content": {"title": "B"}}]}]}')
    _write(f"{d}/b.json", '{"navigation": [{"content": {"title": "C"}}]}')
    docs = rd.read_json_documents(spark, d, whole_file=True)
    got = sorted((r["doc_id"].rsplit("/", 1)[-1], r["pos"], r["title"]) for r in cat.titled(cat.flatten_tree(docs)).collect())
    assert got == [("a.json", 0, "A"), ("a.json", 1, "B"), ("b.json", 0, "C")]


def test_post_files_keep_dots_and_signs_of_names(spark):
    d = tempfile.mkdtemp(prefix="cl-names-")
    for name in ("john.doe", "anna.json", "bob", "c+d.txt", "é x.jsonl", "eve.v2.txt"):
        _write(f"{d}/in/{name}", '{"like_count": 1}\n')
    got = {r["file_key"] for r in rd.read_post_files(spark, f"{d}/in").collect()}
    assert got == {"john.doe", "anna", "bob", "c+d", "é x", "eve.v2"}


def test_checkpoint_folder_must_be_named_off_local_masters():
    from types import SimpleNamespace

    from creatorlens.session import ensure_checkpoint_dir
    nothing = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: nothing, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=nothing))


def test_stream_killed_between_write_and_commit(spark, monkeypatch):
    """The batch that was written but not committed is replayed; readers see the table of the batch before until then."""
    from creatorlens.streaming import engagement
    d = tempfile.mkdtemp(prefix="cl-stream3-")
    infl = spark.createDataFrame([("anna", 10), ("bob", 4), ("cy", 5), (None, 1), ("dup", 2), ("dup", 4)], "username string, followers int")
    kw = dict(key_pattern=r"owner=([^/]+)/", checkpoint=f"{d}/ckpt")
    read = lambda: sorted(((r[0], r[1]) for r in engagement_table(spark, f"{d}/out").collect()), key=repr)
    with pytest.raises(ValueError, match="no committed batch"):
        engagement_table(spark, f"{d}/out")
    _write(f"{d}/in/owner=anna/p1.txt", '{"like_count": 10}\n')
    run_engagement_stream(spark, f"{d}/in/*/", infl, f"{d}/out", **kw)
    before = [("anna", 100.0), ("bob", None), ("cy", None), ("dup", None), ("dup", None), (None, None)]
    assert read() == sorted(before, key=repr)
    _write(f"{d}/in/owner=anna/p2.txt", '{"like_count": 30}\n')
    _write(f"{d}/in/owner=eve/p1.txt", '{"like_count": 3}\n')
    commit = engagement._commit

    def killed(*args):
        raise RuntimeError("killed")

    monkeypatch.setattr(engagement, "_commit", killed)
    with pytest.raises(Exception, match="killed"):
        run_engagement_stream(spark, f"{d}/in/*/", infl, f"{d}/out", **kw)
    assert read() == sorted(before, key=repr)
    monkeypatch.setattr(engagement, "_commit", commit)
    run_engagement_stream(spark, f"{d}/in/*/", infl.unionByName(spark.createDataFrame([("eve", 3)], infl.schema)), f"{d}/out", **kw)
    assert read() == sorted([("anna", 200.0), *before[1:], ("eve", 100.0)], key=repr)


def test_upsert_batches(spark):
    """Only touched buckets are written, a committed batch is not written again, and an empty batch changes nothing."""
    import json

    from creatorlens.streaming import upsert_batch
    d = tempfile.mkdtemp(prefix="cl-upsert-")
    infl = spark.createDataFrame([(f"u{i}", 10) for i in range(300)], "username string, followers int")
    changed = lambda *rows: spark.createDataFrame(list(rows), "username string, sum_likes double, n_posts long")
    upsert_batch(changed(("u1", 5.0, 1)), 0, infl, d)
    upsert_batch(changed(("u1", 20.0, 2), ("u2", 1.0, 1)), 1, infl, d)
    upsert_batch(changed(("u1", 99.0, 3)), 1, infl, d)
    upsert_batch(changed(), 2, infl, d)
    with open(f"{d}/_manifests/{2:020d}.json") as f:
        folders = [b.split("/")[0].split("-")[0] for b in json.load(f)["buckets"].values()]
    assert sorted(set(folders)) == ["batch=0", "batch=1"] and folders.count("batch=1") <= 2
    got = {r["username"]: r["engagement_rate"] for r in engagement_table(spark, d).collect()}
    assert len(got) == 300 and got["u1"] == pytest.approx(100.0) and got["u2"] == pytest.approx(10.0) and got["u3"] is None
