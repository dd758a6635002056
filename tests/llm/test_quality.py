import zlib

import numpy as np
import pyarrow as pa

from creatorlens.llm import quality
from tests.llm import messy


def test_sum_of_squares_identity():
    column = pa.array(messy.texts())
    buckets, values, offsets, stats = quality.features(column)
    model = quality.FactorisationMachine(seed=3)
    random = np.random.default_rng(0)
    model.weight, model.bias = random.normal(0, 0.1, len(model.weight)).astype(np.float32), 0.3
    index, x, at = model._join(buckets, values, offsets, stats)
    got = model.score(buckets, values, offsets, stats)
    for i in range(len(column)):
        own, xi = index[at[i]:at[i + 1]][:80], x[at[i]:at[i + 1]][:80].astype(float)
        raw, _ = model._raw(own, xi.astype(np.float32), np.array([0, len(own)]))
        v = model.factor[own].astype(float)
        pairs = sum(float(v[a] @ v[b]) * xi[a] * xi[b] for a in range(len(own)) for b in range(a + 1, len(own)))
        assert abs(raw[0] - (model.bias + float(model.weight[own] @ xi) + pairs)) < 1e-3
        assert 0 <= got[i] <= 1


def test_features_do_not_depend_on_the_batch():
    texts = messy.texts()
    together = quality.features(pa.array(texts))
    for i, text in enumerate(texts):
        b, v, o, s = quality.features(pa.array([text], pa.string()))
        a, z = together[2][i:i + 2]
        assert np.array_equal(b, together[0][a:z]) and np.array_equal(v, together[1][a:z]) and np.allclose(s[0], together[3][i])
    assert not quality.features(pa.array([None, ""], pa.string()))[3].any()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = quality.op6_quality(spark, sf).collect()
    assert len(got) == 1000
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.93
    assert np.mean([r.predicted for r in held if labels[r.doc_id] == 1]) > 0.97


def test_only_the_text_counts(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels)
    one = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "'other' AS source", "0L AS n_chars", "9.0D AS score")
    two = quality.scored(other, model)
    assert two.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    assert {r.doc_id: r.score for r in two.collect()} == one


def test_messy_and_empty_tables(spark):
    label = "doc_id long, quality int, toxic int"
    rows = [(i, int(i % 2), None) for i in range(20)] + [(None, 1, 0), (3, None, 0), (4, 0, 1), (4, 1, 1), (999, 1, 1)]
    model = quality.train(messy.docs(spark), spark.createDataFrame(rows, label))
    out = quality.scored(messy.docs(spark), model).collect()
    assert len(out) == len(messy.rows()) and all(0 <= r.score <= 1 for r in out)
    for rows, want in (([], 1.0), ([(i, 0, 0) for i in range(20)], 0.0)):
        model = quality.train(messy.docs(spark), spark.createDataFrame(rows, label))
        assert {r.score for r in quality.scored(messy.docs(spark), model).collect()} == {want}
    assert quality.scored(messy.empty(spark), model).collect() == []
