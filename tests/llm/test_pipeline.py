import corpus_pipeline
from creatorlens.llm import decontaminate, quality
from creatorlens.llm.common import table
from tests.llm import messy
from tests.llm.test_bpe import PATH
from tests.llm.test_jaccard import _kept
from tests.llm.test_secrets import brute as brute_secrets

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns, rows = docs.columns, docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        got = out.collect()
        if name == "quality classifier":
            score = {r.doc_id: r.score for r in quality.scored(docs, quality.train(docs, table(spark, SF, "labels"))).collect()}
            want = [r for r in rows if score[r.doc_id] >= 0.5]
        elif name == "n-gram Jaccard join":
            keep = _kept([(r.doc_id, r.text) for r in rows], 5, 80)
            want = [r for r in rows if r.doc_id in keep]
        elif name == "benchmark decontamination":
            bad = {r.id for r in decontaminate.leaks(docs, table(spark, SF, "benchmark")).collect()}
            whole = {r.doc_id for r in rows for i in table(spark, SF, "benchmark").collect() if i.text in r.text}
            assert whole <= bad
            want = [r for r in rows if r.doc_id not in bad]
        elif name == "secret scans":
            spans = {i: s for i, _, s in brute_secrets([(r.doc_id, r.text, r.source, None) for r in rows])}
            assert len(got) == len(rows)
            for r, o in zip(sorted(rows), sorted(got)):
                assert r.doc_id == o.doc_id and (r == o) == (not spans[r.doc_id]) and o.n_chars == (len(o.text) if spans[r.doc_id] else r.n_chars)
            want = got
        else:
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(PATH)
            assert {r.doc_id: list(r.ids) for r in got} == {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in rows}
            break
        assert out.columns == columns and sorted(got) == sorted(want) and 0 < len(got) <= len(rows)
        docs, rows = spark.createDataFrame(got, docs.schema), got


def test_run_and_messy_documents(spark, tmp_path):
    messy.docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i > 5), 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 0 < len(out) < len(messy.rows()) and len({r.doc_id for r in out}) <= len(out)


def test_run_on_no_documents(spark, tmp_path):
    messy.empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
