import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from creatorlens.llm import tokenbin
from creatorlens.llm.common import shared_folder
from tests.llm import messy

PATH = public_tokenizers.path("word_bpe_49k.json")


def _want(rows):
    library = Tokenizer.from_file(PATH)
    return [(i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]


def test_messy_table(spark):
    folder = shared_folder(spark, "test-tokens")
    manifest = tokenbin.write_tokens(messy.docs(spark), PATH, folder, 1)
    assert tokenbin.read_manifest(folder) == manifest and manifest["width"] == 2
    got = [(r.id, r.start, r.n_tokens, list(r.ids)) for r in tokenbin.read_tokens(spark, manifest).collect()]
    want = _want((r[0], r[1]) for r in messy.rows())
    assert sorted(((i, ids) for i, _, _, ids in got), key=repr) == sorted(want, key=repr)
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.concatenate([[0], np.cumsum([r[2] for r in got])])[:-1].tolist()
    assert all(len(r[3]) == r[2] for r in got)
    order = [-1 if r[0] is None else r[0] for r in got]
    assert order == sorted(order)


def test_empty_table(spark):
    manifest = tokenbin.write_tokens(messy.empty(spark), PATH, shared_folder(spark, "test-tokens"), 1)
    assert manifest["parts"] == [] and tokenbin.read_tokens(spark, manifest).collect() == []


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in tokenbin.op5_tokenbin(spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for i, ids in _want(tuple(r) for r in rows):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
