import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from creatorlens.llm import bpe
from tests.llm import messy

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "b", "'s", "'S", " ", "\n", "é", "É", "Σ", "İ", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "\x1c", "\x85", "1", "２", "!",
         "</w>", "😂", "😂😂😂", "é", "́", "ﬁ", "中文", " don't", "the", "TH", "<", "|", ">", "\xa0", " ", "﻿", "​", "ß", "ǅ", "ΑΣ", "\x00",
         "w", "/", "'re", "'LL", "ve", "l", " 't", "Éé×", "÷"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_as_the_library(library):
    r, own = random.Random(5), bpe.ForcedBoundaryBpe(PATH)
    for text in messy.texts() + ["".join(r.choice(PARTS) for _ in range(r.randint(0, 12))) for _ in range(3000)]:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_fragments(library):
    r, own = random.Random(2), bpe.ForcedBoundaryBpe(PATH)
    for n in (63, 64, 65, 200, 254, 255, 256, 5000):
        for text in ("".join(r.choice("aehtin") for _ in range(n)), "é" * n, "!" * n, "a" * n):
            assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_no_token_spans_a_cut(library):
    own = bpe.ForcedBoundaryBpe(PATH)
    assert own.inside.sum() < own.inside.size // 10  # there are forced boundaries
    for token in list(own.vocab)[::97]:
        ids = [own.vocab[c] for c in token]
        assert own.inside[ids[:-1], ids[1:]].all()


def test_messy_table(spark, library):
    got = sorted(map(tuple, bpe.digests(bpe.encode_decode(messy.docs(spark), PATH)).collect()), key=repr)
    want = []
    for row in messy.rows():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        want.append((row[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.encode_decode(messy.empty(spark), PATH).collect() == []


def test_whole_documents(spark, library):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in bpe.op10_bpe(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(rows)
    for row in rows:
        ids = library.encode(row.text, add_special_tokens=False).ids
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
