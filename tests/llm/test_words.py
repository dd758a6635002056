import random
import re

import numpy as np
import pyarrow as pa

from creatorlens.llm import words as W
from tests.llm import messy


def _split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w]


def test_hashes_tell_words_apart(monkeypatch):
    texts = messy.texts() + ["A a", "\x00 x"]
    for chunk in (W.CHUNK_BYTES, 700):
        monkeypatch.setattr(W, "CHUNK_BYTES", chunk)
        names, seen = {}, 0
        for first, end, hashes, offsets in W.WordHasher().texts(pa.array(texts)):
            for row in range(first, end):
                own = hashes[offsets[row - first]:offsets[row - first + 1]].tolist()
                words = _split(texts[row])
                assert len(own) == len(words)
                for h, w in zip(own, words):
                    assert names.setdefault(w, h) == h
                seen += 1
        assert seen == len(texts) and len(set(names.values())) == len(names)


def test_ngrams_and_distinct():
    r = random.Random(1)
    lists = [[r.randint(1, 5) for _ in range(n)] for n in (0, 1, 3, 4, 5, 30, 0, 2)]
    flat = np.array([x for one in lists for x in one], np.uint64)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    for whole in (False, True):
        grams, at = W.ngrams(flat, offsets, 4, whole)
        names = {}
        for one, a, b in zip(lists, at[:-1], at[1:]):
            want = [tuple(one[i:i + 4]) for i in range(len(one) - 3)] or ([tuple(one)] if whole and one else [])
            assert len(want) == b - a
            for w, h in zip(want, grams[a:b].tolist()):
                assert names.setdefault(w, h) == h
        assert len(set(names.values())) == len(names)
    values, at, counts = W.distinct(flat, offsets)
    for one, a, b in zip(lists, at[:-1], at[1:]):
        assert values[a:b].tolist() == sorted(set(one)) and counts[a:b].tolist() == [one.count(x) for x in sorted(set(one))]


def test_slices_of_a_column():
    column = pa.array(["a b", "c", None, "d e f"]).slice(1)
    _, _, hashes, offsets = next(W.WordHasher().texts(column))
    assert offsets.tolist() == [0, 1, 1, 4] and len(hashes) == 4
