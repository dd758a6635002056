"""Token ids as flat binary files with 64-bit document offsets, memory-mapped on reading.

Layout of a folder, one set of files per partition (partitions hold ascending ranges of ids):

* ``part-00007.tokens``   ids of all documents end to end, little-endian unsigned 16- or 32-bit integers
* ``part-00007.offsets``  n + 1 little-endian unsigned 64-bit integers: where each document starts in the part
* ``part-00007.ids``      the documents' ids (Arrow IPC file)
* ``manifest.json``       width, end id, and per part its documents, tokens and base: the prefix sums of the
  parts' token counts, so that base + offset is a document's place in the whole sequence

Each task writes under a name of its own attempt and renames at its end, so a repeated or speculative task
replaces a file by the same bytes.  The driver sees one row per part.

Null texts count as empty (the end id alone); rows with equal ids follow each other in the order of a hash
of their texts; null ids come first.  Input columns other than the id and the text are not read.
"""

from __future__ import annotations

import itertools
import json
import os
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.llm.common import filesystem, shared_folder, slices, table
from creatorlens.llm.pretokens import WordMemo, encode_column

_LOADED: dict[str, LibraryEncoder] = {}


class LibraryEncoder:
    """The tokenizers library with a memo of words: a text's ids are those of its words, end to end."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.memo = WordMemo()

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                      [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).to_pylist()
        got = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.fromiter(itertools.chain.from_iterable(got), np.int32),
                np.concatenate([[0], np.cumsum([len(x) for x in got])]))

    def other(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return encode_column(column, self.memo, self.words, self.other)


def _encoder(path: str) -> LibraryEncoder:
    if path not in _LOADED:
        _LOADED[path] = LibraryEncoder(path)
    return _LOADED[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every document's ids followed by the end id."""
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(len(offsets))


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Encode all documents in ascending order of their ids, write the files, return the manifest."""
    from tokenizers import Tokenizer
    size = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    width = 2 if size <= 1 << 16 else 4
    ranged = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
              .repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        fs, at = filesystem(folder)
        fs.create_dir(at, recursive=True)
        own = f"{at}/.part-{part:05d}-{uuid.uuid4().hex}"
        counts, ids = [np.zeros(1, np.int64)], []
        with fs.open_output_stream(f"{own}.tokens") as out:
            for batch in batches:
                for piece in slices(batch, "text", 2 << 20):
                    flat, offsets = with_end(*encoder.column(piece.column("text")), end_id)
                    out.write(flat.astype(f"<u{width}").tobytes())
                    counts.append(np.diff(offsets))
                    ids.append(piece.column("id"))
        ends = np.cumsum(np.concatenate(counts))
        if not ids:
            fs.delete_file(f"{own}.tokens")
            return
        with fs.open_output_stream(f"{own}.offsets") as out:
            out.write(ends.astype("<u8").tobytes())
        with fs.open_output_stream(f"{own}.ids") as out, pa.ipc.new_file(out, pa.schema([("id", ids[0].type)])) as file:
            for one in ids:
                file.write_batch(pa.RecordBatch.from_arrays([one], names=["id"]))
        for kind in ("tokens", "offsets", "ids"):
            fs.move(f"{own}.{kind}", f"{at}/part-{part:05d}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(ends) - 1], pa.int64()),
                                          pa.array([int(ends[-1])], pa.int64())], names=["part", "docs", "tokens"])

    parts = sorted(tuple(r) for r in ranged.mapInArrow(run, "part int, docs long, tokens long").collect())  # one row per file
    bases = [0, *itertools.accumulate(tokens for _, _, tokens in parts)]
    manifest = {"folder": folder, "width": width, "end_id": end_id, "id_type": docs.schema[id_col].dataType.simpleString(),
                "parts": [{"part": p, "docs": d, "tokens": t, "base": b} for (p, d, t), b in zip(parts, bases)]}
    fs, at = filesystem(folder)
    fs.create_dir(at, recursive=True)
    with fs.open_output_stream(f"{at}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> dict:
    fs, at = filesystem(folder)
    with fs.open_input_file(f"{at}/manifest.json") as f:
        return json.loads(f.read())


def mapped(folder: str, name: str) -> pa.Buffer:
    """A file's bytes: memory-mapped where the folder is a file system's, else read."""
    from pyarrow import fs as pafs
    fs, at = filesystem(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(f"{at}/{name}").read_buffer()
    with fs.open_input_file(f"{at}/{name}") as f:
        return f.read_buffer()


def read_tokens(spark: SparkSession, manifest: dict, column: str = "ids array<long>",
                of: Callable[[np.ndarray], object] = lambda ids: ids.astype(np.int64)) -> DataFrame:
    """(id, start, n_tokens, <column>) of every document in the files; ``of`` gives the last from its ids.

    One task per part; it maps the files and hands on a few thousand documents at a time.
    """
    folder, width = manifest["folder"], manifest["width"]
    schema = f"id {manifest['id_type']}, start long, n_tokens long, {column}"
    rows = [(p["part"], p["base"]) for p in manifest["parts"]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, base in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"part-{part:05d}"
                tokens = np.frombuffer(mapped(folder, f"{name}.tokens"), f"<u{width}")
                offsets = np.frombuffer(mapped(folder, f"{name}.offsets"), "<u8").astype(np.int64)
                at = 0
                file = pa.ipc.open_file(mapped(folder, f"{name}.ids"))
                for ids in map(file.get_batch, range(file.num_record_batches)):
                    ends = offsets[at:at + ids.num_rows + 1]
                    last = pa.array([of(tokens[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
                    yield pa.RecordBatch.from_arrays([ids.column(0), pa.array(ends[:-1] + base), pa.array(np.diff(ends)), last],
                                                     names=["id", "start", "n_tokens", column.split()[0]])
                    at += ids.num_rows

    if not rows:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(rows, "part int, base long").repartition(len(rows))
    return files.mapInArrow(run, schema)


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op5_tokenbin(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    manifest = write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                            shared_folder(spark, "tokens"), end_id=1)
    return read_tokens(spark, manifest, "ids_crc32 long", crc32).withColumnRenamed("id", "doc_id")
