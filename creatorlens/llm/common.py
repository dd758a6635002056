"""Tables, shared folders and Arrow helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import itertools
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.llm.words import mark
from creatorlens.session import ensure_checkpoint_dir

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
MARK_BITS = 1 << 16, 1 << 28  # least and most bits of a mark table

_serial = itertools.count()

# Python workers live long: have glibc give numpy's large blocks back when they are freed
try:
    ctypes.CDLL("libc.so.6").mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
except (OSError, AttributeError):  # another C library
    pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder (as a URI) below the one that ``spark.checkpoint.dir`` names."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm/{name}-{uuid.uuid4().hex[:12]}-{next(_serial)}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows scans the copy, so neither a
    second use nor a lost executor repeats the work before it.  The write's own shuffle files, which nothing reads
    after it, are deleted."""
    path, conf = shared_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEAN_UP, None)
    conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEAN_UP)
        else:
            conf.set(CLEAN_UP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    """128 bits (k, l) that name a row's id and text, never null."""
    name = F.to_json(F.struct(F.col(id_col).alias("id")))
    return F.xxhash64(name, F.lit(0), F.col(text_col)).alias("k"), F.xxhash64(F.col(text_col), F.lit(1), name).alias("l")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    while name.lower() in [c.lower() for c in df.columns]:
        name = f"_{name}"
    return name


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part's texts take about ``most`` bytes (one row at least)."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield batch.slice(first)


def filesystem(uri: str):
    """pyarrow file system and path of a URI (``file:``, ``hdfs:``, ``s3:`` ...) or a plain path."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def mark_table(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter (packed bits) of a column of 64-bit hashes: 32 bits for each, within ``MARK_BITS``.  With
    more hashes than that it only lets more others pass.  Tasks send the words of the table that they set."""
    size = min(max(MARK_BITS[0], 1 << (32 * hashes.count() - 1).bit_length()), MARK_BITS[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.zeros(size // 8, np.uint8)
        for batch in batches:
            mark(packed, batch.column(0).to_numpy().view(np.uint64))
        words = packed.view(np.int64)
        at = np.flatnonzero(words)
        for first in range(0, len(at), 1 << 18):
            some = at[first:first + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], names=["at", "word"])

    rows = hashes.mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word"))
    found = rows.toArrow()  # at most size / 64 rows
    words = np.zeros(size // 64, np.int64)
    words[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return words.view(np.uint8)
