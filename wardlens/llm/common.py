"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows in one Arrow batch.  Whole texts travel in a batch, so it is small: 250 texts of
# 100 KB are 25 MB.
BATCH_ROWS = 250
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Send at most ``rows`` rows at a time to Python, so that long texts fit."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def utf8(text: str | Column) -> Column:
    """The bytes of a text column; null counts as an empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column, F.lit("")).cast("binary")


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``size`` words joined by spaces, repeats included.

    Fewer words than ``size`` are one shingle; no words have none.  The hash is the one
    that Spark's ``xxhash64`` gives for the same string.
    """
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    last = ends[size - 1 :] or [len(joined)]
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts, last)), np.uint64, len(last))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) for the nodes of the links a-b, roots left out.

    Links of one task shrink to at most one row per node before they are shuffled.
    """
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while (new != new[new]).any():
            new = new[new]
        label = new
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def group_batches(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], side="left"))  # the last group may go on
        if held and keys[0] != held[-1].column(key)[-1].as_py():
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def without(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose ``key`` is not in the one column of ``ids``; null equals null."""
    gone = ids.toDF("_gone")
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti")
