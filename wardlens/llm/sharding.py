"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id.  A Feistel network permutes the smallest
power-of-four range that holds all numbers; a result beyond the last row is permuted
again until it falls inside (cycle walking), which makes it a permutation of exactly the
rows.  Place p of the shuffle is slot p // shards of shard p % shards, so shard sizes
differ by at most one and both are computed from the row number alone, in either
direction.  Only ids and sizes are shuffled, never texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.materialize import written

SHARDS = 24
SEED = 2026
ROUNDS = 6
_POSITION_BITS = 33  # of monotonically_increasing_id() that number the rows of a partition


def _mix(z: np.ndarray, key: int) -> np.ndarray:
    z = z + np.uint64(key)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Shuffle:
    """A permutation of 0 .. n-1 that depends on n and the seed alone."""

    def __init__(self, n: int, seed: int = SEED, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.keys = [(seed * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) % 2**64 for i in range(1, rounds + 1)]

    def _network(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for key in keys:
            left, right = right, left ^ (_mix(right, key) & mask)
        return (right << half) | left  # halves swapped, so reversed keys undo the network

    def _walk(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        out = self._network(np.asarray(x, np.uint64), keys)
        while len(beyond := np.flatnonzero(out >= self.n)):
            out[beyond] = self._network(out[beyond], keys)
        return out.astype(np.int64)

    def place(self, row: np.ndarray) -> np.ndarray:
        """Place in the shuffle of each row number."""
        return self._walk(row, self.keys)

    def row(self, place: np.ndarray) -> np.ndarray:
        """Row number at each place of the shuffle."""
        return self._walk(place, self.keys[::-1])


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> tuple[DataFrame, int]:
    """``df`` with global row numbers from 0 in the given order, and the number of rows.

    Rows are sorted by ranges; a range's first number is the count of the ranges before it,
    one row per partition.  Rows that tie in ``order`` are numbered in any order.
    """
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumns({"_range": F.spark_partition_id(), "_at": position}), "ranged_rows")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    first = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    total = ranged.count()
    numbered = ranged.join(first, "_range").withColumn(name, F.col("_first") + F.col("_at"))
    return numbered.drop("_range", "_at", "_first"), total


def place_column(row_no: Column | str, n: int, seed: int = SEED) -> Column:
    @F.arrow_udf("bigint")
    def of(rows: pa.Array) -> pa.Array:
        return pa.array(Shuffle(n, seed).place(rows.to_numpy(zero_copy_only=False)))

    return of(row_no)


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """(id, size, text_crc32, row_no, shard, slot) of every row.

    ``size`` is the text's UTF-8 bytes plus 8; a null text has none and the checksum of an
    empty one.  Rows are numbered by id, then checksum and size, nulls first; repeated rows
    take neighbouring numbers and each gets a slot of its own.  The result does not depend on
    files or partitions.  An empty table gives an empty one; further columns are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    numbered, n = number_rows(written(narrow, "row_sizes"), ["id", "text_crc32", "size"])
    placed = numbered.withColumn("place", place_column("row_no", n, seed))
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "row_no",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )
