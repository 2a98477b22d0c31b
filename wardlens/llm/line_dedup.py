"""Line deduplication with two Bloom filters.

A first pass over the lines fills two Bloom filters, one of hashes seen once and one of
hashes seen in a second document.  A second pass tests each line against the second
filter: only suspected repeats leave their task, as 128-bit digests of the line.  These are
grouped and counted exactly, so that a false alarm of the filter changes nothing, and the
holder that keeps the line is chosen there.

The filters' size follows the number of lines (``bits_per_line``) up to ``max_filter_bytes``
each, which bounds what is broadcast.  Beyond that size the filter lets more single lines
through to the exact count; the result is the same.

Filters of different tasks are merged bit by bit: a bit that two tasks have set is set in
the merged second filter.  Every hash of two documents is therefore in it, wherever the
documents lie.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .common import LOWER, small_batches, utf8

MIN_CHARS = 20
MIN_DOCUMENTS = 3
BITS_PER_LINE = 16
BITS_PER_KEY = 3  # set in the one 64-bit word of a key
MAX_FILTER_BYTES = 64 << 20
SEGMENT_WORDS = 1 << 13
_BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """What two lines must share to count as the same: stripped, A-Z in lower case."""
    return line.strip(_BLANK).translate(LOWER)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars)


def key_digest(key: bytes) -> bytes:
    """What stands for a key once it leaves its task."""
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(text: bytes, min_chars: int) -> set[bytes]:
    """The distinct keys of a text that are long enough to be looked at."""
    return {k for k in map(line_key, text.split(b"\n")) if _long_enough(k, min_chars)}


def _bits(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each hash and the mask of its bits there; ``words`` is a power of two."""
    mask = np.zeros(len(hashes), np.uint64)
    for i in range(BITS_PER_KEY):
        mask |= np.uint64(1) << ((hashes >> np.uint64(40 + 6 * i)) & np.uint64(63))
    return (hashes & np.uint64(words - 1)).astype(np.int64), mask


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)


def _fill(words: int, min_chars: int):
    """Arrow rows -> this task's two filters, as compressed segments."""

    def fill(batches):
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for batch in batches:
            parts = [_hashes(line_keys(t, min_chars)) for t in batch.column(0).to_pylist()]
            hashes, documents = np.unique(np.concatenate(parts or [_hashes([])]), return_counts=True)
            at, mask = _bits(hashes, words)
            again = (documents > 1) | ((once[at] & mask) == mask)
            np.bitwise_or.at(twice, at[again], mask[again])
            np.bitwise_or.at(once, at, mask)
        size = min(SEGMENT_WORDS, words)
        for start in range(0, words, size):
            a, b = once[start : start + size], twice[start : start + size]
            if a.any():
                packed = [[zlib.compress(x.tobytes(), 1)] for x in (a, b)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([start // size], pa.int32()), *(pa.array(p, pa.binary()) for p in packed)],
                    ["segment", "once", "twice"],
                )

    return fill


def _merge(batches):
    """Segments of many tasks -> the merged second filter, one row per segment."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            a, b = (np.frombuffer(zlib.decompress(p), np.uint64) for p in packed)
            if segment in once:
                twice[segment] |= b | (once[segment] & a)
                once[segment] |= a
            else:
                once[segment], twice[segment] = a.copy(), b.copy()
    for segment, bits in twice.items():
        if bits.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment], pa.int32()), pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())],
                ["segment", "twice"],
            )


def twice_seen(texts: DataFrame, min_chars: int, bits_per_line: int, max_filter_bytes: int) -> np.ndarray:
    """The filter of line hashes that more than one document may hold."""
    text = F.col(texts.columns[0]).cast("string")
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    lines = texts.agg(F.sum(breaks + 1)).first()[0] or 0
    wanted = max(1024, lines * bits_per_line // 64)
    words = min(1 << (wanted - 1).bit_length(), max_filter_bytes // 8)
    filled = texts.mapInArrow(_fill(words, min_chars), "segment int, once binary, twice binary")
    merged = filled.repartition("segment").mapInArrow(_merge, "segment int, twice binary")
    bits = np.zeros(words, np.uint64)
    size = min(SEGMENT_WORDS, words)
    for segment, packed in merged.toLocalIterator():  # at most max_filter_bytes in all
        bits[segment * size : (segment + 1) * size] = np.frombuffer(zlib.decompress(packed), np.uint64)
    return bits


def _suspects(shared, min_chars: int):
    @F.arrow_udf("array<binary>")
    def of(texts: pa.Array) -> pa.Array:
        bits = shared.value
        out = []
        for text in texts.to_pylist():
            keys = [*line_keys(text, min_chars)]
            at, mask = _bits(_hashes(keys), len(bits))
            out.append([key_digest(k) for k, hit in zip(keys, (bits[at] & mask) == mask) if hit])
        return pa.array(out, pa.list_(pa.binary()))

    return of


def dropped_keys(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    bits_per_line: int = BITS_PER_LINE,
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """(id, dropped): digests of the keys whose lines a document loses, where it loses any.

    ``docs`` has the columns ``id`` and ``text`` (bytes).
    """
    spark = docs.sparkSession
    bits = twice_seen(docs.select("text"), min_chars, bits_per_line, max_filter_bytes)
    shared = spark.sparkContext.broadcast(bits)
    suspected = docs.select("id", F.explode(_suspects(shared, min_chars)("text")).alias("key"))
    suspected = written(suspected, "suspected_lines")
    repeats = (
        suspected.groupBy("key")
        .agg(F.count_distinct("id").alias("holders"), F.max("id").alias("keeper"))
        .filter(F.col("holders") >= min_documents)
        .select("key", "keeper")
    )
    losing = suspected.join(repeats, "key").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return losing.groupBy("id").agg(F.collect_set("key").alias("dropped"))


def _apply(text: Column, dropped: Column) -> Column:
    @F.arrow_udf("struct<n_lines: bigint, n_dropped: bigint, kept: string>")
    def of(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for text, keys in zip(texts.to_pylist(), dropped.to_pylist()):
            lines = text.split(b"\n")
            left = lines
            if keys:
                gone = set(keys)
                left = [x for x in lines if key_digest(line_key(x)) not in gone]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(left))
            kept.append(b"\n".join(left).decode())
        arrays = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n_lines", "n_dropped", "kept"])

    return of(text, dropped)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``_lines`` (n_lines, n_dropped, kept text).

    A key found in ``min_documents`` documents or more keeps its lines in the document with
    the largest id alone, in all of that document's lines.  Shorter keys stay everywhere.  A
    null or empty text is one empty line and ends as an empty text.  Rows that share an id
    are one document; a row without an id holds lines but is not counted, and loses lines
    that are dropped elsewhere.  An empty table gives an empty one.  A column of the name
    ``_lines`` is replaced.
    """
    small_batches(docs.sparkSession)
    drops = dropped_keys(docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")), **options)
    drops = drops.select(F.col("id").alias("_line_owner"), F.col("dropped").alias("_line_keys"))
    joined = docs.join(drops, docs[id_col].eqNullSafe(drops["_line_owner"]), "left")
    applied = _apply(utf8(docs[text_col]), F.col("_line_keys"))
    kept = [docs[c] for c in docs.columns if c != "_lines"]
    return joined.select(*kept, applied.alias("_lines"))
