"""Benchmark decontamination as a prefix-filtered set join.

Benchmark items are cut into windows of consecutive words and a window into shingles.
A window that occurs in a document has all its shingles there, so it is enough to join
one of them, its prefix: the shingle that is rarest over all documents.  A window with a
shingle that no document holds is done.  Every join hit fixes where the window would have
to start; it must lie inside the text (length and positional bounds) and the words there
must be the window's words, which is checked word by word.

Documents are read once.  Stretches of words that are covered by possible benchmark
shingles (a bitmap of fixed largest size says which) are kept; all other words are left
where they are.  Equal stretches, such as a passage that a third of all documents repeat,
are matched once and handed back by a join.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .common import lower_ascii, shingle_hashes, small_batches, utf8

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
MAX_BITMAP_BITS = 1 << 27  # 16 MB; a fuller bitmap lets more stretches through, no fewer
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z in lower case."""
    return text.translate(_TO_WORDS).split()


def _shingles(words: Column, size: Column) -> Column:
    """Array of (offset, shingle) over an array of words with at least ``size`` words."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(starts, lambda i: F.struct(i.alias("offset"), F.array_join(F.slice(words, i + 1, size), " ").alias("shingle")))


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window_words: int) -> DataFrame:
    """(item_id, window): every window of every item, once; ``window`` is an array of words."""
    words = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(id_col).alias("item_id"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window_words + 1, F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice("words", i, window_words))
    return items.select("item_id", F.explode(windows).alias("window")).distinct()


def _bitmap(shingles: DataFrame) -> np.ndarray:
    """A bit for the hash of every shingle; at least 64 bits a shingle where the limit allows."""
    wanted = 64 * max(1024, shingles.count())
    size = min(1 << (wanted - 1).bit_length(), MAX_BITMAP_BITS)
    place = F.xxhash64("shingle").bitwiseAND(F.lit(size - 1))
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(shingle), 64L) as int))")
    words = shingles.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(size // 64, np.uint64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _hit(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def _runs(hit: np.ndarray, least: int, size: int) -> list[tuple[int, int]]:
    """[start, end) in words of runs of at least ``least`` hits of shingles of ``size`` words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return [(int(a), int(b) + size - 1) for a, b in zip(edges[::2], edges[1::2]) if b - a >= least]


def stretches(text: bytes, bitmap: np.ndarray, sizes: dict[int, int]) -> tuple[int, list[dict]]:
    """The number of words and the stretches (start, words) that may hold windows.

    ``sizes`` has the shingle lengths and the fewest shingles that a window of it has.
    """
    words = words_of(text)
    spans: list[tuple[int, int]] = []
    for size, least in sizes.items():
        if len(words) >= size:
            spans += _runs(_hit(shingle_hashes(words, size), bitmap), least, size)
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return len(words), [{"start": a, "words": b" ".join(words[a:b]).decode()} for a, b in merged]


def _mark(shared, sizes: dict[int, int]):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.string())]))

    @F.arrow_udf("struct<n_words: bigint, found: array<struct<start: int, words: string>>>")
    def mark(texts: pa.Array) -> pa.Array:
        n, found = zip(*(stretches(t, shared.value, sizes) for t in texts.to_pylist())) if len(texts) else ((), ())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(found, kind)], ["n_words", "found"])

    return mark


def _covered(hits: Column) -> Column:
    """Words inside the union of (start, length) intervals."""

    def add(acc: Column, hit: Column) -> Column:
        end = hit["at"] + hit["n"]
        new = F.greatest(end - F.greatest(hit["at"], acc["end"]), F.lit(0))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["total"] + new).alias("total"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(F.array_sort(hits), zero, lambda a, h: add(a, h).cast("struct<end:int,total:bigint>"))["total"]


def _postings(split: DataFrame, size: int, window_words: int) -> DataFrame:
    """(words, n_rows, at, shingle, from, around): the shingles of every text ``w``.

    A posting carries the few words around it that any window through it can have.
    """
    reach = window_words - size

    def posting(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0))
        around = F.slice("w", first + 1, i - first + window_words)
        shingle = F.array_join(F.slice("w", i + 1, size), " ")
        return F.struct(i.alias("at"), shingle.alias("shingle"), first.alias("from"), around.alias("around"))

    starts = F.sequence(F.lit(0), F.size("w") - size)
    return split.filter(F.size("w") >= size).select("words", "n_rows", F.inline(F.transform(starts, posting)))


def match_windows(texts: DataFrame, windows: DataFrame, shingle_words: int, window_words: int, sizes: list[int]) -> DataFrame:
    """(words, n_hit, items): what occurs in each text of ``texts`` (words, n_rows).

    ``windows`` has item_id and window.  Only texts with an occurrence come back.
    """
    size = F.least(F.size("window"), F.lit(shingle_words))
    by_window = windows.select("window").distinct()
    tokens = by_window.select("window", F.size("window").alias("n"), F.inline(_shingles(F.col("window"), size)))

    split = texts.select("words", "n_rows", F.split("words", " ").alias("w"))
    postings = written(reduce(DataFrame.unionByName, [_postings(split, k, window_words) for k in sizes or [shingle_words]]), "postings")

    counts = postings.groupBy("shingle").agg(F.sum("n_rows").alias("n_found"))
    ranked = tokens.join(counts, "shingle", "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)))
    prefix = ranked.groupBy("window", "n").agg(F.min(F.struct("n_found", "shingle", "offset")).alias("p"))
    prefix = prefix.filter("p.n_found > 0").select("window", "n", "p.shingle", "p.offset")

    start = F.col("at") - F.col("offset")
    inside = (start >= F.col("from")) & (start - F.col("from") + F.col("n") <= F.size("around"))
    same = F.slice("around", F.greatest(start - F.col("from"), F.lit(0)) + 1, F.col("n")) == F.col("window")
    hits = postings.join(prefix, "shingle").filter(inside & same).select("words", start.alias("at"), "n", "window")
    hits = written(hits, "window_hits")
    spans = hits.groupBy("words").agg(_covered(F.collect_set(F.struct("at", "n"))).alias("n_hit"))
    named = hits.select("words", "window").distinct().join(windows, "window")
    items = named.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return spans.join(items, "words", "left")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    shingle_words: int = SHINGLE_WORDS,
) -> DataFrame:
    """(id, n_words, n_hit, items): words inside benchmark windows, and those windows' items.

    One row per row of ``docs``; ``items`` are item ids as strings, sorted, each once.  Null
    and empty texts have no words and no hits.  An item without words has no windows; one
    with fewer words than a window is one window.  A null item id has windows that count as
    hits but is no item.  Repeated rows each get their row.  An empty benchmark hits nothing,
    an empty ``docs`` gives an empty table.  Further columns, whatever their names, are not
    looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    windows = written(item_windows(benchmark, item_col, item_text_col, window_words), "windows")
    lengths = sorted(r[0] for r in windows.select(F.size("window")).distinct().collect())  # at most window_words
    sizes: dict[int, int] = {}
    for n in lengths:
        k = min(n, shingle_words)
        sizes[k] = min(n - k + 1, sizes.get(k, n))
    size = F.least(F.size("window"), F.lit(shingle_words))
    bitmap = _bitmap(windows.select(F.inline(_shingles(F.col("window"), size))).select("shingle").distinct())
    mark = _mark(spark.sparkContext.broadcast(bitmap), sizes)
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), mark(utf8(text_col)).alias("m")
    )
    marked = written(marked.select("row", "id", "m.n_words", "m.found"), "marked")

    found = marked.select("row", F.inline("found")).select("row", "words")
    texts = found.groupBy("words").agg(F.count("*").alias("n_rows"))
    matched = match_windows(texts, windows, shingle_words, window_words, [*sizes])
    per_row = found.join(matched, "words").groupBy("row").agg(
        F.sum("n_hit").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.coalesce("items", F.array().cast("array<string>")))))).alias("items"),
    )
    none = F.array().cast("array<string>")
    return marked.select("row", "id", "n_words").join(per_row, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
    )
