"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint's row of the pivot table holds its Hamming distances to many reference
fingerprints.  Two fingerprints that differ in d bits differ by at most d in every
coordinate, so a pair whose largest coordinate difference exceeds the limit is discarded
and only the survivors are compared bit by bit.

The pivots are of two kinds.  The zero word and the 64 one-bit words are never stored:
the difference of a fingerprint's distances to zero and to the word of bit i is 2 * bit i - 1,
so a block of equal bits is a block of equal coordinates.  Of six blocks at most four can
hold a differing bit, hence two blocks agree in every linked pair, and each of the 15
pairs of blocks is an equi-join key; no pair within the limit is lost.  The dense pivots
are the stored table that discards.

Exact copies share a fingerprint and are one row throughout.  A key that very many
different fingerprints share is cut into tiles, and each pair of tiles is a task group
of its own of bounded size.  A group hands on at most one link per member.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .common import LOWER, forest, group_batches, shingle_hashes, small_batches, utf8, without
from .components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
N_PIVOTS = 32
TILE_ROWS = 4096  # fingerprints in one group at most, whatever the key
PAIRS_AT_ONCE = 1 << 20
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)  # byte value -> its bits


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit number; 0 without words."""
    hashes = shingle_hashes(text.translate(LOWER).split(), shingle_words)
    if not len(hashes):
        return 0
    octets = hashes.astype("<u8").view(np.uint8).astype(np.int64) + 256 * np.tile(np.arange(8), len(hashes))
    ones = np.bincount(octets, minlength=2048).reshape(8, 256) @ _BITS
    majority = np.packbits(2 * ones.ravel() > len(hashes), bitorder="little")
    return int(majority.view("<i8")[0])


def fingerprint_column(text: Column | str, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle_words) for t in texts.to_pylist()], pa.int64())

    return of(utf8(text))


def hex_digits(fp: Column | str) -> Column:
    """16 lower-case hex digits of a 64-bit number."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def pivots(count: int = N_PIVOTS) -> np.ndarray:
    """Fixed dense reference fingerprints (outputs of a 64-bit mixing function)."""
    z = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def block_keys(fp: str, max_bits: int = MAX_BITS) -> Column:
    """An array of keys; fingerprints within ``max_bits`` share one at least."""
    n = max_bits + 2
    edges = [64 * i // n for i in range(n + 1)]

    def block(i: int) -> Column:
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))

    widest = max(b - a for a, b in zip(edges, edges[1:]))
    keys = [
        F.shiftleft(F.lit(k).cast("long"), 2 * widest).bitwiseOR(F.shiftleft(block(i), widest)).bitwiseOR(block(j))
        for k, (i, j) in enumerate(combinations(range(n), 2))
    ]
    return F.array(*keys)


def linked_pairs(cell: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> Iterator[tuple]:
    """Index pairs within ``max_bits`` among rows of equal ``cell`` (sorted by cell).

    Rows are compared with the rows 1, 2, 3, ... places on as long as the cell is the same.
    """
    table = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)  # the pivot table
    left, step = np.arange(len(fp)), 1
    while True:
        left = left[left + step < len(fp)]
        left = left[cell[left] == cell[left + step]]
        if not len(left):
            return
        for at in range(0, len(left), PAIRS_AT_ONCE):
            x = left[at : at + PAIRS_AT_ONCE]
            for ref in range(0, len(refs), 8):
                near = np.abs(table[x, ref : ref + 8] - table[x + step, ref : ref + 8]).max(axis=1) <= max_bits
                x = x[near]
            x = x[np.bitwise_count(fp[x] ^ fp[x + step]) <= max_bits]
            if len(x):
                yield x, x + step
        step += 1


def _cell_links(max_bits: int, n_pivots: int):
    def links(batches):
        refs = pivots(n_pivots)
        for table in group_batches(batches, "cell"):
            cell = table.column("cell").to_numpy()
            fp = table.column("fp").to_numpy().view(np.uint64)
            found = [*linked_pairs(cell, fp, max_bits, refs)]
            if found:
                x, y = (fp[np.concatenate(side)].view(np.int64) for side in zip(*found))
                node, root = forest(x, y)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])

    return links


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = N_PIVOTS, tile: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``max_bits``."""
    keyed = fps.select("fp", F.explode(block_keys("fp", max_bits)).alias("key"))
    hot = keyed.groupBy("key").count().filter(F.col("count") > tile)
    hot = hot.select("key", F.ceil(F.col("count") * 2 / tile).alias("tiles"))
    # a fingerprint of tile i is in the cells (i, j) and (j, i) of all other tiles j
    own = F.pmod(F.xxhash64("fp"), F.col("tiles"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: t != own)
    both = F.transform(others, lambda t: F.shiftleft(F.least(t, own), 16).bitwiseOR(F.greatest(t, own)))
    cells = F.when(F.col("tiles").isNull(), F.array(F.lit(0).cast("long"))).otherwise(both)
    dealt = keyed.join(hot, "key", "left").select("fp", F.shiftleft("key", 32).alias("key"), F.explode(cells).alias("t"))
    grouped = dealt.select("fp", F.col("key").bitwiseOR(F.col("t")).alias("cell"))
    return grouped.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_cell_links(max_bits, n_pivots), "a bigint, b bigint")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(id, fingerprint, component_id): the smallest id reachable over links, per row.

    Texts are compared whole.  A null or empty text, or one without words, has the
    fingerprint zero and links like any other.  A null id is no smallest id unless a whole
    component has none.  Repeated rows stay as rows of one component.  Further columns of
    ``docs``, whatever their names, are not looked at.  An empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle_words).alias("fp"))
    hashed = written(narrow, "fingerprints")
    fps = written(hashed.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct_fingerprints")
    found = components(fingerprint_links(fps, max_bits))
    labelled = fps.join(found, fps["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = labelled.select("fp", "label").join(least, "label").select("fp", "component_id")
    return hashed.join(classes, "fp").select(F.col("id").alias(id_col), hex_digits("fp").alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each component; all columns as they were.

    Rows that share the kept id count as one document and all stay.
    """
    found = simhash_components(docs, id_col, text_col)
    is_first = F.col(id_col).eqNullSafe(F.col("component_id"))
    gone = found.groupBy(id_col).agg(F.bool_or(is_first).alias("stays")).filter("not stays")
    # as a table its size is known, so that the engine moves texts only where the ids are many
    return without(docs, written(gone.select(id_col), "gone"), id_col)
