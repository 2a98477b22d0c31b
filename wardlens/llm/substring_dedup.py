"""Repeated byte strings, found by a suffix order that is built blockwise over a difference cover.

What decides is the order of suffixes by their first ``LENGTH`` bytes, and among equal
ones by where they start.  Sorting every suffix would move each byte many times, so the
order is built in steps over a difference cover: the residues ``COVER`` modulo ``PERIOD``,
whose differences give every residue.  For any two positions some shift below ``PERIOD``
brings both onto the cover; suffixes that agree in ``LENGTH`` bytes therefore have cover
positions at one shift that agree in ``SAMPLE`` bytes.

1. *Cover sample.*  Strings of ``SAMPLE`` bytes at cover positions are named and sorted, a
   bucket at a time.  A suffix with no repeated cover string after it is alone.
2. *Ranks of the sample.*  Repeated cover strings are sorted, again by bucket, by name, by
   what surrounds them as far as any suffix through them reaches, and by place.  This rank
   settles long ties: all suffixes that start up to ``PERIOD`` - 1 bytes before a cover
   string are as its surroundings are, so where an earlier place has equal surroundings,
   they all tie with earlier ones, and where no place has similar ones, none does.
3. *Suffix buckets.*  Only suffixes near the ends of a repeat are left, where surroundings
   are similar and not equal.  They are routed by their first bytes and each bucket is
   sorted by itself.

Texts are cut into blocks of bounded bytes that are written once, bucketed by block, and
stay where they are.  A block asks questions, as short names per bucket; a bucket answers
with one or two bits a name, in the order asked, and the block joins the answers by its
number.  Equal questions of a block are asked once, so a string that a third of all
documents hold costs one row per block.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.materialize import fresh_folder, written
from .common import group_batches, small_batches

LENGTH = 100
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)  # every residue is a difference of two of them
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 24 << 20  # of text that one bucket stands for
SLICE_BYTES = 1 << 19  # of a block that are named at once
_LAST = np.iinfo(np.int64).max  # stands for a missing id: after all others


class Block:
    """The texts of one block, in the order of their ids, and what is known about them."""

    def __init__(self, table: pa.Table, length: int, buckets: int):
        self.length, self.buckets = length, buckets
        self.sample = length - PERIOD + 1
        rows = zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), table.column("row").to_pylist())
        docs = sorted((_LAST if d is None else d, hashlib.blake2b(t, digest_size=8).digest(), r, d, t) for d, t, r in rows)
        self.ids = [d[3] for d in docs]
        self.texts = [d[4] for d in docs]
        self.order = np.array([(d[0], int.from_bytes(d[1], "little", signed=True), d[2]) for d in docs], np.int64).reshape(-1, 3)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.start = np.cumsum(sizes) - sizes
        self.size = sizes
        self.total = int(sizes.sum())

    # --- first question: which cover strings repeat? ---------------------------------------
    def cover_positions(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, position in it) of every cover string that ends inside its document."""
        docs, places = [], []
        for d, size in enumerate(self.size.tolist()):
            if size >= self.length:
                at = (np.arange(0, size, PERIOD)[:, None] + np.array(COVER)).ravel()
                at = at[at <= size - self.sample]
                docs.append(np.full(len(at), d))
                places.append(at)
        none = [np.empty(0, np.int64)]
        return np.concatenate(docs or none), np.concatenate(places or none)

    def names(self, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A 64-bit polynomial of each cover string, from running sums over slices of the block.

        Names only say which strings to look at; surroundings and suffixes have hashes of their own.
        """
        at, n = self.start[docs] + places, self.sample
        whole = np.frombuffer(b"".join(self.texts), np.uint8)
        values, power, inverse = _polynomial()
        out = np.empty(len(at), np.uint64)
        for low in range(0, len(whole), SLICE_BYTES):
            r = slice(*np.searchsorted(at, [low, low + SLICE_BYTES]))
            part = whole[low : low + SLICE_BYTES + n]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(values[part] * power[: len(part)], out=sums[1:])
            p = at[r] - low
            out[r] = (sums[p + n] - sums[p]) * inverse[p]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))

    def cover(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Distinct names of the block's cover strings, by bucket: 40 bits each, and whether
        the block holds a name more than once."""
        docs, places = self.cover_positions()
        self.docs, self.places, self.name = docs, places, self.names(docs, places)
        bucket = self.name % np.uint64(self.buckets)
        short = (self.name // np.uint64(self.buckets)) & np.uint64((1 << 40) - 1)
        key = (bucket << np.uint64(40)) | short
        self.keys, self.key_of, held = np.unique(key, return_inverse=True, return_counts=True)
        for b, start, end in _runs((self.keys >> np.uint64(40)).astype(np.int64)):
            names = self.keys[start:end].view(np.uint8).reshape(-1, 8)[:, :5]
            yield b, names.tobytes(), np.packbits(held[start:end] > 1).tobytes(), b""

    def keep_repeated(self, answers: dict[int, bytes]) -> None:
        """Keep the cover strings whose names repeat."""
        repeated = np.zeros(len(self.keys), bool)
        for b, start, end in _runs((self.keys >> np.uint64(40)).astype(np.int64)):
            repeated[start:end] = _bits(answers[b], end - start)
        kept = repeated[self.key_of]
        self.docs, self.places, self.name = self.docs[kept], self.places[kept], self.name[kept]

    # --- second question: how do their surroundings rank? ------------------------------------
    def surroundings(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Distinct (name, surroundings) with their first place, by bucket."""
        far, n, sample = PERIOD - 1, self.length, self.sample
        near = far // 2
        whole, left, right = (np.zeros(len(self.docs), t) for t in (np.uint64, np.uint16, np.uint16))
        digest, short, texts, sizes = xxhash.xxh3_64_intdigest, xxhash.xxh32_intdigest, self.texts, self.size.tolist()
        for i, (d, p) in enumerate(zip(self.docs.tolist(), self.places.tolist())):
            text = texts[d]
            begin, end = max(0, p - far), min(sizes[d], p + n)
            whole[i] = digest(text[begin:end], (p - begin) * 256 + end - p)
            # zero matches nothing: the text ends before
            if p >= near:
                left[i] = short(text[p - near : p]) % 65535 + 1
            if p + sample + near <= sizes[d]:
                right[i] = short(text[p + sample : p + sample + near]) % 65535 + 1
        bucket = (self.name % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((self.places, self.docs, whole, self.name, bucket))
        new = np.ones(len(order), bool)
        same = lambda x: x[order][1:] == x[order][:-1]
        new[1:] = ~(same(self.name) & same(whole))
        first = order[new]  # the first place of each distinct (name, surroundings)
        self.first = self._by_place(first, bucket, self.docs, self.places)
        place_of = np.empty(len(bucket), np.int64)
        place_of[self.first] = np.arange(len(first))
        self.class_of = np.empty(len(order), np.int64)
        self.class_of[order] = place_of[first][np.cumsum(new) - 1]
        short = self.name // np.uint64(self.buckets)
        columns = [(short & np.uint64(0xFFFFFFFF)).astype("<u4"), (short >> np.uint64(32)).astype("u1"), whole, left, right]
        for b, start, end in _runs(bucket[self.first]):
            yield b, *self._placed(columns, self.first[start:end], self.docs, self.places)

    @staticmethod
    def _by_place(at: np.ndarray, bucket: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Questions of a bucket in the order of their places, which pack into few bytes so."""
        return at[np.lexsort((places[at], docs[at], bucket[at]))]

    def _placed(self, columns: list[np.ndarray], at, docs, places) -> tuple[bytes, bytes, bytes]:
        """Questions column by column, the documents that own them, and their places."""
        owners, own = np.unique(docs[at], return_inverse=True)
        steps = np.concatenate([np.diff(x, prepend=0).astype("<i4") for x in (own, places[at])])
        return b"".join(c[at].tobytes() for c in columns), self.order[owners].tobytes(), zlib.compress(steps.tobytes(), 1)

    def settle(self, answers: dict[int, bytes]) -> None:
        """Mark the suffixes that tie with earlier ones, and list those that are still open."""
        bucket = (self.name[self.first] % np.uint64(self.buckets)).astype(np.int64)
        later, is_open = np.zeros(len(self.first), bool), np.zeros(len(self.first), bool)
        for b, start, end in _runs(bucket):
            both = _bits(answers[b], 2 * (end - start))
            later[start:end], is_open[start:end] = both[: end - start], both[end - start :]
        is_first = np.zeros(len(self.name), bool)
        is_first[self.first] = True
        ties = later[self.class_of] | ~is_first
        opened = is_open[self.class_of] & ~ties
        self.gone = np.zeros(self.total + 1, bool)  # suffix starts that tie with earlier ones
        self.gone[: self.total] = self._before(ties)
        opened = self._before(opened) & ~self.gone[: self.total]
        at = np.flatnonzero(opened)
        self.open_doc = np.searchsorted(self.start, at, side="right") - 1
        self.open_place = at - self.start[self.open_doc]

    def _before(self, chosen: np.ndarray) -> np.ndarray:
        """Starts of whole strings that reach over a chosen cover string."""
        docs, places = self.docs[chosen], self.places[chosen]
        low = np.maximum(0, places - (PERIOD - 1))
        high = np.minimum(places, self.size[docs] - self.length)
        ok = high >= low
        edge = np.zeros(self.total + 1, np.int32)
        np.add.at(edge, self.start[docs[ok]] + low[ok], 1)
        np.add.at(edge, self.start[docs[ok]] + high[ok] + 1, -1)
        return np.cumsum(edge)[: self.total] > 0

    # --- third question: which of the open suffixes tie? ----------------------------------------
    def open_suffixes(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Distinct open suffixes with their first place, by the bucket of their first bytes."""
        texts, n = self.texts, self.length
        pairs = [*zip(self.open_doc.tolist(), self.open_place.tolist())]
        digests = b"".join(xxhash.xxh3_128_digest(texts[d][p : p + n]) for d, p in pairs)
        lead = np.fromiter((xxhash.xxh32_intdigest(texts[d][p : p + 16]) for d, p in pairs), np.uint64, len(pairs))
        halves = np.frombuffer(digests, "<u8").reshape(-1, 2)
        bucket = (lead % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((self.open_place, self.open_doc, halves[:, 1], halves[:, 0], bucket))
        new = np.ones(len(order), bool)
        new[1:] = (halves[order][1:] != halves[order][:-1]).any(axis=1)
        self.open_first = self._by_place(order[new], bucket, self.open_doc, self.open_place)
        self.open_bucket = bucket[self.open_first]
        columns = [halves[:, 0], (halves[:, 1] & np.uint64(0xFFFFFFFF)).astype("<u4")]
        for b, start, end in _runs(self.open_bucket):
            yield b, *self._placed(columns, self.open_first[start:end], self.open_doc, self.open_place)

    def state(self) -> bytes:
        """What the last step needs to know of the steps before."""
        own = self.start[self.open_doc] + self.open_place
        repeated = np.ones(len(own), bool)  # later places of the block itself are settled here
        repeated[self.open_first] = False
        self.gone[own[repeated]] = True
        runs = np.array([*_runs(self.open_bucket)], np.int64).reshape(-1, 3)
        held = io.BytesIO()
        np.savez_compressed(
            held, gone=np.packbits(self.gone[: self.total]), asked=np.diff(own[self.open_first], prepend=0).astype(np.int32),
            bucket=runs[:, 0], count=runs[:, 2] - runs[:, 1],
        )
        return held.getvalue()

    def finish(self, state: bytes, answers: dict[int, bytes]) -> None:
        """Put one row per document, what is left of it, in ``rows``."""
        known = np.load(io.BytesIO(state))
        self.gone = np.concatenate([np.unpackbits(known["gone"], count=self.total).astype(bool), [False]])
        asked, start = np.cumsum(known["asked"], dtype=np.int64), 0
        for b, n in zip(known["bucket"].tolist(), known["count"].tolist()):
            self.gone[asked[start : start + n][_bits(answers[b], n)]] = True
            start += n
        edge = np.zeros(self.total + 1, np.int32)
        starts = np.flatnonzero(self.gone)
        edge[starts] += 1
        edge[starts + self.length] -= 1
        covered = np.cumsum(edge)[: self.total] > 0
        removed, spans, kept = [], [], []
        for text, start, size in zip(self.texts, self.start.tolist(), self.size.tolist()):
            out = covered[start : start + size]
            n = int(np.count_nonzero(out))
            removed.append(n)
            spans.append(int(np.count_nonzero(out[1:] & ~out[:-1])) + bool(n and out[0]))
            kept.append(text if not n else np.frombuffer(text, np.uint8)[~out].tobytes())
        arrays = [
            pa.array(self.ids, pa.int64()), pa.array(self.size), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
            pa.array(kept, pa.binary()),
        ]
        self.rows = pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


_SECOND = ("<u4", "u1", "<u8", "<u2", "<u2")  # name, surroundings, left and right side
_THIRD = ("<u8", "<u4")  # 96 bits of the suffix


@cache
def _polynomial() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit value per byte, and the powers of an odd base and of its inverse."""
    base, n = 0x9E3779B97F4A7C15, SLICE_BYTES + 4096
    values = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), "<u8")

    def powers(x: int) -> np.ndarray:
        steps = np.full(n, x, np.uint64)
        steps[0] = 1
        return np.cumprod(steps)

    return values, powers(base), powers(pow(base, -1, 1 << 64))


def _runs(sorted_keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, end) of the runs of equal keys."""
    starts = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(sorted_keys)]):
        yield int(sorted_keys[start]), start, end


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).astype(bool)


# --- buckets ----------------------------------------------------------------------------------
def repeated_names(rows: pa.Table) -> list[bytes]:
    """Per row of 40-bit names: bits of those that another row, or the row itself, repeats."""
    asked, own = (rows.column(c).to_pylist() for c in ("asked", "owners"))
    edges = np.cumsum([0, *(len(x) // 5 for x in asked)])
    wide = np.zeros((edges[-1], 8), np.uint8)
    wide[:, :5] = np.frombuffer(b"".join(asked), np.uint8).reshape(-1, 5)
    names = wide.view("<u8").ravel()
    order = np.argsort(names, kind="stable")
    same = names[order][1:] == names[order][:-1]
    out = np.concatenate([_bits(x, n) for x, n in zip(own, np.diff(edges))])
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return [np.packbits(out[s:e]).tobytes() for s, e in zip(edges, edges[1:])]


def _in_place(rows: pa.Table, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The columns of all questions, their rank by place over all documents, and where rows end."""
    asked, owners, places, blocks = (rows.column(c).to_pylist() for c in ("asked", "owners", "places", "block"))
    width = sum(np.dtype(k).itemsize for k in kinds)
    columns, doc, place, base, sizes = [[] for _ in kinds], [], [], 0, []
    docs = [np.frombuffer(x, np.int64).reshape(-1, 3) for x in owners]
    for questions, own, packed in zip(asked, docs, places):
        n, at = len(questions) // width, 0
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(questions, kind, n, at))
            at += n * np.dtype(kind).itemsize
        steps = np.frombuffer(zlib.decompress(packed), "<i4").reshape(2, n).astype(np.int64)
        doc.append(np.cumsum(steps[0]) + base)
        place.append(np.cumsum(steps[1]))
        base += len(own)
        sizes.append(n)
    table = np.concatenate([np.insert(d, 2, b, axis=1) for d, b in zip(docs, blocks)])  # id, digest, block, row
    rank = np.empty(len(table), np.int64)
    rank[np.lexsort(table.T[::-1])] = np.arange(len(table))
    order = (rank[np.concatenate(doc)] << 32) | np.concatenate(place)
    return [np.concatenate(c) for c in columns], order, np.cumsum([0, *sizes])


def _group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _shared(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether another member of the same group has the same key; zero is shared by none."""
    order = np.lexsort((key, group))
    same = (group[order][1:] == group[order][:-1]) & (key[order][1:] == key[order][:-1]) & (key[order][1:] != 0)
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def ranked_surroundings(rows: pa.Table) -> list[bytes]:
    """Per row two bits a cover string: an earlier one has equal surroundings; it is the first
    with its surroundings, and others share its name and a side but not its surroundings."""
    (low, high, whole, left, right), place, edges = _in_place(rows, _SECOND)
    names = (high.astype(np.uint64) << np.uint64(32)) | low
    order = np.lexsort((place, whole, names))
    name = np.cumsum(_group_starts(names[order]))
    first = _group_starts(name, whole[order])
    later, is_open = np.empty(len(order), bool), np.zeros(len(order), bool)
    later[order] = ~first
    ones = np.flatnonzero(first)  # one of each kind of surroundings
    at = order[ones]
    is_open[at] = _shared(name[ones], left[at]) | _shared(name[ones], right[at])
    return [np.packbits(np.concatenate([later[s:e], is_open[s:e]])).tobytes() for s, e in zip(edges, edges[1:])]


def tied_suffixes(rows: pa.Table) -> list[bytes]:
    """Per row bits of the suffixes that equal one of an earlier place."""
    (high, low), place, edges = _in_place(rows, _THIRD)
    order = np.lexsort((place, low, high))
    later = np.empty(len(order), bool)
    later[order] = ~_group_starts(high[order], low[order])
    return [np.packbits(later[s:e]).tobytes() for s, e in zip(edges, edges[1:])]


STEPS = [(Block.cover, repeated_names), (Block.surroundings, ranked_surroundings), (Block.open_suffixes, tied_suffixes)]


# --- blocks and answers as tables ---------------------------------------------------------------
def _cut(block_bytes: int):
    """Arrow rows (doc_id, text) -> (block, row, doc_id, text), a new block every ``block_bytes``."""

    def of(batches):
        block, row, size = (TaskContext.get().partitionId() << 24), 0, 0
        for batch in batches:
            blocks, rows = [], []
            for n in pc.binary_length(batch.column(1)).to_pylist():
                if row and size + n > block_bytes:
                    block, row, size = block + 1, 0, 0
                blocks.append(block)
                rows.append(row)
                row, size = row + 1, size + n
            arrays = [pa.array(blocks, pa.int64()), pa.array(rows, pa.int32()), *batch.columns]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "row", "doc_id", "text"])

    return of


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, row, doc_id, text) written as a table bucketed by ``block``: grouping it by
    block, or joining by block, leaves the texts where they are."""
    spark = docs.sparkSession
    n = min(100_000, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"text_blocks_{uuid.uuid4().hex}"
    cut = docs.mapInArrow(_cut(block_bytes), "block bigint, row int, doc_id bigint, text binary")
    writer = cut.write.bucketBy(n, "block").option("compression", "zstd").option("path", fresh_folder(spark, "text_blocks"))
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def _block_of(texts: pa.Table, answers: pa.Table, length: int, buckets: int) -> tuple[Block, list[dict[int, bytes]]]:
    known: list[dict[int, bytes]] = [{} for _ in range(len(STEPS) + 1)]
    for s, bucket, answer in zip(*(answers.column(c).to_pylist() for c in ("step", "bucket", "answer"))):
        known[s][bucket] = answer
    return Block(texts, length, buckets), known


def _questions(length: int, buckets: int, step: int):
    """(texts of a block, its answers so far) -> its next questions; after the last ones a row
    with the block's state, in a bucket that does not exist."""

    def of(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block, known = _block_of(texts, answers, length, buckets)
        asked = [*block.cover()]
        for done in range(step):
            (block.keep_repeated, block.settle)[done](known[done])
            asked = [*STEPS[done + 1][0](block)]
        if step == len(STEPS) - 1:
            asked.append((STATE, block.state(), b"", b""))
        number = texts.column("block")[0].as_py()
        rows = [dict(zip(_ASKED.names, (bucket, number, *parts))) for bucket, *parts in asked]
        return pa.Table.from_pylist(rows, _ASKED)

    return of


def _finished(length: int, buckets: int):
    """(texts of a block, its state and last answers) -> one row per document."""

    def of(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block, known = _block_of(texts, answers, length, buckets)
        block.finish(known[len(STEPS)][STATE], known[len(STEPS) - 1])
        return pa.Table.from_batches([block.rows])

    return of


STATE = -1
_ASKED = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("asked", pa.binary()), ("owners", pa.binary()), ("places", pa.binary())])


def _answered(step: int):
    def of(batches):
        for rows in group_batches(batches, "bucket"):
            answers = STEPS[step][1](rows)
            arrays = [rows.column("block").combine_chunks(), rows.column("bucket").combine_chunks(), pa.array(answers, pa.binary())]
            yield pa.RecordBatch.from_arrays([arrays[0], pa.array([step] * len(rows), pa.int32()), *arrays[1:]], ["block", "step", "bucket", "answer"])

    return of


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of each row of ``docs``; ``kept`` is binary.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
    row of smaller id, or earlier in its row.  Rows that share an id come in the order of a
    digest of their texts, and equal ones in the order they are read; rows without an id
    come last.  Null texts are empty, texts count as UTF-8 bytes, and invalid bytes stay as
    they are.  Other columns are not looked at; an empty table gives an empty one.
    ``length`` is at least ``PERIOD`` + 16 and at most 4096.
    """
    if not PERIOD + 16 <= length <= 4096:
        raise ValueError(f"strings of {length} bytes are too short, or too long, for a cover of period {PERIOD}")
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    blocks = text_blocks(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")), block_bytes)
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    answers = spark.createDataFrame([], "block bigint, step int, bucket int, answer binary")
    out = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    asked = "bucket int, block bigint, asked binary, owners binary, places binary"

    def by_block(function, schema: str, answers: DataFrame) -> DataFrame:
        return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(function, schema)

    for step in range(len(STEPS)):
        questions = by_block(_questions(length, buckets, step), asked, answers)
        if step == len(STEPS) - 1:
            questions = written(questions, "questions")  # read for the states, too
            last = questions.filter(F.col("bucket") == STATE).select("block", F.lit(len(STEPS)).alias("step"), "bucket", F.col("asked").alias("answer"))
        dealt = questions.filter(F.col("bucket") != STATE).repartition(buckets, "bucket").sortWithinPartitions("bucket")
        found = dealt.mapInArrow(_answered(step), "block bigint, step int, bucket int, answer binary")
        answers = answers.unionByName(written(found, "answers"))
    known = last.unionByName(answers.filter(F.col("step") == len(STEPS) - 1))
    return by_block(_finished(length, buckets), out, known).withColumnRenamed("doc_id", id_col)
