"""Alignment of two tokenizations of the same text, as an Arrow pipeline.

Tokenizer A reads a blank and the text, tokenizer B the text, before which it puts a blank
itself; both token sequences spell the same bytes.  Byte offsets where tokens of both end
cut the sequences into groups, and the tokens of a group are linked.

Texts are cut into units at single blanks between other characters.  Neither vocabulary
has an entry that goes on past such a blank (checked when a vocabulary is read), so a unit
has the same tokens alone as inside its text, and a group never spans two units.  Each
unit a worker meets for the first time goes through the pipeline: token lists are
flattened beside their parent indices, segmented cumulative sums give each token's end,
an Acero hash join on the keys of the ends finds the common ends, and a second one on the key
of the group's end pairs the tokens.  Documents are then lists of units; their links come
from ``list_flatten``, ``list_parent_indices`` and ``Table.group_by``.

Counts over the corpus are taken per batch by ``Table.group_by`` and merged by Spark.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.materialize import written
from .bpe import byte_characters
from .common import small_batches

# a blank with no white space on either side
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")
TABLE_BYTES = 80 << 20  # of units and their tokens that a worker remembers
SLICE_LINKS = 1 << 20  # links that are spelled out at once
MAX_SHARED_PAIRS = 4_000_000  # pairs whose counts are broadcast (17 bytes each); more are joined
DOC_COLUMNS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def byte_level_entries(names: dict[int, str]) -> dict[int, bytes]:
    """Bytes of the entries of a byte-level vocabulary; a special entry spells its own name."""
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    return {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for i, t in names.items()}


def piece_bytes(piece: str) -> bytes:
    """Bytes of a piece: U+2581 is a blank, <0xHH> the byte HH."""
    found = _BYTE_PIECE.match(piece)
    return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()


class Vocabularies:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the worker is one of many on its machine
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        entries_a = byte_level_entries({i: t for t, i in self.a.get_vocab().items()})
        entries_b = {i: piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())}
        self.size_a, self.size_b = max(entries_a) + 1, len(entries_b)
        self.bytes_a = pa.array([entries_a.get(i, b"") for i in range(self.size_a)], pa.binary())
        self.bytes_b = pa.array([entries_b[i] for i in range(self.size_b)], pa.binary())
        across = next((t for t in (*entries_a.values(), *entries_b.values()) if _CUT.search(t.decode(errors="replace"))), None)
        if across:
            raise ValueError(f"entry {across!r} goes on past a blank, so texts cannot be cut there")
        self.len_a, self.len_b = (pc.cast(pc.binary_length(x), pa.int64()) for x in (self.bytes_a, self.bytes_b))

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Token ids of each unit under both; none where the bytes do not spell blank and unit."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = self.b.encode(units, num_threads=1)
        whole = [b" " + u.encode() for u in units]
        for ids, entries in ((a, self.bytes_a), (b, self.bytes_b)):
            lists = pa.array(ids, pa.list_(pa.int32()))
            spelled = entries.take(pc.list_flatten(lists))
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(spelled).to_numpy(), dtype=np.int64)])[lists.offsets.to_numpy()].tolist()
            data = spelled.buffers()[2].to_pybytes() if len(spelled) else b""
            for i, (start, end, want) in enumerate(zip(ends, ends[1:], whole)):
                if data[start:end] != want:
                    a[i], b[i] = [], []
        return a, b


def _ends(lists: pa.ListArray, lengths: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(ids, unit, end in the unit) of all tokens: a cumulative sum that starts anew per unit."""
    ids, unit = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    running = np.concatenate([[0], pc.cumulative_sum(pc.take(lengths, ids)).to_numpy()])
    return ids, unit, running[1:] - running[lists.offsets.to_numpy()[:-1]][unit]


def _summed(table: pa.Table, keys: list[str]) -> pa.Table:
    return table.group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def _pairs(a: pa.Table, b: pa.Table, size_b: int, base: np.ndarray) -> pa.Table:
    """(unit, pair, n): linked pairs of ids; ``a`` and ``b`` hold (group's end key, id, n)."""
    linked = a.join(b, "key", join_type="inner", right_suffix="_b", use_threads=False)
    pair = pc.add(pc.multiply(linked["id"], pa.scalar(size_b, pa.int64())), linked["id_b"])
    unit = np.searchsorted(base, linked["key"].to_numpy()) - 1
    table = pa.table({"unit": unit, "pair": pair, "n": pc.multiply(linked["n"], linked["n_b"])})
    return _summed(table, ["unit", "pair"])


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())


def align(ids_a: list[list[int]], ids_b: list[list[int]], vocab: Vocabularies) -> dict:
    """Groups, links and the text of the groups for each unit.

    The key of a token's end is the end behind the bytes of the units before, so every
    (unit, end) has a key of its own; the keys are dense, which the hash join needs to be quick.

    Units without tokens have zeros.  ``pairs`` is a table (unit, pair, n) of the linked id
    pairs, ``pair`` being a * size_b + b; ``text`` the groups as ``a1,a2|b1;a3|b2``.
    """
    n = len(ids_a)
    lists_a, lists_b = (pa.array(x, pa.list_(pa.int64())) for x in (ids_a, ids_b))
    a, unit_a, end_a = _ends(lists_a, vocab.len_a)
    b, unit_b, end_b = _ends(lists_b, vocab.len_b)
    sizes = np.zeros(n, np.int64)
    sizes[unit_a] = end_a  # the last end of a unit is its size
    base = np.cumsum(sizes) - sizes
    key_a, key_b = pa.array(base[unit_a] + end_a), pa.array(base[unit_b] + end_b)
    shared = pa.table({"key": key_a}).join(pa.table({"key": key_b}), "key", join_type="inner", use_threads=False)
    cuts = np.sort(shared["key"].to_numpy())  # one per group: the key of its end
    group_a, group_b = (np.searchsorted(cuts, k.to_numpy()) for k in (key_a, key_b))
    in_a, in_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
    links = in_a * in_b
    unit_of = np.searchsorted(base, cuts) - 1

    tables = []
    order = np.cumsum(links) // SLICE_LINKS
    starts = np.flatnonzero(np.diff(order, prepend=-1)) if len(order) else []
    for lo, hi in zip(starts, [*starts[1:], len(cuts)]):
        sides = []
        for ids, group in ((a, group_a), (b, group_b)):
            at, to = np.searchsorted(group, [lo, hi])
            side = pa.table({"key": cuts[group[at:to]], "id": ids[at:to], "n": np.ones(to - at, np.int64)})
            if links[lo:hi].max() > 64:  # tokens that repeat in a long group are one row
                side = _summed(side, ["key", "id"])
            sides.append(side)
        tables.append(_pairs(*sides, vocab.size_b, base))

    none = pa.table({c: pa.array([], pa.int64()) for c in ("unit", "pair", "n")})
    pairs = _summed(pa.concat_tables([none, *tables]), ["unit", "pair"]) if len(tables) != 1 else tables[0]

    group_text = [
        pc.binary_join(pa.ListArray.from_arrays(_offsets(n_in), pc.cast(ids, pa.string())), ",")
        for ids, n_in in ((a, in_a), (b, in_b))
    ]
    group_text = pc.binary_join_element_wise(*group_text, "|")
    text = pc.binary_join(pa.ListArray.from_arrays(_offsets(np.bincount(unit_of, minlength=n)), group_text), ";")

    def per_unit(units: np.ndarray, weights=None) -> np.ndarray:
        return np.bincount(units, weights, minlength=n).astype(np.int64)

    return {
        "n_a": per_unit(unit_a),
        "n_b": per_unit(unit_b),
        "n_groups": per_unit(unit_of),
        "n_links": per_unit(unit_of, links),
        "text": text.to_pylist(),
        "pairs": pairs,
    }


class UnitTable:
    """What a worker knows about units; emptied when it holds ``TABLE_BYTES``."""

    COUNTS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self, vocab: Vocabularies):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.text: list[str] = []
        self.numbers = {c: [] for c in self.COUNTS}  # arrays of what was learned, in order
        self.pairs, self.times, self.lengths = [], [], []
        self.bytes = 0

    def learn(self, units: list[str]) -> None:
        ids_a, ids_b = self.vocab.encode(units)
        found = align(ids_a, ids_b, self.vocab)
        table = found["pairs"].sort_by("unit")
        self.pairs.append(table["pair"].to_numpy())
        self.times.append(table["n"].to_numpy())
        self.lengths.append(np.bincount(table["unit"].to_numpy(), minlength=len(units)))
        for c in self.COUNTS:
            self.numbers[c].append(found[c])
        self.at.update(zip(units, range(len(self.text), len(self.text) + len(units))))
        self.text += found["text"]
        self.bytes += sum(map(len, units)) + sum(map(len, found["text"])) + 16 * len(table) + 200 * len(units)

    def join(self) -> dict[str, np.ndarray]:
        """All that was learned, in one array per kind."""
        for parts in (*self.numbers.values(), self.pairs, self.times, self.lengths):
            if len(parts) > 1:
                parts[:] = [np.concatenate(parts)]
        whole = {c: parts[0] for c, parts in self.numbers.items()}
        return whole | {"pairs": self.pairs[0], "times": self.times[0], "lengths": self.lengths[0]}


@cache
def unit_table(path_a: str, path_b: str) -> UnitTable:
    """One table per worker and pair of vocabularies."""
    return UnitTable(Vocabularies(path_a, path_b))


def align_texts(texts: list[str], table: UnitTable) -> tuple[dict[str, np.ndarray], list[str], pa.Table]:
    """Counts per text, the digest of its groups, and a table (doc, pair, n) of its links."""
    if table.bytes > TABLE_BYTES:
        table.clear()
    cut = [_CUT.split(t) if t else [] for t in texts]
    new = list({u: None for units in cut for u in units if u not in table.at})
    if new or not table.numbers["n_a"]:
        table.learn(new)
    known = table.join()
    places = [[*map(table.at.__getitem__, units)] for units in cut]
    flat = np.array([p for x in places for p in x], np.int64)
    sizes = np.array([len(x) for x in places], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    # a text with one unit that does not spell its bytes has no tokens at all
    spelled = sizes > 0
    spelled[doc[known["n_groups"][flat] == 0]] = False
    counts = {c: np.bincount(doc, known[c][flat], minlength=len(texts)).astype(np.int64) * spelled for c in table.COUNTS}
    digests = [
        hashlib.sha256(";".join(map(table.text.__getitem__, x)).encode()).hexdigest() if ok else ""
        for x, ok in zip(places, spelled)
    ]
    keep = spelled[doc]
    flat, doc = flat[keep], doc[keep]
    offsets = np.concatenate([[0], np.cumsum(known["lengths"])]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(known[c])).take(pa.array(flat)) for c in ("pairs", "times")]
    links = pa.table({
        "doc": pa.array(doc).take(pc.list_parent_indices(lists[0])),
        "pair": pc.list_flatten(lists[0]),
        "n": pc.list_flatten(lists[1]),
    })
    return counts, digests, _summed(links, ["doc", "pair"])


def _aligned(path_a: str, path_b: str):
    """Arrow rows (doc_id, text) -> counts, digest and the lists of linked pairs."""

    def of(batches):
        for batch in batches:
            table = unit_table(path_a, path_b)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            counts, digests, links = align_texts(texts, table)
            links = links.sort_by([("doc", "ascending"), ("pair", "ascending")])
            offsets = np.searchsorted(links["doc"].to_numpy(), np.arange(len(texts) + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), links[c].combine_chunks().cast(pa.int32())) for c in ("pair", "n")]
            arrays = [batch.column(0), *(pa.array(counts[c]) for c in UnitTable.COUNTS), pa.array(digests, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *UnitTable.COUNTS, "groups_sha256", "pairs", "times"])

    return of


def _partial_counts(batches):
    """Arrow rows (pairs) -> how many documents of the batches hold each pair."""
    held, rows = [], 0

    def merged(tables):
        return _summed(pa.concat_tables(tables), ["pair"])

    for batch in batches:
        pairs = pa.table({"pair": pc.list_flatten(batch.column(0))}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        held.append(pairs.rename_columns(["pair", "n"]))
        rows += len(pairs)
        if rows > 4 * len(held[0]) + (1 << 18):
            held = [merged(held)]
            rows = len(held[0])
            if rows > 1 << 20:  # what a task holds stays bounded
                yield from held[0].to_batches()
                held, rows = [], 0
    if held:
        yield from merged(held).to_batches()


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n_docs, best): in how many documents a pair is linked, and whether no other
    pair of the same A id is in more."""
    parts = aligned.select("pairs").mapInArrow(_partial_counts, "pair int, n bigint")
    counted = parts.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    counted = written(counted, "pair_counts")
    a = F.floor(F.col("pair") / size_b)
    highest = counted.groupBy(a.alias("a")).agg(F.max("n_docs").alias("top"))
    marked = counted.withColumn("a", a).join(highest, "a")
    return marked.select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def _looked_up(shared):
    """Arrow rows (..., pairs, times) -> (..., n_best, count_sum), from the broadcast counts."""

    def of(batches):
        pair, n_docs, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), pc.list_flatten(batch.column("times")).to_numpy()
            doc = pc.list_parent_indices(pairs).to_numpy()
            at = np.searchsorted(pair, pc.list_flatten(pairs).to_numpy())
            n_best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, doc, times * best[at])
            np.add.at(total, doc, times * n_docs[at])
            kept = batch.drop_columns(["pairs", "times"])
            arrays = [*kept.columns, pa.array(n_best), pa.array(total)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept.schema.names, "n_best", "count_sum"])

    return of


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of each row, written.

    ``pairs`` are the distinct linked pairs (A id * size of B + B id), ``times`` how often
    each is linked in the text.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.make_valid_utf8(F.col(text_col)).alias("text"))
    schema = f"{DOC_COLUMNS}, pairs array<int>, times array<int>"
    return written(rows.mapInArrow(_aligned(path_a, path_b), schema), "aligned")


def token_alignment(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_shared_pairs: int = MAX_SHARED_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: token, group and link counts, and how its links rank.

    A null or empty text, and one whose tokens do not spell a blank and the text under both
    vocabularies, has zeros and an empty digest.  Bytes that are no UTF-8 count as U+FFFD.
    Rows with equal or null ids are documents of their own; other columns are not looked at.
    An empty table gives an empty one.  A stretch without a single blank between other
    characters is encoded as a whole.

    Counts of at most ``max_shared_pairs`` pairs are broadcast; more are joined with the
    documents' pairs.
    """
    spark = docs.sparkSession
    size_b = _piece_count(path_b)
    aligned = aligned_documents(docs, path_a, path_b, id_col, text_col)
    counts = written(pair_counts(aligned, size_b), "pair_ranks")
    n = counts.count()
    columns = ["doc_id", *UnitTable.COUNTS, "n_best", "count_sum", "groups_sha256"]
    if n <= max_shared_pairs:
        table = counts.orderBy("pair").toArrow()
        shared = spark.sparkContext.broadcast(
            (table["pair"].to_numpy(), table["n_docs"].to_numpy(), table["best"].to_numpy(zero_copy_only=False))
        )
        out = aligned.mapInArrow(_looked_up(shared), f"{DOC_COLUMNS}, n_best bigint, count_sum bigint")
        return out.select(*columns)
    numbered = written(aligned.withColumn("row", F.monotonically_increasing_id()), "numbered")
    links = numbered.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", "l.pairs", "l.times")
    ranked = links.join(counts, links["pairs"] == counts["pair"])
    sums = ranked.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).cast("bigint").alias("count_sum"),
    )
    out = numbered.drop("pairs", "times").join(sums, "row", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("n_best", "count_sum")}).select(*columns)


@cache
def _piece_count(path_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
