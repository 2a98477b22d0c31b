"""BPE encoding and decoding with a contiguous rank array per word.

A word is held as an array of part boundaries and, beside it, the merge ranks of adjacent
parts.  The smallest rank is searched by a scan, its boundary is deleted, and the ranks of
the two neighbours are looked up anew, until no adjacent parts merge.  Words are short, so
scanning an array beats a heap; only a word of more than ``LONG_WORD`` bytes, whose scans
would take the square of its length, keeps its ranks in a heap.

The vocabulary file says how a text becomes words: special strings, normalisation, the
split pattern, bytes as visible characters and the suffix of a word's last part.  Encoded
words are kept in tables of bounded bytes in each worker, as words repeat; long ones are not.
A full table becomes the older one and takes the older one's place, and words that are met
again move on, so that common words are not forgotten with the rare ones.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import utf8

TABLE_BYTES = 20 << 20  # of each of the four tables of known words, as held in memory
ENTRY_BYTES = 170  # of an entry besides its characters and ids
LONGEST_KNOWN = 64  # characters of a word that is remembered
LONG_WORD = 256  # bytes from which merges are found by a heap
_NEVER = 1 << 60
# the pattern language of the vocabulary file counts these as white space
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


@cache
def byte_characters() -> list[str]:
    """The visible character that stands for each byte value in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    moved = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [chr(moved.get(b, b)) for b in range(256)]


class WordBpe:
    """A vocabulary of the kind of ``word_bpe_49k.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {
            (self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.inner = [self.ids[c] for c in byte_characters()]
        self.last = [self.ids[c + self.suffix] for c in byte_characters()]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", _SPACE)
        self.words = regex.compile(split).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        # ids of texts between blanks, and of words, as little-endian 32-bit numbers
        self.table: dict[str, bytes] = {}
        self.word_table: dict[str, bytes] = {}
        self.older_table: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.table_bytes = self.word_bytes = 0

    def merge(self, word: str) -> list[int]:
        """Ids of one word, by repeated deletion of the boundary of smallest rank."""
        data = word.encode()
        if len(data) > LONG_WORD:
            return self._merge_long(data)
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.last[data[-1]])
        lookup = self.ranks.get
        none = (_NEVER, 0)
        ranks = [lookup(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best is none:
                break
            at = ranks.index(best)
            parts[at] = best[1]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = lookup((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = lookup((parts[at], parts[at + 1]), none)
        return parts

    def _merge_long(self, data: bytes) -> list[int]:
        """The same for a long word: neighbours are linked, and a heap holds the ranks.

        Of equal ranks the leftmost comes first, as in the scan.  An entry is stale where one
        of its parts has been merged since.
        """
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.last[data[-1]])
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        lookup = self.ranks.get
        heap = []
        for at, pair in enumerate(zip(parts, parts[1:])):
            found = lookup(pair)
            if found:
                heap.append((found[0], at, *pair, found[1]))
        heapq.heapify(heap)
        while heap:
            _, at, left, right, merged = heapq.heappop(heap)
            to = after[at]
            if parts[at] != left or to < 0 or parts[to] != right:
                continue
            parts[at], parts[to] = merged, -1
            after[at] = after[to]
            if after[to] >= 0:
                before[after[to]] = at
            for a, b in ((before[at], at), (at, after[at])):
                if a >= 0 and b >= 0:
                    found = lookup((parts[a], parts[b]))
                    if found:
                        heapq.heappush(heap, (found[0], a, parts[a], parts[b], found[1]))
        return [p for p in parts if p >= 0]

    def _word(self, word: str) -> bytes:
        found = self.word_table.get(word)
        if found is None:
            found = self.older_words.get(word)
            if found is None:
                found = self.pack(self.merge(word))
            if len(word) <= LONGEST_KNOWN:
                if self.word_bytes > TABLE_BYTES:
                    self.older_words, self.word_table, self.word_bytes = self.word_table, {}, 0
                self.word_table[word] = found
                self.word_bytes += ENTRY_BYTES + len(word) + len(found)
        return found

    def normalise(self, text: str) -> str:
        """Canonical composition, then lower case letter by letter (no rule for word ends)."""
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def _piece(self, piece: str) -> bytes:
        """Packed ids of a text between blanks."""
        found = self.table.get(piece)
        if found is None:
            found = self.older_table.get(piece)
            if found is None:
                words = self.words(self.normalise(piece))
                # a piece that is one word shares its characters and ids with the table of words
                found = self._word(piece) if words == [piece] else b"".join([*map(self._word, words)])
            if len(piece) <= LONGEST_KNOWN:
                if self.table_bytes > TABLE_BYTES:
                    self.older_table, self.table, self.table_bytes = self.table, {}, 0
                self.table[piece] = found
                self.table_bytes += ENTRY_BYTES + len(piece) + len(found)
        return found

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def pieces(self, text: str) -> list[bytes]:
        """Packed ids of the text's pieces.  Blanks and line breaks never lie inside a word, and no
        composition reaches across them, so they are safe places to cut."""
        if self.specials is None or "<|" not in text:
            return [*map(self._piece, text.split(" "))] if "\n" not in text else [*map(self._piece, text.replace("\n", " ").split(" "))]
        out = []
        for i, part in enumerate(self.specials.split(text)):
            if i % 2:
                out.append(self.pack([self.special[part]]))
            else:
                out += map(self._piece, part.replace("\n", " ").split(" "))
        return out

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        return b"".join(self.pieces(text))

    def encode(self, text: str) -> list[int]:
        return self.unpack(self.packed(text))

    def unpack(self, packed: bytes) -> list[int]:
        return np.frombuffer(packed, "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The parts' names with a blank between them, as the vocabulary has no decoder."""
        return " ".join(map(self.names.__getitem__, ids))

    def text_of(self, ids: list[int]) -> str:
        """Words back from ids: bytes of the parts, a blank where a word ends."""
        back = {c: b for b, c in enumerate(byte_characters())}
        out = bytearray()
        for i in ids:
            name = self.names[i]
            if i in self.special.values():
                out += name.encode() + b" "
                continue
            ends = self.suffix and name.endswith(self.suffix)
            out += bytes(back[c] for c in (name.removesuffix(self.suffix) if ends else name))
            out += b" " if ends else b""
        return out.decode(errors="replace").rstrip(" ")


@cache
def vocabulary(path: str) -> WordBpe:
    """One vocabulary per worker and path."""
    return WordBpe(path)


def encode_column(text: Column | str, path: str) -> Column:
    """A struct (n_tokens, ids as bytes of little-endian 32-bit numbers, decoded) of each text.

    Null is an empty text, which has no ids and decodes to an empty string.  Strings of
    special tokens inside a text become their ids.  ``path`` is a file every executor has.
    """

    @F.arrow_udf("struct<n_tokens: bigint, ids: binary, decoded: string>")
    def of(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        n, ids, decoded = [], [], []
        for text in texts.to_pylist():
            ids.append(bpe.packed(text.decode()))
            n.append(len(ids[-1]) // 4)
            decoded.append(bpe.decode(bpe.unpack(ids[-1])))
        arrays = [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n_tokens", "ids", "decoded"])

    return of(utf8(text))


def digest_column(text: Column | str, path: str, keep_ids: bool = False) -> Column:
    """A struct (n_tokens, ids_sha256, decoded_sha256, ids); neither the decoded text nor, unless
    ``keep_ids``, the ids leave the worker (``ids`` is null then)."""

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string, ids: binary>")
    def of(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path)
        n, digests, decoded, kept = [], [], [], []
        for text in texts.to_pylist():
            ids = bpe.packed(text.decode())
            n.append(len(ids) // 4)
            digests.append(hashlib.sha256(ids).hexdigest())
            decoded.append(hashlib.sha256(bpe.decode(bpe.unpack(ids)).encode()).hexdigest())
            kept.append(ids if keep_ids else None)
        arrays = [pa.array(n, pa.int64()), *(pa.array(x, pa.string()) for x in (digests, decoded)), pa.array(kept, pa.binary())]
        return pa.StructArray.from_arrays(arrays, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    return of(utf8(text))
