"""Token counts by batch encoding, returning lengths only.

Texts are cut at blanks and line breaks, which no token of a vocabulary that drops white
space reaches across; a long text is therefore never encoded as a whole, and its count is
the sum over its pieces.  Pieces not met before are encoded by the library in batches of
about equal bytes, and only the lengths come back.  A worker remembers the lengths of a
bounded number of pieces, as words repeat.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import utf8

BATCH_BYTES = 1 << 20  # of pieces in one call of the library
PART_CHARS = 1 << 20  # of a text that are split at once
TABLE_PIECES = 400_000


class PieceCounter:
    """Lengths of pieces under one vocabulary file."""

    def __init__(self, path: str, batch_bytes: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the worker is one of many on its machine
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.batch_bytes = batch_bytes
        self.table: dict[str, int] = {"": 0}

    def _encode(self, pieces: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        self.table.update(zip(pieces, map(len, encoded)))

    def learn(self, pieces: set[str]) -> None:
        """Look up the lengths of all ``pieces``, in batches balanced by bytes."""
        new = [p for p in pieces if p not in self.table]
        if len(self.table) + len(new) > TABLE_PIECES:
            self.table = {"": 0}
            new = [*pieces]
        batch, size = [], 0
        for piece in new:
            batch.append(piece)
            size += len(piece.encode())
            if size >= self.batch_bytes:
                self._encode(batch)
                batch, size = [], 0
        if batch:
            self._encode(batch)

    def count(self, text: str) -> int:
        total = 0
        for part in parts(text):
            pieces = part.split(" ")
            self.learn(set(pieces))
            total += sum(map(self.table.__getitem__, pieces))
        return total


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut at blanks, line breaks as blanks."""
    text = text.replace("\n", " ")
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def byte_balanced(texts: list[bytes], size: int) -> Iterator[list[bytes]]:
    """Consecutive texts in batches that end when they reach ``size`` bytes."""
    batch, total = [], 0
    for text in texts:
        batch.append(text)
        total += len(text)
        if total >= size:
            yield batch
            batch, total = [], 0
    if batch:
        yield batch


@cache
def counter(path: str, batch_bytes: int = BATCH_BYTES) -> PieceCounter:
    """One counter per worker and vocabulary file."""
    return PieceCounter(path, batch_bytes)


def token_count(text: Column | str, path: str, batch_bytes: int = BATCH_BYTES) -> Column:
    """The number of tokens of each whole text, without added special tokens.

    Null and empty texts have none.  Strings of special tokens inside a text count as the
    library takes them.  ``path`` is a vocabulary file of the tokenizers library that every
    executor has; its words must not reach across blanks and line breaks.
    """

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        counts = []
        own = counter(path, batch_bytes)
        for batch in byte_balanced(texts.to_pylist(), 4 * batch_bytes):
            whole = [t.decode() for t in batch]
            if sum(map(len, whole)) <= PART_CHARS * 8:  # one call for the new pieces of many texts
                own.learn({p for t in whole if len(t) <= PART_CHARS for p in t.replace("\n", " ").split(" ")})
            counts += map(own.count, whole)
        return pa.array(counts, pa.int64())

    return of(utf8(text))
