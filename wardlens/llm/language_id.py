"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams in order of
frequency.  A document gets a profile of its own in the same way; its distance to a
language is the sum, over its n-grams, of how many places each is out of its place in the
language's list, an n-gram that the list lacks counting as the full length.  The nearest
language wins.

Profiles are learned from labelled rows.  The fit reads a sample of them, whose expected
size per language is a parameter; a language with fewer rows gives all of them.  Sampled
rows are counted where they lie and only the counts of distinct n-grams are shuffled.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import small_batches, utf8

ORDERS = (1, 2, 3)
PROFILE_SIZE = 400
SAMPLE_PER_LANGUAGE = 4000
CHUNK_CHARS = 1 << 20  # long texts are counted in pieces of this many characters
UNKNOWN = "und"
_GAP = 1  # code of everything that is no letter; not 0, so that n-grams of all orders differ


@cache
def _letters() -> np.ndarray:
    """Code point -> code point of its lower-case letter, or the gap where it is no letter."""
    chars = map(chr, range(0x110000))
    return np.fromiter((ord(c.lower()[0]) if c.isalpha() else _GAP for c in chars), np.int64, 0x110000)


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """n-grams as numbers, 21 bits a character; those with a gap inside or alone are left out."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out = np.zeros(n, np.int64)
    for i in range(order):
        out = (out << 21) | codes[i : i + n]
    keep = np.ones(n, bool)
    for i in range(1 if order > 1 else 0, order - 1 if order > 1 else 1):
        keep &= codes[i : i + n] != _GAP
    if order == 2:
        keep &= (codes[:-1] != _GAP) | (codes[1:] != _GAP)
    return out[keep]


def count_grams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a UTF-8 text and how often each occurs.

    An n-gram of 2 or 3 may start or end in the gap beside a word.
    """
    points = np.frombuffer(f"\n{text.decode()}\n".encode("utf-32-le"), np.uint32)
    letters = _letters()
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, len(points), CHUNK_CHARS):
        codes = letters[points[start : start + CHUNK_CHARS + max(ORDERS) - 1]]
        for order in ORDERS:  # those that start in this chunk
            parts.append(np.unique(_grams(codes[: CHUNK_CHARS + order - 1], order), return_counts=True))
    grams = np.concatenate([p[0] for p in parts])
    counts = np.concatenate([p[1] for p in parts])
    distinct, place = np.unique(grams, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def top_grams(text: bytes, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first; ties in the numbers' order."""
    grams, counts = count_grams(text)
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """Rank tables of all languages over the n-grams that any of them lists."""

    def __init__(self, ranked: dict[str, list[int]], size: int):
        self.size = size
        self.languages = sorted(ranked)
        self.grams = np.unique(np.fromiter((g for v in ranked.values() for g in v), np.int64))
        self.ranks = np.full((len(self.grams), len(self.languages)), -1, np.int64)
        for j, lang in enumerate(self.languages):
            self.ranks[np.searchsorted(self.grams, ranked[lang]), j] = np.arange(len(ranked[lang]))

    def predict(self, text: bytes) -> tuple[str, float]:
        """(language, score): 1 is a profile in the same order, 0 one without a shared n-gram."""
        own = top_grams(text, self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        listed = self.grams[at] == own
        ranks = np.where(listed[:, None], self.ranks[at], -1)
        off = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = np.minimum(off, self.size).sum(axis=0)
        best = int(distance.argmin())  # ties go to the first name
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def _count_rows(batches):
    """(lang, gram, n) of the rows of a task, counted text by text."""
    totals: dict[str, list] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            totals.setdefault(lang, []).append(count_grams(text))
        for lang, parts in totals.items():
            grams, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            totals[lang] = [(grams, np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64))]
    for lang, [(grams, counts)] in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], ["lang", "gram", "n"]
        )


def is_held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_profiles(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    size: int = PROFILE_SIZE,
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
) -> Profiles:
    """Learn profiles from rows whose language is known.

    About ``sample_per_language`` rows of each language are read, chosen by a hash of the
    id, so that a repeated fit reads the same rows; rows with a null id, text or language
    teach nothing.  Without labelled rows there is no language.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = rows.groupBy("lang").count().collect()  # one row per language
    if not counts:
        return Profiles({}, size)
    share = F.lit(0.0)
    for lang, n in counts:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample_per_language / n))).otherwise(share)
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = rows.filter(chance < share).select("lang", utf8("text"))
    grams = sampled.mapInArrow(_count_rows, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    ranked: dict[str, list[int]] = {}
    top = grams.withColumn("place", place).filter(F.col("place") <= size).orderBy("lang", "place")
    for r in top.collect():  # at most ``size`` rows per language
        ranked.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(ranked, size)


def predict_language(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> Column:
    """A struct (lang_pred, score) of each whole text.

    ``und`` with score 0 where the text is null, has no letter, or no language was learned.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in texts.to_pylist()]
        names, scores = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return of(utf8(docs[text_col]))
