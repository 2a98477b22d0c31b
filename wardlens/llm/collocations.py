"""Collocations by multikey three-way quicksort of suffix pointers.

Every word occurrence is a suffix pointer; its key is the words from there to the end of
the piece, at most ``max_words``.  The pointers are partitioned three ways by the word at
the current depth (less, equal, greater than a pivot); the equal part goes on one word
deeper, and an equal part at the last depth is one phrase, whose count is its size.

This happens twice.  A task sorts the pointers of a block of texts, which counts its
phrases before anything is shuffled.  The counted suffixes are then routed by their
leading words to buckets over the whole corpus, and each bucket is sorted again, pointers
now carrying counts: an equal part at depth two is complete there, and one that is too rare
is abandoned before it is partitioned further.

Single words are routed by the word.  Suffixes are routed by their first two words; where
these are very common, by the first three, with the count of the pair sent apart, so that
no bucket gets more than its share.  Which pairs count as very common is taken from a
bounded sample; it decides where rows go and changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.materialize import written
from .common import LOWER, group_batches, small_batches

MIN_COUNT = 10
MAX_WORDS = 3
TOP = 2000
INSIDE_PERCENT = 50  # of a phrase's occurrences lie inside a longer candidate: it is dropped
BLOCK_WORDS = 1 << 20  # sorted at once before the shuffle
BUCKET_BYTES = 8 << 20  # of text that one bucket stands for
SMALL_PART = 1 << 14  # pointers below which a part is sorted directly
SAMPLE_ROWS = 2000  # documents that tell which pairs are very common
HOT_SHARE = 1 / 2000  # of the sampled pairs
MAX_HOT = 8192  # routes that are broadcast at most
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TO_WORDS = bytes(ord(".") if c in _BREAKS else 0x20 if c == 9 else c for c in LOWER)
WORD, SUFFIX, LONG = 0, 1, 2  # kinds of routed rows


def words_of(text: bytes) -> list[bytes]:
    """Words in order, with b"." where a piece ends; no word holds a break or a blank."""
    return text.translate(_TO_WORDS).replace(b".", b" . ").split()


def equal_parts(keys: list[np.ndarray], weights: np.ndarray | None = None, least: list[int] | None = None) -> tuple:
    """(pointers, sizes): one pointer per distinct key, and how many pointers have it.

    ``keys`` holds one column per depth; pointers with ``weights`` count that often.  Parts
    that are equal down to depth d and smaller than ``least[d]`` are abandoned.
    """
    depth_of_all = len(keys)
    weigh = (lambda p: len(p)) if weights is None else (lambda p: int(weights[p].sum()))
    found, sizes = [], []
    stack = [(np.arange(len(keys[0])), 0)] if len(keys[0]) else []
    while stack:
        part, depth = stack.pop()
        if depth and least and least[depth - 1] > 1 and weigh(part) < least[depth - 1]:
            continue
        if depth == depth_of_all:
            found.append(part[:1])
            sizes.append(np.array([weigh(part)]))
        elif len(part) <= SMALL_PART:
            pointers, n = _small_part(keys, part, depth, weights, least)
            found.append(pointers)
            sizes.append(n)
        else:
            key = keys[depth][part]
            pivot = np.sort(key[:: len(key) // 64])[32]  # middle of a few
            stack += [(part[key > pivot], depth), (part[key < pivot], depth), (part[key == pivot], depth + 1)]
            stack = [s for s in stack if len(s[0])]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found), np.concatenate(sizes).astype(np.int64)


def _small_part(keys, part, depth, weights, least) -> tuple[np.ndarray, np.ndarray]:
    """What ``equal_parts`` finds below ``depth``, by one sort of the remaining words."""
    order = np.lexsort([keys[d][part] for d in range(len(keys) - 1, depth - 1, -1)])
    part = part[order]
    own = np.ones(len(part), np.int64) if weights is None else weights[part]
    new = np.zeros(len(part), bool)
    new[0] = True
    stays = np.ones(len(part), bool)
    for d in range(depth, len(keys)):
        key = keys[d][part]
        new[1:] |= key[1:] != key[:-1]
        if least and least[d] > 1:
            starts = np.flatnonzero(new)
            size = np.add.reduceat(own, starts)
            stays &= np.repeat(size >= least[d], np.diff(starts, append=len(part)))
    starts = np.flatnonzero(new)
    size = np.add.reduceat(own, starts)
    return part[starts][stays[starts]], size[stays[starts]]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def route(hashes: list[np.ndarray]) -> np.ndarray:
    """A number that the given leading words, as hashes, share."""
    out = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        out = _mix(out * np.uint64(31) + h)
    return out


class Block:
    """Texts of one language as word numbers; number 0 ends a piece."""

    def __init__(self):
        self.number = defaultdict(count(1).__next__, {b".": 0})
        self.codes: dict[str, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        words = words_of(text)
        words.append(b".")
        self.codes[lang].append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def suffixes(self, max_words: int) -> Iterator[tuple[str, np.ndarray, list[np.ndarray], np.ndarray]]:
        """(language, count of every word number, words of each distinct suffix, their counts)."""
        for lang, parts in self.codes.items():
            codes = np.concatenate([*parts, np.zeros(max_words, np.int32)])
            at = np.flatnonzero(codes)
            keys = [codes[at]]
            for d in range(1, max_words):
                keys.append(np.where(keys[-1] != 0, codes[at + d], 0))
            pointers, sizes = equal_parts(keys)
            yield lang, np.bincount(codes, minlength=len(self.number)), [k[pointers] for k in keys], sizes

    def routed(self, max_words: int, buckets: int, hot: np.ndarray) -> Iterator[tuple]:
        """(bucket, lang, kind, words, counts) of all suffixes; ``hot`` are routes of common pairs."""
        names = [*self.number]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        for lang, words, keys, sizes in self.suffixes(max_words):
            of_lang = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))

            def way(columns, n, of_lang=of_lang):
                return route([np.full(n, of_lang), *(hashes[c] for c in columns)])

            words[0] = 0
            known = np.flatnonzero(words)
            yield from self._dealt(names, lang, WORD, [known], words[known], way([known], len(known)), buckets)
            longer = keys[1] != 0
            keys, sizes = [k[longer] for k in keys], sizes[longer]
            pair = way(keys[:2], len(sizes))
            common = np.isin(pair, hot)
            if common.any():
                deep = [k[common] for k in keys]
                whole = deep[2] != 0 if max_words > 2 else np.zeros(len(deep[0]), bool)
                own = [k[whole] for k in deep]
                yield from self._dealt(names, lang, LONG, own, sizes[common][whole], way(own[:3], len(own[0])), buckets)
                # the pair itself: one row with its whole count
                starts, inverse = np.unique(pair[common], return_index=True, return_inverse=True)[1:]
                totals = np.bincount(inverse, sizes[common]).astype(np.int64)
                none = np.zeros(len(starts), np.int32)
                deep = [k[starts] if d < 2 else none for d, k in enumerate(deep)]
                yield from self._dealt(names, lang, SUFFIX, deep, totals, pair[common][starts], buckets)
                keys, sizes, pair = [k[~common] for k in keys], sizes[~common], pair[~common]
            yield from self._dealt(names, lang, SUFFIX, keys, sizes, pair, buckets)

    @staticmethod
    def _dealt(names, lang, kind, keys, sizes, way, buckets) -> Iterator[tuple]:
        bucket = (way % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        flat = np.stack(keys, axis=1)[order] if len(keys) else None
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for start, end in zip(edges, [*edges[1:], len(order)]):
            words = b" ".join([names[i] if i else b"" for i in flat[start:end].ravel().tolist()])
            yield int(bucket[order[start]]), lang, kind, words, sizes[order[start:end]].astype("<u8").tobytes()


_ROUTED = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("kind", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])


def _blocks(max_words: int, buckets: int, hot, block_words: int):
    """Arrow rows (lang, text) -> counted suffixes of each block, routed by leading words."""

    def rows(block: Block) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in block.routed(max_words, buckets, hot.value):
            held.append(row)
            size += len(row[3]) + len(row[4])
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist([dict(zip(_ROUTED.names, r)) for r in held], _ROUTED)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(_ROUTED.names, r)) for r in held], _ROUTED)

    def of(batches):
        block = Block()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(lang, text)
                if block.size >= block_words:
                    yield from rows(block)
                    block = Block()
        yield from rows(block)

    return of


def _common_pairs(share: float):
    """Arrow rows (lang, text) of a sample -> counts of pairs, as their routes."""

    def of(batches):
        block = Block()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block.add(lang, text)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in block.number), np.uint64, len(block.number))
        for lang, _, keys, sizes in block.suffixes(2):
            of_lang = np.full(len(sizes), np.uint64(xxhash.xxh3_64_intdigest(lang.encode())))
            kept = (keys[1] != 0) & (sizes >= max(2, share * sizes.sum() / 4))
            way = route([of_lang[kept], *(hashes[k[kept]] for k in keys)])
            yield pa.RecordBatch.from_arrays([pa.array(way.view(np.int64)), pa.array(sizes[kept])], ["way", "n"])

    return of


def hot_pairs(rows: DataFrame, n_rows: int, sample_rows: int = SAMPLE_ROWS, share: float = HOT_SHARE) -> np.ndarray:
    """Routes of the pairs that are very common in a sample: at most ``MAX_HOT`` numbers."""
    sample = rows.sample(min(1.0, sample_rows / max(1, n_rows)), seed=42)
    counted = sample.coalesce(8).mapInArrow(_common_pairs(share), "way bigint, n bigint").groupBy("way").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "way").limit(MAX_HOT).collect()
    total = sum(r["n"] for r in top)
    return np.array([r["way"] for r in top if r["n"] >= share * total], np.int64).view(np.uint64)


def _frequent(max_words: int, min_count: int):
    """Arrow rows of whole buckets -> phrases of ``min_count`` or more, and words in all per language."""

    def of(batches):
        for table in group_batches(batches, "bucket"):
            # batches end between buckets, and a bucket holds every kind and language
            for bucket in _split(table, ["bucket", "lang", "kind"]):
                lang, kind = (bucket.column(c)[0].as_py() for c in ("lang", "kind"))
                width = 1 if kind == WORD else max_words
                number = defaultdict(count(1).__next__, {b"": 0})
                flat = [
                    np.fromiter(map(number.__getitem__, payload.split(b" ")), np.int32)
                    for payload in bucket.column("words").to_pylist()
                ]
                codes = np.concatenate(flat).reshape(-1, width)
                weights = np.concatenate([np.frombuffer(c, "<u8") for c in bucket.column("counts").to_pylist()]).astype(np.int64)
                names = [*number]
                keys = [np.ascontiguousarray(codes[:, d]) for d in range(width)]
                if kind == WORD:
                    yield _out([lang], [0], [""], [int(weights.sum())])
                for depth in range({WORD: 1, SUFFIX: 2, LONG: 3}[kind], width + 1):
                    whole = keys[depth - 1] != 0
                    own = [k[whole] for k in keys[:depth]]
                    # a part that is rare after its leading words is abandoned there
                    least = [1 if kind != WORD and d == 0 or kind == LONG and d == 1 else min_count for d in range(depth)]
                    pointers, n = equal_parts(own, weights[whole], least)
                    phrases = [b" ".join([names[k[p]] for k in own]).decode() for p in pointers.tolist()]
                    yield _out([lang] * len(n), [depth] * len(n), phrases, n.tolist())

    return of


def _split(table: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from a table sorted by them."""
    table = table.combine_chunks()
    new = np.zeros(len(table), bool)
    new[:1] = True
    for key in keys:
        column = np.asarray(table.column(key).to_pylist(), dtype=object)
        new[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(new).tolist()
    for start, end in zip(starts, [*starts[1:], len(table)]):
        yield table.slice(start, end - start)


def _out(lang, length, phrase, n) -> pa.RecordBatch:
    arrays = [pa.array(lang, pa.string()), pa.array(length, pa.int32()), pa.array(phrase, pa.string()), pa.array(n, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "words", "phrase", "f"])


def phrase_counts(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    block_words: int = BLOCK_WORDS,
    bucket_bytes: int = BUCKET_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """(lang, words, phrase, f): every phrase of 1 to ``max_words`` words that occurs
    ``min_count`` times or more; ``words`` = 0 has the number of all words of a language."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.make_valid_utf8(F.col(text_col)), F.lit(""))
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text.cast("binary").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // bucket_bytes))
    hot = spark.sparkContext.broadcast(hot_pairs(rows, size["rows"], share=hot_share))
    schema = "bucket int, lang string, kind int, words binary, counts binary"
    routed = rows.mapInArrow(_blocks(max_words, buckets, hot, block_words), schema)
    dealt = routed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "lang", "kind")
    found = dealt.mapInArrow(_frequent(max_words, min_count), "lang string, words int, phrase string, f bigint")
    return written(found, "phrase_counts")


def candidates(counts: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of every phrase of two words or more, by its lowest cut."""
    phrases = counts.filter("words >= 2").withColumn("parts", F.split("phrase", " "))
    cuts = F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"),
        F.array_join(F.slice("parts", 1, k), " ").alias("left"),
        F.array_join(F.slice("parts", k + 1, max_words), " ").alias("right"),
    )))
    cut = phrases.select("lang", "phrase", "words", F.col("f").alias("a"), cuts.alias("c"))
    cut = cut.select("lang", "phrase", "words", "a", "c.k", "c.left", "c.right")
    known = counts.filter("words >= 1")
    for side, n in (("left", "l"), ("right", "r")):
        cut = cut.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(n)), ["lang", side])
    # exact: the products pass 64 bits, the quotient is at most a million
    scored = cut.withColumn("score", F.expr(
        "(1000000 * cast(a as decimal(16, 0)) * cast(a as decimal(16, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    ))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return scored.groupBy("lang", "phrase", "words", "a").agg(lowest.alias("c")).select(
        "lang", "phrase", "words", "a", "c.l", "c.r", "c.score"
    )


def _not_inside(found: DataFrame, percent: int, max_words: int) -> DataFrame:
    """Candidates but those of which ``percent`` of the occurrences lie in one longer candidate."""
    size, parts = F.col("words"), F.split("phrase", " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " ")
    )))
    inner = found.filter("words > 2").select("lang", F.explode(F.array_distinct(runs)).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    joined = found.join(inner, ["lang", "phrase"], "left")
    return joined.filter(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a"))).drop("longer")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    inside_percent: int = INSIDE_PERCENT,
    top: int = TOP,
    **options,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score.

    Null languages are ``und``, null texts empty; bytes that are no UTF-8 count as U+FFFD.
    Repeated rows count as often as they occur; ties go by count, then by the phrase's bytes.
    A language without candidates has no rows, an empty table gives an empty one, and other
    columns are not looked at.
    """
    counts = phrase_counts(docs, text_col, lang_col, min_count, max_words, **options)
    found = written(_not_inside(candidates(counts, max_words), inside_percent, max_words), "collocations")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # the best of each share of a language first, so that no task orders all of it
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", share).orderBy(*best)))
    first = first.filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("bigint"))
    totals = counts.filter("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = MIN_COUNT, inside_percent: int = INSIDE_PERCENT, top: int = TOP) -> str:
    """The same in SQL, for phrases of two and three words."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
with texts as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''), '{upper}', '{lower}') t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) p from texts),
worded as (select lang, regexp_extract_all(p, '[^\x20\x09]+') w from pieces),
placed as (select lang, w, unnest(range(1, len(w) + 1)) i from worded),
runs as (
  select lang, 1 words, w[i] phrase from placed
  union all select lang, 2, w[i] || ' ' || w[i + 1] from placed where i + 1 <= len(w)
  union all select lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] from placed where i + 2 <= len(w)),
f as (select lang, words, phrase, count(*) f from runs group by all),
totals as (select lang, sum(f)::bigint n from f where words = 1 group by lang),
cuts as (
  select c.lang, c.words, c.phrase, c.f a, k,
    array_to_string(string_split(c.phrase, ' ')[1:k], ' ') lft, array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') rgt
  from f c, range(1, 3) ks(k) where c.words >= 2 and c.f >= {min_count} and k < c.words),
scored as (
  select c.lang, c.words, c.phrase, c.a, c.k, x.f l, y.f r,
    ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f))::bigint score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.lft join f y on y.lang = c.lang and y.phrase = c.rgt),
cand as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inner_runs as (
  select lang, array_to_string(string_split(phrase, ' ')[1:2], ' ') phrase, a from cand where words = 3
  union all select lang, array_to_string(string_split(phrase, ' ')[2:3], ' '), a from cand where words = 3),
longest as (select lang, phrase, max(a) longer from inner_runs group by all),
kept as (
  select c.* from cand c left join longest g on g.lang = c.lang and g.phrase = c.phrase
  where g.longer is null or 100 * g.longer < {inside_percent} * c.a),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= {top}
"""
