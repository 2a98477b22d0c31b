"""Collocations against a plain version over lists."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import lower, table

from wardlens.llm import collocations, queries

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_rows(rows, min_count=10, max_words=3, percent=50, top=2000):
    counts = defaultdict(Counter)
    for r in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(r["text"])):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                counts[r["lang"] if r["lang"] is not None else "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = defaultdict(int)
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        rows = []
        for p, a in found.items():
            if p in inside and 100 * inside[p] >= percent * a:
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((" ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        rows.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *x) for i, x in enumerate(rows[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_query_is_the_plain_version(spark):
    assert rows_of(queries.QUERIES["op11_collocations"](spark, "/root/testdata/sf0.001")) == plain_rows(table("documents"))


ODD = [
    ("en", "New York is big. New York! new york\tcity, NEW YORK city; York"),
    ("en", "a a a a a a\na a b a a b\x0ba a b"),
    (None, "a b c a b c a b c"),
    ("und", "a b c, a b c"),
    ("fr", None),
    ("fr", ""),
    ("fr", "... !? \t \n"),
    ("", "É è É è É è x\x00y z x\x00y z\x1cq  c d"),
    ("de", "ß " * 500 + "ß"),
    ("en", "the cat " * 300),
]


@pytest.mark.parametrize(("hot", "block", "size"), [(1 / 2000, 1 << 20, 1 << 20), (1e-9, 40, 300), (0.2, 7, 100)])
def test_odd_texts_whatever_the_routes(spark, hot, block, size):
    rows = [(i // 2, lang, text, "x") for i, (lang, text) in enumerate(ODD * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string, phrase string").repartition(4)
    want = plain_rows([{"lang": r[1], "text": r[2]} for r in rows], min_count=3, max_words=4, top=5)
    found = collocations.collocations(
        docs, min_count=3, max_words=4, top=5, hot_share=hot, block_words=block, bucket_bytes=size
    )
    assert rows_of(found) == want


def test_empty_table_and_no_candidates(spark):
    schema = "lang string, text string"
    assert rows_of(collocations.collocations(spark.createDataFrame([], schema))) == []
    assert rows_of(collocations.collocations(spark.createDataFrame([("en", "one two three")], schema))) == []


def test_one_phrase_holds_a_third_of_all_words(spark):
    rows = [("en", "hot pair here " * 400 + f"rare{i} word{i % 7} here")  for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert rows_of(collocations.collocations(docs, block_words=3000)) == plain_rows([{"lang": r[0], "text": r[1]} for r in rows])


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    counts = spark.createDataFrame(
        [("en", 1, "x", big + 1), ("en", 1, "y", big + 7), ("en", 2, "x y", big)], "lang string, words int, phrase string, f bigint"
    )
    row = collocations.candidates(counts).first()
    assert row["score"] == 1000000 * big * big // ((big + 1) * (big + 7))


def test_equal_parts_are_the_counts(monkeypatch):
    monkeypatch.setattr(collocations, "SMALL_PART", 200)
    rng = np.random.default_rng(5)
    keys = [rng.zipf(1.4, 20_000).clip(max=60).astype(np.int32) for _ in range(3)]
    weights = rng.integers(1, 5, 20_000)
    for own in (None, weights):
        n = np.ones(20_000, int) if own is None else own
        want = Counter()
        for row, w in zip(zip(*keys), n):
            want[tuple(map(int, row))] += int(w)
        pointers, sizes = collocations.equal_parts(keys, own)
        assert {tuple(int(k[p]) for k in keys): int(s) for p, s in zip(pointers, sizes)} == want
        assert len(pointers) == len(want)
        pointers, sizes = collocations.equal_parts(keys, own, [40, 20, 9])
        first, second = Counter(), Counter()
        for row, w in want.items():
            first[row[:1]] += w
            second[row[:2]] += w
        kept = {r: w for r, w in want.items() if w >= 9 and second[r[:2]] >= 20 and first[r[:1]] >= 40}
        assert {tuple(int(k[p]) for k in keys): int(s) for p, s in zip(pointers, sizes)} == kept
