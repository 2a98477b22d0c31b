"""Token alignment against a plain version that aligns whole texts with the libraries."""

import hashlib
from bisect import bisect_left
from collections import Counter
from functools import cache
from itertools import accumulate

import public_tokenizers
import pytest
import sentencepiece
from brute import table
from tokenizers import Tokenizer

from wardlens.llm import queries, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None,
    "",
    " ",
    "   two  blanks   and a tab\t here \n\n new  line \n",
    "Don't <|endoftext|> stop <s>it</s> <unk> <0x41>",
    "a▁b is spelled another way",
    "日本語テキスト 한국어 ไทย 👩‍👩‍👧 😀!!! ###$$$ ½ é",
    "x" * 3000,
    "ab " * 2000,
    "a b　c\x85d \x1c e\x00f ᠎ g",
    "same words again and again",
    "same words again and again",
    "Same Words Again",
]


@cache
def names_of_a():
    return token_alignment.byte_level_entries({i: t for t, i in Tokenizer.from_file(A).get_vocab().items()})


def plain_groups(library, pieces, text):
    """Groups of (A ids, B ids) of a whole text; none where the bytes differ."""
    whole = b" " + text.encode()
    names_a = names_of_a()
    a = library.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    bytes_a = [names_a[i] for i in a]
    bytes_b = [token_alignment.piece_bytes(pieces.id_to_piece(i)) for i in b]
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends_a, ends_b = ([*accumulate(map(len, x))] for x in (bytes_a, bytes_b))
    cuts = sorted({*ends_a} & {*ends_b})
    groups = [([], []) for _ in cuts]
    for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
        for i, end in zip(ids, ends):
            groups[bisect_left(cuts, end)][side].append(i)
    return groups


def plain_rows(rows):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    found = [(r["doc_id"], plain_groups(library, pieces, r["text"] or "")) for r in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in found]
    docs = Counter(pair for c in links for pair in c)
    top = {}
    for (x, _), n in docs.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (doc_id, groups), c in zip(found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), c.total(),
            sum(n for p, n in c.items() if docs[p] == top[p[0]]), sum(n * docs[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_is_the_plain_version(spark):
    want = sorted(plain_rows(table("documents")), key=repr)
    assert rows_of(queries.QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")) == want


@pytest.mark.parametrize("shared", [token_alignment.MAX_SHARED_PAIRS, 0], ids=["broadcast", "joined"])
def test_odd_texts_equal_and_null_ids(spark, shared):
    rows = [(None if i == 3 else i // 2, t, i, "x") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, pairs int, row string").repartition(3)
    found = token_alignment.token_alignment(docs, A, B, max_shared_pairs=shared)
    assert rows_of(found) == sorted(plain_rows([{"doc_id": r[0], "text": r[1]} for r in rows]), key=repr)


def test_empty_table_and_bytes_that_are_no_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    found = token_alignment.token_alignment(empty, A, B)
    assert rows_of(found) == [] and found.columns == COLUMNS
    broken = spark.sql("select 1L doc_id, cast(unhex('6120ff62') as string) text")
    assert rows_of(token_alignment.token_alignment(broken, A, B)) == plain_rows([{"doc_id": 1, "text": "a �b"}])


def test_long_group_is_paired_in_slices(monkeypatch):
    monkeypatch.setattr(token_alignment, "SLICE_LINKS", 50)
    vocab = token_alignment.Vocabularies(A, B)
    units = ["ﷺ" * 30 + "né", "plain", "漢字かな" * 20, "ab"]
    found = token_alignment.align(*vocab.encode(units), vocab)
    library = Tokenizer.from_file(A)
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    want = Counter()
    for i, unit in enumerate(units):
        for a, b in plain_groups(library, pieces, unit):
            want.update((i, x * vocab.size_b + y) for x in a for y in b)
    got = found["pairs"].to_pylist()
    assert Counter({(r["unit"], r["pair"]): r["n"] for r in got}) == want and len(got) == len(want)


def test_table_of_units_may_be_emptied_at_any_time(monkeypatch):
    monkeypatch.setattr(token_alignment, "TABLE_BYTES", 500)
    own = token_alignment.UnitTable(token_alignment.Vocabularies(A, B))
    texts = [t or "" for t in ODD]
    once = [token_alignment.align_texts([t], own) for t in texts]
    counts, digests, _ = token_alignment.align_texts(texts, own)
    assert [d[0] for _, d, _ in once] == digests
    assert [c["n_links"][0] for c, _, _ in once] == counts["n_links"].tolist()
