"""BPE and token counts against the tokenizers library."""

import hashlib
import sys
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from brute import sha, table
from tokenizers import Tokenizer

from wardlens.llm import bpe, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    " ",
    "\n\t\r\x0b\x0c",
    "Don't STOP'ing we'll they'Ve 'S",
    "a<|startoftext|>b <|endoftext|>, <|ENDOFTEXT|> <|endoftext|><|endoftext|",
    "<|endoftext|>\n<|startoftext|>",
    "ΑΣ ΟΔΟΣ Σ σς İstanbul ẞ ǅ",
    "é e ́ ́x Å 가 ﬁ ½ ² ١٢٣ 123456",
    "日本語テキスト 한국어 ไทย हिन्दी 👩‍👩‍👧 😀!!! ###$$$",
    "x" * 5000,
    "a b c　d e\x85f\x1cg\x1fh​i﻿j",
    "ab " * 3000,
    "\x00\x01\x7f",
]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def plain(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_encoding_is_the_librarys(library, text):
    own = bpe.vocabulary(PATH)
    ids, decoded = plain(library, text)
    assert own.encode(text) == ids
    assert own.decode(ids) == decoded
    assert token_counts.counter(PATH).count(text) == len(ids)


def test_every_character_in_a_text(library):
    """One text per block of code points; those that Python's Unicode tables lack are left out."""
    own, counter = bpe.vocabulary(PATH), token_counts.counter(PATH)
    differ = []
    for start in range(0, 0x30000, 64):
        block = "".join(f"a{chr(c)}b {chr(c)}" for c in range(start, start + 64) if unicodedata.category(chr(c)) not in ("Cn", "Cs"))
        ids = library.encode(block, add_special_tokens=False).ids
        if own.encode(block) != ids or counter.count(block) != len(ids):
            differ.append(hex(start))
    assert differ == []


def test_words_come_back():
    own = bpe.vocabulary(PATH)
    assert own.text_of(own.encode("The quick brown fox, naïve")) == "the quick brown fox , naïve"


def test_merges_follow_ranks_in_long_words(library):
    rng = np.random.default_rng(5)
    own = bpe.vocabulary(PATH)
    for n in range(1, 60):
        word = "".join(rng.choice(list("abcdehinorst"), n))
        assert own.merge(word) == library.encode(word, add_special_tokens=False).ids


def test_queries_of_the_small_table(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in table("documents")}
    nine = {r["doc_id"]: r for r in queries.op9(spark, sf).collect()}
    seven = {r["doc_id"]: r for r in queries.op7(spark, sf).collect()}
    assert set(nine) == set(seven) == set(docs)
    for doc_id, text in docs.items():
        ids, decoded = plain(library, text)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        r = nine[doc_id]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest, sha(decoded))
        assert (seven[doc_id]["n_tokens"], seven[doc_id]["n_bytes"]) == (len(ids), len(text.encode()))
        assert seven[doc_id]["over_limit"] == (len(ids) > 2048)


def test_columns_over_odd_rows(spark, library):
    data = [(i, t, 1, "x") for i, t in enumerate([None, *ODD, ODD[4], ODD[4]])]
    frame = spark.createDataFrame(data, "doc_id bigint, text string, t int, ids string")
    got = frame.select("doc_id", token_counts.token_count("text", PATH, 64).alias("n"), bpe.encode_column("text", PATH).alias("e"))
    for r, (_, text, *_) in zip(sorted(got.collect()), data):
        ids, decoded = plain(library, text)
        assert (r["n"], np.frombuffer(r["e"]["ids"], "<u4").tolist(), r["e"]["decoded"]) == (len(ids), ids, decoded)
    assert frame.limit(0).select(bpe.digest_column("text", PATH)).count() == 0


def test_parts_and_batches_lose_nothing():
    text = " ".join(f"w{i}" for i in range(3000))
    cut = [*token_counts.parts(text, 100)]
    assert " ".join(cut) == text and max(map(len, cut)) < 120
    assert [*token_counts.parts("x" * 500, 100)] == ["x" * 500]
    texts = [b"x" * n for n in (1, 500, 3, 0, 90, 20)]
    batches = [*token_counts.byte_balanced(texts, 100)]
    assert [t for b in batches for t in b] == texts and len(batches) == 2


def test_tables_of_words_are_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BYTES", 2000)
    monkeypatch.setattr(token_counts, "TABLE_PIECES", 10)
    own, counter = bpe.WordBpe(PATH), token_counts.PieceCounter(PATH, 32)
    text = " ".join(f"word{i}" for i in range(200))
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids and len(own.table) <= 10
    assert counter.count(text) == len(ids)
    assert sys.getsizeof(own.word_table) < 10_000


def test_long_words_in_time_and_as_the_library(library, monkeypatch):
    """Long words go through the heap, whose ids are those of the scan and of the library."""
    import random
    import time

    rng = random.Random(3)
    words = ["a" * 1_000_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=200_000)), "ab" * 700 + "é" * 300]
    own = bpe.WordBpe(PATH)
    start = time.perf_counter()
    found = [own.encode(w) for w in words]
    assert time.perf_counter() - start < 60
    assert found == [plain(library, w)[0] for w in words]
    short = ["".join(rng.choices("abct hes", k=n)).replace(" ", "e") for n in range(1, 250, 7)]
    scanned = [own.merge(w) for w in short]
    assert [own._merge_long(w.encode()) for w in short] == scanned
    assert not own.table or max(map(len, own.table)) <= bpe.LONGEST_KNOWN


def test_tables_of_words_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_BYTES", 2000)
    own = bpe.WordBpe(PATH)
    text = " ".join(f"word{i}" for i in range(500))
    assert own.encode(text) == bpe.vocabulary(PATH).encode(text)
    assert len(own.table) < 20 and len(own.word_table) < 20


def test_words_met_again_are_still_known():
    """100,000 different words fit into the tables of a worker, which were emptied again and again before."""
    coder = bpe.WordBpe(PATH)
    words = [f"w{i}x" for i in range(100_000)]
    for word in words:
        coder._piece(word)
    assert all(word in coder.table for word in words)


def test_common_words_stay_known_among_many_rare_ones(monkeypatch):
    """Full tables were emptied whole, so that every common word was encoded anew."""
    monkeypatch.setattr(bpe, "TABLE_BYTES", 50_000)
    coder, merged = bpe.WordBpe(PATH), []
    merge = coder.merge
    monkeypatch.setattr(coder, "merge", lambda word: merged.append(word) or merge(word))
    for i in range(2000):
        coder.encode(f"common rare{'x' * (i % 40)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}")
    assert merged.count("common") == 1 and len(merged) > 1500


def test_tables_of_words_hold_few_bytes():
    """The four tables of a worker hold at most some 100 MB; they took twice that."""
    coder = bpe.WordBpe(PATH)
    before = coder.table_bytes
    for i in range(1000):
        coder._piece(f"word{i}")
    tables = (coder.table, coder.word_table)
    held = sum(sys.getsizeof(t) for t in tables) + sum({id(o): sys.getsizeof(o) for t in tables for kv in t.items() for o in kv}.values())
    assert held <= coder.table_bytes - before + coder.word_bytes
    assert 4 * bpe.TABLE_BYTES <= 100 << 20
