"""Repeated substrings against a plain version that remembers every string."""

import hashlib

import numpy as np
import pytest
from brute import table
from hypothesis import given, settings
from hypothesis import strategies as st

from wardlens.llm import queries, substring_dedup

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]


def plain_rows(docs, length=100):
    """Rows are (id or None, bytes); ties of ids by a digest of the text."""
    seen, out = set(), []
    key = lambda r: (r[0] is None, r[0] or 0, int.from_bytes(hashlib.blake2b(r[1], digest_size=8).digest(), "little", signed=True))
    for doc_id, text in sorted(docs, key=key):
        gone = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - length + 1):
            if text[p : p + length] in seen:
                gone[p : p + length] = True
            seen.add(text[p : p + length])
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(gone[i] and not gone[i - 1] for i in range(len(text)))
        out.append((doc_id, len(text), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def rows_of(df):
    found = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.select(*COLUMNS).collect()]
    return sorted(found, key=repr)


def test_cover_has_every_difference():
    differences = {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER}
    assert differences == set(range(substring_dedup.PERIOD))


def test_query_is_the_plain_version(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in table("documents")]
    want = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_rows(docs)]
    got = queries.QUERIES["op12_substring_dedup"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


def word(i):
    return hashlib.md5(str(i).encode()).hexdigest()


ODD = [
    (5, None),
    (5, ""),
    (4, "x" * 99),
    (3, "x" * 100),
    (2, "x" * 350),
    (1, "ab" * 80),
    (9, "é" * 70),
    (8, "a" + "é" * 70),
    (7, "".join(map(word, range(20)))),
    (6, "tail" + "".join(map(word, range(20))) + "head"),
    (6, "tail" + "".join(map(word, range(20))) + "head"),
    (None, "".join(map(word, range(10, 30)))),
    (None, "".join(map(word, range(10, 30)))),
    (10, "".join(map(word, range(5))) + "-" + "".join(map(word, range(14, 20)))),
    (10, "".join(map(word, range(40, 50))) + "".join(map(word, range(40, 50)))),
]


@pytest.mark.parametrize(("block", "bucket"), [(1 << 20, 1 << 20), (300, 200)])
def test_odd_texts_shared_and_null_ids(spark, block, bucket):
    rows = [(d, t, i, b"k") for i, (d, t) in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block bigint, kept binary").repartition(3)
    found = substring_dedup.dedup_substrings(docs, block_bytes=block, bucket_bytes=bucket)
    assert rows_of(found) == plain_rows([(d, (t or "").encode()) for d, t in ODD])


def test_other_length_empty_table_and_bytes_that_are_no_text(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert rows_of(substring_dedup.dedup_substrings(empty)) == []
    broken = spark.sql("select id doc_id, cast(unhex(repeat('61ff', 60)) as string) text from range(3)")
    assert rows_of(substring_dedup.dedup_substrings(broken, length=80)) == plain_rows([(i, b"a\xff" * 60) for i in range(3)], 80)
    with pytest.raises(ValueError, match="too short"):
        substring_dedup.dedup_substrings(empty, length=60)


class Tables:
    """The steps without Spark: blocks as lists of rows, answers passed by hand."""

    @staticmethod
    def run(blocks, length, buckets):
        import pyarrow as pa

        own = []
        for rows in blocks:
            data = {"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.binary()), "row": range(len(rows))}
            own.append(substring_dedup.Block(pa.table(data), length, buckets))
        for (ask, answer), learn in zip(substring_dedup.STEPS, ("keep_repeated", "settle", None)):
            asked = [(bucket, i, *parts) for i, b in enumerate(own) for bucket, *parts in ask(b)]
            answers = [{} for _ in own]
            for bucket in {r[0] for r in asked}:
                rows = [r for r in asked if r[0] == bucket]
                names = ("bucket", "block", "asked", "owners", "places")
                for r, a in zip(rows, answer(pa.table(dict(zip(names, zip(*rows)))))):
                    answers[r[1]][bucket] = a
            for b, a in zip(own, answers):
                getattr(b, learn)(a) if learn else b.finish(b.state(), a)
        return sorted((tuple(r.values()) for b in own for r in b.rows.to_pylist()), key=repr)


@settings(max_examples=120, deadline=None)
@given(st.data())
def test_pasted_stretches_in_any_block(data):
    """Stretches of a few sources pasted behind one another, so that repeats begin and end anywhere."""
    source = b"".join(word(i).encode() for i in range(30)) + b"z" * 130 + b"pq" * 70
    stretch = st.tuples(st.integers(0, len(source) - 1), st.integers(1, 260)).map(lambda x: source[x[0] : x[0] + x[1]])
    texts = data.draw(st.lists(st.lists(stretch, max_size=5).map(b"".join), min_size=1, max_size=9))
    ids = data.draw(st.permutations(range(len(texts))))
    docs = [*zip(ids, texts)]
    cut = data.draw(st.integers(0, len(docs)))
    blocks = [b for b in (docs[:cut], docs[cut:]) if b]
    assert Tables.run(blocks, 100, data.draw(st.integers(1, 5))) == plain_rows(docs)


def test_names_do_not_depend_on_the_slices(monkeypatch):
    """Equal cover strings have equal names wherever they lie, different ones different names."""
    import pyarrow as pa

    text = b"".join(word(i).encode() for i in range(12)) * 3
    table = pa.table({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array([text, text[7:]], pa.binary()), "row": [0, 1]})
    names = []
    for size in (1 << 19, 64):
        monkeypatch.setattr(substring_dedup, "SLICE_BYTES", size)
        block = substring_dedup.Block(table, 100, 3)
        docs, places = block.cover_positions()
        names.append(block.names(docs, places))
        strings = [block.texts[d][p : p + block.sample] for d, p in zip(docs.tolist(), places.tolist())]
        assert len({*zip(strings, names[-1].tolist())}) == len(set(strings)) == len(set(names[-1].tolist()))
    assert (names[0] == names[1]).all()
