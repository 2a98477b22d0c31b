"""Language identification, chat rotation, licence scan, sharding, embeddings, pipeline."""

import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import contamination_rows, groups, held_out, line_rows, sha, simhash_rows, table
from tokenizers import Tokenizer

import corpus_pipeline
from wardlens.llm import chat, language_id, licenses, pq_dedup, queries, sharding

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- language identification -------------------------------------------------------------
def test_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r for r in table("documents", sf)}
    got = queries.op1(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(truth) and len(got) == len(truth)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    right = [r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in got if r["held_out"]]
    assert np.mean(right) > 0.97


def plain_grams(text):
    letters = [c.lower()[0] if c.isalpha() else "_" for c in text]
    padded = ["_", *letters, "_"]
    found = {}
    for c in letters:
        if c != "_":
            found[c] = found.get(c, 0) + 1
    for n in (2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if (n == 2 and g != ["_", "_"]) or (n == 3 and g[1] != "_"):
                found["".join(g)] = found.get("".join(g), 0) + 1
    return found


@pytest.mark.parametrize("text", ["", "a", "Ab ba", "x1y", "éÉ ß\n日本", "the the then"])
@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_grams_are_counted_whatever_the_chunk(monkeypatch, text, chunk):
    monkeypatch.setattr(language_id, "CHUNK_CHARS", chunk)
    _, counts = language_id.count_grams(text.encode())
    assert sorted(counts) == sorted(plain_grams(text).values())


def test_out_of_place_distance():
    grams = language_id.top_grams(b"aab", 9)
    same = language_id.Profiles({"x": [int(g) for g in grams], "y": [int(g) for g in grams[::-1]]}, len(grams))
    assert same.predict(b"aab") == ("x", 1.0)
    n = len(grams)
    turned = language_id.Profiles({"y": [int(g) for g in grams[::-1]]}, n)
    distance = sum(abs(i - (n - 1 - i)) for i in range(n))
    assert turned.predict(b"aab") == ("y", pytest.approx(1 - distance / (n * n)))
    assert turned.predict("ыы".encode()) == ("y", pytest.approx(0.0))
    assert same.predict(b" 12 ") == ("und", 0.0)


def test_language_of_odd_rows(spark):
    data = [(1, "le la les des une", "fr", 1), (2, "the and of with", "en", 1), (3, None, "en", 1), (None, "the", "en", 1), (4, "12 34", None, 1)]
    frame = spark.createDataFrame([*data, data[0]], "doc_id bigint, text string, lang string, score int")
    found = language_id.fit_profiles(frame)
    assert found.languages == ["en", "fr"]
    got = frame.select("doc_id", language_id.predict_language(frame, found)["lang_pred"].alias("p")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "fr"), (1, "fr"), (2, "en"), (3, "und"), (4, "und"), (None, "en")], key=str)
    none = language_id.fit_profiles(frame.limit(0))
    assert none.predict(b"the") == ("und", 0.0)


# --- chat rotation -----------------------------------------------------------------------
CHAT = "conv_id bigint, turn bigint, role string, text string, part string, mask int"


def test_every_participant_is_assistant_once(spark):
    said = [("system", "be kind"), ("ann", "hi <|im_end|>"), ("bob", "hello"), ("cleo", ""), ("ann", "bye"), (None, None)]
    data = [(1, i, s, t, "x", 1) for i, (s, t) in enumerate(said)] + [(2, 0, "system", "x", "x", 1), (None, 0, "ann", "x", "x", 1)]
    got = {r["perspective"]: r for r in chat.rotate_perspectives(spark.createDataFrame(data, CHAT)).collect()}
    assert set(got) == {"ann", "bob", "cleo"}
    ann = got["ann"]
    assert ann["text"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\nhello<|im_end|>\n"
        "<|im_start|>user name=cleo\n<|im_end|>\n<|im_start|>assistant\nbye<|im_end|>\n<|im_start|>user name=unknown\n<|im_end|>\n"
    )
    learned = [ann["text"][a:b] for a, b in ann["mask"]]
    assert learned == ["hi < |im_end|><|im_end|>", "bye<|im_end|>"]
    assert [got["cleo"]["text"][a:b] for a, b in got["cleo"]["mask"]] == ["<|im_end|>"]


def test_long_dialogues_and_ties(spark):
    data = [(1, i // 2, "ab"[i % 2], f"m{i}", "", 0) for i in range(40)] + [(1, None, "a", "first", "", 0)] * 2
    frame = spark.createDataFrame(data, CHAT)
    got = {(r["perspective"], r["part"]): r for r in chat.rotate_perspectives(frame, part_turns=8).collect()}
    assert set(got) == {(p, n) for p in "ab" for n in (-1, 0, 1, 2)}
    assert got["a", -1]["text"].count("first") == 2 and got["b", -1]["mask"] == []
    for p in "ab":
        learned = [got[p, n]["text"][a:b] for n in (0, 1, 2) for a, b in got[p, n]["mask"]]
        assert learned == [f"m{i}<|im_end|>" for i in range("ab".index(p), 40, 2)]
    assert chat.rotate_perspectives(frame.limit(0)).count() == 0


# --- licence scan ------------------------------------------------------------------------
def test_longer_rules_take_their_sentences(spark):
    s = licenses.SENTENCES
    mit = ". ".join([s["mit-grant"], s["mit-notice"], s["as-is"]])
    texts = [
        mit.upper() + ".",
        s["mit-grant"] + ". Other words. " + s["mit-notice"],
        "Intro.\nLicensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0.\n" * 3,
        None,
        "",
        "nothing here",
    ]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id int, text string, ids string, left string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(frame).collect()}
    assert [got[i]["licenses"] for i in range(7)] == [["MIT"], ["MIT"], ["Apache-2.0", "CC-BY-NC-4.0"], ["Apache-2.0"], [], [], []]
    assert [got[i]["n_matches"] for i in range(7)] == [1, 1, 2, 3, 0, 0, 0]
    assert [got[i]["n_sentences"] for i in range(7)] == [3, 3, 3, 3, 0, 0, 1]
    assert licenses.scan_licenses(frame.limit(0)).count() == 0


# --- sharding ----------------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 65537])
def test_the_shuffle_is_a_permutation_with_an_inverse(n):
    s = sharding.Shuffle(n)
    placed = s.place(np.arange(n))
    assert sorted(placed) == list(range(n))
    assert (s.row(placed) == np.arange(n)).all()
    if n >= 1000:
        assert (placed != np.arange(n)).mean() > 0.99
        assert abs(np.corrcoef(placed, np.arange(n))[0, 1]) < 0.1


def test_shards_and_slots(spark):
    got = queries.op6(spark, SMALL).collect()
    docs = {r["doc_id"]: r["text"] for r in table("documents")}
    counts = np.bincount([r["shard"] for r in got], minlength=24)
    assert len(got) == len(docs) and counts.max() - counts.min() <= 1 and len(counts) == 24
    for shard in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(counts[shard]))
    for r in got:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 8, zlib.crc32(text), "rows", None)
    order = sorted(docs)
    place = {r["doc_id"]: r["slot"] * 24 + r["shard"] for r in got}
    assert [place[d] for d in order] == sharding.Shuffle(len(docs)).place(np.arange(len(docs))).tolist()


def test_shards_do_not_depend_on_partitions(spark):
    data = [(i % 50, "t" * (i % 7), "x") for i in range(200)] + [(None, None, "x")] * 3
    frame = spark.createDataFrame(data, "doc_id bigint, text string, _at string")
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    one, two = (
        sorted(map(str, (tuple(r) for r in sharding.shard_documents(f, shards=3).select(*columns).collect())))
        for f in (frame.coalesce(1), frame.repartition(9))
    )
    assert one == two and len(one) == 203
    assert sharding.shard_documents(frame.limit(0)).count() == 0


# --- embeddings --------------------------------------------------------------------------
def cosine_rows(ids, vectors, limit=0.9):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    width = max(len(v) for v, o in zip(vectors, ok) if o)
    x = np.array([[*v, *[0.0] * (width - len(v))] if o else [0.0] * width for v, o in zip(vectors, ok)], np.float64)
    size = np.linalg.norm(x, axis=1)
    with np.errstate(invalid="ignore"):
        near = (x @ x.T) / np.outer(size, size) >= limit
    lengths = np.array([len(v) if o else -i for i, (v, o) in enumerate(zip(vectors, ok))])
    near &= (lengths[:, None] == lengths[None, :]) & ~np.eye(len(x), dtype=bool)
    order = np.argsort(ids, kind="stable")
    root = groups(len(ids), lambda i, j: near[order[i], order[j]])
    component = {int(ids[order[i]]): int(ids[order[r]]) for i, r in enumerate(root)}
    return sorted((int(i), int(n), component[int(i)], component[int(i)] == i) for i, n in zip(ids, near.sum(axis=1)))


@pytest.mark.parametrize("tiles", [(16, 64), (512, 8192)])
def test_embeddings_of_the_small_table(spark, tiles):
    rows_ = table("embeddings")
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = rows(pq_dedup.cosine_components(vectors, tiles=tiles), "vec_id", "n_links", "component_id", "kept")
    expected = cosine_rows([r["vec_id"] for r in rows_], [r["embedding"] for r in rows_])
    assert got == expected


def test_recall_near_the_limit(spark):
    """Pairs with a cosine just above the limit among unrelated vectors."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=(1500, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=base.shape)
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9001, 0.96, (1500, 1))
    x = np.concatenate([base, cosine * base + np.sqrt(1 - cosine**2) * side])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = sum(r["n_links"] for r in pq_dedup.cosine_components(frame).collect())
    expected = sum(r[1] for r in cosine_rows(np.arange(len(x)), x.tolist()))
    assert expected >= 3000 and got == expected


@pytest.mark.parametrize("jitter", [0.05, 0.3])
def test_recall_in_a_dense_group(spark, jitter):
    """A third of the vectors in one ball that draws far more lists than a few probes reach."""
    rng = np.random.default_rng(13)
    n, d = 30_000, 64
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(n, d)))
    ball = rng.permutation(n)[: n // 3]
    x[ball] = unit(x[ball[0]] + jitter * x[ball])
    index = pq_dedup.Index.fit(x[: 173 * pq_dedup.SAMPLE_PER_LIST], 173)
    assert len(np.unique(pq_dedup._nearest(x[ball], index.centroids, 1))) > 40
    expected = np.concatenate([(q @ x.T >= 0.9).sum(axis=1) - 1 for q in np.array_split(x, 30)])
    data = pa.table({"vec_id": np.arange(n), "embedding": pa.FixedSizeListArray.from_arrays(x.ravel(), d).cast(pa.list_(pa.float64()))})
    found = pq_dedup.cosine_components(spark.createDataFrame(data)).toArrow().sort_by("vec_id")
    assert found.column("n_links").to_numpy().tolist() == expected.tolist()
    assert len(set(np.array(found.column("component_id"))[ball])) == 1


def test_a_pair_on_two_shelves_counts_at_both_ends():
    """One is sent to the other's shelf, never both; equal vectors count as often as they are there."""
    x = np.array([[1.0, *[0.0] * 7], [0.99, 0.1, *[0.0] * 6]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = pq_dedup.Index(8, x.copy(), np.zeros((8, 1, 1)))
    shelves = pq_dedup.Shelves(np.zeros(2), np.zeros(2), np.ones(2, np.int64), np.arange(2))
    shared, shelved = SimpleNamespace(value=index), SimpleNamespace(value=shelves)
    assigned = pa.RecordBatch.from_pylist([{"cid": 10 + i, "n": 3 + i, "packed": v.tobytes()} for i, v in enumerate(x)])
    [visiting] = pq_dedup._visit(shared, shelved, 0.9, "<f8")(pq_dedup._assign(shared, "<f8")([assigned]))
    assert visiting.column("visits").to_pylist() == [[0], [0, 1]]
    member, visitor = visiting.to_pylist()
    cell = [{"cell": 0, **r} for r in (member, {**visitor, "codes": None, "missed": None})]
    schema = pa.schema([pa.field("cell", pa.int64()), *visiting.schema])
    found = [r for b in pq_dedup._compare(shared, shelved, 0.9, "<f8")([pa.RecordBatch.from_pylist(cell, schema)]) for r in b.to_pylist()]
    assert {r["a"]: r["links"] for r in found if r["links"] is not None} == {10: 4, 11: 3}


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=8).tolist()
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0] * 8, [nan, *v[1:]], [inf, *v[1:]], [None, *v[1:]], v, v, [2 * x for x in v], [-x for x in v]]
    vectors += [[*v, 0.0], [*v, 0.0], [1e-200 * x for x in v], [-0.0, 1.0], [0.0, 1.0]]
    data = [(i, x, i, "a") for i, x in enumerate(vectors)]
    frame = spark.createDataFrame(data, "vec_id bigint, embedding array<double>, cid bigint, packed string")
    clean = [[1e200 * y for y in x] if i == 12 else x for i, x in enumerate(vectors)]
    got = rows(pq_dedup.cosine_components(frame), "vec_id", "n_links", "component_id", "kept")
    assert got == cosine_rows(list(range(len(clean))), clean)
    bad = frame.filter("vec_id < 6")
    assert {r["n_links"] for r in pq_dedup.cosine_components(bad).collect()} == {0}
    assert pq_dedup.cosine_components(frame.limit(0)).count() == 0


# --- pipeline ----------------------------------------------------------------------------
def test_pipeline_is_its_plain_stages(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = [r for r in table("documents") if any(c.isalpha() for c in r["text"] or "")]
    docs = [{"doc_id": d, "text": t} for d, _, _, t in line_rows(docs)]
    docs = [r for r, s in zip(sorted(docs, key=lambda r: r["doc_id"]), simhash_rows(docs)) if s[2] == r["doc_id"]]
    clean = {r[0] for r in contamination_rows(docs, table("benchmark")) if not r[5]}
    docs = [r for r in docs if r["doc_id"] in clean]
    expected = []
    for r in docs:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        expected.append((r["doc_id"], len(ids), sha(library.decode(ids, skip_special_tokens=False))))
    got = rows(corpus_pipeline.run(spark, SMALL), "doc_id", "n_tokens", "decoded_sha256")
    assert got == sorted(expected) and 0 < len(got) < 200


def test_the_language_stage_rejects_scripts_that_were_not_learned(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    foreign = ["Это обычный русский текст о погоде.", "这是一个关于天气的中文文本。", "Это обычный русский текст о погоде, см. сайт https://example.org/about и пишите нам", " 12 ", None]
    more = spark.createDataFrame([(-1 - i, t, None, "x", 1) for i, t in enumerate(foreign)], docs.schema)
    kept = corpus_pipeline.identify_language(spark, docs.union(more), SMALL)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()}


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == 0


@pytest.mark.parametrize("copies", [1, 40])
def test_pairs_exactly_at_the_limit_link(spark, copies):
    """Small integer vectors whose cosine is 0.9 without rounding, alone and in a dense cell."""
    pairs = [((1, 0, 0, 0), (9, 3, 3, 1)), ((0, 2, 0, 0), (3, 9, 1, 3)), ((0, 0, 5, 0), (1, 3, 9, 3))]
    assert all(pq_dedup.stated_cosine(np.array(a, float).tobytes(), np.array(b, float).tobytes(), "<f8") >= 0.9 for a, b in pairs)
    rows = [[float(v) * (k + 1) for v in side] for k in range(copies) for pair in pairs for side in pair]
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id bigint, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.cosine_components(frame).collect()}
    x = [[int(v) for v in r] for r in rows]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    linked = lambda a, b: dot(a, b) > 0 and 100 * dot(a, b) ** 2 >= 81 * dot(a, a) * dot(b, b)
    assert got == {i: sum(j != i and linked(a, b) for j, b in enumerate(x)) for i, a in enumerate(x)}
