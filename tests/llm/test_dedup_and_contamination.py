"""Line dedup, SimHash near-dedup and decontamination against plain versions."""

import numpy as np
import pytest
from brute import contamination_rows, line_rows, sha, simhash, simhash_rows, table

from wardlens.llm import components, decontamination, line_dedup, queries, simhash as sim

SCHEMA = "doc_id bigint, text string, fp string, id bigint, words string, component_id int"
WORDS = [f"w{i}" for i in range(300)]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def odd_texts():
    """Nulls, empty texts, long texts, ties, near copies, shared lines and passages."""
    rng = np.random.default_rng(7)
    prose = lambda n: " ".join(rng.choice(WORDS, n))
    base, passage, line = prose(400), prose(60), "A Line that many documents share  "
    texts = [None, "", " ", "\n", "one", base, base, base + " end", base.upper(), prose(20000)]
    texts += [f"{prose(30)}\n{line}\n{prose(30)}" for _ in range(4)] + [line, f"{line}\n{line.upper()}\nx\nx\nx"]
    texts += [f"{prose(12)} {passage} {prose(12)}" for _ in range(6)] + ["é" * 19, "é" * 20, "É" * 20, "é" * 20, "é" * 20]
    texts += [passage.replace(" ", ", ").upper(), " ".join(passage.split()[5:14]), " ".join(passage.split()[5:15])]
    return [{"doc_id": i, "text": t} for i, t in enumerate(texts)], passage


@pytest.fixture(scope="module")
def odd(spark, odd_texts):
    data = [(r["doc_id"], r["text"], "x", 1, None, 2) for r in odd_texts[0]]
    return spark.createDataFrame(data, SCHEMA)


def test_lines_of_the_small_table(spark):
    expected = sorted((d, n, k, sha(t)) for d, n, k, t in line_rows(table("documents")))
    got = rows(queries.op8(spark, "/root/testdata/sf0.001"), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == expected and any(r[2] for r in got)


@pytest.mark.parametrize("options", [{}, {"max_filter_bytes": 8192}, {"bits_per_line": 256}])
def test_lines_of_odd_texts(odd, odd_texts, options):
    """A full filter changes what is shuffled, not the result."""
    got = line_dedup.dedup_lines(odd, **options)
    assert got.columns == [*odd.columns, "_lines"]
    assert rows(got, "doc_id", "_lines.n_lines", "_lines.n_dropped", "_lines.kept") == sorted(line_rows(odd_texts[0]))


def test_lines_of_repeated_rows_and_null_ids(spark):
    line = "a line of twenty characters"
    data = [(1, line), (1, line), (2, line), (None, line)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    assert {r["_lines"]["n_dropped"] for r in line_dedup.dedup_lines(frame).collect()} == {0}
    more = frame.union(spark.createDataFrame([(3, line)], frame.schema))
    got = [(r["doc_id"], r["_lines"]["n_dropped"]) for r in line_dedup.dedup_lines(more).collect()]
    assert sorted(got, key=str) == [(1, 1), (1, 1), (2, 1), (3, 0), (None, 1)]


def test_simhash_of_the_small_table(spark):
    got = rows(queries.op3(spark, "/root/testdata/sf0.001"), "doc_id", "fingerprint", "component_id")
    assert got == sorted(simhash_rows(table("documents")))


def test_simhash_of_odd_texts(odd, odd_texts):
    got = rows(sim.simhash_components(odd), "doc_id", "fingerprint", "component_id")
    assert got == sorted(simhash_rows(odd_texts[0]))


def test_one_of_each_component_stays_with_all_columns(odd, odd_texts):
    kept = sim.one_per_component(odd)
    assert kept.columns == odd.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[2] for r in simhash_rows(odd_texts[0])}


@pytest.mark.parametrize("tile", [8, 64, 4096])
def test_all_links_are_found_whatever_the_tile(spark, tile):
    """Many fingerprints with equal blocks: hot keys are cut into tiles without losing links."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 7), replace=False)) for b in base for _ in range(60)]
    fps = np.unique(np.array([*near, 0, 2**64 - 1], np.uint64))
    frame = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp bigint")
    found = components.components(sim.fingerprint_links(frame, tile=tile))
    label = {int(v): int(v) for v in fps.view(np.int64)} | {r["node"]: r["component"] for r in found.collect()}
    linked = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    reach = linked
    while True:
        more = (reach.astype(np.int32) @ reach.astype(np.int32)) > 0
        if (more == reach).all():
            break
        reach = more
    labels = np.array([label[int(v)] for v in fps.view(np.int64)])
    assert ((labels[:, None] == labels[None, :]) == reach).all()


def test_pivot_table_keeps_every_pair_within_the_limit():
    rng = np.random.default_rng(1)
    fp = np.sort(rng.integers(0, 2**64, 50, dtype=np.uint64))
    fp = np.concatenate([fp, fp ^ np.uint64(0b10110), fp ^ np.uint64(1 << 60)])
    found = {(a, b) for x, y in sim.linked_pairs(np.zeros(len(fp)), fp, 4, sim.pivots()) for a, b in zip(x.tolist(), y.tolist())}
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    assert found == {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if near[i, j]}


def test_fingerprint_is_the_plain_one():
    for text in ("", "a", "a b c d", "A b\tc\x0bd é f", "x " * 999):
        assert sim.fingerprint(text.encode()) & (2**64 - 1) == simhash(text)


def test_components_of_a_long_chain(spark):
    links = spark.range(500).selectExpr("id + 1 a", "id b").union(spark.range(900, 903).selectExpr("id a", "903L b"))
    got = {r["node"]: r["component"] for r in components.components(links.repartition(7)).collect()}
    assert got == {i: 0 for i in range(1, 501)} | {901: 900, 902: 900, 903: 900}
    assert components.components(links.limit(0)).count() == 0


def test_contamination_of_the_small_table(spark):
    found = queries.op4(spark, "/root/testdata/sf0.01")
    got = rows(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    sf = "/root/testdata/sf0.01"
    assert got == sorted(contamination_rows(table("documents", sf), table("benchmark", sf)))


def test_contamination_of_odd_texts(spark, odd, odd_texts):
    texts, passage = odd_texts
    w = passage.split()
    items = [passage, " ".join(w[:30]), " ".join(w[20:26]), w[3], "é" * 20, "", None, " ".join(w[:9]), " ".join(w[:30]), "zzz yyy"]
    items = [{"item_id": i, "text": t} for i, t in enumerate(items)]
    bench = spark.createDataFrame([(r["item_id"], r["text"], 1) for r in items], "item_id bigint, text string, words int")
    got = [
        (r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), sha(",".join(r["items"])), r["n_hit"] > 0)
        for r in decontamination.contamination(odd, bench).collect()
    ]
    expected = contamination_rows(texts, items)
    assert sorted(got) == sorted(expected)
    assert any(r[5] for r in expected) and not all(r[5] for r in expected)


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert line_dedup.dedup_lines(none).count() == 0
    assert sim.simhash_components(none).count() == 0
    assert decontamination.contamination(none, bench).count() == 0
    assert {r["n_hit"] for r in decontamination.contamination(odd, bench.limit(0)).collect()} == {0}
