from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seriesloom.llm import common, embedding_dedup, line_dedup, queries, simhash_dedup, substring_dedup
from tests.llm import brute
from tests.llm.conftest import LONG


def test_components_of_chains_stars_and_loops(spark):
    rnd = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    noise = [(2000 + rnd.randrange(80), 2000 + rnd.randrange(80)) for _ in range(60)]
    edges = chain + star + noise + [(5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    real = [(a, b) for a, b in edges if a != b]
    want = brute.components({n for e in real for n in e}, real)
    assert {r["node"]: r["component"] for r in common.components(df).collect()} == want
    assert common.components(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \t\nZé ", max_size=60))
def test_fingerprint(text):
    assert simhash_dedup.fingerprint(text.encode()) == brute.fingerprint(text)


def test_simhash_groups_equal_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.simhash_groups(docs)
    found = queries.op2_simhash_dedup(spark, sf).collect()
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in found} == want
    assert all(len(r["fingerprint"]) == 16 for r in found)


@pytest.mark.parametrize("rows", [4, 64])
def test_simhash_links_in_long_and_short_lists(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash_dedup, "LIST_ROWS", rows)
    rnd = random.Random(3)
    bases = [rnd.getrandbits(64) for _ in range(4)]
    prints = {b ^ sum(1 << i for i in rnd.sample(range(64), k)) for b in bases for k in (0, 1, 1, 2, 2, 3, 4) for _ in range(9)}
    signed = [p - (p >> 63 << 64) for p in prints]
    reps = spark.createDataFrame([(p, i) for i, p in enumerate(signed)], "fp long, rep long")
    found = {(r["a"], r["b"]) for r in simhash_dedup.links(reps).collect()}
    ids = {p - (p >> 63 << 64): p for p in prints}
    values = [ids[p] for p in signed]
    near = [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 2]
    nodes = range(len(values))
    assert brute.components(nodes, found) == brute.components(nodes, near)


def test_simhash_edges(make, edge):
    rows = {r["doc_id"]: r for r in simhash_dedup.groups(make(edge)).collect()}
    assert rows[0]["fp"] == rows[1]["fp"] == rows[2]["fp"] == 0
    assert rows[0]["component_id"] == rows[2]["component_id"] == 0
    assert rows[4]["component_id"] == 3
    kept = simhash_dedup.deduplicate(make(edge + [(3, "one")]))
    assert kept.columns == make(edge).columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 5, 6, 8, 9] and ids.count(None) == 1
    assert simhash_dedup.groups(make(edge).limit(0)).count() == 0
    clash = make(edge).withColumn("fp", F.lit("x")).withColumn("component_id", F.lit("y"))
    assert simhash_dedup.deduplicate(clash).columns == clash.columns


def vectors(seed=0):
    rnd = np.random.default_rng(seed)
    rows = []
    for i in range(60):
        base = rnd.normal(size=16)
        rows.append((i, base.astype("f4").tolist(), i % 3))
        rows.append((100 + i, (base + rnd.normal(size=16) * 0.12).astype("f4").tolist(), i % 3))
    rows += [(300 + i, rows[0][1], 0) for i in range(5)]
    rows += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [1.0, None], 0), (404, [math.nan, 1.0], 0)]
    rows += [(405, [math.inf, 1.0], 0), (406, rows[0][1], None), (407, [x * 3 for x in rows[0][1]], 0), (408, [1.0, 2.0], 0), (409, [2.0, 4.0], 0)]
    return rows


@pytest.mark.parametrize("tile", [7, 1024])
def test_vectors_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n_links", F.lit("own"))
    found = embedding_dedup.near_duplicates(df.repartition(3)).collect()
    f4 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], p) for i, v, p in rows]
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == brute.near_vectors(f4)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bound_is_sound():
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embedding_dedup.quantised(x)
    i, j = embedding_dedup.possible(q, s, e, q, s, e, 0.3)
    assert set(zip(*np.nonzero(x @ x.T >= 0.3), strict=True)) <= set(zip(i, j, strict=True))


def test_repeated_vector_rows_are_copies(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0)], "vec_id long, embedding array<float>, label int")
    assert [tuple(r) for r in embedding_dedup.near_duplicates(df).collect()] == [(1, 1, 1, True)] * 2


def test_majorities():
    rnd = np.random.default_rng(0)
    counts = np.array([1, 2, 3, 254, 255, 256, 511, 1000])
    hashes = rnd.integers(0, 2**64, counts.sum(), dtype=np.uint64)
    at = np.cumsum(counts) - counts
    want = [sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes[a : a + n]) > n) for a, n in zip(at, counts)]
    assert common.majorities(hashes, counts).tolist() == want


def test_line_edges(make, edge):
    docs = make(edge + [(3, "one")]).withColumn("n_removed", F.lit("own"))
    out = line_dedup.deduplicate(docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(edge) + 1
    assert rows[0]["text"] is None and rows[1]["text"] == "" and rows[2]["text"] == edge[2][1]
    assert rows[3]["text"] == "one" and rows[4]["text"] == "" and rows[9]["text"] == "same line here"
    assert rows[7]["text"] == ""  # within the similarity of document 6
    assert line_dedup.deduplicate(docs.limit(0)).count() == 0


def test_substrings_equal_brute_force_on_the_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, k, brute.sha(t)) for i, (n, k, t) in brute.without_repeats(docs).items()}
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in queries.op7_substring_dedup(spark, sf).collect()}
    assert found == want and any(k for _, k, _ in want.values())


def test_substrings_of_periodic_and_overlapping_texts(make):
    rnd = random.Random(11)
    vocabulary = "abcdef"
    shared = [rnd.choice(vocabulary) * rnd.randint(1, 3) for _ in range(120)]
    docs = [(0, "a " * 100), (1, "a b " * 60), (2, " ".join(shared)), (3, " ".join(shared[10:90] + shared[5:60])), (4, None), (5, "")]
    for i in range(6, 40):
        a = rnd.randrange(0, 80)
        own = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        docs.append((i, " ".join(own + shared[a : a + rnd.randint(20, 70)] + own[::-1])))
    found = substring_dedup.deduplicate(make(docs).withColumn("kept", F.lit("own"))).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in found} == brute.without_repeats(docs)
    for r in found:
        assert sum(s["words"] for s in r["removed_spans"]) == r["n_removed"]


def test_substring_edges(make, edge):
    out = substring_dedup.deduplicate(make(edge + [(6, LONG)]))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(edge) + 1
    assert (rows[0]["n_words"], rows[0]["kept"]) == (0, "")
    assert rows[6]["n_removed"] == rows[6]["n_words"] == 20_000 and rows[7]["kept"] == "tail"
    assert substring_dedup.deduplicate(make(edge).limit(0)).count() == 0


def test_repeated_ids_with_other_vectors_and_text_labels(spark):
    rows = [(1, [0.0, 1.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.001], "a"), (3, [1.0, 0.0], "b"), (None, [1.0, 0.0], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    found = sorted((tuple(r) for r in embedding_dedup.near_duplicates(df).collect()), key=str)
    assert found == sorted([(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (None, 0, None, True)], key=str)


@pytest.mark.parametrize("name", ["doc", "tag", "spans", "_t", "rank", "_source", "_s", "_data", "_in", "_kept", "fp", "drop"])
def test_clashing_names(make, name):
    from seriesloom.llm import mixing, quality, simhash_dedup

    docs = make([(0, "some words here"), (1, "some words here"), (2, None)]).withColumn(name, F.lit("own"))
    for out in (
        substring_dedup.deduplicate(docs), mixing.mix(docs), quality.with_signals(docs), quality.passing(docs),
        simhash_dedup.with_fingerprint(docs), simhash_dedup.deduplicate(docs),
    ):
        assert name in out.columns
        out.count()
