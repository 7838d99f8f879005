from __future__ import annotations

import random

import corpus_pipeline
from seriesloom.llm import simhash_dedup
from tests.llm import brute


def similar_groups(docs) -> dict[int, int]:
    """Groups by nothing but the rule: Jaccard similarity of the sets of five-word shingles of at least 0.8."""
    sets = {}
    for i, text in docs:
        ws = brute.words((text or "").lower())
        sets[i] = {tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))}
    ids = list(sets)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    return brute.components(ids, edges)


def edited_docs(seed: int = 3) -> list[tuple[int, str]]:
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(900)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 300))) for _ in range(60)]
    for base in texts[:40]:
        for edits in (1, 1, 2, 3, 5):
            ws = base.split()
            for _ in range(edits):
                ws[rnd.randrange(len(ws))] = rnd.choice(vocabulary)
            texts.append(" ".join(ws))
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_similar_groups_equal_brute_force(make):
    docs = edited_docs()
    want = similar_groups(docs)
    assert len(set(want.values())) < len(docs) - 60
    assert {r["doc_id"]: r["component_id"] for r in simhash_dedup.similar_groups(make(docs)).collect()} == want


def test_pipeline_stage_drops_edited_copies(spark, make):
    docs = edited_docs(5)
    want = {i for i, c in similar_groups(docs).items() if i == c}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, make(docs), "").collect()} == want


def test_similar_edges(make, edge):
    kept = simhash_dedup.deduplicate_similar(make(edge + [(3, "one")]))
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [0, 3, 5, 6, 8, 9] and ids.count(None) == 1
    assert kept.columns == make(edge).columns
    assert simhash_dedup.similar_groups(make(edge).limit(0)).count() == 0


def test_pipeline_stage_links_by_fingerprints_too(spark, make):
    """Texts whose repeated words decide the fingerprint are linked by it, though few of their distinct shingles are shared."""
    shared = " ".join(f"word{i}" for i in range(11))
    docs = [(i, " ".join([shared] * 60 + [f"own{i}x{k}" for k in range(40)])) for i in range(6)]
    docs += [(10 + i, f"quite another text number {i} of some {i * i} words") for i in range(4)]
    prints = [simhash_dedup.fingerprint(text.encode()) for _, text in docs]
    assert len({i for i, c in similar_groups(docs).items() if i == c}) == len(docs)
    want = {i for i, c in brute.components([i for i, _ in docs], [(docs[a][0], docs[b][0]) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]).items() if i == c}
    assert len(want) < len(docs)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, make(docs), "").collect()} == want
