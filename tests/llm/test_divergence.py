"""The audit against one that sums every term of every pair."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = [s for x, s in groups if x == lang]

        def p(count):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        each = {s: p(counts[lang, s]) for s in own}
        q = p(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(sum(abs(each[s][t] - each[o][t]) for t in kept), o) for o in own if o != s]
            marks = [(each[s][t] - q[t], t) for t in kept if counts[lang, s][t] and each[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", marks, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows, **options):
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    df = df.withColumns({"term": F.lit(1), "counts": F.lit("x"), "p": F.lit(0)})
    return sorted(map(tuple, divergence.audit(df, **options).collect()))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(1)
    words = ["the", "The", "é", "É", "naïve", "日本", "x-y", "a1b", "don't", *(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))]
    sources = [None, "", "a", "b", "ü", "web"]
    texts = [
        (" ".join(rnd.choices(words, weights=[1 + (i * (3 + s) % 17) ** 2 for i in range(len(words))], k=rnd.randint(0, 60))), lang, sources[s])
        for lang in ("en", "de", None)
        for s in range(len(sources))
        for _ in range(30)
    ]
    return [*texts, (None, "en", "silent"), ("", "en", "silent"), ("1 2 3", "xx", "one"), ("rare", "yy", "one"), (None, "yy", "two")]


@pytest.mark.parametrize("entries", [1, 200, 10**6])
def test_equals_sums_over_all_terms(spark, rows, entries):
    """One run a document, several, and one a task: the merged runs are the same index."""
    assert audited(spark, rows, min_docs=5, top=7, entries=entries) == brute(rows, 5, 7)


def test_blocks_of_sources_and_small_chunks(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "SIDE", 2)
    monkeypatch.setattr(divergence, "CHUNK", 3)
    monkeypatch.setattr(divergence, "PIECE", 10)
    assert audited(spark, rows, min_docs=3, top=50) == brute(rows, 3, 50)


def test_repeated_and_very_long_texts_and_none(spark):
    rows = [("Wort und Wort " * 300_000, "de", "a"), ("Wort", "de", "b"), ("Wort", "de", "b")]
    assert audited(spark, rows, min_docs=1) == brute(rows, 1, 50)
    assert audited(spark, []) == []


def test_one_run_in_memory_at_a_time():
    """A chunk is opened only when the merge reaches it."""
    opened = []

    def chunks():
        for i in range(50):
            opened.append(i)
            word = b"%03d" % i
            row = {"lang": "en", "first": word, "names": ["s"], "terms": [word], "docs": [1], "sources": [0], "counts": [2], "sizes": [1]}
            yield divergence._Chunk({k: pa.scalar(v) for k, v in row.items()})

    merged = divergence._merged(chunks(), 1)
    for i in range(10):
        assert next(merged) == ("en", b"%03d" % i, 1, {"s": 2})
        assert len(opened) <= i + 3


def test_runs_are_sorted_by_term():
    batch = pa.record_batch([pa.array(["en"] * 3), pa.array(["a", "b", "a"]), pa.array(["b a c", "c a", "d"])], names=["lang", "source", "text"])
    seen = [t for out in divergence._runs(1, 10**6)(iter([batch])) for row in out.to_pylist() for t in row["terms"]]
    assert seen == [b"a", b"b", b"c", b"d"]
