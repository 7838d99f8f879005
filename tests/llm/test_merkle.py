"""The Merkle manifest against a plain tree built node by node."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from seriesloom.llm import merkle

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root and each leaf's siblings."""
    proofs = [[] for _ in nodes]
    level, owners = list(nodes), [[i] for i in range(len(nodes))]
    while len(level) > 1:
        above, merged = [], []
        for i in range(0, len(level), 2):
            run = level[i : i + 2]
            for j in range(len(run)):
                for leaf in owners[i + j]:
                    proofs[leaf] += run[:j] + run[j + 1 :]
            above.append(h(*run))
            merged.append([x for o in owners[i : i + 2] for x in o])
        level, owners = above, merged
    return level[0], proofs


def brute(rows):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r[0], h(*map(field, r))))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    roots, proofs = [], {}
    for name in names:
        leaves = sorted(trees[name], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subroot, own = tree([x[1] for x in leaves])
        roots.append(subroot)
        proofs[name] = list(zip(leaves, own, strict=True))
    root, upper = tree(roots)
    return sorted(
        (str(doc), leaf, roots[i], root, h(*own, *upper[i]))
        for i, name in enumerate(names)
        for (doc, leaf), own in proofs[name]
    )


def found(spark, rows, **columns):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    df = df.withColumns({"pos": F.lit(1), "tree": F.lit("x"), "node": F.lit("y"), "each": F.lit(0)})
    return merkle.manifest(df, "lang", "doc_id", FIELDS, columns or None)


def digests(out):
    rows = out.withColumn("p", merkle.proof_hash(F.col("proof"))).collect()
    return sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], r["p"]) for r in rows)


@pytest.mark.parametrize("step", [2, 3, 8])
def test_equals_a_plain_tree(spark, monkeypatch, step):
    """Trees of one leaf, of powers of two and of one more, over one and several stored levels."""
    monkeypatch.setattr(merkle, "STEP", step)
    sizes = {None: 1, "": 2, "é": 3, "a": 4, "b": 5, "c": 17, "zz": 65}
    rows = [(i, "s", lang, i * 3, f"t{i}") for lang, n in sizes.items() for i in range(n)]
    random.Random(0).shuffle(rows)
    out = found(spark, rows)
    assert digests(out) == brute(rows)
    assert out.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).isEmpty()


def test_edges(spark):
    """Null fields and keys, empty and very long texts, repeated rows, clashing names."""
    rows = [(None, None, None, None, None), (1, "", "en", 0, ""), (1, "", "en", 0, ""), (2, "s", "en", 5, "é\n:-"), (3, "-", "en", None, "wörd " * 400_000)]
    assert digests(found(spark, rows)) == brute(rows)


def test_one_row_and_none(spark):
    one = [(7, "s", "en", 1, "x")]
    assert digests(found(spark, one)) == brute(one)
    assert found(spark, []).count() == 0


def test_tampering_shows(spark):
    rows = [(i, "s", "ab"[i % 2], i, f"t{i}") for i in range(40)]
    changed = merkle.leaf([F.col(f) + 1 if f == "n_chars" else F.col(f) for f in FIELDS])
    out = found(spark, rows, tampered=F.when(F.col("doc_id") % 5 == 0, changed))
    fits = merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")) == F.col("root")
    assert {r["doc_id"] for r in out.where(~fits).collect()} == set(range(0, 40, 5))
