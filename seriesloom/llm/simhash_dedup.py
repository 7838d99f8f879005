"""Near-duplicate documents by SimHash.

A fingerprint has eight positional bytes. Fingerprints within two bits agree in at least six of them
(the guaranteed minimum). An inverted index finds the pairs that may reach it, the shared positional
bytes of a pair are tallied, pairs with six or more go on to the exact bit count.

Lists of single positional bytes would hold a 256th of the corpus each, so that tallying over them is
quadratic. The index therefore keys on two of the four positional byte pairs at a time: two differing
bits spoil at most two byte pairs, so each pair of fingerprints that can reach the minimum meets in one
of these six lists or more.

Two bits are near identity. ``similar_groups`` and ``deduplicate_similar`` hold a wider rule: texts whose sets of
five-word shingles have a Jaccard similarity of 0.8 or more. At 0.8 a SimHash differs in about ten of 64 bits, too many
for any positional index, so candidates come from 32 independent fingerprints instead, each of four minima of hashes of
the shingles, and are verified by their exact similarity. The pipeline links by both rules (``deduplicate_near``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Aside, WordHashes, components, mixed, rolled, slices, written

MAX_BITS = 2
MIN_SHARED_BYTES = 8 - MAX_BITS
#: Lists up to this length are compared pairwise; longer ones by shared neighbours, which is exact and linear.
LIST_ROWS = 64

#: The rule for similar texts: words of a shingle, and the least Jaccard similarity as a fraction.
SHINGLE = 5
SIMILAR = (4, 5)
#: Independent fingerprints and minima in each: a pair at 0.8 meets in none with a probability of (1 - 0.8^4)^32 = 5e-8.
BANDS, MINIMA = 32, 4


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text, as an unsigned number; 0 without words."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        join, digest = b" ".join, xxhash.xxh64_intdigest
        hashes = [digest(join(s), seed) for s in zip(*(words[i:] for i in range(shingle)))]
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big")


def with_fingerprint(
    docs: DataFrame, text: str = "text", out: str = "fp", shingle: int = 3, keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a long column ``out``: the fingerprint's bits. Null and word-free texts get 0.

    A column of the same name is replaced.
    """
    aside = Aside(docs)
    docs, text, keep = aside.docs, aside[text], aside.kept([out], keep)
    schema = docs.select(*keep).schema.add(out, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data"):
            at = batch.schema.get_field_index("_data")
            values = np.array([fingerprint(x or b"", shingle) for x in batch.column(at).to_pylist()], np.uint64)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values.view(np.int64))], [*keep, out])

    return aside.back(docs.select(*keep, F.col(text).cast("binary").alias("_data")).mapInArrow(run, schema), [out])


def _byte(column: str, i: int):
    return F.shiftrightunsigned(F.col(column), 56 - 8 * i).bitwiseAND(F.lit(255))


def _index(reps: DataFrame) -> DataFrame:
    """A posting ``slot, word, fp, rep`` for each of the six choices of two positional byte pairs."""
    pair = [F.shiftrightunsigned("fp", 48 - 16 * i).bitwiseAND(F.lit(65535)) for i in range(4)]
    lists = [
        F.struct(F.lit(n).alias("slot"), (F.shiftleft(pair[i], 16).bitwiseOR(pair[j])).alias("word"))
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return reps.select("fp", "rep", F.explode(F.array(*lists)).alias("k")).select("k.slot", "k.word", "fp", "rep")


def links(reps: DataFrame) -> DataFrame:
    """Edges ``a, b`` between representatives (columns ``fp``, distinct, and ``rep``) that connect all fingerprints
    within two bits, directly or through others within two bits."""
    index = _index(reps)
    counts = written(index.groupBy("slot", "word").count().where("count > 1"), "lists")
    short = index.join(counts.where(F.col("count") <= LIST_ROWS).drop("count"), ["slot", "word"])
    x = short.select("slot", "word", F.col("fp").alias("fa"), F.col("rep").alias("a"))
    y = short.select("slot", "word", F.col("fp").alias("fb"), F.col("rep").alias("b"))
    shared = sum((F.when(_byte("fa", i) == _byte("fb", i), 1).otherwise(0) for i in range(8)), F.lit(0))
    near = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= MAX_BITS
    same = (F.col("x.slot") == F.col("y.slot")) & (F.col("x.word") == F.col("y.word"))
    pairs = x.alias("x").join(y.alias("y"), same & (F.col("fa") < F.col("fb")) & (shared >= MIN_SHARED_BYTES) & near)

    # Two fingerprints within two bits are each within one bit of a third value. In a long list 32 bits agree, so each
    # member has 33 such values, and each value has at most 33 members: nobody meets the whole list.
    long = index.join(counts.where(F.col("count") > LIST_ROWS).drop("count"), ["slot", "word"])
    free = [sum(65535 << (48 - 16 * i) for i in range(4) if i not in c) for c in combinations(range(4), 2)]
    mask = F.element_at(F.array(*[F.lit(f - (f >> 63 << 64)).cast("long") for f in free]), F.col("slot") + 1)
    flips = [F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)]]
    variant = F.explode(F.filter(F.array(*flips), lambda v: v.bitwiseAND(mask) == v)).alias("flip")
    met = long.select("slot", "word", "fp", "rep", variant).groupBy(
        "slot", "word", F.col("fp").bitwiseXOR(F.col("flip")).alias("value")
    ).agg(F.collect_list("rep").alias("reps")).where(F.size("reps") > 1)
    stars = met.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b"))
    return pairs.select("a", "b").union(stars.where("a <> b"))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp, component_id`` per row of ``docs``: near-duplicate groups named by their smallest key.

    Rows with equal fingerprints (copies, texts without words) are one class from the start; only classes
    are compared. Repeated keys and ties stay separate rows with the same group; an empty table gives none.
    """
    named = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"))
    prints = written(with_fingerprint(named, "t", keep=["id"]), "prints")
    reps = written(prints.groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    found = components(links(reps))
    named = written(
        reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id")),
        "named",
    )
    return prints.join(named, "fp").select(F.col("id").alias(key), "fp", "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay: of each near-duplicate group the row with the smallest key (all columns kept).

    If several rows share that smallest key, they are that one document and one of them stays. Rows without a key
    cannot be named and all stay. Texts may be of any length; an empty table gives an empty one.
    """
    aside = Aside(docs)
    return aside.back(_leaders(aside.docs, groups(aside.docs, aside[key], aside[text]), aside[key]))


def _leaders(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    kept = found.where(F.col(key) == F.col("component_id")).select(F.col(key).alias("_kept")).distinct()
    named = docs.join(kept, F.col(key).cast("long") == F.col("_kept"), "left_semi").dropDuplicates([key])
    return named.union(docs.where(F.col(key).isNull()))


def shingles(data: bytes, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a UTF-8 text; a shorter text is one shingle."""
    words = data.lower().split()
    return np.unique(rolled(hashes.of(words), min(shingle, len(words)))) if words else np.empty(0, np.uint64)


_SEEDS = mixed(np.arange(1, 2 * BANDS * MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def bands(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` (all positive) consecutive shingle hashes: ``BANDS`` fingerprints of its set."""
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(counts), band, np.uint64)
        for i in range(band * MINIMA, (band + 1) * MINIMA):
            least = np.minimum.reduceat((values ^ _SEEDS[2 * i]) * (_SEEDS[2 * i + 1] | np.uint64(1)), starts)
            key = mixed(key ^ mixed(least))
        out[:, band] = key
    return out


def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, tag`` (hash of the text), ``n`` (distinct shingles), ``c`` and ``c2`` (hash of the set) and ``bands`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "_data", 1 << 18):
            sets = [shingles(x or b"", hashes) for x in batch.column(2).to_pylist()]
            n = np.array([len(x) for x in sets], np.int64)
            some = n > 0
            c, c2, lists = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), [[]] * len(n)
            if some.any():
                values, counts = np.concatenate(sets), n[some]
                starts = np.cumsum(counts) - counts
                c[some] = np.add.reduceat(mixed(values), starts)
                c2[some] = np.add.reduceat(mixed(~values), starts)
                for i, row in zip(np.flatnonzero(some), bands(values, counts).view(np.int64), strict=True):
                    lists[i] = row
            arrays = [pa.array(x.view(np.int64)) for x in (n, c, c2)] + [pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["id", "tag", "n", "c", "c2", "bands"])

    named = docs.where(F.col(key).isNotNull())
    named = named.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("_data"))
    return named.mapInArrow(run, "id long, tag long, n long, c long, c2 long, bands array<long>")


def _similar(both: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose texts ``x, y`` reach the similarity, counted exactly on their sets of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "x"):
            near = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = shingles(x, hashes), shingles(y, hashes)
                common = len(np.intersect1d(p, q, assume_unique=True))
                near.append(SIMILAR[1] * common >= SIMILAR[0] * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, component_id`` per row with a key: groups connected by similar texts, named by their smallest key.

    Texts with equal sets of shingles (copies, texts without words) are one class from the start. In every list of
    classes with an equal fingerprint all are first verified against the list's least; after that only pairs that are
    still in different groups are looked at, so that a group of many similar texts never makes its pairs.
    """
    sets = written(_sets(docs, key, text), "sets")
    first = F.min(F.struct("id", "tag")).alias("first")
    classes = written(sets.groupBy("c", "c2", "n").agg(first, F.any_value("bands").alias("bands")), "sets")
    postings = classes.select("c", "n", F.explode("bands").alias("word"))
    lists = postings.groupBy("word").agg(F.count("*").alias("count"), F.min(F.struct("c", "n")).alias("least")).where("count > 1")
    shared = written(postings.join(lists.drop("count"), "word"), "shared")
    own = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("t"))

    def sized(x: str, y: str):
        return SIMILAR[1] * F.least(x, y) >= SIMILAR[0] * F.greatest(x, y)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = written(pairs.distinct(), "pairs")
        nodes = pairs.select(F.col("a").alias("c")).union(pairs.select(F.col("b").alias("c"))).distinct()
        wanted = classes.join(nodes, "c").select("c", "first.id", "first.tag")
        texts = written(own.join(wanted, ["id", "tag"]).select("c", "t").dropDuplicates(["c"]), "texts")
        x, y = (texts.select(F.col("c").alias(c), F.col("t").alias(t)) for c, t in (("a", "x"), ("b", "y")))
        return written(_similar(pairs.join(x, "a").join(y, "b")), "links")

    stars = shared.where((F.col("c") != F.col("least.c")) & sized("n", "least.n"))
    links = verified(stars.select(F.col("least.c").alias("a"), F.col("c").alias("b")))
    found = written(components(links).select(F.col("node").alias("c"), F.col("component").alias("g")), "groups")
    labelled = written(shared.join(found, "c", "left").select("word", "c", "n", F.coalesce("g", "c").alias("g")), "labelled")
    x, y = labelled.alias("x"), labelled.alias("y")
    apart = (F.col("x.word") == F.col("y.word")) & (F.col("x.c") < F.col("y.c")) & (F.col("x.g") != F.col("y.g"))
    rest = x.join(y, apart & sized("x.n", "y.n")).select(F.col("x.c").alias("a"), F.col("y.c").alias("b"))
    found = components(links.union(verified(rest))).withColumnRenamed("node", "c")
    member = written(classes.join(found, "c", "left").select("c", "c2", "n", "first.id", F.coalesce("component", "c").alias("g")), "member")
    names = written(member.groupBy("g").agg(F.min("id").alias("component_id")), "named")
    member = member.join(names, "g").select("c", "c2", "n", "component_id")
    return sets.join(member, ["c", "c2", "n"]).select(F.col("id").alias(key), "component_id")


def deduplicate_similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay: of each group of similar texts the row with the smallest key, as in ``deduplicate``."""
    aside = Aside(docs)
    return aside.back(_leaders(aside.docs, similar_groups(aside.docs, aside[key], aside[text]), aside[key]))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, component_id`` per row with a key: groups connected by fingerprints within two bits or by similar texts."""
    found = groups(docs, key, text).union(similar_groups(docs, key, text).select(key, F.lit(None).cast("long"), "component_id"))
    found = written(found.where(F.col(key).isNotNull()).select(F.col(key).alias("node"), F.col("component_id").alias("to")).distinct(), "rules")
    whole = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")))
    rows = found.select("node").distinct().join(whole, "node", "left")
    return rows.select(F.col("node").alias(key), F.coalesce("component", "node").alias("component_id"))


def deduplicate_near(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay: of each group by either rule the row with the smallest key, as in ``deduplicate``."""
    aside = Aside(docs)
    return aside.back(_leaders(aside.docs, near_groups(aside.docs, aside[key], aside[text]), aside[key]))
