"""Substring deduplication on a compacted de Bruijn graph of words.

The edges of the graph are windows of ``WINDOW`` words. Each window carries an anchor, the least of its ``ANCHOR``-word
hashes, so windows that say the same have the same anchor. Consecutive edges under one anchor follow each other without
a branch and are compacted to one path with one hash, some fourteen edges on average. Spark joins keep the paths whose
anchor occurs elsewhere; a path that is repeated as a whole needs no further look. Only where a path differs from the
others of its anchor (at the ends of a repeated span) are edges opened again, from the source coordinates of one
occurrence of each different path, and counted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.llm.common import ROLL, Aside, WordHashes, mixed, rolled, slices, written

WINDOW = 35
ANCHOR = 8
_LOW = np.uint64(0xFFFFFFFF)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each window of ``width`` keys, by doubling."""
    out, have = keys, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    if have < width:
        out = np.minimum(out[: len(keys) - width + 1], out[width - have : width - have + len(keys) - width + 1])
    return out


class _Powers:
    """Powers of the rolling multiplier and of its inverse, as far as needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << n.bit_length()
            inverse = pow(ROLL, -1, 1 << 64)
            for name, base in (("up", ROLL), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


def paths(ids: np.ndarray, powers: _Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, path hash, first window and number of windows of each path of a text's word hashes."""
    grams = rolled(ids, ANCHOR)
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    at = (_least(keys, WINDOW - ANCHOR + 1) & _LOW).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    n = np.diff(np.r_[first, len(at)])
    up, down = powers.to(len(ids) + 1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(ids * up[: len(ids)])]
    whole = (sums[first + n + WINDOW - 1] - sums[first]) * down[first]
    return grams[at[first]], mixed(whole ^ mixed(n.astype(np.uint64))), first, n


def _paths_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(), _Powers()
        for batch in slices(batches, "t"):
            parts: list[list] = [[] for _ in range(5)]
            for row, data in enumerate(batch.column(2).to_pylist()):
                words = (data or b"").split()
                if len(words) >= WINDOW:
                    found = paths(hashes.of(words), powers)
                    for part, values in zip(parts, (np.full(len(found[0]), row), *found), strict=True):
                        part.append(values)
            if parts[0]:
                row, anchor, path, first, n = (np.concatenate(p) for p in parts)
                rows = pa.array(row)
                arrays = [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(anchor.view(np.int64)),
                    pa.array(path.view(np.int64)),
                    pa.array((first << 32) | n),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc", "tag", "anchor", "path", "span"])

    source = docs.select(F.col(key).cast("long").alias("d"), F.xxhash64(text).alias("g"), F.col(text).cast("binary").alias("t"))
    return source.mapInArrow(run, "doc long, tag long, anchor long, path long, span long")


def _opened(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``anchor, edge, uses, doc, tag, span`` for each window of the wanted paths (``anchor, uses, doc, tag, span``)."""
    at = wanted.groupBy("doc", "tag").agg(F.collect_list(F.struct("anchor", "uses", "span")).alias("at"))  # a document's at most
    rows = docs.select(F.col(key).cast("long").alias("d"), F.xxhash64(text).alias("g"), F.col(text).cast("binary").alias("t"))
    found = rows.join(at, F.col("d").eqNullSafe(F.col("doc")) & (F.col("g") == F.col("tag"))).select("doc", "tag", "t", "at")
    # Rows that repeat a key and its text open their windows twice, which cannot make a lone window look shared: a path
    # that is used once belongs to a row that is there once.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "t"):
            for at in range(batch.num_rows):
                doc, tag, data, wants = (batch.column(i)[at].as_py() for i in range(4))
                edges = rolled(hashes.of(data.split()), WINDOW)
                spans = np.array([(w["span"] >> 32, w["span"] & 0xFFFFFFFF) for w in wants], np.int64)
                which = np.repeat(np.arange(len(wants)), spans[:, 1])
                offset = np.arange(len(which)) - np.repeat(np.cumsum(spans[:, 1]) - spans[:, 1], spans[:, 1])
                starts = spans[which, 0] + offset
                anchors = np.array([w["anchor"] for w in wants], np.int64)[which]
                uses = np.array([w["uses"] for w in wants], np.int64)[which]
                n = len(which)
                arrays = [anchors, edges[starts].view(np.int64), uses, np.full(n, tag), (starts << 32) | 1]
                columns = [pa.array(x, pa.int64()) for x in arrays]
                columns.insert(3, pa.array([doc] * n, pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "edge", "uses", "doc", "tag", "span"])

    return found.mapInArrow(run, "anchor long, edge long, uses long, doc long, tag long, span long")


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc, tag, span``: runs of windows (first window << 32 | number) whose word sequence starts elsewhere too.

    ``tag`` is a hash of the text. Windows are told apart by 128 bits: anchor and path, or anchor and edge.
    """
    table = written(_paths_of(docs, key, text), "paths")
    # What an aggregation feeds to a join is written first: with an exchange on either side Spark can split a common key.
    shared = written(table.groupBy("anchor").count().where("count > 1").select("anchor"), "shared")
    used = written(table.join(shared, "anchor", "left_semi"), "used")
    place = F.struct("doc", "tag", "span")
    distinct = written(used.groupBy("anchor", "path").agg(F.count("*").alias("uses"), F.min(place).alias("at")), "distinct")
    whole = used.join(distinct.where("uses > 1").select("anchor", "path"), ["anchor", "path"], "left_semi")
    lone = written(distinct.where("uses = 1").select("anchor").distinct(), "lone")
    wanted = distinct.join(lone, "anchor", "left_semi").select("anchor", "uses", "at.doc", "at.tag", "at.span")
    edges = written(_opened(docs, wanted, key, text), "edges")
    twice = written(edges.groupBy("anchor", "edge").agg(F.sum("uses").alias("all")).where("all > 1").select("anchor", "edge"), "twice")
    ends = edges.where("uses = 1").join(twice, ["anchor", "edge"], "left_semi")
    return whole.select("doc", "tag", "span").union(ends.select("doc", "tag", "span"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, n_removed, kept`` (the words that stay, joined by one space) and ``removed_spans``
    (first word, number of words; ascending, apart).

    Every word inside a window that starts anywhere else as well goes, in all its occurrences, judged on the input.
    Null texts have no words. Rows that repeat a key and its text are copies of each other and lose what they share.
    Columns with the names produced are replaced; every input row stays. Texts may be of any length; an empty table gives
    an empty one.
    """
    produced = ["n_words", "n_removed", "kept", "removed_spans"]
    aside = Aside(docs)
    docs, key, text, keep = aside.docs, aside[key], aside[text], aside.kept(produced)
    spans = repeated_windows(docs, key, text).groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))  # a document's
    spans = written(spans, "spans")
    rows = docs.select(*keep, F.col(key).cast("long").alias("_d"), F.xxhash64(text).alias("_g"), F.col(text).cast("binary").alias("_t"))
    rows = rows.join(spans, F.col("_d").eqNullSafe(F.col("doc")) & (F.col("_g") == F.col("tag")), "left")
    rows = rows.select(*keep, "_t", F.col("spans").alias("_spans"))
    schema = docs.select(*keep).schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    span = T.StructType().add("first", "long").add("words", "long")
    schema = schema.add("removed_spans", T.ArrayType(span))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_t"):
            n_words, n_removed, kept, removed = [], [], [], []
            names = batch.schema.names
            for data, found in zip(batch.column(names.index("_t")).to_pylist(), batch.column(names.index("_spans")), strict=True):
                words = (data or b"").split()
                gone: list[dict] = []
                count = 0
                if found.is_valid:
                    packed = found.values.to_numpy()
                    edge = np.zeros(len(words) + 1, np.int32)
                    np.add.at(edge, packed >> 32, 1)
                    np.add.at(edge, (packed >> 32) + (packed & 0xFFFFFFFF) + WINDOW - 1, -1)
                    out = np.cumsum(edge[:-1]) > 0
                    change = np.flatnonzero(np.diff(np.r_[0, out.view(np.int8), 0]))
                    gone = [{"first": int(a), "words": int(b - a)} for a, b in change.reshape(-1, 2)]
                    count = int(out.sum())
                    words_left = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                else:
                    words_left = words
                n_words.append(len(words))
                n_removed.append(count)
                kept.append(b" ".join(words_left).decode("utf-8", "replace"))
                removed.append(gone)
            columns = [batch.column(i) for i, name in enumerate(names) if name not in ("_t", "_spans")]
            arrays = [*columns, pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.string()), pa.array(removed, kind)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *produced])

    return aside.back(rows.mapInArrow(run, schema), produced)
