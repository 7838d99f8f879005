"""Audit of how far sources diverge in their words, from a single-pass index of term frequencies.

Tasks index their documents in memory until a bound is met, then hand on a run of postings sorted by term, cut into
chunks by hash shard. Each shard merges the chunks of all runs through a heap, with no more of a run in memory than one
chunk, into document and source frequencies. From these come probabilities in integer arithmetic, the terms that mark a
source, and the distance of every pair of sources: what single sources contribute is summed from counts of equal
probabilities, and only terms that two sources share need a correction of their own, streamed over the index.
"""

from __future__ import annotations

import heapq
import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.llm.common import slices, written

#: Postings (term, source) and (term) that a task holds before it hands on a run; some 100 MB.
BLOCK_ENTRIES = 500_000
#: Terms in a chunk of a run at most.
CHUNK = 1024
#: Chunks in a batch that a task hands on.
ROWS = 64
#: Bytes of one text that are cut into words at a time.
PIECE = 4 << 20
#: Sources in a block of pair sums.
SIDE = 512

#: Terms whose corrections are summed at a time.
DENSE_ROWS = 512

MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP = 50

#: Bytes as the terms see them: A-Z lowered, all that ends a term blanked, the rest (UTF-8 beyond ASCII) as it is.
_FOLD = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

RUNS = "shard int, lang string, first binary, terms array<binary>, docs array<long>, names array<string>, sizes array<int>, sources array<int>, counts array<long>"
INDEX = "lang string, term binary, docs long, sources array<string>, counts array<long>"
PAIRS = "lang string, a string, b string, correction long"


def _pieces(folded: bytes) -> Iterator[list[bytes]]:
    """The terms of a folded text, in pieces that end between terms."""
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


class _Block:
    """Postings of the documents seen since the last run: by language, documents of a term; by source, occurrences."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter] = {}
        self.counts: dict[str, dict[str, Counter]] = {}
        self.entries = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        docs = self.docs.setdefault(lang, Counter())
        counts = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        before, own = len(docs) + len(counts), set()
        for terms in _pieces(text.translate(_FOLD)):
            counts.update(terms)
            own.update(terms)
        docs.update(own)
        self.entries += len(docs) + len(counts) - before

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """The postings as chunks of terms in order, each of one language and shard."""
        for lang, docs in self.docs.items():
            if not docs:
                continue
            names = sorted(self.counts[lang])
            each = [self.counts[lang][s] for s in names]
            salt = zlib.crc32(lang.encode())
            terms = sorted(docs)
            shard = np.fromiter((zlib.crc32(t, salt) % shards for t in terms), np.int32, len(terms))
            by_shard = np.argsort(shard, kind="stable")
            terms, shard = [terms[i] for i in by_shard.tolist()], shard[by_shard]
            place = dict(zip(terms, range(len(terms)), strict=True))
            at = np.fromiter(itertools.chain.from_iterable(map(place.__getitem__, c) for c in each), np.int64, sum(map(len, each)))
            count = np.fromiter(itertools.chain.from_iterable(c.values() for c in each), np.int64, len(at))
            source = np.repeat(np.arange(len(names), dtype=np.int32), [len(c) for c in each])
            order = np.argsort(at, kind="stable")
            source, count, sizes = source[order], count[order], np.bincount(at, minlength=len(terms)).astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            begins = np.flatnonzero(np.diff(shard, prepend=-1))
            cuts = [c for i, j in zip(begins, [*begins[1:], len(terms)], strict=True) for c in range(i, j, CHUNK)]
            lists = lambda cut, values, kind: pa.ListArray.from_arrays(pa.array(np.append(cut, len(values)).astype(np.int32)), pa.array(values, kind))
            used = [np.unique(x) for x in np.split(source, ends[cuts[1:]])]
            local = [np.searchsorted(u, x) for u, x in zip(used, np.split(source, ends[cuts[1:]]), strict=True)]
            named = np.cumsum([0, *map(len, used[:-1])])
            columns = {
                "shard": pa.array(shard[cuts]),
                "lang": pa.array([lang] * len(cuts), pa.string()),
                "first": pa.array([terms[c] for c in cuts], pa.binary()),
                "terms": lists(cuts, terms, pa.binary()),
                "docs": lists(cuts, list(map(docs.__getitem__, terms)), pa.int64()),
                "names": lists(named, [names[i] for u in used for i in u], pa.string()),
                "sizes": lists(cuts, sizes, pa.int32()),
                "sources": lists(ends[cuts], np.concatenate(local).astype(np.int32), pa.int32()),
                "counts": lists(ends[cuts], count, pa.int64()),
            }
            batch = pa.record_batch(list(columns.values()), names=list(columns))
            yield from (batch.slice(i, ROWS) for i in range(0, len(cuts), ROWS))
        self.__init__()


def _runs(shards: int, entries: int):
    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in slices(batches, "text"):
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
                block.add(lang, source, text.as_buffer().to_pybytes())
                if block.entries >= entries:
                    yield from block.run(shards)
        yield from block.run(shards)

    return index


class _Chunk:
    """A chunk of a run while the merge is in it: its terms in order, and where it stands."""

    def __init__(self, row: dict[str, pa.Scalar]) -> None:
        values = lambda c: row[c].values.to_numpy(zero_copy_only=False).tolist()
        self.lang, self.first, self.names = row["lang"].as_py(), row["first"].as_py(), row["names"].as_py()
        self.terms, self.docs, self.sources, self.counts = map(values, ("terms", "docs", "sources", "counts"))
        self.ends = [0, *itertools.accumulate(values("sizes"))]
        self.at = 0


def _chunks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[_Chunk]:
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names if n != "shard"}
        for i in range(batch.num_rows):
            yield _Chunk({n: c[i] for n, c in columns.items()})


def _merged(chunks: Iterator[_Chunk], min_docs: int) -> Iterator[tuple[str, bytes, int, dict[str, int]]]:
    """Terms in order with their documents and counts by source; a chunk is opened when the heap reaches its first term."""
    waiting = next(chunks, None)
    heap: list[tuple[bytes, int]] = []
    opened: dict[int, _Chunk] = {}
    lang, serial = "", 0
    while heap or waiting:
        if not heap:
            lang = waiting.lang
        while waiting and waiting.lang == lang and (not heap or waiting.first <= heap[0][0]):
            heapq.heappush(heap, (waiting.first, serial))
            opened[serial] = waiting
            serial += 1
            waiting = next(chunks, None)
        term, docs, parts = heap[0][0], 0, []
        while heap and heap[0][0] == term:
            number = heap[0][1]
            chunk = opened[number]
            docs += chunk.docs[chunk.at]
            parts.append((chunk, chunk.at))
            chunk.at += 1
            if chunk.at < len(chunk.terms):
                heapq.heapreplace(heap, (chunk.terms[chunk.at], number))
            else:
                heapq.heappop(heap)
                del opened[number]
        if docs < min_docs:
            continue
        by_source: dict[str, int] = {}
        for chunk, at in parts:
            for j in range(chunk.ends[at], chunk.ends[at + 1]):
                name = chunk.names[chunk.sources[j]]
                by_source[name] = by_source.get(name, 0) + chunk.counts[j]
        yield lang, term, docs, by_source


def _frequencies(min_docs: int):
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ((lang, term, docs, *zip(*sorted(by.items()), strict=True)) for lang, term, docs, by in _merged(_chunks_of(batches), min_docs))
        while rows := list(itertools.islice(kept, 2048)):
            yield pa.record_batch(list(map(pa.array, zip(*rows, strict=True), schema.types)), schema=schema)

    return merge


def index(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``lang, term, docs, sources, counts`` of the terms in at least ``min_docs`` documents of their language."""
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))])
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = read.mapInArrow(_runs(shards, entries), RUNS)
    dealt = runs.repartitionById(shards, F.col("shard")).sortWithinPartitions("lang", "first")
    return written(dealt.mapInArrow(_frequencies(min_docs), INDEX), "term-index")


def _probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact at any size."""
    wide = lambda c: c.cast("decimal(20,0)")
    above = wide(F.lit(SCALE)) * wide(count + F.lit(PRIOR))
    below = wide(total + terms * F.lit(PRIOR))
    return F.call_function("div", above, below) + F.lit(1)


def _side(at: np.ndarray, row: np.ndarray, p: np.ndarray, zero: np.ndarray, side: int, rows: int) -> tuple:
    """The sources of one side as dense columns: which rows have them, their probabilities, and those at no occurrence."""
    own = at // SIDE == side
    column, width = at[own] % SIDE, int((at[own] % SIDE).max()) + 1
    here, dense, none = np.zeros((rows, width), bool), np.zeros((rows, width), np.int64), np.zeros(width, np.int64)
    here[row[own], column] = True
    dense[row[own], column] = p[own]
    none[column] = zero[own]
    return int(side), here, dense, none


def _corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over shared terms by pair of sources, in blocks of ``SIDE`` sources a side."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("correction", pa.int64())])
    names: dict[str, dict[str, int]] = {}
    sums: dict[tuple[str, int, int], np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        by_lang = {lang: list(own) for lang, own in names.items()}
        for (lang, p, q), block in sums.items():
            i, j = np.nonzero(block)
            if len(i):
                own = by_lang[lang]
                a, b = [own[p * SIDE + x] for x in i], [own[q * SIDE + x] for x in j]
                yield pa.record_batch([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(block[i, j])], schema=schema)
        names.clear()
        sums.clear()

    for batch in batches:
        for start in range(0, batch.num_rows, DENSE_ROWS):
            part = batch.slice(start, DENSE_ROWS)
            lists = part.column("each")
            each, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            langs = part.column("lang").to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), sizes)
            p, zero = each.field("p").to_numpy(), each.field("zero").to_numpy()
            sources = each.field("source").to_numpy(zero_copy_only=False)
            for lang in dict.fromkeys(langs):
                mine = np.flatnonzero(langs[row] == lang)
                own = names.setdefault(lang, {})
                at = np.fromiter((own.setdefault(x, len(own)) for x in sources[mine]), np.int64, len(mine))
                sides = [_side(at, row[mine], p[mine], zero[mine], u, part.num_rows) for u in np.unique(at // SIDE)]
                for (u, here, pu, zu), (v, there, pv, zv) in itertools.product(sides, sides):
                    block = sums.setdefault((lang, u, v), np.zeros((SIDE, SIDE), np.int64))
                    for a in np.flatnonzero(here.any(axis=0)):
                        rows = here[:, a]
                        x, z = pu[rows, a][:, None], zu[a]
                        change = np.abs(x - pv[rows]) - np.abs(x - zv) - np.abs(z - pv[rows]) + np.abs(z - zv)
                        block[a, : there.shape[1]] += (change * there[rows]).sum(axis=0)
            if len(sums) > 16:
                yield from out()
    yield from out()


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP, entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how every source differs from the others of its language.

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z lowered; those in at least ``min_docs`` documents of
    a language count. A source's probability of a term is 1 + floor(1e9 (count + 5) / (N + 5 V)), N its counted
    occurrences, V the language's terms. ``part`` ``pair``: ``value`` is the summed difference from source ``item``;
    ``term``: the excess over the whole language of term ``item``, the ``top`` largest. Ranks descend by value; ties go by
    item. Null text, language and source read as ''. Sources without terms still have their pairs; of a language without
    counted terms all differences are 0, and one source alone has no pairs. Repeated rows count each time, texts may be of any length, an empty table
    gives no rows, further columns are not read.
    """
    found = index(docs, text, lang, source, min_docs, entries)
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source))]).distinct()
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)
    each = found.select("lang", "term", total.alias("total"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    each = each.select("lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.counts").alias("count"))
    n = each.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    v = found.groupBy("lang").agg(F.count("*").alias("v"), F.sum(total).alias("n_lang"))
    sized = groups.join(n, ["lang", "source"], "left").join(v, "lang", "left").na.fill(0, ["n", "v", "n_lang"])
    zero = F.when(F.col("v") > 0, _probability(F.lit(0), F.col("n"), F.col("v")))
    sized = written(sized.withColumn("zero", zero), "term-groups")

    own = _probability(F.col("count"), F.col("n"), F.col("v"))
    whole = _probability(F.col("total"), F.col("n_lang"), F.col("v"))
    valued = written(each.join(sized, ["lang", "source"]).select("lang", "source", "term", "zero", own.alias("p"), whole.alias("q")), "term-values")
    by_value = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    marks = valued.where("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    marks = marks.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    lists = valued.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "zero")).alias("each"))
    shared = lists.where(F.size("each") > 1).select("lang", "each").mapInArrow(_corrections, PAIRS)
    shared = shared.groupBy("lang", "a", "b").agg(F.sum("correction").alias("correction"))
    equal = valued.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("times"))
    other = sized.select("lang", F.col("source").alias("b"), F.col("zero").alias("zero_b"))
    apart = F.abs(F.col("zero") - F.col("zero_b"))
    alone = equal.join(other, "lang").where("source <> b").groupBy("lang", F.col("source").alias("a"), "b").agg(
        F.sum(F.col("times") * (F.abs(F.col("p") - F.col("zero_b")) - apart)).alias("alone")
    )
    back = alone.select("lang", F.col("a").alias("b"), F.col("b").alias("a"), F.col("alone").alias("back"))
    pairs = sized.join(other, "lang").where("source <> b").select("lang", F.col("source").alias("a"), "b", (F.col("v") * apart).alias("base"))
    pairs = pairs.join(alone, ["lang", "a", "b"], "left").join(back, ["lang", "a", "b"], "left").join(shared, ["lang", "a", "b"], "left")
    value = sum((F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("alone", "back", "correction")), F.coalesce("base", F.lit(0).cast("long")))
    pairs = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value")).withColumn("rank", F.row_number().over(by_value))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").union(columns(marks, "term"))
