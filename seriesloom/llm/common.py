"""Helpers that several operators share: shared storage, Arrow slicing, word hashing, components."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters. ``bytes.split()`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"

#: Entries of a generation of a worker's cache; two of them take some 80 MB.
CACHE_ENTRIES = 300_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it. Only a local master may do without: there one machine
    runs everything, so a temporary folder is set for the session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="seriesloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes inside give their shuffle files back when they are done, instead of when the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, unless ``kept``; nothing that is still to run may read them."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, name: str, kept: bool = False, outer: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and survives lost executors.

    The table belongs to the scope of ``scratch`` that is open, or to the one around it (``outer``), or to none (``kept``).
    """
    path = new_path(df.sparkSession, name)
    with freeing_shuffles(df.sparkSession):
        df.write.parquet(path)
    if len(_scopes) > outer and not kept:
        _scopes[-1 - outer].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Aside:
    """``docs`` with its columns under names of their own, so that none clashes with a name that an operator works with."""

    def __init__(self, docs: DataFrame) -> None:
        self.names, self.own = docs.columns, [f"_in_{i}" for i in range(len(docs.columns))]
        self.docs = docs.toDF(*self.own)

    def __getitem__(self, name: str) -> str:
        """The name that a column has here; names compare without case, as in Spark."""
        return self.own[[c.lower() for c in self.names].index(name.lower())]

    def kept(self, produced: Iterable[str], keep: Sequence[str] | None = None) -> list[str]:
        """The columns (of those named ``keep``) that none of ``produced`` replaces."""
        wanted = None if keep is None else {c.lower() for c in keep}
        taken = {c.lower() for c in produced}
        return [o for o, c in zip(self.own, self.names, strict=True) if c.lower() not in taken and (wanted is None or c.lower() in wanted)]

    def back(self, out: DataFrame, produced: Iterable[str] = ()) -> DataFrame:
        """The columns of ``out`` under their first names, then those produced."""
        named = [F.col(o).alias(c) for o, c in zip(self.own, self.names, strict=True) if o in out.columns]
        return out.select(*named, *[F.col(f"`{c}`") for c in produced])


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each (always at least one row)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()  # idle workers keep nothing for tasks that may not come


def gathered(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.Table]:
    """Batches put together until ``column`` holds ``limit`` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(column)).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Remembered(dict):
    """Key -> ``make(key)``, remembered per worker in two generations of at most ``limit`` entries.

    When the young generation is full it becomes the old one; what is asked for again moves back. Frequent keys stay,
    rare ones go, and memory is bounded. Keys longer than 64 are not kept.
    """

    def __init__(self, make: Callable, limit: int = CACHE_ENTRIES) -> None:
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > 64:
                return value
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


class WordHashes(Remembered):
    """Word (bytes) -> 64-bit hash."""

    def __init__(self) -> None:
        super().__init__(xxhash.xxh3_64_intdigest)

    def of(self, words: Sequence[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


#: An odd multiplier for rolling hashes over 64-bit word hashes (golden ratio).
ROLL = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of all windows of ``n`` consecutive values, by doubling."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out, width, power = hashes, 1, ROLL
    for bit in bin(n)[3:]:
        out = out[:-width] * np.uint64(power) + out[width:]
        power, width = power * power & _ALL, 2 * width
        if bit == "1":
            out = out[:-1] * np.uint64(ROLL) + hashes[width : width + len(out) - 1]
            power, width = power * ROLL & _ALL, width + 1
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: spreads entropy over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated(values: np.ndarray) -> np.ndarray:
    """Mask of the values that occur more than once."""
    if len(values) < 2:
        return np.zeros(len(values), bool)
    order = np.argsort(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeats(values: np.ndarray) -> np.ndarray:
    """Mask of the values that occur earlier already."""
    order = np.argsort(values, kind="stable")
    out = np.zeros(len(values), bool)
    out[order[1:][values[order[1:]] == values[order[:-1]]]] = True
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask of the ``n`` positions inside windows of ``width`` that begin where ``starts`` is true."""
    edge = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(starts)
    edge[at] += 1
    edge[at + width] -= 1
    return np.cumsum(edge[:-1]) > 0


#: Byte -> its eight bits as eight byte lanes of one number, lowest bit in the lowest lane.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)
_LANE_MAX = 255


def majorities(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` (all positive) consecutive 64-bit hashes: the bits set in over half of them.

    Bits are counted in byte lanes, eight at a time, over at most 255 hashes; the parts of a run are added up after.
    """
    if not len(counts):
        return np.empty(0, np.uint64)
    parts = -(-counts // _LANE_MAX)
    first = np.cumsum(parts) - parts
    inside = np.arange(int(parts.sum())) - np.repeat(first, parts)
    starts = np.repeat(np.cumsum(counts) - counts, parts) + _LANE_MAX * inside
    each = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    sums = np.empty((len(starts), 8), "<u8")
    for i, values in enumerate(each):
        sums[:, i] = np.add.reduceat(_LANES[values], starts)
    bits = sums.view(np.uint8)
    half = counts // 2
    over = bits[first] > half.clip(max=_LANE_MAX)[:, None]
    for run in np.flatnonzero(parts > 1):
        over[run] = bits[first[run] : first[run] + parts[run]].sum(axis=0, dtype=np.int64) > half[run]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph with columns ``a`` and ``b`` (long).

    Returns ``node, component``: every node of a non-loop edge with the smallest node it reaches.
    Each round contracts every node into the neighbour of least hash (itself included); the hash
    changes with the round, so even long chains halve in expectation. Nodes are only ever reduced
    by a minimum, which Spark combines before its shuffle; all tables stay distributed.
    """
    spark = edges.sparkSession
    live = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    maps: list[DataFrame] = []
    while not live.isEmpty():
        turn = F.lit(len(maps))
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", turn).alias("h"), F.col("b").alias("v"))).alias("m"))
        own = F.struct(F.xxhash64("a", turn).alias("h"), F.col("a").alias("v"))
        step = written(least.select(F.col("a").alias("node"), F.least(own, F.col("m"))["v"].alias("to")), "step")
        maps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("y"))
        moved = live.join(left, "a").join(right, "b").where("x <> y")
        live = written(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    out = maps[0].select("node", F.col("to").alias("root"))
    for step in maps[1:]:
        out = out.join(step.select(F.col("node").alias("root"), "to"), "root", "left")
        out = out.select("node", F.coalesce("to", "root").alias("root"))
    out = written(out, "roots")
    names = written(out.groupBy("root").agg(F.min(F.least("node", "root")).alias("component")), "names")
    return out.join(names, "root").select("node", "component")
