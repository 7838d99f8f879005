"""Near-duplicate embeddings by int8 tile products.

Every unit vector is rounded to int8 with a scale of its own, and the length of what rounding lost is kept. A tile
product of int8 values, exact in single precision, times the scales approximates the cosine; by the triangle inequality
it is off by at most ``|q_x| e_y + e_x``. Only pairs that this bound leaves possible are computed in double precision.

Equal vectors are one class with a count before anything is compared. Tiles are hash parts of a label with a bounded
expected size. A pair of tiles travels as int8 values only and names the classes that are still possible; the vectors of
those follow in a join of their own, and each pair of tiles then gives counts and a spanning forest, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import components, written

THRESHOLD = 0.98
TILE = 1024
#: Covers rounding of the single-precision products and scales.
SLACK = 4e-6
#: Pairs that are recomputed at a time.
PAIRS = 1 << 16


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit rows -> int8 values, scales, and lengths of the rounding errors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    return q.astype(np.int8), scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def possible(qx, sx, ex, qy, sy, ey, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose cosine may reach the threshold, from quantised values and error lengths alone."""
    fx, fy = qx.astype(np.float32), qy.astype(np.float32)
    product = (fx @ fy.T) * sx.astype(np.float32)[:, None] * sy.astype(np.float32)[None, :]
    length = np.linalg.norm(fx.astype(np.float64), axis=1) * sx
    bound = length[:, None] * ey[None, :] + ex[:, None]
    return np.nonzero(product + bound >= threshold - SLACK)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _unit(x: np.ndarray) -> np.ndarray:
    unit = x / np.abs(x).max(axis=1)[:, None]
    return unit / np.linalg.norm(unit, axis=1)[:, None]


def _rows(column: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


_BLOBS = ["ids", "q", "scale", "error"]


def _pack(table: pa.Table) -> pa.Table:
    """One row per tile: class numbers, int8 values, scales and error lengths; not the vectors."""
    ids = table["cid"].to_numpy()
    blobs = [ids, *quantised(_unit(_rows(table["embedding"], len(ids))))]
    key = [table[c].slice(0, 1).combine_chunks() for c in _TILE]
    return pa.Table.from_arrays([*key, *[pa.array([b.tobytes()], pa.binary()) for b in blobs]], names=[*_TILE, *_BLOBS])


_TILE = ["label", "dim", "tile", "tiles"]


def _survivors(row: dict, threshold: float) -> np.ndarray:
    """Classes of a pair of tiles that the bound leaves possible with any other."""
    sides = []
    for side in "ab":
        q = np.frombuffer(row[f"q_{side}"], np.int8).reshape(-1, row["dim"])
        sides += [q, np.frombuffer(row[f"scale_{side}"]), np.frombuffer(row[f"error_{side}"])]
    i, j = possible(*sides, threshold)
    a, b = (np.frombuffer(row[f"ids_{side}"], np.int64) for side in "ab")
    if row["a"] == row["b"]:
        i, j = i[i < j], j[i < j]
    return np.union1d(a[i], b[j])


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """Linked classes among the survivors of a pair of tiles, how many vectors each links to, and its root in a forest."""
    ids, copies, tile = (table[c].to_numpy() for c in ("cid", "copies", "tile"))
    x = _rows(table["embedding"], len(ids))
    q, scale, error = quantised(_unit(x))
    length = np.linalg.norm(x, axis=1)
    one, two = table["a"][0].as_py(), table["b"][0].as_py()
    left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == two)
    i, j = possible(q[left], scale[left], error[left], q[right], scale[right], error[right], threshold)
    i, j = left[i], right[j]
    if one == two:
        i, j = i[i < j], j[i < j]
    sure = np.zeros(len(i), bool)
    for at in range(0, len(i), PAIRS):
        s = slice(at, at + PAIRS)
        sure[s] = np.einsum("ij,ij->i", x[i[s]], x[j[s]]) / (length[i[s]] * length[j[s]]) >= threshold
    i, j = i[sure], j[sure]
    links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
    hit = np.flatnonzero(links)
    arrays = [ids[hit], links[hit].astype(np.int64), ids[_forest(i, j, len(ids))[hit]]]
    return pa.Table.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["cid", "links", "root"])


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD
) -> DataFrame:
    """``key, n_links, component_id, kept`` for each row of ``vectors``; its other columns are not returned.

    Vectors of one label (of any type that can be compared) and length whose cosine in double precision reaches
    ``threshold`` are linked. ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the
    smallest key reachable, ``kept`` whether that is the row's own. Rows with a null key or label, or with a null, zero
    or empty vector or one that holds null, NaN or infinite components, link with nothing. Repeated rows count as copies
    of each other, repeated keys with different vectors as different vectors. An empty table gives no rows.
    """
    v = F.col(embedding)
    sound = F.size(v).cast("boolean") & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = sound & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).alias("label"), v.alias("embedding"))
    rows = rows.withColumn("sound", F.coalesce(sound & F.col("label").isNotNull() & F.col("id").isNotNull(), F.lit(False)))
    valid = rows.where("sound").select("id", "label", "embedding", F.xxhash64("embedding").alias("h"))
    classes = valid.groupBy("label", "h", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("cid"), "*", F.size("embedding").alias("dim")), "classes")
    counts = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(TILE)).cast("int").alias("tiles"))
    tiled = classes.join(counts, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("cid"), F.col("tiles")).cast("int"))
    kinds = tiled.select(*_TILE).schema
    for name in _BLOBS:
        kinds = kinds.add(name, "binary")
    packed = tiled.select(*_TILE, "cid", "embedding").groupBy("label", "dim", "tile").applyInArrow(_pack, kinds)
    tiles = written(packed, "tiles")
    pairs = tiles.select("label", "dim", F.col("tile").alias("a"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("b"))
    for side in "ab":
        blobs = tiles.select("label", "dim", F.col("tile").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in _BLOBS])
        pairs = pairs.join(blobs, ["label", "dim", side])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                ids = pa.array(_survivors(one.select(["dim", "a", "b", *names]).to_pylist()[0], threshold))
                again = pa.array(np.zeros(len(ids), np.int64))
                yield pa.RecordBatch.from_arrays([*[one.column(c).take(again) for c in _PAIR], ids], [*_PAIR, "cid"])

    names = [f"{c}_{side}" for c in _BLOBS for side in "ab"]
    possible_ = written(pairs.mapInArrow(run, pairs.select(*_PAIR).schema.add("cid", "long")), "possible")
    whole = tiled.select("cid", "copies", "tile", "embedding")
    rest = possible_.join(whole, "cid").groupBy(*_PAIR)  # two tiles' vectors at most
    found = written(rest.applyInArrow(lambda t: _compare(t, threshold), "cid long, links long, root long"), "links")
    linked = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cid")
    linked = written(classes.select("cid", "rep").join(linked, "cid"), "linked")
    named = linked.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = linked.join(named, "component").select("cid", "component_id")
    totals = found.groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.join(totals, "cid", "left").join(named, "cid", "left")
    known = written(
        known.select(
            F.col("label").alias("l"),
            F.col("h").alias("k"),
            F.col("embedding").alias("e"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component_id", "rep").alias("component_id"),
        ),
        "known",
    )
    same = (F.col("h") == F.col("k")) & (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))
    out = valid.join(known, same).select("id", "n_links", "component_id")
    rest = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.union(rest).select(
        F.col("id").alias(key), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


_PAIR = ["label", "dim", "a", "b"]
