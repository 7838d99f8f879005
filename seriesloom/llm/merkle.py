"""Merkle manifest of a dataset: a tree for each partition of the rows, and one over the trees' roots.

Checkpoint and recompute: only every ``STEP``-th level is stored, as one row for each aligned subtree of up to
``2 ** STEP`` nodes. Proofs regenerate the levels in between from a subtree's stored nodes, emit the siblings and drop
the levels again. All of it is column functions; no task ever holds more than one subtree of a level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seriesloom.llm.common import written

#: Levels from one stored level to the next.
STEP = 8

#: A step of a proof: whether the own node is the right one, and the other node's hash (null: there is none).
PROOF = "array<struct<right: boolean, hash: string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def leaf(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, each ``-`` if null, else its UTF-8 byte count, a colon, and itself."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(F.concat(*[field(v) for v in values]))


def _ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos``, their place within ``tree`` by ``order`` (nulls first), and ``n``, the rows of the tree.

    Rows are dealt by ranges of (tree, order), so that no task holds a tree; only counts of a range and tree are added up.
    """
    by = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order]]
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = written(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "merkle-ranked")
    part = F.shiftright("at", 33)
    counts = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("own"))
    before = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "part",
        (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("own").over(W.partitionBy("tree")).alias("n"),
    )
    found = placed.withColumn("part", part).join(starts, ["tree", "part"])
    return found.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _height(n: str) -> Column:
    """Levels from a stored level of ``n`` nodes to the next stored one, or to the root if that comes first."""
    return F.when(F.col(n) > 1, F.least(F.lit(STEP), F.length(F.bin(F.col(n) - 1)))).otherwise(0)


def _regenerated(nodes: Column, height: Column) -> Column:
    """The levels of a subtree from its stored nodes: an array of arrays of hashes, the stored one first."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
        return F.transform(runs, lambda i: digest(F.concat(level[i * 2], F.coalesce(F.get(level, i * 2 + 1), F.lit("")))))

    steps = F.array_repeat(F.lit(0), height)
    return F.aggregate(steps, F.array(nodes), lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))))


def _stored(nodes: DataFrame, carried: Sequence[str]) -> DataFrame:
    """A stored level: a row for each aligned subtree, with its ``nodes`` and what each carries, in order."""
    block = F.shiftright("pos", STEP).alias("block")
    each = F.struct("pos", "node", *carried)
    rows = nodes.groupBy("tree", block).agg(F.max("n").alias("n"), F.sort_array(F.collect_list(each)).alias("each"))
    return written(rows, "merkle-level")


def build(nodes: DataFrame, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of all trees over ``tree, pos, n, node``, leaves first, and ``tree, root``."""
    levels = [_stored(nodes, carried)]
    while True:
        hashes = F.col("each.node")
        top = F.element_at(_regenerated(hashes, _height("n")), -1)[0]
        tops = levels[-1].select("tree", F.col("block").alias("pos"), F.ceil(F.col("n") / (1 << STEP)).alias("n"), top.alias("node"))
        if levels[-1].where(F.col("n") > (1 << STEP)).isEmpty():
            return levels, tops.select("tree", F.col("node").alias("root"))
        levels.append(_stored(tops, ()))


def proofs(levels: Sequence[DataFrame], carried: Sequence[str] = ()) -> DataFrame:
    """``tree, pos, node, proof`` of every leaf, with what it carries; from the top stored level down."""
    above: DataFrame | None = None
    for i, level in reversed(list(enumerate(levels))):
        height = _height("n")
        rows = level.withColumn("_levels", _regenerated(F.col("each.node"), height)).withColumn("_height", height)
        if above is None:
            rows = rows.withColumn("_upper", F.array().cast(PROOF))
        else:
            upper = above.select("tree", F.col("pos").alias("block"), F.col("proof").alias("_upper"))
            rows = rows.join(upper, ["tree", "block"])

        def own(j: Column) -> Column:
            steps = F.when(F.col("_height") > 0, F.sequence(F.lit(0), F.col("_height") - 1)).otherwise(F.array().cast("array<int>"))

            def step(k: Column) -> Column:
                at = F.floor(j / F.pow(F.lit(2), k)).cast("int")
                right = at % 2 == 1
                return F.struct(right.alias("right"), F.get(F.get("_levels", k), at + F.when(right, -1).otherwise(1)).alias("hash"))

            return F.concat(F.transform(steps, step), F.col("_upper"))

        each = F.explode(F.transform("each", lambda x, j: F.struct(x.alias("x"), own(j).alias("proof"))))
        kept = ["pos", "node", *(carried if i == 0 else ())]
        above = rows.select("tree", each.alias("e")).select("tree", *[F.col(f"e.x.{c}").alias(c) for c in kept], "e.proof")
        if i:
            above = written(above, "merkle-proofs")
    return above


def folded(node: Column, proof: Column) -> Column:
    """The root that a node and its proof lead to."""

    def step(own: Column, x: Column) -> Column:
        other = F.coalesce(x["hash"], F.lit(""))
        return digest(F.when(x["right"], F.concat(other, own)).otherwise(F.concat(own, other)))

    return F.aggregate(proof, node, step)


def proof_hash(proof: Column) -> Column:
    """SHA-256 of the siblings that there are, level by level."""
    return digest(F.array_join(F.transform(proof, lambda x: x["hash"]), ""))


def manifest(rows: DataFrame, tree: str, key: str, fields: Sequence[str], carried: dict[str, Column] | None = None) -> DataFrame:
    """``key, tree, leaf, subroot, root, proof`` of every row, and the ``carried`` columns.

    ``proof`` leads from the leaf through its subroot to the root. Leaves are ordered by ``key`` within each value of
    ``tree`` (null is a value of its own and comes first), those of equal or null keys by their hashes, so repeated rows
    change nothing but which of them comes first. Null fields, empty and very long texts are hashed as they are; an empty
    table gives an empty result. Columns are renamed while it works, so no name can clash.
    """
    name = F.coalesce(F.concat(F.lit("v"), F.col(tree).cast("string")), F.lit(""))
    extra = carried or {}
    own = {c: f"_c{i}" for i, c in enumerate(extra)}
    leaves = rows.select(
        name.alias("tree"), F.col(key).alias("_key"), leaf([F.col(f) for f in fields]).alias("node"), *[v.alias(own[c]) for c, v in extra.items()]
    )
    held = ["_key", *own.values()]
    levels, subroots = build(_ranked(leaves, ["_key", "node"]), held)
    subroots = written(subroots, "merkle-subroots")
    trees = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_tree"), F.col("root").alias("node"))
    top, root = build(_ranked(trees, ["_tree"]), ["_tree"])
    paths = proofs(top, ["_tree"]).join(root, "tree")
    named = [F.col("_tree").alias("tree"), F.col("node").alias("subroot"), "root", F.col("proof").alias("_rest")]
    paths = written(paths.select(*named), "merkle-paths")
    found = proofs(levels, held).join(paths, "tree")
    return found.select(
        F.col("_key").alias(key),
        F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias(tree),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        F.concat("proof", "_rest").alias("proof"),
        *[F.col(o).alias(c) for c, o in own.items()],
    )

