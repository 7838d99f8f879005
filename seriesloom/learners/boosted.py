"""Gradient-boosted trees for every series and step at once, grown level by level by Spark aggregations.

Rows live in blocks of one series and a span of days: bins of the features and, for each step, what the trees so far
leave over. A level is one pass over the blocks, which sums residuals by (series, step, node, feature, bin), and one
aggregation that picks each node's split. A series may have any number of blocks, so no task needs to hold one. Trees are
rows of small arrays, scored by column functions.

Squared error, second-order leaves ``sum of residuals / (rows + ridge)``, missing values with a learned direction.
Residuals are summed as whole multiples of a power of two, so trees do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.plans.scratch import Scratch

#: Days of a block: at most so many rows of a series, if it has one a day.
BLOCK_DAYS = 512
#: Rounds from one table of residuals to the next; passes in between apply the trees since.
EVERY = 8
#: Bytes of splits up to which a pass broadcasts them; more are joined by shuffle.
BROADCAST = 32 << 20
#: Series whose sums a task adds up before it hands them on.
HELD = 64
#: Gain that a split needs.
LEAST_GAIN = 1e-6

BLOCK = "series string, unit double, n int, bins binary, left binary, test binary"
HIST = "series string, unit double, round int, step int, node int, feature int, bin int, g long, n long"
SPLIT = "series string, round int, step int, node int, feature int, cut int, missing_left boolean, value double, left double, right double, gain double, g long, n long, unit double"
TREES = "array<struct<feature: array<int>, threshold: array<double>, missing_left: array<boolean>, value: array<double>, gain: array<double>>>"


@dataclass(frozen=True)
class Options:
    """The surveyed models' settings; ``patience`` rounds without a better holdout end a series, None runs them all."""

    rounds: int = 1000
    rate: float = 0.01
    depth: int = 3
    ridge: float = 1.0
    least_rows: int = 1
    bins: int = 32
    base: float = 0.5
    patience: int | None = 50


def _edges(rows: DataFrame, size: int, bins: int) -> DataFrame:
    """``series, edges, unit``: up to ``bins - 1`` cut points a feature, and the unit of the residuals."""
    at = [i / (bins - 1) for i in range(bins - 1)]
    each = [F.array_distinct(F.coalesce(F.percentile_approx(F.col("x")[i], at, 10_000), F.array().cast("array<double>"))) for i in range(size)]
    top = F.max(F.array_max(F.transform("y", F.abs)))
    unit = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(top, F.lit(1.0)))) - 36)
    return rows.where(~F.col("test")).groupBy("series").agg(F.array(*each).alias("edges"), unit.alias("unit"))


def _packed(size: int, steps: int, base: float):
    schema = pa.schema([("series", pa.string()), ("unit", pa.float64()), ("n", pa.int32()), ("bins", pa.binary()), ("left", pa.binary()), ("test", pa.binary())])

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for series, unit, edges, each in zip(*(batch.column(c) for c in ("series", "unit", "edges", "each")), strict=True):
                rows = each.values
                n = len(rows)
                flat = rows.field("x").flatten()
                x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, size)
                y = rows.field("y").flatten().to_numpy(zero_copy_only=False).reshape(n, steps)
                bins = np.zeros((n, size), np.uint8)
                for f, own in enumerate(edges.as_py()):
                    bins[:, f] = np.where(np.isnan(x[:, f]), 0, 1 + np.searchsorted(np.array(own), x[:, f], "right"))
                test = rows.field("test").to_numpy(zero_copy_only=False).astype(np.uint8)
                out.append((series.as_py(), unit.as_py(), n, bins.tobytes(), (y - base).tobytes(), test.tobytes()))
            if out:
                yield pa.record_batch(list(map(pa.array, zip(*out, strict=True), schema.types)), schema=schema)

    return pack


class _Splits:
    """The splits of one series since its residuals were stored, as arrays by (round, step, node)."""

    def __init__(self, splits: pa.StructArray | None, steps: int, depth: int) -> None:
        nodes = (2 << depth) - 1
        if splits is None or not len(splits):
            self.rounds = 0
            return
        get = lambda c: splits.field(c).to_numpy(zero_copy_only=False)
        number, step, node, feature = get("round"), get("step"), get("node"), get("feature")
        _, at = np.unique(number, return_inverse=True)
        self.rounds = int(at.max()) + 1
        shape = (self.rounds, steps, nodes)
        self.feature, self.cut = np.full(shape, -1, np.int64), np.zeros(shape, np.int64)
        self.missing_left, self.value = np.zeros(shape, bool), np.zeros(shape)
        order = np.argsort(node, kind="stable")  # a child's own value equals what its parent gave it
        at, step, node = at[order], step[order], node[order]
        own = feature[order] >= 0
        self.feature[at, step, node] = feature[order]
        self.cut[at, step, node] = get("cut")[order]
        self.missing_left[at, step, node] = get("missing_left")[order].astype(bool)
        self.value[at, step, node] = get("value")[order]
        self.value[at[own], step[own], 2 * node[own] + 1] = get("left")[order][own]
        self.value[at[own], step[own], 2 * node[own] + 2] = get("right")[order][own]

    def nodes(self, r: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row and step (rows x steps) after ``depth`` levels of a round's trees."""
        n, steps = len(bins), self.feature.shape[1]
        node, each, row = np.zeros((n, steps), np.int64), np.arange(steps)[None], np.arange(n)[:, None]
        for _ in range(depth):
            feature = self.feature[r, each, node]
            bin_ = bins[row, np.maximum(feature, 0)]
            left = np.where(bin_ == 0, self.missing_left[r, each, node], bin_ <= self.cut[r, each, node])
            node = np.where(feature < 0, node, 2 * node + np.where(left, 1, 2))
        return node


def _rows_of(batch: pa.RecordBatch, size: int, steps: int, depth: int):
    """``series, unit, bins, left, test, splits`` of each block of a batch."""
    lists = batch.column("splits") if "splits" in batch.schema.names else None
    for i in range(batch.num_rows):
        n = batch.column("n")[i].as_py()
        bins = np.frombuffer(batch.column("bins")[i].as_py(), np.uint8).reshape(n, size)
        left = np.frombuffer(batch.column("left")[i].as_py()).reshape(n, steps)
        test = np.frombuffer(batch.column("test")[i].as_py(), np.uint8).astype(bool)
        splits = _Splits(lists[i].values if lists is not None and lists[i].is_valid else None, steps, depth)
        yield batch.column("series")[i].as_py(), batch.column("unit")[i].as_py(), bins, left, test, splits


def _applied(left: np.ndarray, bins: np.ndarray, splits: _Splits, rounds: int, depth: int) -> np.ndarray:
    each = np.arange(left.shape[1])[None]
    for r in range(rounds):
        left = left - splits.value[r, each, splits.nodes(r, bins, depth)]
    return left


def _histograms(size: int, steps: int, number: int, level: int, bins_n: int, depth: int, loss: bool):
    """A pass: residual sums of a level's nodes, from which the trees since the stored residuals are taken off first."""
    width, kinds = 1 << level, bins_n + 1
    schema = pa.schema([("series", pa.string()), ("unit", pa.float64()), *[(c, pa.int32()) for c in ("round", "step", "node", "feature", "bin")], ("g", pa.int64()), ("n", pa.int64())])

    def out(held: dict) -> Iterator[pa.RecordBatch]:
        for (series, unit), (g, n, squares) in held.items():
            feature, step, local, bin_ = np.nonzero(n)
            columns = [step, local + width - 1, feature, bin_, g[feature, step, local, bin_], n[feature, step, local, bin_]]
            if loss and squares[1]:
                more = [np.arange(steps), *[np.full(steps, -1)] * 2, np.zeros(steps, int), squares[0], np.full(steps, squares[1])]
                columns = [np.concatenate(x) for x in zip(columns, more, strict=True)]
            many = len(columns[0])
            arrays = [pa.array([series] * many, pa.string()), pa.array(np.full(many, unit)), pa.array(np.full(many, number, np.int32)), *[pa.array(c.astype(t)) for c, t in zip(columns, ["i4"] * 4 + ["i8"] * 2, strict=True)]]
            yield pa.record_batch(arrays, schema=schema)
        held.clear()

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for series, unit, bins, left, test, splits in _rows_of(batch, size, steps, depth):
                whole = splits.rounds - (level > 0)
                left = _applied(left, bins, splits, whole, depth)
                node = splits.nodes(whole, bins, level) if level else np.zeros(left.shape, np.int64)
                if (series, unit) not in held:
                    if len(held) >= HELD:
                        yield from out(held)
                    shape = (size, steps, width, kinds)
                    held[series, unit] = [np.zeros(shape, np.int64), np.zeros(shape, np.int64), [np.zeros(steps, np.int64), 0]]
                g, n, squares = held[series, unit]
                local = node - (width - 1)
                on = (local >= 0) & ~test[:, None]
                at = ((np.arange(steps)[None] * width + local) * kinds)[on]
                whole_units = np.rint(left / unit)[on]
                for f in range(size):
                    cell = at + np.broadcast_to(bins[:, f : f + 1], on.shape)[on]
                    g[f] += np.bincount(cell, whole_units, steps * width * kinds).astype(np.int64).reshape(g[f].shape)
                    n[f] += np.bincount(cell, minlength=steps * width * kinds).reshape(n[f].shape)
                if loss and test.any():
                    scale = unit * unit * 2.0**40  # of a power of two too, and far from overflow
                    squares[0] += np.rint(left[test] ** 2 / scale).astype(np.int64).sum(axis=0)
                    squares[1] += int(test.sum())
        yield from out(held)

    return task


def _advanced(size: int, steps: int, depth: int):
    """Blocks with the residuals after all splits they carry."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [_applied(left, bins, splits, splits.rounds, depth).tobytes() for _, _, bins, left, _, splits in _rows_of(batch, size, steps, depth)]
            kept = ["series", "unit", "n", "bins", "left", "test"]
            yield pa.record_batch([pa.array(left, pa.binary()) if c == "left" else batch.column(c) for c in kept], names=kept)

    return task


KEYS = ["series", "round", "step", "node", "feature", "bin"]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _best(rows: pa.Table, o: Options, schema: pa.Schema) -> pa.RecordBatch:
    """The best split of each node from sorted sums: all cuts, missing values to either side."""
    column = lambda c: rows.column(c).to_numpy()
    series, number, step, node, feature, bin_ = map(column, KEYS)
    code = rows.column("series").combine_chunks().dictionary_encode().indices.to_numpy()
    cell = _starts(code, step, node, feature, bin_)
    g, n = np.add.reduceat(column("g"), cell), np.add.reduceat(column("n"), cell)
    code, step, node, feature, bin_, at = code[cell], step[cell], node[cell], feature[cell], bin_[cell], cell
    line = _starts(code, step, node, feature)
    which = np.repeat(np.arange(len(line)), np.diff(np.append(line, len(code))))
    all_g, all_n = np.add.reduceat(g, line)[which], np.add.reduceat(n, line)[which]
    upto = lambda v: np.cumsum(v) - (np.cumsum(v) - v)[line][which]
    gl, nl = upto(g), upto(n)
    none = lambda v: np.where(bin_[line] == 0, v[line], 0)[which]
    unit = column("unit")[at]

    def gain(left: np.ndarray, many: np.ndarray) -> np.ndarray:
        part = lambda v, k: (v * unit) ** 2 / (k + o.ridge)
        found = part(left, many) + part(all_g - left, all_n - many) - part(all_g, all_n)
        sound = (many >= o.least_rows) & (all_n - many >= o.least_rows) & (found > LEAST_GAIN) & (node >= 0)
        return np.where(sound, found, 0.0)

    with_missing, without = gain(gl, nl), gain(gl - none(g), nl - none(n))
    missing_left = with_missing >= without
    gains = np.where(missing_left, with_missing, without)
    gl, nl = gl - np.where(missing_left, 0, none(g)), nl - np.where(missing_left, 0, none(n))
    group = _starts(code, step, node)
    own = np.repeat(np.arange(len(group)), np.diff(np.append(group, len(code))))
    top = np.flatnonzero(gains == np.maximum.reduceat(gains, group)[own])
    pick = top[_starts(own[top])]  # the first feature and cut among equals
    split = gains[pick] > 0
    leaf = lambda v, k: o.rate * v[pick] * unit[pick] / (k[pick] + o.ridge)
    values = {
        "series": series[at][pick],
        "round": number[at][pick],
        "step": step[pick],
        "node": node[pick],
        "feature": np.where(split, feature[pick], -1),
        "cut": bin_[pick],
        "missing_left": missing_left[pick],
        "value": leaf(all_g, all_n),
        "left": leaf(gl, nl),
        "right": leaf(all_g - gl, all_n - nl),
        "gain": gains[pick],
        "g": all_g[pick],
        "n": all_n[pick],
        "unit": unit[pick],
    }
    return pa.record_batch([pa.array(values[f.name], f.type) for f in schema], schema=schema)


def _chosen(hist: DataFrame, o: Options) -> DataFrame:
    """Splits from the sums of all tasks, dealt by series and step; a node without a sound one keeps its value."""
    names = ["round", "step", "node", "feature", "cut"]
    schema = pa.schema(
        [("series", pa.string()), *[(c, pa.int32()) for c in names], ("missing_left", pa.bool_()), *[(c, pa.float64()) for c in ("value", "left", "right", "gain")]]
        + [("g", pa.int64()), ("n", pa.int64()), ("unit", pa.float64())]
    )

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = _starts(batch.column("series").to_numpy(zero_copy_only=False), batch.column("step").to_numpy())[-1]
            if last:  # whatever ends before the batch's last series and step is complete
                yield _best(pa.Table.from_batches([*held, batch.slice(0, last)]), o, schema)
                held = []
            held.append(batch.slice(last))
            if len(held) > 1 and (held[0].column("series")[0], held[0].column("step")[0]) != (batch.column("series")[0], batch.column("step")[0]):
                yield _best(pa.Table.from_batches(held[:-1]), o, schema)
                held = held[-1:]
        if held:
            yield _best(pa.Table.from_batches(held), o, schema)

    return hist.repartition("series", "step").sortWithinPartitions("series", "step", "node", "feature", "bin").mapInArrow(choose, SPLIT)


def _with_splits(blocks: DataFrame, splits: DataFrame | None, small: bool) -> DataFrame:
    if splits is None:
        return blocks
    named = ["round", "step", "node", "feature", "cut", "missing_left", "value", "left", "right"]
    lists = splits.where("node >= 0").groupBy("series").agg(F.collect_list(F.struct(*named)).alias("splits"))
    return blocks.join(F.broadcast(lists) if small else lists, "series", "left")


def _losses(splits: DataFrame) -> DataFrame:
    """``series, step, round, loss`` of the holdout after each round; a pass reports on the round before it."""
    off = F.sqrt(F.col("g") * F.pow("unit", F.lit(2)) * 2.0**40 / F.col("n"))
    return splits.where("node = -1").select("series", "step", (F.col("round") - 1).alias("round"), off.alias("loss"))


def _stopped(losses: DataFrame, patience: int) -> DataFrame:
    """``series, step, best_round, best_loss, done``: the best round before ``patience`` rounds brought nothing better."""
    ordered = F.sort_array(F.collect_list(F.struct("round", "loss")))
    first = F.struct(F.lit(-1).alias("best"), F.lit(float("inf")).alias("loss"), F.lit(False).alias("done"))

    def step(state: Column, x: Column) -> Column:
        better = ~state["done"] & (x["loss"] < state["loss"])
        best = F.when(better, x["round"]).otherwise(state["best"])
        done = state["done"] | (x["round"] - best >= patience)
        return F.struct(best.alias("best"), F.when(better, x["loss"]).otherwise(state["loss"]).alias("loss"), done.alias("done"))

    folded = losses.groupBy("series", "step").agg(F.aggregate(ordered, first, step).alias("s"))
    return folded.select("series", "step", F.col("s.best").alias("best_round"), F.col("s.loss").alias("best_loss"), F.col("s.done").alias("done"))


def _trees(splits: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """``series, step, trees``: the rounds' trees in order, thresholds instead of bins, nodes numbered from the root."""
    nodes = (2 << depth) - 1
    own = splits.where("node >= 0").join(edges.select("series", "edges"), "series")
    cut = F.when(F.col("cut") > 0, F.get(F.get("edges", F.col("feature")), F.col("cut") - 1)).otherwise(float("-inf"))
    split = F.col("feature") >= 0
    node = F.struct(
        F.col("feature").alias("feature"), F.when(split, cut).alias("threshold"), F.col("missing_left").alias("missing_left"), F.col("value").alias("value"), F.col("gain").alias("gain")
    )
    leaf = lambda value: F.struct(F.lit(-1).alias("feature"), F.lit(None).cast("double").alias("threshold"), F.lit(False).alias("missing_left"), F.col(value).alias("value"), F.lit(0.0).alias("gain"))
    entry = lambda place, value: F.struct(place.alias("key"), value.alias("value"))
    last = split & (F.col("node") >= (1 << depth - 1) - 1)
    at = F.array(entry(F.col("node"), node))
    both = F.array(entry(F.col("node"), node), entry(F.col("node") * 2 + 1, leaf("left")), entry(F.col("node") * 2 + 2, leaf("right")))
    rows = own.select("series", "step", "round", F.explode(F.when(last, both).otherwise(at)).alias("e"))
    trees = rows.groupBy("series", "step", "round").agg(F.map_from_entries(F.collect_list("e")).alias("m"))
    each = F.transform(F.sequence(F.lit(0), F.lit(nodes - 1)), lambda i: F.try_element_at("m", i))
    names = ["feature", "threshold", "missing_left", "value", "gain"]
    tree = F.struct(*[F.transform(each, (lambda c: lambda x: x[c])(c)).alias(c) for c in names])
    packed = trees.select("series", "step", F.struct("round", tree.alias("tree")).alias("t"))
    lists = packed.groupBy("series", "step").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("series", "step", F.transform("t", lambda t: t["tree"]).cast(TREES).alias("trees"))


def fit(frame: DataFrame, features: int, steps: int, options: Options = Options()) -> DataFrame:
    """``series, step, base, trees, train_rows, best_round, best_loss, gains, splits`` from ``series, date, x, y, test``.

    ``x`` holds the features (null or NaN: missing), ``y`` the targets of all steps (none of them null). Rows with
    ``test`` are never split on; with ``patience`` a step keeps its trees up to its best round on them (``best_round``,
    from 1; a series without test rows keeps all), and a series leaves the passes once all its steps have stopped.
    ``gains`` and ``splits`` sum the gain and count the splits of each feature in the trees kept. Series without training
    rows give no row. An empty frame gives an empty result.
    """
    o, spark = options, frame.sparkSession
    with Scratch(spark, "boosted") as work:
        block = F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / BLOCK_DAYS).alias("block")
        known = F.transform("x", lambda v: F.when(~F.isnan(v), v))
        rows = frame.select("series", block, known.alias("x"), F.col("y").cast("array<double>").alias("y"), "test")
        lists = work.written(rows.groupBy("series", "block").agg(F.collect_list(F.struct("x", "y", "test")).alias("each")))
        edges = work.written(_edges(lists.select("series", F.inline("each")), features, o.bins))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = lists.join(edges, "series").repartitionByRange(parts, "series", "block").sortWithinPartitions("series", "block")
        blocks = work.written(placed.select("series", "unit", "edges", "each").mapInArrow(_packed(features, steps, o.base), BLOCK))
        small = edges.count() * steps * ((1 << o.depth) - 1) * EVERY * 64 <= BROADCAST
        done: list[str] = []
        window: list[str] = []

        def level(number: int, depth: int, loss: bool) -> str:
            splits = work.read(SPLIT, *window) if window else None
            task = _histograms(features, steps, number, depth, o.bins, o.depth, loss)
            hist = _with_splits(blocks, splits, small).mapInArrow(task, HIST)
            return work.write(_chosen(hist, o))

        stopping = o.patience is not None
        for number in range(o.rounds):
            for depth in range(o.depth):
                window.append(level(number, depth, stopping and depth == 0 and number > 0))
            if (number + 1) % EVERY == 0 and number + 1 < o.rounds:
                lists = _with_splits(blocks, work.read(SPLIT, *window), small)
                if stopping:
                    state = _stopped(_losses(work.read(SPLIT, *done, *window)), o.patience)
                    over = state.groupBy("series").agg(F.bool_and("done").alias("over")).where("over")
                    lists = lists.join(over, "series", "left_anti")
                blocks = work.written(lists.mapInArrow(_advanced(features, steps, o.depth), BLOCK))
                done, window = [*done, *window], []
                if stopping and blocks.isEmpty():
                    break
        if stopping and window:
            window.append(level(o.rounds, 0, True))
        splits = work.read(SPLIT, *done, *window).where(F.col("round") < o.rounds) if done or window else spark.createDataFrame([], SPLIT)
        models = _trees(splits, edges, o.depth)
        rows_of = splits.where("node = 0 and round = 0").select("series", "step", F.col("n").alias("train_rows"))
        models = models.join(rows_of, ["series", "step"])
        if stopping:
            best = _stopped(_losses(work.read(SPLIT, *done, *window)), o.patience).drop("done")
            models = models.join(best, ["series", "step"], "left")
        else:
            models = models.withColumns({"best_round": F.lit(None).cast("int"), "best_loss": F.lit(None).cast("double")})
        kept = F.coalesce(F.col("best_round") + 1, F.size("trees"))
        models = models.withColumn("trees", F.slice("trees", F.lit(1), kept)).withColumn("best_round", kept)
        each = [_of_feature(F.lit(f)) for f in range(features)]
        found = models.select(
            "series", "step", F.lit(o.base).alias("base"), "trees", "train_rows", "best_round", "best_loss",
            F.array(*[g for g, _ in each]).alias("gains"), F.array(*[n for _, n in each]).alias("splits"),
        )
        return work.written(found, kept=True)


def _of_feature(f: Column) -> tuple[Column, Column]:
    """Summed gain and number of splits of a feature over all trees."""

    def over(trees: Column, first: Column, value) -> Column:
        tree = lambda t: F.aggregate(F.arrays_zip(t["feature"], t["gain"]), first, lambda a, x: a + F.when(x["feature"] == f, value(x)).otherwise(first))
        return F.aggregate(trees, first, lambda a, t: a + tree(t))

    return over(F.col("trees"), F.lit(0.0), lambda x: x["gain"]), over(F.col("trees"), F.lit(0), lambda x: F.lit(1))


def value(known: Column, base: Column, trees: Column, depth: int = 3) -> Column:
    """The prediction at an array of features: every tree walked from its root, null and NaN features as missing."""
    levels = F.sequence(F.lit(1), F.lit(depth))

    def leaf(tree: Column) -> Column:
        def down(node: Column, _: Column) -> Column:
            feature = F.get(tree["feature"], node)
            x = F.get(known, feature)
            left = F.when(x.isNull() | F.isnan(x), F.get(tree["missing_left"], node)).otherwise(x < F.get(tree["threshold"], node))
            return F.when(feature < 0, node).otherwise(node * 2 + F.when(left, 1).otherwise(2)).cast("int")

        return F.get(tree["value"], F.aggregate(levels, F.lit(0), down))

    return F.aggregate(trees, base, lambda total, tree: total + leaf(tree))
