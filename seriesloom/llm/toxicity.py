"""Toxicity of texts by a linear classifier whose scores must not change when identity terms are swapped.

A text is the set of its words and of their first letters (stems of inflected languages), hashed. Features whose share
of toxic texts is far from the average are kept, and weighted by their log-odds. The weights minimise the logistic loss
over the labelled texts, plus the squared change of score when every identity term of a text is replaced by another one
of its kind (a counterfactual text), plus a ridge term. Loss and gradient of each step are sums that tasks make over the
stored features of their texts; the driver only holds the weights.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import Remembered, slices, written

#: Labelled texts that the fit uses at most, those of least hash.
TRAIN_ROWS = 20_000
#: Partitions of the labelled texts' features; a step brings one gradient from each to the driver.
PARTS = 8
#: Values of the feature hash, features that the model may hold, and texts that a feature needs.
BUCKETS, FEATURES, LEAST_TEXTS = 1 << 20, 4096, 4
#: Standard deviations that a feature's toxic texts must be off their expected number.
CONTRAST = 3.5
#: Weights of the counterfactual and of the ridge term, and steps of the fit.
FAIRNESS, RIDGE, STEPS = 1.0, 1e-3, 40
#: Letters of a word's beginnings.
STEMS = range(3, 9)

WORDS = re.compile(r"[^\W\d_]+")

# Identity terms by kind, in the languages of the corpus.
KINDS = [
    "women men girls boys",
    "woman man girl boy",
    "female male",
    "gay lesbian bisexual straight heterosexual homosexual transgender queer",
    "christian muslim jewish hindu buddhist sikh atheist catholic protestant",
    "christians muslims jews hindus buddhists sikhs atheists catholics protestants",
    "black white asian latino hispanic african european arab",
    "immigrants refugees foreigners natives citizens",
    "disabled deaf blind autistic",
    "frauen männer mädchen jungen",
    "frau mann",
    "schwul lesbisch bisexuell heterosexuell homosexuell transgeschlechtlich",
    "christen muslime juden hindus buddhisten atheisten katholiken protestanten",
    "einwanderer flüchtlinge ausländer einheimische",
    "femmes hommes filles garçons",
    "femme homme",
    "gays lesbiennes bisexuels hétérosexuels homosexuels",
    "chrétiens musulmans juifs hindous bouddhistes athées catholiques protestants",
    "immigrés réfugiés étrangers citoyens",
    "mujeres hombres niñas niños",
    "mujer hombre",
    "gais lesbianas bisexuales heterosexuales homosexuales",
    "cristianos musulmanes judíos hindúes budistas ateos católicos protestantes",
    "inmigrantes refugiados extranjeros ciudadanos",
]


def swaps(kinds: Iterable[str] = tuple(KINDS)) -> dict[str, list[str]]:
    """Each identity term with the others of its kind, those that follow it first."""
    out: dict[str, list[str]] = {}
    for kind in kinds:
        terms = kind.split()
        for i, term in enumerate(terms):
            out.setdefault(term, terms[i + 1 :] + terms[:i])
    return out


def words(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def word_features(word: str) -> np.ndarray:
    """Hashes of a word and of its beginnings."""
    parts = [word + "$", *(word[:n] for n in STEMS if n < len(word)), word]
    return np.array([xxhash.xxh3_64_intdigest(p.encode()) % BUCKETS for p in parts], np.int32)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int32)


def counterfactual(found: set[str], others: dict[str, list[str]], turn: int) -> set[str] | None:
    """The words with every identity term replaced; ``turn`` picks the replacement. None without such a term."""
    named = found & others.keys()
    if not named:
        return None
    return (found - named) | {others[t][turn % len(others[t])] for t in named}


def _featured(others: dict[str, list[str]]) -> Callable:
    """Rows ``key, label, features, swapped`` from ``key, label, text``."""

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Remembered(word_features, 100_000)
        of = lambda found: _joined([cache[w] for w in found])
        kind = pa.list_(pa.int32())
        for batch in slices(batches, "text"):
            own, swapped = [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words(text)
                other = counterfactual(found, others, xxhash.xxh3_64_intdigest(str(key).encode()))
                own.append(of(found))
                swapped.append(None if other is None else of(other))
            yield pa.record_batch([batch.column("label"), pa.array(own, kind), pa.array(swapped, kind)], names=["label", "features", "swapped"])

    return features


def _summed(df: DataFrame, part: Callable, size: int) -> np.ndarray:
    """Vectors that ``part`` makes of the batches of each task, summed on the driver: ``size`` doubles from each."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            part(batch, total)
        yield pa.record_batch([pa.array([total.tobytes()])], names=["v"])

    rows = df.mapInArrow(task, "v binary").collect()
    return sum((np.frombuffer(r["v"]) for r in rows), np.zeros(size))


def _ragged(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and row numbers of a list column; null lists have none."""
    sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


class Model:
    """Weights of the kept feature hashes (ascending) and an intercept: all a task needs to score texts."""

    def __init__(self, kept: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.kept, self.weights, self.bias = kept, weights, bias

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where hashes are among those kept; those that are not are left out."""
        if not len(self.kept):
            return np.empty(0, np.int64)
        at = np.searchsorted(self.kept, hashes).clip(max=len(self.kept) - 1)
        return at[self.kept[at] == hashes]

    def score(self, found: set[str], known: Remembered) -> float:
        at = {i for w in found for i in known[w]}
        margin = self.bias + float(self.weights[sorted(at)].sum()) if at else self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """``key, label, text`` of at most ``rows`` labelled keys, those of least hash; of several labels the largest counts."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key"))
    picks = known.agg(F.max(F.col(label).cast("double")).alias("label")).orderBy(F.xxhash64("key"), "key").limit(rows)
    read = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return read.join(F.broadcast(picks), "key").select("key", "label", "text")  # at most ``rows`` keys and labels


def fit(train: DataFrame, fairness: float = FAIRNESS, ridge: float = RIDGE, steps: int = STEPS, kinds: Iterable[str] = tuple(KINDS)) -> Model:
    """The model of rows ``key, label, text`` (labels 0 and 1).

    Features are made once and written. Without rows, or with one label only, the model has its intercept alone.
    """
    rows = written(train.mapInArrow(_featured(swaps(kinds)), "label double, features array<int>, swapped array<int>").coalesce(PARTS), "toxicity-features")

    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    base = (toxic + 0.5) / (n + 1)
    bias = float(np.log(base / (1 - base)))
    if toxic in (0, n):
        return Model(np.empty(0, np.int32), np.empty(0), bias)
    counts = rows.select("label", F.explode("features").alias("feature")).groupBy("feature").agg(F.count("*").alias("seen"), F.sum("label").alias("hits"))
    off = F.abs(F.col("hits") - F.col("seen") * base) / F.sqrt(F.col("seen") * (base * (1 - base)))
    marked = counts.withColumn("off", off).where((F.col("seen") >= LEAST_TEXTS) & (F.col("off") >= CONTRAST))
    best = sorted(marked.orderBy(F.col("off").desc(), "feature").limit(FEATURES).collect())
    kept = np.array([r["feature"] for r in best], np.int32)
    seen, hits = (np.array([r[c] for r in best], float) for c in ("seen", "hits"))
    scale = np.log((hits + 0.5) / (toxic + 1)) - np.log((seen - hits + 0.5) / (n - toxic + 1))
    size = len(kept)
    bare = Model(kept, np.zeros(size), bias)

    def slim(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            lists = [[None if x is None else bare.places(np.array(x, np.int32)).astype(np.int32) for x in batch.column(c).to_pylist()] for c in ("features", "swapped")]
            yield pa.record_batch([batch.column("label"), *[pa.array(x, kind) for x in lists]], names=["label", "features", "swapped"])

    slimmed = written(rows.mapInArrow(slim, rows.schema), "toxicity-kept")

    def loss(point: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss at weights (in units of the features' log-odds) and intercept, and its gradient."""
        weights, own_bias = point[:-1] * scale, point[-1]

        def part(batch: pa.RecordBatch, total: np.ndarray) -> None:
            label = batch.column("label").to_numpy()
            (x, row), (y, other) = _ragged(batch.column("features")), _ragged(batch.column("swapped"))
            margin = np.bincount(row, weights[x], minlength=len(label))
            pull = 1 / (1 + np.exp(-(margin + own_bias))) - label
            named = ~np.array([v is None for v in batch.column("swapped").to_pylist()], bool)
            change = np.where(named, margin - np.bincount(other, weights[y], minlength=len(label)), 0.0)
            total[0] += np.logaddexp(0, margin + own_bias).sum() - (label * (margin + own_bias)).sum() + fairness * (change**2).sum()
            both = pull + 2 * fairness * change
            total[1 : size + 1] += np.bincount(x, both[row], minlength=size) - np.bincount(y, 2 * fairness * change[other], minlength=size)
            total[size + 1] += pull.sum()

        total = _summed(slimmed, part, size + 2) / n
        gradient = np.append(total[1 : size + 1] * scale + ridge * point[:-1], total[-1])
        return total[0] + ridge / 2 * float(point[:-1] @ point[:-1]), gradient

    point = minimised(loss, np.append(np.zeros(size), bias), steps)
    return Model(kept, point[:-1] * scale, float(point[-1]))


def minimised(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Minimum of a convex function by quasi-Newton steps of limited memory, each halved until it descends."""
    value, gradient = loss(point)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, weights = -gradient, []
        for move, turn in reversed(moves):
            weights.append((move @ direction) / (move @ turn))
            direction = direction - weights[-1] * turn
        if moves:
            move, turn = moves[-1]
            direction = direction * (move @ turn) / (turn @ turn)
        for (move, turn), weight in zip(moves, reversed(weights), strict=True):
            direction = direction + move * (weight - (turn @ direction) / (move @ turn))
        slope = float(gradient @ direction)
        if slope > -1e-10:
            break
        length = 1.0
        while True:
            new = point + length * direction
            new_value, new_gradient = loss(new)
            if new_value <= value + 1e-4 * length * slope or length < 1e-6:
                break
            length /= 2
        if new_value >= value:
            break
        if (new - point) @ (new_gradient - gradient) > 1e-12:
            moves = [*moves[1 - memory :], (new - point, new_gradient - gradient)]
        small = value - new_value < 1e-6 * max(value, 1e-9)
        point, value, gradient = new, new_value, new_gradient
        if small:
            break
    return point


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1; null texts score as empty ones, which have the intercept alone."""
    own = [f"_in_{i}" for i in range(len(docs.columns))]
    place = [c.lower() for c in docs.columns].index(text.lower())
    read = docs.toDF(*own)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(lambda w: tuple(model.places(word_features(w)).tolist()))
        for batch in slices(batches, own[place]):
            values = [model.score(words(t or ""), known) for t in batch.column(place).to_pylist()]
            yield batch.append_column("_score", pa.array(values, pa.float64()))

    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(own, docs.schema.fields, strict=True))
    names = [c for c in docs.columns if c.lower() != "score"]
    kept = [F.col(o).alias(c) for o, c in zip(own, docs.columns, strict=True) if c in names]
    return read.mapInArrow(scored, f"{schema}, _score double").select(*kept, F.col("_score").alias("score"))


def held_out(key: Column, parts: int = 5) -> Column:
    """Whether a row is kept from the fit: one in ``parts``, by the CRC-32 of its key as text; a null key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == 0


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", **options) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` from a model of the labelled rows that are not held out.

    Only the text counts for a score. Null and empty texts get the intercept's score; texts may be of any length; repeated
    rows score alike; without labels every score is 0.5; an empty table gives an empty result. Columns named as those
    produced are replaced.
    """
    train = labelled(docs, labels.where(~held_out(F.col(key))), key, text, label)
    found = score(docs, fit(train, **options), text)
    return found.withColumns({"held_out": held_out(F.col(key)), "predicted": (F.col("score") >= 0.5).cast("int")})
