"""Random forest and gradient boosting over all series.

Training rows are binned once and stored; the trees of all folds are grown together (see
``histograms``). Growing runs while the plan is built, since the trees are part of the
plan afterwards. Few rows are one task's work. From ``ONE_TASK`` pairs of row and fold on,
every level is one aggregation over the stored rows, for boosting of one tree, for the
forest of ``TREES_AT_ONCE``. Both ways give the same trees.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...sources.shared import use_shared_folder
from ..features import CYCLIC, CYCLIC_CORE, anchor_features, training_rows
from .base import FINAL, anchors, forecast_columns
from . import histograms
from .histograms import BINS, Growth, Spec, Task, Trees, binned, predict, read_trees

# Model sizes, and the fewest rows worth fitting.
FOREST_TREES, FOREST_DEPTH, FOREST_LEAF = 300, 8, 3
BOOST_ROUNDS, BOOST_RATE, BOOST_DEPTH, BOOST_LEAF, BOOST_LEAVES = 400, 0.05, 6, 10, 31
MIN_ROWS = 10

#: Pairs of row and fold that one task fits alone (some 100 MB).
ONE_TASK = 1_000_000
#: Trees of a forest that go down a level together, and rounds of boosting after which targets are stored.
TREES_AT_ONCE, ROUNDS_STORED = 10, 20

# The forest reads a missing lag12 as a number, boosting as missing: column 8 or 9 of the bins.
_LAG12 = CYCLIC.index("lag12")
_COLUMNS = {False: [*range(_LAG12), _LAG12 + 1], True: list(range(_LAG12 + 1))}


def _forest(trees: int) -> Spec:
    return Spec(trees, FOREST_DEPTH, FOREST_LEAF, boosted=False)


def _boosting(rounds: int) -> Spec:
    return Spec(rounds, BOOST_DEPTH, BOOST_LEAF, boosted=True, rate=BOOST_RATE, max_leaves=BOOST_LEAVES)


@dataclass(frozen=True)
class TrainingTable:
    """Binned training rows of all folds: ``(key, since, y, bins, target)``, a row serving the folds from ``since`` on.

    ``months`` are the folds, ``rows`` and ``lag12_means`` their training rows and the mean of
    lag12 in them, missing as 0. ``cuts`` are upper edges of the bins of each feature.
    """

    table: DataFrame
    months: list[datetime.date]
    rows: np.ndarray
    lag12_means: np.ndarray
    cuts: list[np.ndarray]


def training_table(state: DataFrame, folds: DataFrame | None = None) -> TrainingTable:
    """Reads the feature rows once for bin edges and counts and once to store them binned.

    Edges are quantiles of the rows that the earliest fold with enough of them may learn
    from, so no fold sees a later count in them. The driver gets at most 63 edges for each
    feature and one row for each fold (K + 1 at most).
    """
    use_shared_folder(state.sparkSession)
    months = [FINAL] if folds is None else sorted(r.fold for r in folds.collect())
    rows = training_rows(state, CYCLIC_CORE)
    if months:
        rows = rows.where(F.col("month") < F.lit(months[-1]))
    since = sum((F.when(F.col("month") >= F.lit(m), 1).otherwise(0) for m in months), F.lit(0)).cast("int")
    key = F.xxhash64("category", "month")
    rows = rows.select(key.alias("key"), since.alias("since"), F.col("count").alias("y"), *CYCLIC).checkpoint()
    sums = {r.since: r for r in rows.groupBy("since").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("lag12", F.lit(0.0))).alias("lag12")).collect()}
    counts = np.cumsum([sums[k].n if k in sums else 0 for k in range(len(months))]).astype(int)
    lag12 = np.cumsum([sums[k].lag12 if k in sums else 0.0 for k in range(len(months))])
    # Folds with too few rows are not fitted.
    enough = counts >= MIN_ROWS
    base = int(np.argmax(enough)) if enough.any() else len(months)
    quantiles = [k / BINS for k in range(1, BINS)]
    known = rows.where(F.col("since") <= base)
    edges = known.agg(*[F.percentile_approx(c, quantiles, 20_000).alias(c) for c in CYCLIC], F.lit(0).alias("_")).first()
    cuts = [np.unique(np.array(edges[c] or [], float)) for c in CYCLIC]

    def bin_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["key", "since", "y"]].assign(bins=[x.tobytes() for x in bins_of(batch, cuts).T])

    table = rows.mapInPandas(bin_rows, "key long, since int, y double, bins binary").checkpoint()
    table = table.withColumn("target", F.lit(None).cast("binary"))
    return TrainingTable(table, months, counts, lag12 / np.maximum(counts, 1), cuts)


def bins_of(frame: pd.DataFrame, cuts: list[np.ndarray], lag12_fill: float | np.ndarray = 0.0) -> np.ndarray:
    """(features + 1, rows): the bins of all features, and of lag12 with missing ones filled."""
    out = [binned(frame[c].to_numpy(float), edges) for c, edges in zip(CYCLIC, cuts, strict=True)]
    lag12 = frame["lag12"].to_numpy(float)
    return np.stack([*out, binned(np.where(np.isnan(lag12), lag12_fill, lag12), cuts[_LAG12])])


def fit(data: TrainingTable, spec: Spec) -> tuple[np.ndarray, list[Trees]]:
    """Means and trees of the folds that have enough rows."""
    fitted = int((data.rows >= MIN_ROWS).sum())
    if not fitted:
        return np.zeros(0), []
    skipped = len(data.months) - fitted
    rows = data.table.withColumn("since", F.greatest(F.col("since") - skipped, F.lit(0)))
    means, units = _scale(rows, fitted)
    task = Task(spec, _COLUMNS[spec.boosted], means, units)
    if int(data.rows[-fitted:].sum()) <= ONE_TASK:
        # Trees of 2 ** (depth + 1) nodes for each of the K + 1 folds.
        return means, read_trees(rows.coalesce(1).mapInArrow(histograms.in_one_task(task), histograms.FOREST).collect(), fitted)
    return means, (_boosted if spec.boosted else _independent)(rows, task)


def _scale(rows: DataFrame, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean target of each fold, and the parts of one in which sums over its rows are exact.

    Whole numbers below 2 ** 53 add up without rounding. Sixteen times the span leaves room
    for resampled rows and for targets that grow while boosting.
    """
    found = {r.since: r for r in rows.groupBy("since").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("decimal(38,9)")).alias("sum"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect()}
    n, total, lo, hi = 0, 0, np.inf, -np.inf
    means, units = np.zeros(folds), np.zeros(folds)
    for k in range(folds):
        if k in found:
            n, total = n + found[k].n, total + found[k]["sum"]
            lo, hi = min(lo, found[k].lo), max(hi, found[k].hi)
        means[k] = float(total / n)
        units[k] = 2.0 ** np.floor(52 - np.log2(16.0 * n * max(hi - lo, 1e-9)))
    return means, units


def _level(rows: DataFrame, task: Task, growing: dict[int, Growth], before: list[Trees]) -> dict[int, Growth]:
    """One aggregation: cells of the next level, their sums, the best splits. Returns trees that go on."""
    cells = rows.mapInArrow(histograms.level_cells(task, growing, before), histograms.CELLS)
    splits = cells.groupBy("tree", "part").applyInArrow(histograms.best_splits(task.spec, len(task.columns)), histograms.BEST)
    # Eight numbers for each node of the level.
    histograms.take_splits(growing, splits.collect())
    return {number: g for number, g in growing.items() if not g.done}


def _independent(rows: DataFrame, task: Task) -> list[Trees]:
    out = []
    for first in range(0, task.spec.trees, TREES_AT_ONCE):
        growths = {k: Growth(len(task.means), task.spec) for k in range(first, min(first + TREES_AT_ONCE, task.spec.trees))}
        growing = growths
        while growing:
            growing = _level(rows, task, growing, [])
        out += [g.finished(task.units) for g in growths.values()]
    return out


def _boosted(rows: DataFrame, task: Task) -> list[Trees]:
    """Rounds one after another. Targets are those stored less the few trees since."""
    out: list[Trees] = []
    stored = 0
    for number in range(task.spec.trees):
        if number - stored == ROUNDS_STORED:
            rows = rows.mapInArrow(histograms.less_trees(task, out[stored:]), rows.schema).checkpoint()
            stored = number
        growth = Growth(len(task.means), task.spec)
        growing = {number: growth}
        while growing:
            growing = _level(rows, task, growing, out[stored:])
        out.append(growth.finished(task.units))
    return out


def tree_model(
    state: DataFrame, folds: DataFrame | None, spec: Spec, anchor: str = "last_row", data: TrainingTable | None = None
) -> DataFrame:
    """Forecasts of the trees that ``spec`` describes; the recent average where rows or features are too few."""
    data = data or training_table(state, folds)
    means, trees = fit(data, spec)
    fitted = [m for m, n in zip(data.months, data.rows, strict=True) if n >= MIN_ROWS]
    number = {m: k for k, m in enumerate(fitted)}
    lag12_means, cuts, columns = data.lag12_means[len(data.months) - len(fitted) :], data.cuts, _COLUMNS[spec.boosted]

    @F.pandas_udf("double")
    def score(fold: pd.Series, x: pd.DataFrame) -> pd.Series:
        k = fold.map(number).to_numpy(int)
        bins = bins_of(x, cuts, lag12_means[k])[columns]
        return pd.Series(predict(spec, means, trees, k, bins))

    targets = anchor_features(anchors(state, folds), anchor)
    usable = F.col("fold").isin(fitted) if fitted else F.lit(False)
    for name in CYCLIC_CORE:
        usable &= F.col(name).isNotNull()
    ready = forecast_columns(targets.where(usable), score(F.col("fold"), F.struct(*CYCLIC)))
    short = forecast_columns(targets.where(~usable), F.col("fallback"), F.lit("short"))
    return ready.unionByName(short)


def random_forest(
    state: DataFrame, folds: DataFrame | None = None, trees: int = FOREST_TREES, anchor: str = "last_row", data: TrainingTable | None = None
) -> DataFrame:
    """Missing lag12 counts as 0 in training and as the training mean in prediction."""
    return tree_model(state, folds, _forest(trees), anchor, data)


def gradient_boost(
    state: DataFrame, folds: DataFrame | None = None, rounds: int = BOOST_ROUNDS, anchor: str = "last_row", data: TrainingTable | None = None
) -> DataFrame:
    """Missing lag12 stays missing; each split says which way it goes."""
    return tree_model(state, folds, _boosting(rounds), anchor, data)


def importances(trees: list[Trees], columns: list[int]) -> np.ndarray:
    """Share of each feature in the gains, a tree as much as another."""
    total = np.zeros(len(CYCLIC))
    for t in trees:
        inner = t.feature >= 0
        gains = np.bincount(np.minimum(np.array(columns)[t.feature[inner]], _LAG12), t.gain[inner], len(CYCLIC))
        total += gains / gains.sum() if gains.sum() else 0.0
    return total / total.sum() if total.sum() else total


def feature_importance(state: DataFrame, trees: int = FOREST_TREES, rounds: int = BOOST_ROUNDS) -> DataFrame:
    """Importance of every feature in both models fitted on all rows."""
    data = training_table(state)
    rows = []
    for name, spec in (("random_forest", _forest(trees)), ("gradient_boost", _boosting(rounds))):
        found = importances(fit(data, spec)[1], _COLUMNS[spec.boosted])
        rows += [(name, feature, float(w)) for feature, w in zip(CYCLIC, found, strict=True)]
    return state.sparkSession.createDataFrame(rows, "model string, feature string, importance double")
