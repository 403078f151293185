"""Least-norm linear regression on sparse tables of any width, for several folds at once.

A table has a row per non-zero cell: key, slot (its column) and value. The result is the least-squares
solution of least norm, also where columns are multiples of each other.

Tables of a few hundred columns are summed up to their normal equations in one pass, per fold, and these
are solved at once. For wider ones conjugate gradients on the normal equations start at zero and so
never leave the space that the rows span. A round is two grouped sums, one over the slots of a key and one
over the keys of a slot. All folds and targets are solved side by side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.sources.files import staged

#: The slot of the column of ones.
CONSTANT = -1
#: Columns up to which the sums of products of each two columns come to the driver.
GATHERED = 512
#: Directions in which the columns' squares sum up to less than this share of the greatest are not told from zero.
NEGLIGIBLE = 1e-10


@dataclass
class Fit:
    """``weights``: slot and x, an array with an entry for every (fold, target); ``norms``: slot and the
    root mean square that the cells of the slot were divided by."""

    weights: DataFrame
    norms: DataFrame
    folds: list
    targets: list[str]
    rounds: int
    converged: bool


def with_constant(cells: DataFrame, rows: DataFrame) -> DataFrame:
    one = rows.select("key", F.lit(CONSTANT).cast(cells.schema["slot"].dataType).alias("slot"), F.lit(1.0).alias("value"))
    return cells.select("key", "slot", "value").unionByName(one)


def scaled(cells: DataFrame, norms: DataFrame) -> DataFrame:
    return cells.join(norms, "slot").select("key", "slot", (F.col("value") / F.col("norm")).alias("v"))


def at_once(matrix: DataFrame, known: DataFrame, systems: list, targets: list[str]) -> list:
    """(slot, weights) from the products of each two columns, summed up per fold."""
    one, two = matrix.alias("one"), matrix.select("key", F.col("slot").alias("other"), F.col("v").alias("w")).alias("two")
    pairs = one.join(two, "key").filter("slot <= other").groupBy("fold", "slot", "other")
    pairs = pairs.agg(F.sum(F.col("v") * F.col("w")).alias("s")).toPandas()
    sums = matrix.drop("fold").join(known, "key").groupBy("fold", "slot")
    sums = sums.agg(*(F.sum(F.col("v") * F.col(t)).alias(f"t{n}") for n, t in enumerate(targets))).toPandas()
    slots = np.sort(sums["slot"].unique())
    place = {slot: n for n, slot in enumerate(slots)}

    def summed(held) -> tuple[np.ndarray, np.ndarray]:
        """Both sides of the normal equations over all rows outside the fold."""
        left, right = np.zeros((len(slots), len(slots))), np.zeros((len(slots), len(targets)))
        p, s = (x if held is None else x[x["fold"].isna() | (x["fold"] != held)] for x in (pairs, sums))
        a, b = p["slot"].map(place).to_numpy(int), p["other"].map(place).to_numpy(int)
        np.add.at(left, (a, b), p["s"].to_numpy())
        left = left + np.triu(left, 1).T
        np.add.at(right, s["slot"].map(place).to_numpy(int), s[[f"t{n}" for n in range(len(targets))]].to_numpy(float))
        return left, right

    weights = []
    for held in dict.fromkeys(fold for fold, _ in systems):
        left, right = summed(held)
        if len(slots):
            weights += list((np.linalg.pinv(left, rcond=NEGLIGIBLE, hermitian=True) @ right).T)
    return [(int(slot), [float(w[n]) for w in weights]) for n, slot in enumerate(slots)]


def fit(
    cells: DataFrame, rows: DataFrame, targets: list[str], folds: list | None = None, scale: bool = True,
    tolerance: float = 1e-10, rounds: int = 400, gathered: int = GATHERED,
) -> Fit:
    """Fit every target for every fold on the rows of all other folds; without ``folds``, on all rows.

    ``cells``: key, slot >= 0 and value, at most one row per (key, slot); ``rows``: key, fold (if there are
    folds) and the targets, one row per key. Rows of a fold that is not listed train every model. Null or zero
    cells count as absent; a row needs no cell, its model is then the constant alone. Rows whose targets hold a
    null train nothing. With ``scale`` columns are divided by their root mean square first, and the norm is
    that of the weights of these columns. Up to ``gathered`` columns are solved at once; with more, a system
    is done when its residual of the normal equations has fallen by ``tolerance``.
    """
    folds = [None] if folds is None else list(folds)
    systems = [(fold, target) for fold in folds for target in targets]
    fold = F.col("fold") if "fold" in rows.columns else F.lit(None).cast("int")
    known = rows.select("key", fold.alias("fold"), *targets).na.drop(subset=targets)
    filled = with_constant(cells.filter("value <> 0"), rows)
    count = rows.count() or 1
    size = F.sqrt(F.sum(F.col("value") * F.col("value")) / count) if scale else F.lit(1.0)
    norms = staged(filled.groupBy("slot").agg(size.alias("norm")), "norms")
    # a key's cells lie in one file, so that their sums meet before the shuffle
    matrix = staged(scaled(filled, norms).join(known.select("key", "fold"), "key").repartition("key"), "cells")

    if norms.count() <= gathered:
        weights = at_once(matrix, known, systems, targets)
        made = cells.sparkSession.createDataFrame(weights, f"slot {cells.schema['slot'].dataType.simpleString()}, x array<double>")
        return Fit(made, norms, folds, targets, 0, True)
    n = len(systems)
    every = F.sequence(F.lit(0), F.lit(n - 1))
    name = [f"q{j}" for j in range(n)]

    def for_all(build: Callable[[Column], Column]) -> Column:
        """An array with ``build(j)`` for every system. What changes from round to round comes as arrays too, so that
        no round has to be compiled anew."""
        return F.transform(every, build)

    def per_fold(values: Column) -> Column:
        """The values of a key's row, zero for the systems that it is held out of."""
        held = F.array(*(F.lit(fold).cast(known.schema["fold"].dataType) for fold, _ in systems))
        return for_all(lambda j: F.when(F.col("fold") == F.get(held, j), 0.0).otherwise(F.get(values, j)))

    def by_slot(of_keys: DataFrame, result: str) -> DataFrame:
        """Per slot, the sums over its cells of what their keys have in the array q."""
        sums = [F.sum(F.col("v") * F.get("q", j)).alias(c) for j, c in enumerate(name)]
        return matrix.join(of_keys, "key").groupBy("slot").agg(*sums).select("slot", F.array(*name).alias(result))

    truth = F.array(*(F.col(t).cast("double") for _, t in systems))
    state = by_slot(known.select("key", per_fold(truth).alias("q")), "z")
    state = staged(state.select("slot", for_all(lambda j: F.lit(0.0)).alias("x"), "z", F.col("z").alias("p")), "gradients")

    def totals(slots: DataFrame, pairs: list[str]) -> list[list[float]]:
        """Per pair of arrays their inner products, one for every system."""
        each = slots.select(F.posexplode(F.arrays_zip(*sorted(set("".join(pairs)))))).select("pos", "col.*")
        found = each.groupBy("pos").agg(*(F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in pairs)).collect()
        by_system = {r["pos"]: r for r in found}
        return [[by_system[j][pair] if j in by_system else 0.0 for j in range(n)] for pair in pairs]

    left = totals(state, ["zz"])[0]
    goal = [value * tolerance**2 for value in left]
    done = 0
    while done < rounds and any(a > b for a, b in zip(left, goal, strict=True)):
        # both sums of the round: along p for every key, and back to the slots
        along = matrix.join(state.select("slot", "p"), "slot").groupBy("key", "fold")
        along = along.agg(*(F.sum(F.col("v") * F.get("p", j)).alias(c) for j, c in enumerate(name)))
        back = by_slot(along.select("key", per_fold(F.array(*name)).alias("q")), "back")
        none = for_all(lambda j: F.lit(0.0))
        moved = staged(state.join(back, "slot", "left").select("slot", "x", "z", "p", F.coalesce("back", none).alias("w")), "gradients")
        zz, pw, zw, ww = totals(moved, ["zz", "pw", "zw", "ww"])
        step = [zz[j] / pw[j] if zz[j] > goal[j] and pw[j] > 0 else 0.0 for j in range(n)]
        left = [max(0.0, zz[j] - 2 * step[j] * zw[j] + step[j] ** 2 * ww[j]) for j in range(n)]
        turn = [left[j] / zz[j] if step[j] else 0.0 for j in range(n)]
        goal = [goal[j] if step[j] else max(goal[j], left[j]) for j in range(n)]  # no step: as far as it goes
        moved = moved.withColumns({"step": F.lit(step), "turn": F.lit(turn)})
        moved = moved.select(
            "slot", "p", "turn", for_all(lambda j: F.get("x", j) + F.get("step", j) * F.get("p", j)).alias("x"),
            for_all(lambda j: F.get("z", j) - F.get("step", j) * F.get("w", j)).alias("z"),
        )
        state = moved.select("slot", "x", "z", for_all(lambda j: F.get("z", j) + F.get("turn", j) * F.get("p", j)).alias("p"))
        done += 1
    weights = staged(state.select("slot", "x"), "weights")
    return Fit(weights, norms, folds, targets, done, all(a <= b for a, b in zip(left, goal, strict=True)))


def predict(model: Fit, cells: DataFrame, rows: DataFrame, prefix: str = "pred_") -> DataFrame:
    """key, fold (if rows have one) and a prediction per target, for every row of ``rows``: by the model that did not see the
    row's fold, or by the only one. Slots that no row of the fit had, and rows of folds without a model, add nothing: the latter
    get null."""
    several = model.folds != [None]
    keep = [c for c in ("key", "fold") if c in rows.columns]
    place = F.lit(0)
    if several:
        place = F.array_position(F.array(*(F.lit(f) for f in model.folds)), F.col("fold").cast(rows.schema["fold"].dataType)) - 1
        place = F.when(F.col("fold").isNotNull() & (place >= 0), place)
    of_key = rows.select(*keep, place.cast("int").alias("place"))
    filled = scaled(with_constant(cells.filter("value <> 0"), rows), model.norms)
    each = filled.join(of_key, "key").join(model.weights, "slot")
    width = len(model.targets)
    sums = [
        F.sum(F.col("v") * F.get("x", F.col("place") * width + t)).alias(f"{prefix}{name}") for t, name in enumerate(model.targets)
    ]
    return each.groupBy(*keep).agg(*sums)
