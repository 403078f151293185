import numpy as np
import pytest

from gleaner.operators import leastnorm


def sparse(spark, design, y, **more):
    cells = [(int(i), int(j), float(design[i, j])) for i, j in zip(*np.nonzero(design), strict=True)]
    rows = [(i, *(int(v[i]) for v in more.values()), *map(float, np.atleast_1d(y[i]))) for i in range(len(design))]
    names = ["key long", *(f"{k} int" for k in more), *(f"y{t} double" for t in range(np.atleast_2d(y.T).shape[0]))]
    return spark.createDataFrame(cells, "key long, slot int, value double"), spark.createDataFrame(rows, ", ".join(names))


def predictions(df, target="pred_y0"):
    return {r["key"]: r[target] for r in df.collect()}


def station_like(rng, messages, stations, heard):
    """Three columns per station of which two are multiples of each other: rank-deficient."""
    design = np.zeros((messages, 3 * stations))
    for i in range(messages):
        for s in rng.choice(stations, heard, replace=False):
            design[i, 3 * s : 3 * s + 3] = (rng.normal(), 39.0 + s % 7, 2 * (39.0 + s % 7))
    return design


@pytest.mark.parametrize(("scale", "gathered"), [(True, 512), (False, 512), (True, 0)])
def test_least_norm_solution_of_a_rank_deficient_matrix(spark, scale, gathered):
    rng = np.random.default_rng(3)
    design = station_like(rng, 70, 8, 2) / (1.0 if scale else 40.0)
    y = rng.normal(size=70)
    cells, rows = sparse(spark, design, y)
    model = leastnorm.fit(cells, rows, ["y0"], scale=scale, gathered=gathered)
    assert model.converged
    full = np.column_stack([np.ones(70), design])
    norms = np.sqrt((full**2).mean(axis=0)) if scale else np.ones(full.shape[1])
    expected = np.linalg.lstsq(full / norms, y, rcond=1e-10)[0]
    weights = {r["slot"]: r["x"][0] for r in model.weights.collect()}
    assert [weights[j - 1] for j in range(25)] == pytest.approx(list(expected), abs=1e-6)
    got = predictions(leastnorm.predict(model, cells, rows))
    assert [got[i] for i in range(70)] == pytest.approx(list(full / norms @ expected), abs=1e-6)


def test_three_thousand_stations(spark):
    rng = np.random.default_rng(4)
    design = station_like(rng, 1200, 3000, 3)
    truth = rng.normal(size=9000)
    y = 40 + design @ truth / 100
    cells, rows = sparse(spark, design, y)
    model = leastnorm.fit(cells, rows, ["y0"], tolerance=1e-9)
    assert model.converged and model.rounds < 200
    full = np.column_stack([np.ones(1200), design])
    norms = np.sqrt((full**2).mean(axis=0))
    seen = norms > 0
    expected = np.linalg.lstsq(full[:, seen] / norms[seen], y, rcond=1e-10)[0]
    weights = {r["slot"]: r["x"][0] for r in model.weights.collect()}
    assert sorted(weights) == sorted(np.flatnonzero(seen) - 1)
    got = np.array([weights[j] for j in np.flatnonzero(seen) - 1])
    assert np.linalg.norm(got - expected) < 1e-5 * np.linalg.norm(expected)


@pytest.mark.parametrize("gathered", [512, 0])
def test_folds_side_by_side(spark, gathered):
    rng = np.random.default_rng(5)
    design = rng.normal(size=(60, 3))
    y = np.column_stack([design @ [1.0, 2.0, 3.0] + rng.normal(size=60), design[:, 0] - 4])
    fold = np.arange(60) // 20
    cells, rows = sparse(spark, design, y, fold=fold)
    model = leastnorm.fit(cells, rows, ["y0", "y1"], [0, 1, 2], gathered=gathered)
    predicted = leastnorm.predict(model, cells, rows)
    full = np.column_stack([np.ones(60), design])
    for t in (0, 1):
        got = predictions(predicted, f"pred_y{t}")
        for f in range(3):
            weights = np.linalg.lstsq(full[fold != f], y[fold != f, t], rcond=None)[0]
            assert [got[i] for i in range(60) if fold[i] == f] == pytest.approx(list(full[fold == f] @ weights), abs=1e-6)
    # rows of a fold that is not listed train every model and have no prediction
    one = leastnorm.fit(cells, rows, ["y0"], [2])
    got = predictions(leastnorm.predict(one, cells, rows))
    assert all((got[i] is None) == (fold[i] != 2) for i in range(60))


def test_nulls_empty_rows_and_empty_tables(spark):
    cells = spark.createDataFrame([(1, 0, 2.0), (1, 1, None), (2, 0, 0.0), (9, 5, 1.0)], "key long, slot int, value double")
    rows = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 1.0), (4, None)], "key long, y0 double")
    for gathered in (512, 0):
        model = leastnorm.fit(cells, rows, ["y0"], gathered=gathered)
        got = predictions(leastnorm.predict(model, cells, rows))
        assert got == pytest.approx({1: 3.0, 2: 1.0, 3: 1.0, 4: 1.0})
    empty = leastnorm.fit(cells.limit(0), rows.limit(0), ["y0"])
    assert empty.converged and empty.rounds == 0 and empty.weights.count() == 0
    nothing = leastnorm.predict(empty, cells, rows)
    assert nothing.columns == ["key", "pred_y0"]


def test_a_round_has_no_cross_join(spark):
    cells, rows = sparse(spark, np.eye(4), np.arange(4.0))
    model = leastnorm.fit(cells, rows, ["y0"], rounds=1, gathered=0)
    text = leastnorm.predict(model, cells, rows)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
