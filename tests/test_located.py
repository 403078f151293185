import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import located

SCHEMA = "row_key long, messid long, bsid long, nseq int, rssi double, time_ux long, bs_lat double, bs_lng double, lat double, lng double"


def messages(spark):
    """Message 10 was heard twice by station 2: the later row counts."""
    place = {1: (40.0, -105.0), 2: (40.1, -104.9), 5: (40.2, -104.8)}
    heard = [(1, 10, 1, -80.0), (2, 10, 2, -90.0), (3, 10, 2, -70.0), (4, 11, 5, -60.0), (5, 12, 1, -75.0), (6, 12, 5, -65.0)]
    rows = [
        (key, message, station, key % 4, rssi, 1_700_000_000 + key, *place[station], 40.05 + message / 100, -104.95)
        for key, message, station, rssi in heard
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_matrix_keeps_the_last_row(spark):
    matrix = located.feature_matrix(messages(spark), [1, 2, 5], located.ATTRIBUTES)
    assert matrix.columns == ["messid", *(f"{a}_{i}" for a in located.ATTRIBUTES for i in (1, 2, 5))]
    rows = {r["messid"]: r for r in matrix.collect()}
    assert (rows[10]["rssi_1"], rows[10]["rssi_2"], rows[10]["rssi_5"]) == (-80.0, -70.0, 0.0)
    assert rows[11]["distance_1"] == 0.0
    assert rows[11]["distance_5"] > 1.0
    assert not any(name.startswith(("lat", "lng", "distance")) for name in located.feature_matrix(messages(spark), [1]).columns)


def test_one_attribute(spark):
    matrix = located.feature_matrix(messages(spark), [1, 2], ["rssi"])
    assert matrix.columns == ["messid", "rssi_1", "rssi_2"]


def test_incidence(spark):
    rows = {r["messid"]: tuple(r)[1:] for r in located.incidence(messages(spark), [1, 2, 5, 9]).collect()}
    assert rows == {10: (1, 1, 0, 0), 11: (0, 0, 1, 0), 12: (1, 0, 1, 0)}


def test_sparse_form_equals_the_wide_one(spark):
    df = messages(spark)
    attributes = located.MODEL_ATTRIBUTES
    wide = {r["messid"]: r for r in located.feature_matrix(df, [1, 2, 5], attributes).collect()}
    for row in located.sparse_features(df, located.stations(df), attributes).collect():
        dense = [wide[row["messid"]][f"{a}_{i}"] for i in (1, 2, 5) for a in attributes]
        assert list(row["features"].toArray()) == dense


def test_station_list_has_a_bound(spark):
    assert located.station_list(messages(spark)) == [1, 2, 5]
    with pytest.raises(ValueError):
        located.station_list(messages(spark), limit=2)


def regression_rows(spark, n=60):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 2))
    lat = 40 + 0.3 * x[:, 0] - 0.1 * x[:, 1] + rng.normal(scale=0.01, size=n)
    lng = -105 + 0.2 * x[:, 1] + rng.normal(scale=0.01, size=n)
    rows = [(n, *map(float, (a, b, c, d))) for n, (a, b, c, d) in enumerate(zip(x[:, 0], x[:, 1], lat, lng))]
    return spark.createDataFrame(rows, "messid long, x1 double, x2 double, lat double, lng double"), x, lat


def test_least_squares(spark):
    df, x, lat = regression_rows(spark)
    rows = located.assembled(df, ["x1", "x2"])
    got = {r["messid"]: r["pred_lat"] for r in located.predict_positions(located.fit_positions(rows), rows).collect()}
    design = np.column_stack([np.ones(len(x)), x])
    expected = design @ np.linalg.lstsq(design, lat, rcond=None)[0]
    assert [got[n] for n in range(len(x))] == pytest.approx(list(expected), abs=1e-6)


def test_rank_deficient_matrix(spark):
    """Columns that are multiples of each other, as station coordinates are."""
    rng = np.random.default_rng(2)
    heard = rng.integers(0, 2, size=(80, 3)).astype(float)
    design = np.column_stack([heard, heard * [40.0, 40.1, 40.2], heard * [-105.0, -104.9, -104.8]])
    lat = 40 + heard @ [0.1, -0.2, 0.3] + rng.normal(scale=0.01, size=80)
    names = [f"x{n}" for n in range(9)]
    rows = [(n, *map(float, row), float(y), float(y)) for n, (row, y) in enumerate(zip(design, lat))]
    df = spark.createDataFrame(rows, ["messid", *names, "lat", "lng"])
    vectors = located.assembled(df, names)
    models = located.fit_positions(vectors, located.TINY_RIDGE)
    got = {r["messid"]: r["pred_lat"] for r in located.predict_positions(models, vectors).collect()}
    full = np.column_stack([np.ones(80), design])
    expected = full @ (np.linalg.pinv(full) @ lat)
    assert [got[n] for n in range(80)] == pytest.approx(list(expected), abs=1e-4)


def test_out_of_fold_covers_every_key_once(spark):
    df, _, _ = regression_rows(spark)
    rows = located.assembled(df.withColumn("fold", (F.col("messid") / 20).cast("int")), ["x1", "x2"])
    predicted = located.out_of_fold(rows, 3)
    assert sorted(r["messid"] for r in predicted.collect()) == list(range(60))
    errors = located.distance_errors(predicted, "messid").agg(F.max("error_m"), F.count("error_m")).first()
    assert errors[0] < 10_000 and errors[1] == 60
    assert located.rmse(predicted)["lat"] < 0.02


def test_occurring_distances(spark):
    pairs = spark.createDataFrame([(0, 1), (1, 0), (0, 0), (0, 1)], "origin int, target int")
    places = spark.createDataFrame([(0, 10.0, 20.0), (1, 11.0, 21.0), (2, 0.0, 0.0)], "id int, lat double, lng double")
    rows = {(r["origin"], r["target"]): (r["n"], r["km"]) for r in located.occurring_distances(pairs, places, "id").collect()}
    assert rows[(0, 0)] == (1, 0.0)
    assert rows[(0, 1)][0] == 2
    assert rows[(0, 1)][1] == rows[(1, 0)][1] > 100


def test_a_thousand_stations(spark):
    heard = spark.range(6000).selectExpr(
        "id AS row_key", "id div 3 AS messid", "(id * 37) % 1000 AS bsid", "id % 4 AS nseq", "-60.0 - id % 50 AS rssi",
        "1700000000 + id AS time_ux", "39.5 + ((id * 37) % 1000) * 0.001 AS bs_lat", "-105.0 + ((id * 37) % 1000) * 0.002 AS bs_lng",
        "39.5 + (id div 3 % 97) * 0.005 AS lat", "-104.8 + (id div 3 % 89) * 0.006 AS lng",
    )
    rows = located.sparse_features(heard, located.stations(heard)).join(located.ground_truth(heard), "messid")
    assert rows.first()["features"].size == 5000
    models = located.fit_positions(rows, located.TINY_RIDGE, "l-bfgs")
    assert located.predict_positions(models, rows).filter("pred_lat IS NOT NULL AND pred_lng IS NOT NULL").count() == 2000


def test_long_forms_equal_the_wide_ones(spark):
    df = messages(spark)
    numbered = located.numbered_stations(df)
    assert {tuple(r) for r in numbered.collect()} == {(1, 0), (2, 1), (5, 2)}
    wide = {r["messid"]: r for r in located.feature_matrix(df, [1, 2, 5]).collect()}
    cells = {(r["messid"], r["slot"]): r["value"] for r in located.matrix_cells(df, numbered).collect()}
    for message, row in wide.items():
        dense = [row[f"{a}_{i}"] for i in (1, 2, 5) for a in located.MODEL_ATTRIBUTES]
        assert [cells.get((message, slot), 0.0) for slot in range(15)] == dense
    heard = {(r["messid"], r["slot"]) for r in located.incidence_cells(df, numbered).collect()}
    assert heard == {(10, 0), (10, 1), (11, 2), (12, 0), (12, 2)}


def test_five_thousand_stations_are_numbered_in_ranges(spark):
    heard = spark.range(20000).selectExpr("id AS messid", "(id * 7919) % 5000 * 3 AS bsid")
    numbered = located.numbered_stations(heard, heard)
    rows = sorted((r["bsid"], r["slot"]) for r in numbered.collect())
    assert rows == [(3 * n, n) for n in range(5000)]
    text = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    assert located.incidence_cells(heard, numbered).count() == 20000


def test_places_within_a_radius_against_the_full_square(spark):
    rng = np.random.default_rng(6)
    rows = [(n, float(a), float(b)) for n, (a, b) in enumerate(zip(rng.uniform(-90, 90, 150), rng.uniform(-180, 180, 150)))]
    rows += [(200 + n, a, b) for n, (a, b) in enumerate([
        (90.0, 0.0), (89.5, 10.0), (89.5, -170.0), (-90.0, 5.0), (-89.0, 100.0), (0.0, 180.0), (0.1, -180.0), (0.2, -179.9),
        (0.0, 179.95), (60.0, 179.9), (60.0, -179.9), (45.0, 360.0), (45.0, 0.1), (10.0, 10.0), (10.0, 10.0),
    ])]
    rows += [(300, None, 1.0), (301, 1.0, None), (None, 0.0, 180.0)]
    places = spark.createDataFrame(rows, "id int, lat double, lng double")
    one = places.toDF("one", "lat1", "lng1").filter("one IS NOT NULL AND lat1 IS NOT NULL AND lng1 IS NOT NULL")
    other = places.toDF("other", "lat2", "lng2").filter("other IS NOT NULL AND lat2 IS NOT NULL AND lng2 IS NOT NULL")
    square = one.join(other, F.col("one") < F.col("other"))
    km = located.distance_km(*(F.col(c) for c in ("lat1", "lng1", "lat2", "lng2")))
    square = {(r["one"], r["other"]): r["km"] for r in square.withColumn("km", km).collect()}
    for radius in (15.0, 120.0, 900.0, 4000.0):
        near = located.within_radius(places, "id", radius)
        got = {(r["one"], r["other"]): r["km"] for r in near.collect()}
        assert got == pytest.approx({pair: d for pair, d in square.items() if d is not None and d <= radius})
        assert "NestedLoop" not in near._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        located.within_radius(places, "id", 0.0)


def test_radius_join_hands_on_near_pairs_only_in_bounded_keys(spark):
    # a tenth of the places round a pole, as many at one spot, the rest all over
    rows = [(n, 89.0 + (n % 97) / 100, (n * 37) % 360 - 180.0) for n in range(300)]
    rows += [(n, 10.0, 20.0) for n in range(300, 2_700)]
    rows += [(n, (n * 37) % 1700 / 10 - 85.0, (n * 911) % 3600 / 10 - 180.0) for n in range(2_700, 5_000)]
    places = spark.createDataFrame(rows, "id long, lat double, lng double")
    met = located.pairs_nearby(places, "id", 300.0)
    near = located.within_radius(places, "id", 300.0)
    n_met, n_near = met.count(), near.count()
    assert n_near <= n_met <= 1.05 * n_near and near.dropDuplicates(["one", "other"]).count() == n_near
    assert near.filter("one >= 300 AND other < 2700").count() == 2_400 * 2_399 // 2
    sides = spark.createDataFrame([(0, 0)] * 4_500 + [(1, 0)], "band int, cell int")
    blocks, tasks = located.blocks_of_cells(sides, sides)
    assert sorted(map(tuple, blocks.collect())) == [(0, 0, 3, 3), (1, 0, 1, 1)] and tasks == 5


def test_cells_of_shops_are_found_by_all_cores(spark, monkeypatch, tmp_path):
    """A compact table is one split, and every shop is looked up in some ten cells."""
    from gleaner.plans import located as plans
    from gleaner.sources.tables import Tables

    spark.range(1, 5_001, 1, 1).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    seen, within = [], located.within_radius
    monkeypatch.setattr(located, "within_radius", lambda places, *a: seen.append(places) or within(places, *a))
    near = plans.places_within_radius(Tables(spark, str(tmp_path)))
    assert near.columns == ["one", "other", "km"]
    held = seen[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= spark.sparkContext.defaultParallelism and sum(r["count"] for r in held) == 5_000
