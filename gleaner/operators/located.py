"""Messages heard by base stations: wide features, truth, models and distance errors."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.geodesy import distance_km
from gleaner.operators import leastnorm, ranks
from gleaner.sources.files import staged

# fixed values: attributes of a message at a station, in the order of the matrix columns
ATTRIBUTES = ("nseq", "rssi", "time_ux", "lat", "lng", "bs_lat", "bs_lng", "distance")
# ridge for rank-deficient station matrices
TINY_RIDGE = 1e-8
# those a model may see: without the truth and what is computed from it
MODEL_ATTRIBUTES = ("nseq", "rssi", "time_ux", "bs_lat", "bs_lng")


def attach_positions(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Join on the row key both sides carry; one row each, so no key can be hot."""
    return messages.join(positions, "row_key")


def ground_truth(located: DataFrame) -> DataFrame:
    return located.groupBy("messid").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))


def stations(*tables: DataFrame) -> DataFrame:
    """Every station heard in any of the tables, once, in order."""
    return reduce(DataFrame.union, (t.select("bsid") for t in tables)).distinct().orderBy("bsid")


def station_list(*tables: DataFrame, limit: int = 2_000) -> list:
    """Station ids for a pivot. The wide form is for networks up to ``limit`` stations;
    larger ones use :func:`sparse_features`."""
    ids = [row[0] for row in stations(*tables).limit(limit + 1).collect()]
    if len(ids) > limit:
        raise ValueError(f"more than {limit} stations: use sparse_features")
    return ids


def incidence(messages: DataFrame, ids: list) -> DataFrame:
    """message x station: 1 where the station heard the message, else 0."""
    wide = messages.groupBy("messid").pivot("bsid", ids).agg(F.first(F.lit(1)))
    return wide.na.fill(0).toDF("messid", *(f"heard_{i}" for i in ids))


def last_per_station(located: DataFrame, attributes) -> DataFrame:
    """One row per (message, station): the last by row key, chosen map-side first.

    The distance is taken before that, because an operator that leaves the JVM forgets how
    its input was partitioned and would cost the pivot another shuffle.
    """
    if "distance" in attributes:
        km = distance_km(*(F.col(c) for c in ("lat", "lng", "bs_lat", "bs_lng")))
        located = located.withColumn("distance", km)
    return located.groupBy("messid", "bsid").agg(
        *(F.max_by(a, "row_key").cast("double").alias(a) for a in attributes)
    )


def feature_matrix(located: DataFrame, ids: list, attributes=MODEL_ATTRIBUTES) -> DataFrame:
    """Wide matrix, one column per (attribute, station), 0 where a station did not hear."""
    pivoted = (
        last_per_station(located, attributes)
        .groupBy("messid")
        .pivot("bsid", ids)
        .agg(*(F.first(a).alias(a) for a in attributes))
    )
    # a single attribute leaves the pivot column named by the station alone
    made = {(i, a): f"{i}_{a}" if len(attributes) > 1 else str(i) for i in ids for a in attributes}
    columns = [
        F.coalesce(F.col(f"`{made[i, a]}`"), F.lit(0.0)).alias(f"{a}_{i}") for a in attributes for i in ids
    ]
    return pivoted.select("messid", *columns)


def numbered_stations(*tables: DataFrame) -> DataFrame:
    """(bsid, slot): every station heard in any of the tables with its number, in order. Numbered by
    ranges, so that a station table of any size is never in one task."""
    heard = reduce(DataFrame.union, (t.select("bsid") for t in tables)).distinct()
    return ranks.numbered_rows(heard.select(F.lit(0).alias("net"), "bsid"), "net", "bsid", name="slot").select("bsid", "slot")


def incidence_cells(messages: DataFrame, numbered: DataFrame) -> DataFrame:
    """(messid, slot) of every station that heard a message: the ones of :func:`incidence`, for
    networks of any size."""
    return messages.select("messid", "bsid").distinct().join(numbered, "bsid").select("messid", "slot")


def matrix_cells(located: DataFrame, numbered: DataFrame, attributes=MODEL_ATTRIBUTES) -> DataFrame:
    """The matrix of :func:`feature_matrix` as (messid, slot, value), for networks of any size. The
    attributes of station number n have the slots from n times their number on; no row stands for a zero."""
    rows = last_per_station(located, attributes).join(numbered, "bsid")
    cells = rows.select("messid", F.col("slot").alias("station"), F.posexplode(F.array(*attributes)).alias("pos", "value"))
    slot = (F.col("station") * len(attributes) + F.col("pos")).cast("long")
    return cells.filter("value <> 0").select("messid", slot.alias("slot"), "value")


def sparse_features(located: DataFrame, heard: DataFrame, attributes=MODEL_ATTRIBUTES) -> DataFrame:
    """The same matrix as one sparse vector per message, for any number of stations.

    ``heard`` is the result of :func:`stations`. Stations are numbered by a join instead of
    being listed in the plan; a message's group holds at most one row per station. The
    vectors are written in the stored form of the vector type and read back as vectors, so
    no row leaves the JVM.
    """
    width = len(attributes)
    numbered = numbered_stations(heard).select("bsid", F.col("slot").cast("int"))
    entry = F.struct("slot", F.array(*attributes).alias("cells"))
    rows = last_per_station(located, attributes).join(numbered, "bsid")
    entries = rows.groupBy("messid").agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    places = F.transform("entries", lambda e: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda n: e["slot"] * width + n))
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(heard.count() * width).alias("size"),
        F.flatten(places).alias("indices"),
        F.flatten(F.transform("entries", lambda e: e["cells"])).alias("values"),
    )
    vectors = T.StructType([located.schema["messid"], T.StructField("features", VectorUDT())])
    return staged(entries.select("messid", stored.alias("features")), "sparse", schema=vectors)


def assembled(matrix: DataFrame, names: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=names, outputCol="features").transform(matrix)


def fit_positions(train: DataFrame, ridge: float = 0.0, solver: str = "normal"):
    """Least squares for latitude and longitude on the ``features`` column.

    ``normal`` solves the normal equations in one pass, for at most 4096 features of full rank.
    Station matrices have five features per station and are rank-deficient (a station's
    coordinates are multiples of its being heard): give ``l-bfgs``, which takes any number of
    features, and a tiny ``ridge``, without which there is no unique solution.
    """
    return {
        target: LinearRegression(
            featuresCol="features", labelCol=target, predictionCol=f"pred_{target}", solver=solver, regParam=ridge,
            maxIter=500, tol=1e-9,
        ).fit(train)
        for target in ("lat", "lng")
    }


def predict_positions(models, rows: DataFrame) -> DataFrame:
    """Both predictions next to the message id; the key travels with the row."""
    return models["lng"].transform(models["lat"].transform(rows))


def out_of_fold(rows: DataFrame, folds: int, ridge: float = 0.0) -> DataFrame:
    """Predict every fold by a model fitted on the others. ``rows`` is staged by fold, so
    each scan reads only the folds it needs."""
    parts = []
    for fold in range(folds):
        models = fit_positions(rows.filter(F.col("fold") != fold), ridge)
        parts.append(predict_positions(models, rows.filter(F.col("fold") == fold)))
    return reduce(DataFrame.unionByName, parts)


def matrix_predictions(cells: DataFrame, rows: DataFrame, folds: list) -> DataFrame:
    """Positions of the messages in the given folds by least-norm models of the whole station matrix, each
    fitted on the rows outside its fold. ``cells`` as of :func:`matrix_cells`; ``rows``: messid, fold, lat, lng."""
    named = cells.withColumnRenamed("messid", "key"), rows.withColumnRenamed("messid", "key")
    model = leastnorm.fit(*named, ["lat", "lng"], folds)
    held = named[1].filter(F.col("fold").isin(folds))
    return leastnorm.predict(model, named[0], held).withColumnRenamed("key", "messid")


def distance_errors(rows: DataFrame, *keep: str) -> DataFrame:
    """Error in metres between (lat, lng) and (pred_lat, pred_lng)."""
    metres = distance_km(*(F.col(c) for c in ("lat", "lng", "pred_lat", "pred_lng"))) * 1000.0
    return rows.select(*keep, metres.alias("error_m"))


def rmse(rows: DataFrame) -> dict[str, float]:
    return {
        target: RegressionEvaluator(labelCol=target, predictionCol=f"pred_{target}", metricName="rmse").evaluate(rows)
        for target in ("lat", "lng")
    }


def occurring_distances(pairs: DataFrame, places: DataFrame, key: str) -> DataFrame:
    """Distance of every ordered pair of places that occurs in ``pairs`` (origin, target),
    pairs of a place with itself included.

    The pairs are made distinct before the places are joined, so the work follows the data
    rather than the square of the place list.
    """
    distinct = pairs.groupBy("origin", "target").agg(F.count("*").alias("n"))
    here = places.select(F.col(key).alias("origin"), F.col("lat").alias("lat1"), F.col("lng").alias("lng1"))
    there = places.select(F.col(key).alias("target"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    joined = distinct.join(here, "origin").join(there, "target")
    km = distance_km(*(F.col(c) for c in ("lat1", "lng1", "lat2", "lng2")))
    return joined.select("origin", "target", "n", F.round(km, 4).alias("km"))


#: Kilometres of the shortest degree of latitude, and a margin for the ellipsoid against the sphere.
DEGREE_KM, MARGIN = 110.5, 1.01


#: No curve on the ellipsoid is shorter than the same one on a sphere of this radius (b * b / a), in km.
LEAST_CURVATURE_KM = 6335.439
#: Places of a cell that meet in one key of the join, and pairs that a task of the join looks at.
CELL_PLACES, TASK_PAIRS = 2_000, 5_000_000


def blocks_of_cells(near: DataFrame, home: DataFrame) -> tuple[DataFrame, int]:
    """(band, cell, near_blocks, home_blocks): into how many blocks of ``CELL_PLACES`` the places of a cell are cut on
    either side, for cells that both sides have; and how many tasks all their pairs are worth."""
    cells = ["band", "cell"]
    counted = near.groupBy(*cells).agg(F.count("*").alias("n_near")).join(
        home.groupBy(*cells).agg(F.count("*").alias("n_home")), cells
    )
    counted = staged(counted, "cells")
    pairs = counted.agg(F.sum(F.col("n_near").cast("double") * F.col("n_home"))).first()[0] or 0.0
    blocks = (F.ceil(F.col(name) / CELL_PLACES).cast("int").alias(to) for name, to in (("n_near", "near_blocks"), ("n_home", "home_blocks")))
    return counted.select(*cells, *blocks), math.ceil(pairs / TASK_PAIRS)


def pairs_nearby(places: DataFrame, key: str, km: float) -> DataFrame:
    """(one, other, lat1, lng1, lat2, lng2): every two places that may be at most ``km`` apart, by a bound on their
    distance, one < other. See :func:`within_radius`."""
    height = km * MARGIN / DEGREE_KM
    if not 0 < height < 90:
        raise ValueError("a radius between nothing and a quarter of a meridian")
    known = places.select(F.col(key).alias("id"), F.col("lat").cast("double"), F.col("lng").cast("double"))
    known = known.filter("id IS NOT NULL AND lat BETWEEN -90 AND 90 AND lng IS NOT NULL")
    known = known.withColumn("east", F.pmod(F.col("lng") + 180.0, F.lit(360.0)))
    band = F.floor((F.col("lat") + 90.0) / height).cast("int")

    def cells(of: Column) -> Column:
        """Number of cells of a band, by its edge nearest to a pole."""
        edge = F.least(F.greatest(F.abs(of * height - 90.0), F.abs((of + 1) * height - 90.0)), F.lit(90.0))
        return F.greatest(F.floor(F.cos(F.radians(edge)) * 360.0 / height), F.lit(1)).cast("int")

    def cell(east: Column, number: Column) -> Column:
        return F.pmod(F.floor(east * number / 360.0), number).cast("int")

    home = known.withColumn("band", band).withColumn("cell", cell(F.col("east"), cells(F.col("band"))))
    # half the width of the circle in degrees of longitude; all round if it holds a pole
    reach = F.lit(math.sin(math.radians(height))) / F.cos(F.radians("lat"))
    holds_pole = F.abs("lat") + height >= 90.0
    half = F.when(holds_pole | (reach >= 1.0), 180.0).otherwise(F.degrees(F.asin(reach)) * MARGIN)
    near = known.withColumn("half", half).withColumn("band", F.explode(F.array(band - 1, band, band + 1)))
    number = cells(F.col("band"))
    first, last = (F.floor((F.col("east") + sign * F.col("half")) * number / 360.0).cast("int") for sign in (-1, 1))
    touched = F.when(last - first + 1 >= number, F.sequence(F.lit(0), number - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda c: F.pmod(c, number))
    )
    near = near.withColumn("cell", F.explode(F.array_distinct(touched)))

    # blocks of a side meet all blocks of the other one, so no key holds more than a block of each
    blocks, tasks = blocks_of_cells(near.select("band", "cell"), home.select("band", "cell"))
    dealt = lambda name: F.pmod(F.xxhash64("id"), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    north, east = F.radians("lat"), F.radians("lng")
    at = {"x": F.cos(north) * F.cos(east), "y": F.cos(north) * F.sin(east), "z": F.sin(north)}
    place = ["id", "lat", "lng", *at]
    meet = ["band", "cell", "near_block", "home_block"]
    near = near.join(blocks, ["band", "cell"]).withColumn("near_block", dealt("near_blocks")).withColumn("home_block", every("home_blocks"))
    home = home.join(blocks, ["band", "cell"]).withColumn("home_block", dealt("home_blocks")).withColumn("near_block", every("near_blocks"))
    # the keys are few and heavy: as many tasks as their pairs are worth, which adaptive execution does not merge
    tasks = max(tasks, places.sparkSession.sparkContext.defaultParallelism)
    one, other = (
        side.withColumns(at).select(*meet, *(F.col(c).alias(f"{c}{n}") for c in place)).repartition(tasks, *meet)
        for n, side in ((1, near), (2, home))
    )
    chord = sum(((F.col(f"{c}1") - F.col(f"{c}2")) * (F.col(f"{c}1") - F.col(f"{c}2")) for c in at), F.lit(0.0))
    longest = (2.0 * math.sin(km / LEAST_CURVATURE_KM / 2.0)) ** 2 * (1.0 + 1e-9) + 1e-18
    met = one.join(other.hint("merge"), meet).filter((F.col("id1") < F.col("id2")) & (chord <= longest))
    return met.select(F.col("id1").alias("one"), F.col("id2").alias("other"), "lat1", "lng1", "lat2", "lng2")


def within_radius(places: DataFrame, key: str, km: float) -> DataFrame:
    """(one, other, km) of every two places (key, lat, lng) at most ``km`` apart, one < other.

    The globe is cut into bands of latitude as high as the radius and these into cells at least as wide, fewer
    towards the poles and a single one round them. A place meets the places of the cells that its circle touches, also
    across the date line; those whose chord may be short enough have their distance taken, which decides. Places
    without key or position have no neighbours, places of one key are none to each other.
    """
    near = pairs_nearby(places, key, km)
    return near.withColumn("km", distance_km(*(F.col(c) for c in ("lat1", "lng1", "lat2", "lng2")))).filter(
        F.col("km") <= km
    ).select("one", "other", "km")
