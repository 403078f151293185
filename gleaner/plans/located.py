"""Located messages: features, truth, models, errors."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import located, prepare, ranks
from gleaner.plans.registry import query
from gleaner.sources import files

STATIONS = range(12)  # the view numbers its stations so
# fixed values of the validation
FOLDS = 10
BINS = 50_000

LOCATED = "SELECT m.*, p.lat, p.lng FROM messages m JOIN positions p ON m.row_key = p.row_key"


def vincenty_sql(pairs: str) -> str:
    """Recursive form of the distance for the checks: ``pairs`` yields id, la1, lo1, la2, lo2;
    the result is the chain of CTEs ending in ``km(id, km)``."""
    f, a, b = "(1e0 / 298.257223563e0)", "6378.137e0", "6356.7523142e0"
    return f"""WITH RECURSIVE pairs AS ({pairs}),
    base AS (SELECT id, radians(lo2) - radians(lo1) AS l,
                    sin(atan((1 - {f}) * tan(radians(la1)))) AS s1, cos(atan((1 - {f}) * tan(radians(la1)))) AS c1,
                    sin(atan((1 - {f}) * tan(radians(la2)))) AS s2, cos(atan((1 - {f}) * tan(radians(la2)))) AS c2 FROM pairs),
    steps AS (
      SELECT id, 0 AS i, l AS lam, 1e0 AS delta, 0e0 AS ss, 0e0 AS cs, 0e0 AS sg, 0e0 AS c2a, 0e0 AS mid FROM base
      UNION ALL
      SELECT id, i + 1, lam2, abs(lam2 - lam), ss, cs, sg, c2a, mid FROM (
        SELECT *, l + (1 - cc) * {f} * sa * (sg + cc * ss * (mid + cc * cs * (2 * mid * mid - 1))) AS lam2 FROM (
          SELECT *, CASE WHEN c2a = 0 THEN 0e0 ELSE cs - 2 * s1 * s2 / c2a END AS mid,
                 {f} / 16 * c2a * (4 + {f} * (4 - 3 * c2a)) AS cc FROM (
            SELECT *, 1 - sa * sa AS c2a FROM (
              SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0e0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM (
                SELECT s.id, s.i, s.lam, b.l, b.s1, b.c1, b.s2, b.c2, b.s1 * b.s2 + b.c1 * b.c2 * cos(s.lam) AS cs,
                       sqrt(pow(b.c2 * sin(s.lam), 2) + pow(b.c1 * b.s2 - b.s1 * b.c2 * cos(s.lam), 2)) AS ss
                FROM steps s JOIN base b ON s.id = b.id WHERE s.i < 20 AND s.delta > 10e-12)))))),
    last AS (SELECT *, c2a * ({a} * {a} - {b} * {b}) / ({b} * {b}) AS u FROM steps WHERE delta <= 10e-12),
    series AS (SELECT *, 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS aa,
                      u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS bb FROM last),
    km AS (SELECT p.id, {b} * aa * (sg - bb * ss * (mid + bb / 4 * (cs * (2 * mid * mid - 1)
                  - bb / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)))) AS km
           FROM pairs p LEFT JOIN series s ON p.id = s.id)"""


def located_messages(t):
    return located.attach_positions(t["messages"], t["positions"])


@query(LOCATED, views=("messages", "positions"))
def geo_attach_positions(t):
    return located_messages(t)


@query(
    f"SELECT messid, round(avg(lat), 6) AS lat, round(avg(lng), 6) AS lng FROM ({LOCATED}) GROUP BY messid",
    views=("messages", "positions"),
)
def geo_ground_truth(t):
    truth = located.ground_truth(located_messages(t))
    return truth.select("messid", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


@query(
    "SELECT messid, "
    + ", ".join(f"max(CASE WHEN bsid = {i} THEN 1 ELSE 0 END) AS heard_{i}" for i in STATIONS)
    + " FROM messages GROUP BY messid",
    views=("messages",),
)
def geo_incidence(t):
    return located.incidence(t["messages"], located.station_list(t["messages"]))


@query(
    vincenty_sql(
        "SELECT concat(messid, ':', bsid) AS id, max_by(lat, row_key) AS la1, max_by(lng, row_key) AS lo1, "
        "max_by(bs_lat, row_key) AS la2, max_by(bs_lng, row_key) AS lo2 "
        f"FROM ({LOCATED}) GROUP BY messid, bsid"
    )
    + f""", latest AS (SELECT m.messid, m.bsid, max_by(nseq, row_key) AS nseq, max_by(rssi, row_key) AS rssi,
             max_by(time_ux, row_key) AS time_ux, max_by(lat, row_key) AS lat, max_by(lng, row_key) AS lng,
             max_by(bs_lat, row_key) AS bs_lat, max_by(bs_lng, row_key) AS bs_lng
             FROM ({LOCATED}) m GROUP BY m.messid, m.bsid),
       full_rows AS (SELECT l.*, round(k.km, 4) AS distance FROM latest l JOIN km k ON k.id = concat(l.messid, ':', l.bsid))
       SELECT messid, """
    + ", ".join(
        f"coalesce(CAST(max(CASE WHEN bsid = {i} THEN {a} END) AS DOUBLE), 0e0) AS {a}_{i}"
        for a in located.ATTRIBUTES
        for i in STATIONS
    )
    + " FROM full_rows GROUP BY messid",
    views=("messages", "positions"),
)
def geo_feature_matrix(t):
    ids = located.station_list(t["messages"])
    matrix = located.feature_matrix(located_messages(t), ids, located.ATTRIBUTES)
    return matrix.withColumns({f"distance_{i}": F.round(f"distance_{i}", 4) for i in ids})


LANES = """SELECT c_nationkey AS origin, s_nationkey AS target, count(*) AS n FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"""


@query(
    vincenty_sql(
        f"SELECT concat(origin, ':', target) AS id, a.lat AS la1, a.lng AS lo1, b.lat AS la2, b.lng AS lo2 "
        f"FROM ({LANES}) JOIN geo_nations a ON a.n_nationkey = origin JOIN geo_nations b ON b.n_nationkey = target"
    )
    + f" SELECT origin, target, n, round(km, 4) AS km FROM ({LANES}) JOIN km ON id = concat(origin, ':', target)",
    views=("geo_nations",),
)
def pairwise_distance(t):
    """Distances between the places that trade with each other."""
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    items = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey")
    lanes = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = lanes.select(F.col("c_nationkey").alias("origin"), F.col("s_nationkey").alias("target"))
    return located.occurring_distances(pairs, t["geo_nations"], "n_nationkey")


NEAR_KM = 300


@query(
    vincenty_sql(
        "SELECT concat(a.shop, ':', b.shop) AS id, a.lat AS la1, a.lng AS lo1, b.lat AS la2, b.lng AS lo2 "
        f"FROM shops a JOIN shops b ON a.shop < b.shop AND abs(a.lat - b.lat) < {NEAR_KM} / 11e1"
    )
    + f""" SELECT CAST(split_part(id, ':', 1) AS BIGINT) AS one, CAST(split_part(id, ':', 2) AS BIGINT) AS other, round(km, 4) AS km
           FROM km WHERE km <= {NEAR_KM}""",
    views=("shops",),
)
def places_within_radius(t):
    """All pairs of shops at most 300 km apart, over the poles and the date line too."""
    near = located.within_radius(t.spread("shops", "shop"), "shop", NEAR_KM)
    return near.select("one", "other", F.round("km", 4).alias("km"))


# -- errors of a plain estimate: the mean position of the stations that heard the message --

CENTROIDS = f"""SELECT messid, avg(lat) AS lat, avg(lng) AS lng, avg(bs_lat) AS pred_lat, avg(bs_lng) AS pred_lng
    FROM ({LOCATED}) GROUP BY messid"""
ERRORS = (
    vincenty_sql(f"SELECT messid AS id, lat AS la1, lng AS lo1, pred_lat AS la2, pred_lng AS lo2 FROM ({CENTROIDS})")
    + ", errors AS (SELECT id AS messid, round(km * 1e3, 1) AS error_m FROM km)"
)


def station_estimate(t):
    return located_messages(t).groupBy("messid").agg(
        F.avg("lat").alias("lat"), F.avg("lng").alias("lng"),
        F.avg("bs_lat").alias("pred_lat"), F.avg("bs_lng").alias("pred_lng"),
    )


def estimate_errors(t):
    errors = located.distance_errors(station_estimate(t), "messid")
    return errors.withColumn("error_m", F.round("error_m", 1))


@query(ERRORS + " SELECT messid, error_m FROM errors", views=("messages", "positions"))
def geo_error(t):
    return estimate_errors(t)


@query(ERRORS + " SELECT round(quantile_cont(error_m, 0.8), 4) AS p80 FROM errors", views=("messages", "positions"))
def error_p80(t):
    errors = files.staged(estimate_errors(t).select("error_m"), "errors")
    return t.spark.createDataFrame([(round(ranks.exact_percentile(errors, 0.8), 4),)], "p80 double")


HISTOGRAM = (
    ERRORS
    + f""", edges AS (SELECT min(error_m) AS low, max(error_m) AS high FROM errors),
    counts AS (SELECT least({BINS - 1}, CAST(floor((error_m - low) / (high - low) * {BINS}) AS BIGINT)) AS bin, count(*) AS n
               FROM errors, edges GROUP BY 1),
    bins AS (SELECT r.bin, low + r.bin * (high - low) / {BINS} AS bin_start, coalesce(c.n, 0) AS n
             FROM (SELECT unnest(range({BINS})) AS bin) r CROSS JOIN edges LEFT JOIN counts c ON c.bin = r.bin)"""
)


@query(HISTOGRAM + " SELECT bin, round(bin_start, 6) AS bin_start, n FROM bins", views=("messages", "positions"))
def error_histogram(t):
    errors = files.staged(estimate_errors(t).select("error_m"), "errors")
    return ranks.histogram(errors, BINS).withColumn("bin_start", F.round("bin_start", 6))


@query(
    HISTOGRAM
    + """ SELECT bin, round(bin_start / 1e3, 9) AS km, round(sum(n) OVER (ORDER BY bin ROWS UNBOUNDED PRECEDING) / (SELECT sum(n) FROM bins) * 1e2, 6)
                 AS cum_percent FROM bins""",
    views=("messages", "positions"),
)
def error_cdf(t):
    errors = files.staged(estimate_errors(t).select("error_m"), "errors")
    shares = ranks.cumulative_share(ranks.histogram(errors, BINS))
    km = F.round(F.col("bin_start") / 1000.0, 9)
    return shares.select("bin", km.alias("km"), F.round("cum_percent", 6).alias("cum_percent"))


@query(
    f"""SELECT round(sqrt(avg(pow(lat - pred_lat, 2))), 6) AS rmse_lat, round(sqrt(avg(pow(lng - pred_lng, 2))), 6) AS rmse_lng
        FROM ({CENTROIDS})""",
    views=("messages", "positions"),
)
def regression_rmse(t):
    rows = files.staged(station_estimate(t).drop("messid"), "estimates")
    found = located.rmse(rows)
    return t.spark.createDataFrame([(round(found["lat"], 6), round(found["lng"], 6))], "rmse_lat double, rmse_lng double")


# -- models -------------------------------------------------------------------------------


@query(
    f"SELECT messid, CAST(ntile({FOLDS}) OVER (ORDER BY messid) - 1 AS INTEGER) AS fold FROM (SELECT DISTINCT messid FROM messages)",
    views=("messages",),
)
def kfold_assign(t):
    keys = files.staged(t["messages"].select("messid").distinct(), "keys")
    return keys.select("messid", ranks.contiguous_folds(keys, FOLDS).alias("fold"))


# two features of full rank, so that the least-squares solution is unique
PLAIN_FEATURES = ["signal", "north"]
FEATURES = f"""SELECT messid, avg(lat) AS lat, avg(lng) AS lng, avg(rssi) AS x1, avg(bs_lat) AS x2 FROM ({LOCATED}) GROUP BY messid"""


def least_squares_sql(target: str) -> str:
    det = "(var_pop(x1) * var_pop(x2) - pow(covar_pop(x1, x2), 2))"
    b1 = f"(covar_pop(x1, {target}) * var_pop(x2) - covar_pop(x2, {target}) * covar_pop(x1, x2)) / {det}"
    b2 = f"(covar_pop(x2, {target}) * var_pop(x1) - covar_pop(x1, {target}) * covar_pop(x1, x2)) / {det}"
    return f"{b1} AS {target}1, {b2} AS {target}2, avg({target}) - avg(x1) * {b1} - avg(x2) * {b2} AS {target}0"


PREDICTED = ", ".join(f"round({y}0 + {y}1 * x1 + {y}2 * x2, 4) AS pred_{y}" for y in ("lat", "lng"))
FITS = ", ".join(least_squares_sql(y) for y in ("lat", "lng"))


def plain_features(t):
    rows = located_messages(t).groupBy("messid").agg(
        F.avg("lat").alias("lat"), F.avg("lng").alias("lng"), F.avg("rssi").alias("signal"), F.avg("bs_lat").alias("north")
    )
    return files.staged(rows, "features")


def rounded(predictions):
    return predictions.select("messid", *(F.round(f"pred_{y}", 4).alias(f"pred_{y}") for y in ("lat", "lng")))


@query(
    f"WITH rows AS ({FEATURES}), fit AS (SELECT {FITS} FROM rows) SELECT messid, {PREDICTED} FROM rows, fit",
    views=("messages", "positions"),
)
def geo_position_model(t):
    rows = located.assembled(plain_features(t), PLAIN_FEATURES)
    return rounded(located.predict_positions(located.fit_positions(rows), rows))


@query(
    f"""WITH rows AS (SELECT *, ntile({FOLDS}) OVER (ORDER BY messid) AS fold FROM ({FEATURES})),
        fit AS (SELECT f.fold, {FITS} FROM (SELECT DISTINCT fold FROM rows) f JOIN rows r ON r.fold <> f.fold GROUP BY f.fold)
        SELECT messid, {PREDICTED} FROM rows JOIN fit ON rows.fold = fit.fold""",
    views=("messages", "positions"),
)
def geo_plain_oof(t):
    """Two averaged columns instead of the matrix, so that SQL has the solution in closed form."""
    rows = plain_features(t)
    folded = rows.withColumn("fold", ranks.contiguous_folds(rows.select("messid"), FOLDS))
    # folds are key ranges: written in key order, each task touches one or two of them
    by_fold = files.staged(folded.repartitionByRange("messid"), "folds", partition_by="fold")
    return rounded(located.out_of_fold(located.assembled(by_fold, PLAIN_FEATURES), FOLDS))


@query(
    f"""WITH rows AS (SELECT *, substr(md5(concat('100:', messid)), 1, 8) < 'b3333333' AS train FROM ({FEATURES})),
        fit AS (SELECT {FITS} FROM rows WHERE train)
        SELECT messid, {PREDICTED} FROM rows, fit WHERE NOT train""",
    views=("messages", "positions"),
)
def geo_plain_submission(t):
    train, test = prepare.split_rows(located.assembled(plain_features(t), PLAIN_FEATURES), "messid", 0.7, seed=100)
    placed = rounded(located.predict_positions(located.fit_positions(train), test))
    path = files.scratch_dir(t.spark, "positions")
    files.write_csv(placed, path)
    return files.read_csv(t.spark, path, schema="messid long, pred_lat double, pred_lng double")


# -- the whole station matrix: positions that are linear in it are found exactly -----------


def matrix_cells(t):
    return files.staged(located.matrix_cells(located_messages(t), located.numbered_stations(t["messages"])), "cells")


def surveyed_folds(t):
    rows = files.staged(t["surveyed"], "surveyed")
    return rows.withColumn("fold", ranks.contiguous_folds(rows.select("messid"), FOLDS))


def held_out_positions(t):
    """Every message by the model of the other nine folds."""
    placed = located.matrix_predictions(matrix_cells(t), surveyed_folds(t), list(range(FOLDS)))
    return placed.select("messid", *(F.round(f"pred_{y}", 5).alias(f"pred_{y}") for y in ("lat", "lng")))


SURVEYED = "SELECT messid, lat AS pred_lat, lng AS pred_lng FROM surveyed"


@query(SURVEYED, views=("surveyed",))
def geo_oof_predictions(t):
    return held_out_positions(t)


@query(
    SURVEYED + " WHERE substr(md5(concat('100:', messid)), 1, 8) >= 'b3333333'",
    views=("surveyed",),
)
def geo_submission(t):
    """Fit on one part of the messages, place the others, write their positions as CSV."""
    train, test = prepare.split_rows(t["surveyed"], "messid", 0.7, seed=100)
    rows = files.staged(train.withColumn("fold", F.lit(0)).unionByName(test.withColumn("fold", F.lit(1))), "surveyed")
    placed = located.matrix_predictions(matrix_cells(t), rows, [1])
    path = files.scratch_dir(t.spark, "positions")
    files.write_csv(placed.select("messid", F.round("pred_lat", 5).alias("pred_lat"), F.round("pred_lng", 5).alias("pred_lng")), path)
    return files.read_csv(t.spark, path, schema="messid long, pred_lat double, pred_lng double")


HELD_OUT = f"""SELECT messid, p.lat AS lat, p.lng AS lng, s.lat AS pred_lat, s.lng AS pred_lng FROM surveyed s
    JOIN (SELECT messid, avg(lat) AS lat, avg(lng) AS lng FROM ({LOCATED}) GROUP BY messid) p USING (messid)"""
HELD_OUT_ERRORS = (
    vincenty_sql(f"SELECT messid AS id, lat AS la1, lng AS lo1, pred_lat AS la2, pred_lng AS lo2 FROM ({HELD_OUT})")
    + ", errors AS (SELECT id AS messid, round(km * 1e3, 1) AS error_m FROM km)"
)


def held_out_errors(t):
    """Metres between a held-out prediction and where the receivers put the message."""
    rows = held_out_positions(t).join(located.ground_truth(located_messages(t)), "messid")
    return located.distance_errors(rows, "messid").withColumn("error_m", F.round("error_m", 1))


@query(HELD_OUT_ERRORS + " SELECT messid, error_m FROM errors", views=("messages", "positions", "surveyed"))
def geo_oof_errors(t):
    return held_out_errors(t)


@query(
    HELD_OUT_ERRORS
    + f""", edges AS (SELECT min(error_m) AS low, max(error_m) AS high, quantile_cont(error_m, 0.8) AS p80 FROM errors),
    counts AS (SELECT least({BINS - 1}, CAST(floor((error_m - low) / (high - low) * {BINS}) AS BIGINT)) AS bin, count(*) AS n
               FROM errors, edges GROUP BY 1)
    SELECT bin, round(sum(n) OVER (ORDER BY bin) / (SELECT sum(n) FROM counts) * 1e2, 6) AS cum_percent, round(p80, 4) AS p80
    FROM counts, edges""",
    views=("messages", "positions", "surveyed"),
)
def geo_oof_cdf(t):
    """Share of messages up to each occurring error, next to the 80th percentile."""
    errors = files.staged(held_out_errors(t).select("error_m"), "errors")
    shares = ranks.cumulative_share(ranks.histogram(errors, BINS)).filter("n > 0")
    p80 = F.lit(round(ranks.exact_percentile(errors, 0.8), 4)).alias("p80")
    return shares.select("bin", F.round("cum_percent", 6).alias("cum_percent"), p80)


NUMBERED = "numbered AS (SELECT bsid, row_number() OVER (ORDER BY bsid) - 1 AS station FROM (SELECT DISTINCT bsid FROM messages))"


@query(
    f"WITH {NUMBERED} SELECT DISTINCT messid, station AS slot FROM messages JOIN numbered USING (bsid)", views=("messages",)
)
def geo_incidence_cells(t):
    return located.incidence_cells(t["messages"], located.numbered_stations(t["messages"]))


@query(
    f"""WITH {NUMBERED}, latest AS (
        SELECT messid, station, """
    + ", ".join(f"CAST(max_by({a}, row_key) AS DOUBLE) AS v{n}" for n, a in enumerate(located.MODEL_ATTRIBUTES))
    + f""" FROM ({LOCATED}) JOIN numbered USING (bsid) GROUP BY messid, station),
    cells AS ("""
    + " UNION ALL ".join(
        f"SELECT messid, station * {len(located.MODEL_ATTRIBUTES)} + {n} AS slot, v{n} AS value FROM latest"
        for n in range(len(located.MODEL_ATTRIBUTES))
    )
    + ") SELECT * FROM cells WHERE value <> 0",
    views=("messages", "positions"),
)
def geo_matrix_cells(t):
    """The wide matrix in long form: no column per station, so no bound on their number."""
    return located.matrix_cells(located_messages(t), located.numbered_stations(t["messages"]))


@query()
def geo_sparse_model(t):
    """The same as :func:`geo_matrix_model` for networks too large for one column per station."""
    rows = located_messages(t)
    vectors = located.sparse_features(rows, located.stations(t["messages"])).join(located.ground_truth(rows), "messid")
    table = files.staged(vectors, "vectors")
    models = located.fit_positions(table, located.TINY_RIDGE, "l-bfgs")
    return located.distance_errors(located.predict_positions(models, table), "messid")


@query()
def geo_matrix_model(t):
    """Positions from the whole matrix, without the truth among the features."""
    ids = located.station_list(t["messages"])
    rows = located_messages(t)
    matrix = located.feature_matrix(rows, ids).join(located.ground_truth(rows), "messid")
    vectors = located.assembled(files.staged(matrix, "matrix"), [c for c in matrix.columns if c not in ("messid", "lat", "lng")])
    models = located.fit_positions(vectors, located.TINY_RIDGE, "l-bfgs")
    return located.distance_errors(located.predict_positions(models, vectors), "messid")
