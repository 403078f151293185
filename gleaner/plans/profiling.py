"""Counts, statistics, sorts and windows over plain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.operators import prepare, profile, ranks, words
from gleaner.plans.cleaning import FEES, typed_fees
from gleaner.plans.registry import query
from gleaner.sources import files

STATISTICS = ("n", "mean", "stddev", "min", "max")


def describe_sql(table: str, names: list[str]) -> str:
    one = (
        "SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, "
        "round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max FROM {table}"
    )
    return " UNION ALL ".join(one.format(c=c, table=table) for c in names)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 20")
def top_keys(t):
    return profile.top_keys(t["orders"], 20, "o_custkey")


@query("SELECT country, count(*) AS n FROM campaigns GROUP BY country", views=("campaigns",))
def count_by_key(t):
    return profile.count_by(t["campaigns"], "country")


@query("SELECT country, currency, count(*) AS n FROM campaigns GROUP BY country, currency", views=("campaigns",))
def count_by_two_keys(t):
    return profile.count_by(t["campaigns"], "country", "currency")


@query("SELECT DISTINCT deadline FROM campaigns", views=("campaigns",))
def distinct_values(t):
    return t["campaigns"].select("deadline").distinct()


@query("SELECT count(DISTINCT messid) AS n_messages, count(DISTINCT bsid) AS n_stations FROM messages", views=("messages",))
def count_distinct(t):
    return t["messages"].agg(
        F.count_distinct("messid").alias("n_messages"), F.count_distinct("bsid").alias("n_stations")
    )


LINEITEM_NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(describe_sql("lineitem", LINEITEM_NUMBERS))
def describe_numeric(t):
    return profile.describe(t["lineitem"], LINEITEM_NUMBERS)


@query(
    " UNION ALL ".join(
        f"SELECT column_name, '{s}' AS statistic, CAST({s} AS DOUBLE) AS value FROM ({describe_sql('events', ['value'])})"
        for s in STATISTICS
    )
)
def describe_long(t):
    return profile.describe_long(t["events"], ["value"])


PREVIEWED = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query(
    " UNION ALL ".join(
        f"SELECT p_partkey, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value "
        "FROM (SELECT * FROM part ORDER BY p_partkey LIMIT 5)"
        for c in PREVIEWED
    )
)
def preview_long(t):
    return profile.preview_long(t["part"].select("p_partkey", *PREVIEWED), "p_partkey")


@query("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def shape(t):
    return profile.shape(t["lineitem"])


@query(
    f"""SELECT num_dep, CAST(sum(headcount) AS BIGINT) AS headcount, sum(plain_fees) AS plain_fees,
               sum(extra_fees) AS extra_fees FROM ({FEES}) GROUP BY num_dep""",
    views=("fees",),
)
def sum_by_key(t):
    fees = typed_fees(t)
    return fees.groupBy("num_dep").agg(*(F.sum(c).alias(c) for c in prepare.numeric_columns(fees)))


@query("SELECT login, round_even(avg(stargazers_count), 1) AS score FROM repositories GROUP BY login", views=("repositories",))
def avg_rounded(t):
    return t["repositories"].groupBy("login").agg(F.bround(F.avg("stargazers_count"), 1).alias("score"))


@query(
    """WITH ranked AS (SELECT user_id, event_type = 'error' AS hit,
                              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events)
       SELECT user_id, bool_or(hit) AND count(*) >= 4 AS flag FROM ranked WHERE r <= 4 GROUP BY user_id"""
)
def early_signal(t):
    return words.early_signal(t["events"], "user_id", ["ts", "event_id"], F.col("event_type") == "error")


@query(
    """SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg FROM events"""
)
def moving_average(t):
    averaged = ranks.moving_average(t["events"], "user_id", ["ts", "event_id"], "value", rows=7)
    return averaged.select("user_id", "event_id", F.round("moving_avg", 6).alias("moving_avg"))


@query("SELECT vec_id, round(CAST(embedding[len(embedding)] AS DOUBLE), 6) AS last_value FROM embeddings ORDER BY 2, 1")
def sort_by_last_element(t):
    last = F.element_at("embedding", -1)
    return t["embeddings"].orderBy(last, "vec_id").select("vec_id", F.round(last.cast("double"), 6).alias("last_value"))


@query(
    """SELECT p_name, p_partkey FROM part ORDER BY CASE WHEN starts_with(p_name, 'small') THEN 0 ELSE 1 END,
              p_name, p_partkey LIMIT 100"""
)
def priority_sort_topk(t):
    return words.priority_sorted(t["part"].select("p_name", "p_partkey"), "p_name", "small", "p_partkey").limit(100)


# -- sketches per day, stored and united: the error is checked against the exact answer --------


@query("SELECT event_type, count(DISTINCT user_id) AS n_users, true AS within FROM events GROUP BY event_type")
def distinct_by_sketch(t):
    """Distinct users from daily sketches, next to the exact number and whether the estimate keeps its bound."""
    events = t["events"].withColumn("day", F.to_date("ts"))
    daily = files.staged(profile.distinct_sketches(events, "user_id", "event_type", "day"), "sketches")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    both = profile.united_distinct(daily, "event_type").join(exact, "event_type")
    # the bound of small counts is one value
    off = F.abs(F.col("estimate") - F.col("n_users"))
    return both.select("event_type", "n_users", (off <= F.greatest(F.lit(1.0), F.col("n_users") * profile.HLL_ERROR)).alias("within"))


@query("SELECT event_type, count(value) AS n, true AS within FROM events GROUP BY event_type")
def percentile_by_sketch(t):
    """The 80th percentile from daily sketches, and whether its true rank keeps the bound."""
    events = t["events"].select("event_type", "value", F.to_date("ts").alias("day"))
    daily = files.staged(profile.quantile_sketches(events, "value", "event_type", "day"), "sketches")
    found = profile.united_quantile(daily, 0.8, "event_type")
    ranked = events.filter("value IS NOT NULL").join(found, "event_type").groupBy("event_type").agg(
        F.max("n").alias("n"), F.avg((F.col("value") < F.col("estimate")).cast("double")).alias("below"),
        F.avg((F.col("value") <= F.col("estimate")).cast("double")).alias("upto"),
    )
    low, high = 0.8 - profile.KLL_ERROR, 0.8 + profile.KLL_ERROR
    return ranked.select("event_type", "n", ((F.col("below") <= high) & (F.col("upto") >= low)).alias("within"))
