"""Order statistics, folds, histograms and windows against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.operators import ranks


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def third_equal(n=3_000, seed=1):
    """One value makes up a third, the rest spans many orders of magnitude."""
    rng = np.random.default_rng(seed)
    return [7.25] * (n // 3) + [float(x) for x in rng.lognormal(0, 6, n - n // 3)]


def test_order_statistics_refine(spark):
    values = third_equal()
    wanted = [0, 1, 500, 1_500, 2_999]
    found = ranks.order_statistics(column(spark, values), wanted, cells=8)
    assert found == {rank: sorted(values)[rank] for rank in wanted}


def test_order_statistics_integers(spark):
    values = list(range(0, 4_000, 4)) + [2**40] * 5 + [-(2**40)]
    found = ranks.order_statistics(column(spark, values, "long"), [0, 1, 500, 1_000, 1_005], cells=4)
    assert found == {rank: sorted(values)[rank] for rank in (0, 1, 500, 1_000, 1_005)}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=60), st.floats(0, 1))
def test_percentile_any_input(spark, values, share):
    got = ranks.exact_percentile(column(spark, values), share)
    assert got == pytest.approx(float(np.percentile(values, share * 100)), rel=1e-9, abs=1e-9)


def test_percentile(spark):
    assert ranks.exact_percentile(column(spark, [4.0, 1.0, 2.0]), 0.8) == pytest.approx(3.2)
    assert ranks.exact_percentile(column(spark, [None, 5.0]), 0.8) == 5.0
    assert ranks.exact_percentile(column(spark, [None]), 0.8) is None
    estimate = ranks.approximate_percentile(column(spark, [float(n) for n in range(1_000)]), 0.8).first()[0]
    assert abs(estimate - 799) <= 2


@pytest.mark.parametrize("count", [23, 10, 7, 40])
def test_folds(spark, count):
    keys = spark.range(count).select((F.col("id") * 3 + 5).alias("k"))
    got = [r["fold"] for r in keys.select("k", ranks.contiguous_folds(keys, 10).alias("fold")).orderBy("k").collect()]
    expected = [r[0] for r in keys.select(F.ntile(10).over(Window.orderBy("k")) - 1).collect()]
    assert got == expected


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 3.5, 9.0], [4.0, 4.0], [0.0, 1.0, 0.5, 0.25, 0.75]])
def test_histogram(spark, values):
    rows = ranks.histogram(column(spark, values), 4).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=4)
    assert [r["n"] for r in rows] == list(counts)
    assert [r["bin_start"] for r in rows] == pytest.approx(list(edges[:-1]))


def test_cumulative_share_ends_at_hundred(spark):
    shares = ranks.cumulative_share(ranks.histogram(column(spark, third_equal(300)), 50)).orderBy("bin").collect()
    assert shares[-1]["cum_percent"] == 100.0
    assert all(a["cum_percent"] <= b["cum_percent"] for a, b in zip(shares, shares[1:]))


def events(spark, n=2_000):
    """A third of the rows belong to one key, some to none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 17)
    return spark.range(n).select(key.alias("k"), (F.col("id") * 7919 % 997).alias("ts"), "id", F.rand(3).alias("v"))


def test_numbered_rows(spark):
    df = events(spark)
    number = F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")) - 1
    expected = {r["id"]: r["at"] for r in df.withColumn("at", number).collect()}
    assert {r["id"]: r["at"] for r in ranks.numbered_rows(df, "k", "ts", "id").collect()} == expected


@pytest.mark.parametrize("block", [5, 64, 100_000])
def test_moving_average(spark, block):
    df = events(spark).persist()
    frame = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(-4, 0)
    expected = {r["id"]: r["m"] for r in df.withColumn("m", F.avg("v").over(frame)).collect()}
    got = {r["id"]: r["moving_avg"] for r in ranks.moving_average(df, "k", ["ts", "id"], "v", 5, block).collect()}
    assert got == pytest.approx(expected)
    df.unpersist()


def test_moving_average_rejects_short_blocks(spark):
    with pytest.raises(ValueError):
        ranks.moving_average(events(spark), "k", ["ts", "id"], "v", rows=10, block=5)


def test_infinities_and_nan_have_ranks(spark):
    values = [3.0, float("inf"), 1.0, float("nan"), 8.0, float("-inf"), 2.0, float("inf"), 1e308, -1e308, 5e-324, 0.0]
    found = ranks.order_statistics(column(spark, values), list(range(len(values))), cells=3)
    ordered = sorted((v for v in values if v == v))
    assert [found[n] for n in range(len(ordered))] == ordered and found[11] != found[11]


def test_keys_without_value_are_in_the_first_fold(spark):
    keys = spark.createDataFrame([(float(n),) for n in range(9)] + [(None,)], "x double")
    rows = keys.select("x", ranks.contiguous_folds(keys, 10).alias("fold")).collect()
    assert {r["x"]: r["fold"] for r in rows} == {None: 0} | {float(n): n for n in range(9)}


def test_share_of_nothing(spark):
    bins = spark.createDataFrame([(0, 0), (1, 0)], "bin long, n long")
    assert [r["cum_percent"] for r in ranks.cumulative_share(bins).collect()] == [None, None]


@pytest.mark.parametrize(("keys", "nested"), [(["k"], False), ([], False), (["k"], True)])
def test_forward_fill(spark, keys, nested):
    rows = [(None if i < 20 else i // 90, i, None if i % 7 else f"a{i}", None if i % 3 else f"b{i}") for i in range(2, 300)]
    df = spark.createDataFrame(rows[::-1], "k int, o int, a string, b string")
    filled = ranks.forward_fill(df, keys, ["o"], ["a", "b"], nested)
    got = {r["o"]: (r["a"], r["b"]) for r in filled.collect()}
    last = {}
    for k, o, a, b in rows:
        above = last.setdefault(k if keys else 0, [None, None])
        if nested and a is not None:
            above[1] = None
        above[:] = [a if a is not None else above[0], b if b is not None else above[1]]
        assert got[o] == tuple(above)
    assert filled.columns == df.columns and len(got) == len(rows)
    assert ranks.forward_fill(df.limit(0), keys, ["o"], ["a"]).count() == 0
    assert "SinglePartition" not in filled._jdf.queryExecution().executedPlan().toString()
