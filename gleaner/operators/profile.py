"""Profiles of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# name of each statistic and the aggregate behind it
STATISTICS = {
    "n": lambda c: F.count(c).cast("double"),
    "mean": lambda c: F.avg(c),
    "stddev": lambda c: F.stddev_samp(c),
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top_keys(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` most frequent keys, ties in key order."""
    return count_by(df, *keys).orderBy(F.desc("n"), *keys).limit(n)


def describe(df: DataFrame, names: list[str], digits: int = 4) -> DataFrame:
    """One row per column, one column per statistic, from one pass over the table."""
    wide = df.agg(*(make(F.col(name)).alias(f"{name}_{stat}") for name in names for stat, make in STATISTICS.items()))
    rows = F.array(
        *(
            F.struct(F.lit(name).alias("column_name"), *(F.round(f"{name}_{s}", digits).alias(s) for s in STATISTICS))
            for name in names
        )
    )
    return wide.select(F.inline(rows)).withColumn("n", F.col("n").cast("long"))


def describe_long(df: DataFrame, names: list[str], digits: int = 4) -> DataFrame:
    """(column, statistic, value) rows."""
    return describe(df, names, digits).withColumn("n", F.col("n").cast("double")).unpivot(
        "column_name", list(STATISTICS), "statistic", "value"
    )


def preview_long(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first rows by key, turned: one (key, column, value) row per cell, values as text."""
    head = df.orderBy(key).limit(n)
    others = [name for name in df.columns if name != key]
    texts = head.select(key, *(F.col(name).cast("string").alias(name) for name in others))
    return texts.unpivot(key, others, "column_name", "value")


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


# -- mergeable sketches: stored per part, united later, within a stated error -----------------

#: log2 of the buckets of a distinct count, and the relative error that three deviations stay within.
HLL_BITS = 14
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
#: Size of a quantile sketch, and twice the error in rank that it stays within 99 times in a hundred.
KLL_SIZE = 400
KLL_ERROR = 0.0133


def distinct_sketches(df: DataFrame, column: str, *parts: str) -> DataFrame:
    """A few kilobytes per part, however many rows it has; nulls are no values."""
    return df.groupBy(*parts).agg(F.hll_sketch_agg(F.col(column), HLL_BITS).alias("sketch"))


def united_distinct(sketches: DataFrame, *keys: str) -> DataFrame:
    """Distinct values of the parts together: (keys, estimate)."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def quantile_sketches(df: DataFrame, column: str, *parts: str) -> DataFrame:
    """The same for the order of a numeric column."""
    value = F.col(column).cast("double")
    return df.groupBy(*parts).agg(F.kll_sketch_agg_double(value, KLL_SIZE).alias("sketch"))


def united_quantile(sketches: DataFrame, share: float, *keys: str) -> DataFrame:
    """The value below which ``share`` of the parts' rows lie: (keys, estimate, n)."""
    united = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return united.select(
        *keys, F.kll_sketch_get_quantile_double("sketch", F.lit(share)).alias("estimate"), F.kll_sketch_get_n_double("sketch").alias("n")
    )
