"""Preparation of dirty tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.numbers import lenient_int

# fixed values: columns of the campaign table that arrive as text and hold integers
CAMPAIGN_INTEGERS = (
    "goal", "deadline", "state_changed_at", "created_at", "launched_at", "backers_count", "final_status",
)
# fixed values: known only after the outcome, or useless
CAMPAIGN_LEAKS = ("disable_communication", "backers_count", "state_changed_at")


def cast_integers(df: DataFrame, names=CAMPAIGN_INTEGERS) -> DataFrame:
    """Overwrite text columns by their lenient integer value."""
    return df.withColumns({name: lenient_int(F.col(name)) for name in names})


def repair_country_currency(df: DataFrame) -> DataFrame:
    """``country2``: the currency where the country is the text "False".
    ``currency2``: NULL unless it is missing or has three letters."""
    country, currency = F.col("country"), F.col("currency")
    return df.withColumns(
        {
            "country2": F.when(country == "False", currency).otherwise(country),
            "currency2": F.when(F.length(currency) == 3, currency),
        }
    ).drop("country", "currency")


def add_durations(df: DataFrame) -> DataFrame:
    """Readable dates, whole calendar days of the campaign, hours of preparation."""
    days = F.datediff(F.timestamp_seconds("deadline"), F.timestamp_seconds("launched_at"))
    hours = F.round((F.col("launched_at").cast("long") - F.col("created_at")) / F.lit(3600.0), 3)
    readable = {f"{name}2": F.from_unixtime(name) for name in ("deadline", "created_at", "launched_at")}
    return df.withColumns({**readable, "days_campaign": days, "hours_prepa": hours})


def joined_text(*names: str) -> Column:
    """Lower-cased columns joined by a space, missing ones left out."""
    return F.concat_ws(" ", *(F.lower(name) for name in names))


def fill_nulls(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


def prepare_campaigns(df: DataFrame) -> DataFrame:
    """From raw text rows to a table a classifier can read.

    Range filters come before the fill, so only the "unknown" fills can apply. One narrow
    projection over the scan: no shuffle, and it also runs on a streaming DataFrame.
    """
    typed = cast_integers(df).drop(*CAMPAIGN_LEAKS)
    kept = repair_country_currency(typed).filter(F.col("final_status").isin(0, 1))
    timed = add_durations(kept).filter((F.col("hours_prepa") >= 0) & (F.col("days_campaign") >= 0))
    lowered = timed.drop("deadline", "created_at", "launched_at").withColumns(
        {name: F.lower(name) for name in ("name", "descr", "keywords")}
    )
    ready = lowered.withColumn("text", joined_text("name", "descr", "keywords")).filter(F.col("goal") > 0)
    return fill_nulls(
        ready, {"days_campaign": -1, "hours_prepa": -1.0, "goal": -1, "country2": "unknown", "currency2": "unknown"}
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def append_pages(*pages: DataFrame) -> DataFrame:
    """Stack tables by column name; columns a page lacks are NULL."""
    return reduce(lambda top, page: top.unionByName(page, allowMissingColumns=True), pages)


def cross_section(df: DataFrame, column: str, value) -> DataFrame:
    """Rows at one level of a label column, the label dropped."""
    return df.filter(F.col(column) == value).drop(column)


def drop_label(df: DataFrame, column: str, value) -> DataFrame:
    """All rows but those with the label; rows without a label stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def key_hash_below(key: Column, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the keys: the same rows on every run and every retry."""
    bound = f"{min(int(fraction * 16**8), 16**8 - 1):08x}"
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(seed), key.cast("string"))), 1, 8)
    return digest < bound


def sample_rows(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Sample without replacement, decided per key."""
    return df.filter(key_hash_below(F.col(key), fraction, seed))


def split_rows(df: DataFrame, key: str, weight: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that cover the input; the first holds about ``weight`` of it.

    Decided by a hash of the key rather than row position, so a recomputed partition can
    never move a row from one part to the other.
    """
    first = key_hash_below(F.col(key), weight, seed)
    return df.filter(first), df.filter(~first)
