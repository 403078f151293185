"""Counts over the words and characters of a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exploded(df: DataFrame, tokens: Column, name: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(tokens).alias(name))


def count_words(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Occurrences per token. Counted in each map task first, so a word that makes up a
    third of all tokens still leaves one row per task."""
    return exploded(df, tokens, name).groupBy(name).agg(F.count("*").alias("n"))


def regroup_lower(counts: DataFrame) -> DataFrame:
    """Add up counts of words that differ in case only."""
    return counts.groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n"))


def count_characters(df: DataFrame, text: str, *keys: str) -> DataFrame:
    letters = exploded(df, F.split(F.col(text), ""), "ch", *keys).filter("ch <> ''")
    return letters.groupBy(*keys, "ch").agg(F.count("*").alias("n"))


def token_maps(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """One map token -> count per key that has tokens; no larger than the texts of the key.

    Tokens are counted by (key, token) where the rows are, so what moves is the counts; rows that are
    already distributed by their key, as :meth:`Tables.spread` leaves them, do not move at all.
    """
    counted = exploded(df, tokens, "token", key).groupBy(key, "token").agg(F.count("*").alias("n"))
    entries = F.collect_list(F.struct("token", "n"))
    return counted.groupBy(key).agg(F.map_from_entries(entries).alias("counts"))


def blocking_groups(df: DataFrame, key: Column) -> DataFrame:
    """Keys shared by more than one row, with their size; members are not collected."""
    return df.groupBy(key.alias("block")).agg(F.count("*").alias("n")).filter("n > 1")


def priority_sorted(df: DataFrame, name: str, prefix: str, *ties: str) -> DataFrame:
    """Values that begin with ``prefix`` first, each part in ascending order."""
    return df.orderBy(~F.col(name).startswith(prefix), name, *ties)


def early_signal(df: DataFrame, key: str, order: list[str], hit: Column, first: int = 4) -> DataFrame:
    """Per key: is there a hit among its first ``first`` rows? False for shorter keys.

    The rank filter is applied in every map task before the shuffle, so at most ``first``
    rows per key and task travel, however hot the key is.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    head = df.select(key, *order, hit.alias("hit")).withColumn("rank", rank).filter(F.col("rank") <= first)
    flag = F.bool_or("hit") & (F.count("*") >= first)
    return head.groupBy(key).agg(flag.alias("flag"))
