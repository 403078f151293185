"""Exact order statistics, contiguous folds, histograms and moving averages without ever
sorting a whole table in one task."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.sources.files import staged

FINE = 1_000  # histogram cells per refinement


def _cell(value: Column, low, high, cells: int) -> Column:
    """Equal-width cell of a value inside [low, high], the last cell closed. Halves, since the
    difference of two doubles may be too large for one."""
    half = F.lit(0.5)
    width = F.lit(high) * half - F.lit(low) * half
    return F.least(F.lit(cells - 1), F.floor((value * half - F.lit(low) * half) / width * cells).cast("int"))


def order_statistics(values: DataFrame, ranks: list[int], cells: int = FINE) -> dict[int, object]:
    """Exact values at the given zero-based ranks of a one-column numeric DataFrame.

    Every pass is a histogram over the interval that still holds a wanted rank: a partial
    aggregate with at most ``cells`` rows, whatever the size or the skew of the data. The
    interval shrinks ``cells``-fold per pass until a single value is left. Nulls have no rank;
    infinities and NaN, which no interval can hold, are counted apart, NaN above all others.
    Pass a staged table, because each pass scans it again.
    """
    value = F.col(values.columns[0])
    values = values.filter(value.isNotNull())
    found: dict[int, object] = {}
    below, wanted = 0, sorted(set(ranks))
    if values.dtypes[0][1] in ("double", "float"):
        odd = {x: F.count_if(value == F.lit(x)) for x in (-math.inf, math.inf, math.nan)}
        counts = values.agg(*odd.values(), F.count("*")).first()
        below, above = counts[0], counts[3] - counts[1] - counts[2]
        for rank in wanted:
            if rank < below:
                found[rank] = -math.inf
            elif above <= rank < counts[3]:
                found[rank] = math.inf if rank < above + counts[1] else math.nan
        wanted = [rank for rank in wanted if below <= rank < above]
        values = values.filter((value > -math.inf) & (value < math.inf))
    low, high, count = values.agg(F.min(value), F.max(value), F.count(value)).first()
    todo = [(low, high, below, count, wanted)] if count else []
    while todo:
        low, high, below, count, wanted = todo.pop()
        inside = values.filter(value.between(low, high))
        if low == high:
            found.update(dict.fromkeys(wanted, low))
            continue
        narrow = isinstance(low, float) and not (high * 0.5 - low * 0.5) / cells > 0
        if narrow:  # so few representable numbers that each is its own cell
            parts = [(v, v, n) for v, n in inside.groupBy(value).agg(F.count("*")).collect()]
        else:
            cell = _cell(value, low, high, cells).alias("cell")
            parts = [row[1:] for row in inside.groupBy(cell).agg(F.min(value), F.max(value), F.count("*")).collect()]
        for low, high, count in sorted(parts):
            here = [rank for rank in wanted if below <= rank < below + count]
            if here:
                todo.append((low, high, below, count, here))
            below += count
    return found


def approximate_percentile(values: DataFrame, share: float, accuracy: int = 1000) -> DataFrame:
    """One-pass estimate; the rank error is at most ``1 / accuracy`` of the rows."""
    return values.agg(F.percentile_approx(values.columns[0], share, accuracy).alias("percentile"))


def exact_percentile(values: DataFrame, share: float) -> float | None:
    """Percentile with linear interpolation between the two neighbouring values."""
    count = values.agg(F.count(values.columns[0])).first()[0]
    if not count:
        return None
    position = share * (count - 1)
    ranks = [math.floor(position), math.ceil(position)]
    found = order_statistics(values, ranks)
    left, right = (found[rank] for rank in ranks)
    return left + (right - left) * (position - ranks[0])


def fold_starts(count: int, folds: int) -> list[int]:
    """First rank of every fold but the first; the first ``count % folds`` are one larger."""
    size, extra = divmod(count, folds)
    return [fold * size + min(fold, extra) for fold in range(1, folds)]


def contiguous_folds(keys: DataFrame, folds: int) -> Column:
    """Fold number 0 … folds-1 of a row by its key's place in key order.

    ``keys`` holds each key once. Only the ``folds - 1`` cut keys are looked up; the fold is
    then a plain expression on the key, so the rows themselves are not sorted or shuffled. Rows
    without key are in fold 0 and do not count for the sizes.
    """
    name = keys.columns[0]
    count = keys.filter(F.col(name).isNotNull()).count()
    starts = [start for start in fold_starts(count, folds) if start < count]
    cuts = order_statistics(keys, starts)
    return sum((F.when(F.col(name) >= cuts[start], 1).otherwise(0) for start in starts), F.lit(0))


def histogram(values: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last bin closed, empty
    bins included. One value only: the range is widened by one half on both sides."""
    name = values.columns[0]
    value = F.col(name)
    ends = values.agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    half = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    edges = ends.select(F.struct((F.col("low") - half).alias("low"), (F.col("high") + half).alias("high"))).scalar()
    low, high = edges["low"], edges["high"]
    cell = F.least(F.lit(bins - 1).cast("long"), F.floor((value - low) / (high - low) * bins))
    counts = values.filter(value.isNotNull()).groupBy(cell.alias("bin")).agg(F.count("*").alias("n"))
    every = values.sparkSession.range(bins).withColumnRenamed("id", "bin")
    start = low + F.col("bin") * (high - low) / bins
    return every.join(counts, "bin", "left").select("bin", start.alias("bin_start"), F.coalesce("n", F.lit(0)).alias("n"))


def cumulative_share(bins: DataFrame) -> DataFrame:
    """Cumulated per cent per bin. The windows run over the bins, never over the rows."""
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.sum("n").over(Window.partitionBy())
    return bins.withColumn("cum_percent", F.try_divide(F.sum("n").over(upto), total) * 100.0)


def numbered_rows(df: DataFrame, key: str, *order: str, name: str = "at") -> DataFrame:
    """Zero-based row number within each key, for keys of any size.

    Rows are range-partitioned by key and order, so a hot key fills many equal partitions,
    and written once; the number is the place inside the partition plus what the key's
    earlier partitions hold, which is a window over one row per key and partition.
    ``order`` must make the rows of a key distinct.
    """
    ranged = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    placed = staged(
        ranged.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "numbered"
    )
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(key, "part")
        .agg(F.min("place").alias("first"), F.count("*").alias("size"))
        .select(
            F.col(key).alias("of"),
            F.col("part").alias("in_part"),
            (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        )
    )
    same = F.col(key).eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part"))
    return placed.join(offsets, same).select(*df.columns, (F.col("place") + F.col("shift")).alias(name))


def forward_fill(df: DataFrame, keys: list[str], order: list[str], columns: list[str], nested: bool = False) -> DataFrame:
    """``df`` with the nulls of ``columns`` replaced by the last value above them, in ``order`` within ``keys``.

    Keys of any size, or none: rows are range-partitioned by key and order and written once; each partition's
    last values are carried on to the partitions after it, by a window over one row per key and partition.
    Inside a partition the fill is a window of its own. With ``nested`` a column starts anew where one before it has a
    value. Nulls above the first value stay. ``order`` must make the rows of a key distinct.
    """
    sheet, part, at = "_sheet", "_part", "_at"
    ranged = df.withColumn(sheet, F.struct(F.lit(0), *keys)).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = ranged.withColumns({part: F.spark_partition_id(), at: F.monotonically_increasing_id()})
    marks = {}
    for n, c in enumerate(columns):
        given = [F.col(x).isNotNull() for x in (columns[: n + 1] if nested else [c])]
        # the place comes first, so the greatest mark is the last one
        marks[f"_mark{n}"] = F.when(reduce(Column.__or__, given), F.struct(F.col(at).alias("at"), F.col(c).alias("value")))
    placed = staged(placed.withColumns(marks), "filled")
    earlier = Window.partitionBy(sheet).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy(sheet, part).agg(*(F.max(m).alias(m) for m in marks))
    carried = ends.select(
        F.col(sheet).alias("_of"), F.col(part).alias("_in"), *(F.max(m).over(earlier).alias(f"{m}_before") for m in marks)
    )
    above = Window.partitionBy(sheet, part).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = placed.withColumns({m: F.max(m).over(above) for m in marks})
    joined = inside.join(carried, (F.col(sheet) == F.col("_of")) & (F.col(part) == F.col("_in")))
    filled = {c: F.coalesce(m, f"{m}_before")["value"] for c, m in zip(columns, marks, strict=True)}
    return joined.select(*(filled[c].alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns))


def moving_average(
    df: DataFrame, key: str, order: list[str], value: str, rows: int, block: int = 100_000
) -> DataFrame:
    """Mean of a value over the current and the previous ``rows - 1`` rows of its key.

    A key may hold any part of the table: its numbered rows are cut into blocks of ``block``
    consecutive rows, the last ``rows - 1`` rows of each block are also given to the next
    one, and every block is a task-sized window.
    """
    if rows > block:
        raise ValueError("rows must not exceed block")
    at = F.col("at")
    numbered = numbered_rows(df.select(key, *order, value), key, *order)
    own = F.floor(at / block)
    carried = at % block > block - rows
    placed = numbered.withColumn("block", F.explode(F.when(carried, F.array(own, own + 1)).otherwise(F.array(own))))
    frame = Window.partitionBy(key, "block").orderBy("at").rowsBetween(1 - rows, 0)
    mean = placed.withColumn("moving_avg", F.avg(value).over(frame))
    return mean.filter(own == F.col("block")).select(key, *order, "moving_avg")
