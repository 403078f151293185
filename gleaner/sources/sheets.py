"""Sheets exported as text: stacked header rows and index cells that stand for the rows below them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators import ranks

PLACE = ["_file", "_block", "_line"]


def placed_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV without header, every column a string, with their place: file by name, then block, then
    line, which is the order of the sheet also where it is cut into several files and splits."""
    raw = spark.read.option("escape", '"').csv(path, header=False, inferSchema=False)
    meta = F.col("_metadata")
    return raw.select(
        "*", meta["file_path"].alias(PLACE[0]), meta["file_block_start"].alias(PLACE[1]),
        F.monotonically_increasing_id().alias(PLACE[2]),
    )


def joined_names(header: list[list[str | None]], sep: str = "_") -> list[str]:
    """A name per column out of stacked header rows: an empty cell of an upper row belongs to the cell on its
    left, as merged cells do; empty cells of the last row add nothing. Columns without any name are numbered, and
    a name that comes again gets its place."""
    filled = []
    for level, row in enumerate(header):
        last, out = None, []
        for cell in row:
            last = cell if cell not in (None, "") else (last if level + 1 < len(header) else None)
            out.append(last)
        filled.append(out)
    names: list[str] = []
    for at, parts in enumerate(zip(*filled, strict=True)):
        name = sep.join(p for p in parts if p) or f"column{sep}{at}"
        names.append(f"{name}{sep}{at}" if name in names else name)
    return names


def read_sheet(spark: SparkSession, path: str, header_rows: int = 2, index_columns: int = 1, sep: str = "_") -> DataFrame:
    """The data rows of a sheet under joined names, the first ``index_columns`` columns filled downwards.

    A filled cell takes the last value above it. With several index columns an inner one starts anew where an outer one
    does. Only the header rows reach the driver. An empty sheet raises, as it has no names.
    """
    rows = placed_rows(spark, path)
    cells = [c for c in rows.columns if c not in PLACE]
    header = rows.orderBy(*PLACE).limit(header_rows).collect()
    if len(header) < header_rows or not header_rows:
        raise ValueError("the sheet has no header")
    last = F.struct(*(F.lit(header[-1][c]).cast(rows.schema[c].dataType).alias(c) for c in PLACE))
    names = joined_names([[r[c] for c in cells] for r in header], sep)
    data = rows.filter(F.struct(*PLACE) > last)
    filled = ranks.forward_fill(data, [], PLACE, cells[:index_columns], nested=True)
    return filled.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(cells, names, strict=True)))
