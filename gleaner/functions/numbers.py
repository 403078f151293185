"""Lenient number parsing and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: decimal notation without exponent
DECIMAL = r"^\s*[+-]?[0-9]+\.[0-9]*\s*$"


def lenient_int(text: Column) -> Column:
    """Integer part of a decimal text; NULL for anything else or beyond 32 bits.

    Plain integers take the first branch and never meet the pattern.
    """
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(DECIMAL), text.try_cast("double").try_cast("int")))


def shop_price(text: Column) -> Column:
    """``1299€99`` and ``1 299,99`` style amounts."""
    return F.translate(text, ",€  ", "..").try_cast("double")


def marked_down_price(text: Column) -> Column:
    """``999,99€``: decimal comma, one trailing currency sign."""
    return F.replace(text.substr(F.lit(1), F.length(text) - 1), F.lit(","), F.lit(".")).try_cast("double")


def millions(text: Column) -> Column:
    """``13,667.70`` given in millions."""
    return F.round(F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("double") * 1000000, 2)


def percentage(text: Column) -> Column:
    """``20.57%`` as 20.57, the sign kept."""
    return F.rtrim(F.trim(text), F.lit("%")).try_cast("double")
