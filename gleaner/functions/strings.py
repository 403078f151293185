"""Token, key and rewriting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accented letters and the plain letters that replace them in slugs
ACCENTED = "àáâäãåçèéêëìíîïñòóôöõùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"

# fixed values: layouts of "number - name" department labels
DEPARTMENT_SPACED = r"([0-9]{2,3}) - (.*)"
DEPARTMENT_TIGHT = r"([0-9]{2,3})- (.*)"
STARTS_WITH_NUMBER = r"^[0-9]{2,3}.*"


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def department_parts(label: Column, layout: str = DEPARTMENT_SPACED) -> tuple[Column, Column]:
    """Number and name of a department label, NULL where the layout does not match."""
    return tuple(null_if_empty(F.regexp_extract(label, layout, group)) for group in (1, 2))


def space_tokens(text: Column) -> Column:
    """Split on single spaces; empty tokens stay."""
    return F.split(text, " ")


def line_tokens(line: Column) -> Column:
    """Split a line on single spaces without trailing empty tokens.

    An empty line is one empty token; a line of spaces only has none.
    """
    kept = F.rtrim(line, F.lit(" "))
    return F.when((kept == "") & (line != ""), F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def word_tokens(text: Column) -> Column:
    """Lower-cased words between any white space."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda word: word != "")


def slug(text: Column) -> Column:
    """Join key: lower case, no accents, runs of other characters become one dash."""
    plain = F.translate(F.lower(F.trim(text)), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", "-"), F.lit("-"))


def login_of(cell: Column) -> Column:
    """``login`` of ``login (Full Name)``."""
    return F.substring_index(cell, " (", 1)


def full_name_of(cell: Column) -> Column:
    """``Full Name`` of ``login (Full Name)``."""
    return null_if_empty(F.regexp_extract(cell, r"\((.+)\)", 1))


def ends_key(word: Column) -> Column:
    """First two and last two characters, empty for words shorter than two."""
    return F.when(F.length(word) < 2, F.lit("")).otherwise(F.concat(F.left(word, F.lit(2)), F.right(word, F.lit(2))))


def same_ends(word: Column) -> Column:
    """At least two characters, the first equal to the last."""
    return (F.length(word) >= 2) & (F.left(word, F.lit(1)) == F.right(word, F.lit(1)))


def rewrite_span(text: Column, opening: str, closing: str, replacement: str) -> Column:
    """Replace everything from the first ``opening`` through the first ``closing`` when the
    first ``closing`` of the text comes later; otherwise the text is unchanged."""
    start, end = F.instr(text, opening), F.instr(text, closing)
    rest = F.substr(text, end + len(closing))
    return F.when((start > 0) & (end > start), F.concat(F.substr(text, F.lit(1), start - 1), F.lit(replacement), rest)).otherwise(text)
