"""Chat formatting: turns rendered by a template that a deterministic parser can read back.

    ### User:
    text
    </turn>

Only built-in functions. A control string inside a text would be taken for the template's own, so
every turn is rendered, parsed and compared with its source; where they differ, its control strings
are escaped by a backslash, until what is read is what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END = "</turn>"
#: What may stand between "### " and ":", and the strings that the template reserves.
NAME = "[A-Z][a-z]*|Role-[0-9A-F]*"
CONTROL = rf"### (?:{NAME}):|{END}"


def named(role: Column) -> Column:
    """The role as the template writes it: ``User`` for user; any role that is not a run of a-z by its
    bytes in hexadecimal, so that none can upset the header."""
    plain = F.concat(F.upper(F.substring(role, 1, 1)), F.substring(role, F.lit(2), F.length(role)))
    return F.when(role.rlike(r"\A[a-z]+\z"), plain).otherwise(F.concat(F.lit("Role-"), F.hex(role)))


def role_of(name: Column) -> Column:
    spelled = F.unhex(F.substring(name, F.lit(6), F.length(name))).cast("string")
    return F.when(F.startswith(name, F.lit("Role-")), spelled).otherwise(F.lower(name))


def escaped(text: Column) -> Column:
    """The text with a backslash before each control string."""
    return F.regexp_replace(text, f"({CONTROL})", r"\\$1")


def unescaped(body: Column) -> Column:
    return F.regexp_replace(body, rf"\\({CONTROL})", "$1")


def header(role: Column) -> Column:
    return F.concat(F.lit("### "), named(role), F.lit(":\n"))


def rendered(role: Column, body: Column) -> Column:
    # the line feed keeps a backslash at the end of a body away from the mark
    return F.concat(header(role), body, F.lit(f"\n{END}\n"))


def parsed(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation; null if it is not one.

    A control string without a backslash before it is the template's. The text is cut at its end
    marks; each part must be a header and a body in which no other such string stands.
    """
    turn = rf"(?s)\A### ({NAME}):\n(.*)\n\z"
    parts = F.split(formatted, rf"(?<!\\){END}\n")
    read = F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            p.rlike(turn).alias("good"), F.regexp_extract(p, turn, 1).alias("name"), F.regexp_extract(p, turn, 2).alias("body")
        ),
    )
    good = F.forall(read, lambda t: t["good"] & ~t["body"].rlike(rf"(?<!\\)(?:{CONTROL})"))
    turns = F.transform(
        read, lambda t: F.struct(role_of(t["name"]).alias("role"), unescaped(t["body"]).alias("text"))
    )
    return F.when(good & (F.element_at(parts, -1) == ""), turns)


def reads_back(role: Column, text: Column, body: Column) -> Column:
    """Whether the turn, rendered with ``body``, is parsed as (role, text) and nothing else."""
    turns = parsed(rendered(role, body))
    only = F.get(turns, 0)
    return F.coalesce((F.size(turns) == 1) & (only["role"] == role) & (only["text"] == text), F.lit(False))


def bodies(role: Column, text: Column) -> Column:
    """The text as the template may hold it: itself, or escaped where it would not be read back."""
    sound = lambda body: reads_back(role, text, body)
    guarded = escaped(text)
    unread = F.raise_error(F.lit("a turn is not read back as it was written"))
    return F.when(sound(text), text).when(sound(guarded), guarded).otherwise(unread.cast("string"))


def formatted(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    learnt: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """conv_id, formatted and loss of every conversation, of a table with a row per turn.

    loss: the (start, length) spans, in bytes of the formatted text's UTF-8, of the bodies of turns whose role is
    in ``learnt``; in order, without headers and marks. Turns are ordered by number, nulls
    first, then by role and text; repeated rows are turns of their own. Null roles and texts are empty,
    and null ids make one conversation. An empty table gives an empty one; only the four named columns are read.

    Turns are rendered and read back where they lie. A conversation is one text, so its turns meet in
    one task, as the rows of no other grouping here do; they are put in order by a window that spills.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    df = turns.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text")
    )
    df = df.withColumn("body", bodies(F.col("role"), F.col("text"))).select(
        "conv_id", "turn", "role", rendered(F.col("role"), F.col("body")).alias("piece"),
        F.octet_length(header(F.col("role"))).alias("head"), F.octet_length("body").alias("length"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("piece").cast("long")).over(order), F.lit(0).cast("long"))
    span = F.struct((F.col("at") + F.col("head")).alias("start"), F.col("length").cast("long").alias("length"))
    df = df.withColumn("at", before).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("role").isin(*learnt), span))).alias("loss"),
    )
    return df.select("conv_id", F.array_join("pieces.piece", "").alias("formatted"), "loss")


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing in between."""
    raw = formatted.cast("binary")
    body = lambda s: F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string")
    return F.array_join(F.transform(loss, lambda s: unescaped(body(s))), "")
