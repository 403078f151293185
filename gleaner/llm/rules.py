"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.text import words

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "be", "to", "of", "and", "that", "have", "with", "in", "a", "is", "it", "for", "on", "as", "this", "was",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "ein", "eine", "im", "für", "auf", "des", "nicht",
    "le", "la", "les", "de", "des", "et", "du", "un", "une", "est", "que", "dans", "pour", "sur", "au", "qui",
    "el", "los", "las", "y", "en", "por", "con", "del", "se", "no", "una", "al", "lo", "para",
]


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; an open side is None. A measure that is null passes."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Every row names one measure of ``measures`` and the range that a good text keeps to.
THRESHOLDS = (
    Rule("mean_word_chars", 2.0, 12.0),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_ratio", low=0.02),
    Rule("shouting_ratio", high=0.3),
    Rule("dup_line_ratio", high=0.5),
    Rule("piped_line_ratio", high=0.3),
    Rule("repeat_ratio", high=0.2),
)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts that the measures are made of.

    ``n_repeat_words``: words inside 5-word windows that occur twice or more in the text, the
    first included. Windows are compared by a 64-bit hash. Null texts count as empty; repeated
    rows are judged one by one; only the two named columns are read.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = df.select("doc_id", "text", words(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashed"),
    )
    # each intermediate array is used more than once below, so no projection inlines it into a lambda
    window = F.transform(
        F.sequence(F.lit(1), F.size("hashed") - 4),
        lambda i: F.xxhash64(*[F.element_at("hashed", i + k) for k in range(5)]),
    )
    df = df.withColumns({
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_piped_lines": F.size(F.filter("lines", lambda x: x.contains("|"))).cast("long"),
        "windows": F.when(F.size("hashed") >= 5, window).otherwise(F.array().cast("array<bigint>")),
    }).drop("lines", "hashed")
    # most texts repeat no window: only the others pay for sorting theirs
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = df.withColumn(
        "placed", F.when(repeats, placed).otherwise(F.array().cast("array<struct<w:bigint,i:int>>"))
    ).drop("windows")
    same = F.filter(
        "placed",
        lambda x, k: (x["w"] == F.get("placed", k - 1)["w"]) | (x["w"] == F.get("placed", k + 1)["w"]),
    )
    df = df.withColumn("starts", F.sort_array(F.transform(same, lambda x: x["i"]))).drop("placed")
    covered = F.transform("starts", lambda x, k: F.least(F.lit(5), F.coalesce(F.get("starts", k + 1) - x, F.lit(5))))
    return df.withColumn(
        "n_repeat_words", F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    ).drop("starts")


def measures() -> dict[str, Column]:
    """The measures that rules may name, over the columns of ``counts``."""
    per_word = lambda c: F.try_divide(F.col(c), F.col("n_words"))
    per_line = lambda c: F.try_divide(F.col(c), F.col("n_lines"))
    return {
        "mean_word_chars": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "stop_word_ratio": per_word("n_stop_words"),
        "repeat_ratio": per_word("n_repeat_words"),
        "shouting_ratio": F.try_divide(F.col("n_upper"), F.col("word_chars")),
        "dup_line_ratio": per_line("n_dup_lines"),
        "piped_line_ratio": per_line("n_piped_lines"),
    }


def verdict(thresholds: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """All rules of the table as one boolean expression."""
    known = measures()
    passed = F.lit(True)
    for rule in thresholds:
        value = known[rule.measure]
        if rule.low is not None:
            passed = passed & F.coalesce(value >= rule.low, F.lit(True))
        if rule.high is not None:
            passed = passed & F.coalesce(value <= rule.high, F.lit(True))
    return passed


def judge(docs: DataFrame, thresholds: tuple[Rule, ...] = THRESHOLDS, id_col: str = "doc_id", text_col: str = "text"):
    """Counts, ``base_failed`` (under ten words, or over a fifth of them repeated) and ``kept``.

    A text without words fails the base rule. Ties with a threshold pass.
    """
    df = counts(docs, id_col, text_col)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(thresholds)).alias("kept"),
        "n_stop_words", "n_upper", "n_lines", "n_piped_lines",
    )
