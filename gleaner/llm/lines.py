"""Line dedup: winnowed line hashes find runs of lines that occur earlier in the collection.

Only built-in functions. The order of documents is (id, hash of the text); rows that agree in
both are one document to this operator and share its verdict. Lines without a word never count;
lines are compared without the white space around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.sources.files import staged

#: A run of this many lines that occurs earlier is deleted.
MIN_LINES = 2
#: Lines in a gram. A window of MIN_LINES - GRAM + 1 grams gives its smallest hash as fingerprint,
#: so every run of MIN_LINES lines holds a fingerprint that its earlier copy has as well.
GRAM = 1
#: A single line of more words than this is deleted as well where ``long_words`` asks for it.
LONG_WORDS = 50

BLANK = " \t\x0b\x0c\r"


def hashed_lines(text: Column, worded_too: bool = False) -> Column:
    """(p, h) of every line with a word: its place among all lines, and its hash; with
    ``worded_too`` also x, the line itself."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    trimmed = F.transform(lines, lambda x, p: F.struct(p.alias("p"), F.btrim(x, F.lit(BLANK)).alias("x")))
    worded = F.filter(trimmed, lambda s: s["x"] != "")
    more = lambda s: [s["x"].alias("x")] if worded_too else []
    return F.transform(worded, lambda s: F.struct(s["p"].alias("p"), F.xxhash64(s["x"]).alias("h"), *more(s)))


def fingerprints(docs: DataFrame, min_lines: int, gram: int) -> DataFrame:
    """One row per window minimum: document (d, th), its hash g, and ``around``: the runs of
    ``min_lines`` lines that hold it, each with its hash, ordinal, first and last line."""
    span = min_lines - gram + 1
    df = docs.select("d", "th", "lines", F.size("lines").alias("n")).filter(F.col("n") >= min_lines)
    at = lambda i: F.get("lines", i)
    grams = F.transform(
        F.sequence(F.lit(0), F.col("n") - gram), lambda i: F.xxhash64(*[at(i + k)["h"] for k in range(gram)])
    )
    runs = F.transform(
        F.sequence(F.lit(0), F.col("n") - min_lines),
        lambda s: F.struct(
            F.xxhash64(*[at(s + k)["h"] for k in range(min_lines)]).alias("w"), s.alias("s"),
            at(s)["p"].alias("a"), at(s + (min_lines - 1))["p"].alias("b"),
        ),
    )
    df = df.select("d", "th", "n", grams.alias("grams"), runs.alias("runs"))
    # the right-most of equal minima, so that neighbouring windows agree
    minimum = F.transform(
        F.sequence(F.lit(0), F.size("grams") - span),
        lambda s: -F.array_min(
            F.array(*[F.struct(F.get("grams", s + k).alias("g"), (-(s + k)).alias("i")) for k in range(span)])
        )["i"],
    )
    df = df.select("d", "th", "grams", "runs", F.explode(F.array_distinct(minimum)).alias("i"))
    before = F.greatest(F.col("i") + (gram - min_lines), F.lit(0))
    return df.select(
        "d", "th", F.get("grams", F.col("i")).alias("g"),
        F.slice("runs", before + 1, F.col("i") - before + 1).alias("around"),
    )


def long_lines(docs: DataFrame, long_words: int) -> DataFrame:
    """Each line of more than ``long_words`` words as a fingerprint of its own and a run of one line."""
    many = F.filter("lines", lambda s: F.regexp_count(s["x"], F.lit(r"[^\x20\x09-\x0D]+")) > long_words)
    # hashed with a mark, so that it never meets a gram or a run of min_lines
    df = docs.select("d", "th", F.explode(many).alias("r")).withColumn("g", F.xxhash64(F.lit("long"), "r.h"))
    run = F.struct(F.col("g").alias("w"), F.col("r.p").alias("s"), F.col("r.p").alias("a"), F.col("r.p").alias("b"))
    return df.select("d", "th", "g", F.array(run).alias("around"))


def repeated_runs(docs: DataFrame, min_lines: int, gram: int, long_words: int | None = None) -> DataFrame:
    """(d, th, cut): per document the lines, as (a, b) with both ends, that repeat earlier ones."""
    found = fingerprints(docs, min_lines, gram)
    if long_words is not None:
        found = found.unionByName(long_lines(docs, long_words))
    found = staged(found, "line-fingerprints")
    several = found.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1").select("g")
    # a fingerprint that occurs once lies in no repeated run; round the others the match is
    # extended both ways, run by run
    runs = found.join(several, "g", "left_semi").select("d", "th", F.explode("around").alias("r"))
    runs = runs.select("d", "th", "r.*").distinct()
    first = runs.groupBy("w").agg(F.min(F.struct("d", "th", "s")).alias("first"))
    later = runs.join(first, "w").filter(F.struct("d", "th", "s") > F.col("first"))
    return later.groupBy("d", "th").agg(F.collect_set(F.struct("a", "b")).alias("cut"))


def marked(
    docs: DataFrame, min_lines: int = MIN_LINES, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
    long_words: int | None = None,
) -> DataFrame:
    """``docs`` with a struct column ``line_dedup``: kept (text), n_lines, n_removed.

    Every line inside a run of ``min_lines`` lines whose sequence starts earlier (smaller id, or the
    same document) is removed, with the blank lines inside the run. With ``long_words`` so is every
    single line of more words than that which stands earlier, in texts of one line too. Runs are judged on the input,
    not on what is left. A null text stays null and has no lines; an empty table gives an empty one.
    Columns of any name pass through, except one called ``line_dedup``, which is replaced.
    """
    if not 1 <= gram <= min_lines:
        raise ValueError("1 <= gram <= min_lines")
    names = [c for c in docs.columns if c != "line_dedup"]
    key = lambda: (F.col(id_col).alias("d"), F.xxhash64(text_col).alias("th"))
    cuts = repeated_runs(docs.select(*key(), hashed_lines(F.col(text_col), long_words is not None).alias("lines")), min_lines, gram, long_words)
    df = docs.select(F.struct(*names).alias("row"), *key()).alias("doc")
    df = df.join(cuts.alias("cuts"), F.expr("doc.d <=> cuts.d AND doc.th = cuts.th"), "left")
    text = F.col("row")[text_col]
    df = df.select(
        "row", F.split(F.coalesce(text, F.lit("")), "\n").alias("lines"), "cut",
        F.size(hashed_lines(text)).cast("long").alias("n_lines"),
    )
    gone = F.array_distinct(F.flatten(F.transform("cut", lambda r: F.sequence(r["a"], r["b"]))))
    df = df.withColumn(
        "stay", F.when(F.col("cut").isNotNull(), F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), gone))
    )
    joined = F.array_join(F.transform("stay", lambda p: F.get("lines", p)), "\n")
    kept = F.when(F.col("stay").isNull(), F.col("row")[text_col]).otherwise(joined)
    df = df.select("row", "n_lines", kept.alias("kept"))
    left = F.coalesce(F.size(hashed_lines(F.col("kept"))), F.lit(0)).cast("long")
    return df.select(
        "row.*", F.struct("kept", "n_lines", (F.col("n_lines") - left).alias("n_removed")).alias("line_dedup")
    )


def dedup(
    docs: DataFrame, min_lines: int = MIN_LINES, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
    long_words: int | None = None,
) -> DataFrame:
    """``docs`` with the repeated runs deleted; documents that lose all their lines go. Columns of any
    name pass through."""
    others = [c for c in docs.columns if c != text_col]
    row = docs.select(F.struct(*others).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    df = marked(row, min_lines, gram, "doc_id", "text", long_words)
    info = F.col("line_dedup")
    emptied = (info["n_removed"] > 0) & (info["n_removed"] == info["n_lines"])
    columns = [info["kept"].alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return df.filter(~emptied).select(*columns)
