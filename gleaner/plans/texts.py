"""Word and character statistics over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import strings
from gleaner.operators import words
from gleaner.plans.registry import query
from gleaner.sources import files

LINES = r"""WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
    tokens AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
               WHERE rtrim(line, ' ') <> '' OR line = '')"""


def documents(t):
    return t.spread("documents", "doc_id")


def lines_of(t):
    """Documents as lines of text."""
    return documents(t).select(F.explode(F.split("text", "\n")).alias("line"))


@query(LINES + " SELECT word, count(*) AS n FROM tokens GROUP BY word")
def wordcount(t):
    return words.count_words(lines_of(t), strings.line_tokens(F.col("line")))


@query(LINES + " SELECT lower(word) AS word, CAST(count(*) AS BIGINT) AS n FROM tokens GROUP BY 1")
def wordcount_regroup(t):
    return words.regroup_lower(words.count_words(lines_of(t), strings.line_tokens(F.col("line"))))


@query(
    """WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
       tokens AS (SELECT unnest(string_split(line, ' ')) AS word FROM lines)
       SELECT lower(word) AS word, count(*) AS n FROM tokens GROUP BY 1"""
)
def wordcount_lower(t):
    return words.count_words(lines_of(t), strings.space_tokens(F.lower("line")))


RAW = "WITH tokens AS (SELECT unnest(string_split(text, ' ')) AS word FROM documents)"


@query(RAW + " SELECT word, count(*) AS n FROM tokens GROUP BY word")
def wordcount_raw(t):
    return words.count_words(documents(t), strings.space_tokens(F.col("text")))


@query(
    r"""WITH tokens AS (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents)
        SELECT word, count(*) AS n FROM tokens WHERE word <> '' GROUP BY word ORDER BY word"""
)
def wordcount_spec(t):
    return words.count_words(documents(t), strings.word_tokens(F.col("text"))).orderBy("word")


@query(RAW + " SELECT word, count(*) AS n FROM tokens GROUP BY word ORDER BY n DESC, word LIMIT 20")
def top20_words(t):
    counts = words.count_words(documents(t), strings.space_tokens(F.col("text")))
    return counts.orderBy(F.desc("n"), "word").limit(20)


@query(
    r"""WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents WHERE text IS NOT NULL),
        tokens AS (SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
                   WHERE rtrim(line, ' ') <> '' OR line = '')
        SELECT word, count(*) AS n FROM tokens GROUP BY word"""
)
def wc_lines(t):
    """The documents written as text files and counted line by line."""
    path = files.scratch_dir(t.spark, "lines")
    documents(t).select("text").filter(F.col("text").isNotNull()).write.text(path)
    return words.count_words(files.read_lines(t.spark, path), strings.line_tokens(F.col("value")))


@query(
    """WITH chars AS (SELECT lang, unnest(string_split(text, '')) AS ch FROM documents)
       SELECT lang, ch, count(*) AS n FROM chars WHERE ch <> '' GROUP BY lang, ch"""
)
def char_frequency(t):
    return words.count_characters(documents(t), "text", "lang")


@query(
    """WITH tokens AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos
                       FROM documents)
       SELECT doc_id, CAST(pos AS INTEGER) AS pos, lower(token) AS token FROM tokens"""
)
def explode_tokens(t):
    rows = documents(t).select("doc_id", F.posexplode(strings.space_tokens(F.col("text"))).alias("pos", "token"))
    return rows.withColumn("token", F.lower("token"))


@query(
    """WITH tokens AS (SELECT lang, unnest(string_split(text, ' ')) AS w FROM documents)
       SELECT lang, CAST(sum(CASE WHEN length(w) >= 2 AND left(w, 1) = right(w, 1) THEN 1 ELSE 0 END) AS BIGINT) AS n
       FROM tokens GROUP BY lang"""
)
def match_ends_count(t):
    """Counted inside each row, so only one number per language and task is shuffled."""
    hits = F.size(F.filter(strings.space_tokens(F.col("text")), strings.same_ends))
    return documents(t).groupBy("lang").agg(F.sum(hits).alias("n"))


@query(
    """SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w: length(w)), ',') AS lengths
       FROM documents"""
)
def word_lengths(t):
    lengths = F.transform(strings.space_tokens(F.col("text")), lambda w: F.length(w).cast("string"))
    return documents(t).select("doc_id", F.array_join(lengths, ",").alias("lengths"))


@query(
    """SELECT CASE WHEN length(text) < 2 THEN '' ELSE concat(left(text, 2), right(text, 2)) END AS block, count(*) AS n
       FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""
)
def blocking_key_groups(t):
    present = t["documents"].filter(F.col("text").isNotNull())
    return words.blocking_groups(present, strings.ends_key(F.col("text")))


@query(
    """WITH found AS (SELECT lang, text, instr(text, 'the') AS a, instr(text, 'and') AS b FROM documents),
       changed AS (SELECT lang, text, CASE WHEN a > 0 AND b > a
                   THEN concat(substr(text, 1, a - 1), 'good', substr(text, b + 3)) ELSE text END AS new_text FROM found)
       SELECT lang, count(*) AS n_docs, CAST(sum(CASE WHEN new_text <> text THEN 1 ELSE 0 END) AS BIGINT) AS n_rewritten,
              CAST(sum(length(new_text)) AS BIGINT) AS n_chars, min(md5(new_text)) AS least_digest
       FROM changed GROUP BY lang"""
)
def span_rewrite(t):
    new_text = strings.rewrite_span(F.col("text"), "the", "and", "good")
    rewritten = documents(t).select("lang", "text", new_text.alias("new_text"))
    return rewritten.groupBy("lang").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.col("new_text") != F.col("text")).alias("n_rewritten"),
        F.sum(F.length("new_text")).alias("n_chars"),
        F.min(F.md5("new_text")).alias("least_digest"),
    )


@query("SELECT event_type AS line, count(*) AS n FROM events GROUP BY event_type")
def whole_file_lines(t):
    """Text files read as one row each, then cut into lines and counted."""
    path = files.scratch_dir(t.spark, "whole")
    t["events"].select("event_type").write.text(path)
    lines = files.read_whole_texts(t.spark, path).select(F.explode(F.split("value", "\n")).alias("line"))
    return lines.filter("line <> ''").groupBy("line").agg(F.count("*").alias("n"))


@query(
    r"""WITH tokens AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS word FROM documents),
        counts AS (SELECT doc_id, word, count(*) AS n FROM tokens WHERE word <> '' GROUP BY doc_id, word)
        SELECT doc_id, count(*) AS n_words, string_agg(concat(word, '=', n), ' ' ORDER BY concat(word, '=', n)) AS counts
        FROM counts GROUP BY doc_id"""
)
def token_map(t):
    """A map per document, rendered in key order so that it can be compared."""
    maps = words.token_maps(t.spread("documents", "doc_id", keyed=True), "doc_id", strings.word_tokens(F.col("text")))
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("doc_id", F.size("counts").cast("long").alias("n_words"), F.array_join(F.sort_array(entries), " ").alias("counts"))
