"""The registered queries of this subpackage, each next to the SQL it is checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import audit, bpe, chat, classifier, decontam, fim, katz, lines, neardup, rules, substrings, urls, warc
from gleaner.sources.files import scratch_dir

QUERIES = {}
ORACLES = {}

WORD = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    digits = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def url_sql() -> str:
    vocabulary = urls.Vocabulary()
    edged = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::INT"
    strict = " + ".join(map(edged, vocabulary.strict))
    soft = " + ".join(map(edged, vocabulary.soft))
    weight = " + ".join(f"{w}::DOUBLE * {edged(t)}" for t, w in vocabulary.soft.items())
    ordered = sorted(urls.RULES, key=lambda r: -len(r.name))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in ordered) + " END"
    return f"""
    WITH lowered AS (
        SELECT page_id, url, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
        FROM pages),
    parts AS (
        SELECT page_id, coalesce(regexp_extract(low, '^.*?://([^/?#]*)', 1, 's'), '') AS host,
               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
               ({strict})::INT AS n_strict, ({soft})::INT AS n_soft, ({weight})::DOUBLE AS soft_weight
        FROM lowered)
    SELECT page_id, host, path, {case(lambda r: r.name)} AS rule,
           coalesce({case(lambda r: r.verdict)},
                    CASE WHEN n_strict > 0 OR (n_soft > 1 AND soft_weight >= {vocabulary.limit}) THEN 'block'
                         ELSE 'allow' END) AS verdict, n_strict, n_soft, soft_weight
    FROM parts"""


@query(url_sql())
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def lines_sql() -> str:
    t = lines.MIN_LINES
    return f"""
    WITH split AS (
        SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
    numbered AS (
        SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS p FROM split),
    worded AS (
        SELECT doc_id, p, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
        FROM numbered WHERE regexp_matches(line, '{WORD}')),
    ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS s FROM worded),
    runs AS (
        SELECT doc_id, s, p AS a, lead(p, {t - 1}) OVER d AS b, count(*) OVER (d ROWS BETWEEN CURRENT ROW AND {t - 1} FOLLOWING) AS n,
               string_agg(line, chr(10)) OVER (d ROWS BETWEEN CURRENT ROW AND {t - 1} FOLLOWING) AS run
        FROM ordered WINDOW d AS (PARTITION BY doc_id ORDER BY s)),
    long_lines AS (
        SELECT doc_id, p, row_number() OVER (PARTITION BY line ORDER BY doc_id, s) AS k FROM ordered
        WHERE len(regexp_extract_all(line, '{WORD}')) > {lines.LONG_WORDS}),
    later AS (
        SELECT doc_id, a, b FROM (
            SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, s) AS k FROM runs WHERE n = {t}) WHERE k > 1
        UNION ALL SELECT doc_id, p, p FROM long_lines WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS p FROM later),
    flagged AS (
        SELECT n.doc_id, n.p, n.line, w.p IS NOT NULL AS has_word, g.p IS NOT NULL AS out
        FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.p = g.p
        LEFT JOIN worded w ON n.doc_id = w.doc_id AND n.p = w.p)
    SELECT doc_id, count(*) FILTER (has_word)::BIGINT AS n_lines, count(*) FILTER (has_word AND out)::BIGINT AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT out), '')) AS kept_sha256
    FROM flagged GROUP BY doc_id"""


@query(lines_sql())
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = lines.marked(table(spark, sf_dir, "documents"), long_words=lines.LONG_WORDS).select("doc_id", "line_dedup.*")
    kept = F.sha2(F.coalesce("kept", F.lit("")), 256)
    return df.select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


def rules_sql() -> str:
    measure = {
        "mean_word_chars": "word_chars / nullif(n_words, 0)",
        "symbols_per_word": "n_symbols / nullif(n_words, 0)",
        "stop_word_ratio": "n_stop_words / nullif(n_words, 0)",
        "repeat_ratio": "n_repeat_words / nullif(n_words, 0)",
        "shouting_ratio": "n_upper / nullif(word_chars, 0)",
        "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
        "piped_line_ratio": "n_piped_lines / nullif(n_lines, 0)",
    }
    tests = []
    for rule in rules.THRESHOLDS:
        if rule.low is not None:
            tests.append(f"coalesce({measure[rule.measure]} >= {rule.low}::DOUBLE, true)")
        if rule.high is not None:
            tests.append(f"coalesce({measure[rule.measure]} <= {rule.high}::DOUBLE, true)")
    return f"""
    WITH base AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
        FROM documents),
    grams AS (
        SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base)),
    repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
               len(list_filter(w, lambda x: lower(x) IN ({quoted(dict.fromkeys(rules.STOP_WORDS))})))::BIGINT AS n_stop_words,
               length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g'))::BIGINT AS n_upper,
               len(lines)::BIGINT AS n_lines,
               len(list_filter(lines, lambda x: contains(x, '|')))::BIGINT AS n_piped_lines
        FROM base LEFT JOIN covered USING (doc_id)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {' AND '.join(tests)} AS kept, n_stop_words, n_upper, n_lines, n_piped_lines
    FROM judged"""


@query(rules_sql())
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


NEARDUP_SQL = f"""
    WITH RECURSIVE low AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, s FROM (
            SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS s FROM low WHERE len(w) > 1
            UNION ALL SELECT doc_id, w[1] FROM low WHERE len(w) = 1)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
        WHERE 100 * common >= 80 * (x.n + y.n - common)),
    ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
    reach AS (SELECT u AS node, u AS seen FROM ways UNION SELECT r.node, w.v FROM reach r JOIN ways w ON r.seen = w.u),
    least AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
           coalesce(component, d.doc_id) = d.doc_id AS kept
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least ON node = d.doc_id"""


@query(NEARDUP_SQL)
def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.grouped(table(spark, sf_dir, "documents"))


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.fit(docs).judge(docs)


@query(f"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
               min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
    SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
           CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to
    FROM p""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    records = warc.read(spark, manifest, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op7_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"))


@query()
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = substrings.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return df.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS t,
               sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
        FROM documents),
    drawn AS (
        SELECT *, len(t) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
               ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
        FROM cut),
    parts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    texts AS (
        SELECT *, array_to_string(t[1:a], '') AS p, array_to_string(t[a + 1:b], '') AS m, array_to_string(t[b + 1:], '') AS s
        FROM parts)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                            WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM texts""")
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fim.transformed(table(spark, sf_dir, "documents"))
    text = fim.restored(F.col("output"), F.col("form"))
    return df.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


HARD_TURN = r"\### Assistant: </turn> ok"


@query(f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{HARD_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{HARD_TURN}'),
    sized AS (
        SELECT *, length(text) + len(regexp_extract_all(text, '{chat.CONTROL}')) + length('### :' || chr(10) || chr(10) || '{chat.END}' || chr(10))
               + CASE WHEN regexp_full_match(role, '[a-z]+') THEN length(role) ELSE 5 + 2 * strlen(role) END AS chars
        FROM turns)
    SELECT conv_id, count(*)::BIGINT AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id""")
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TURN).alias("text"),
    )
    df = chat.formatted(turns.unionByName(hard))
    df = df.select(
        "conv_id", "formatted", chat.parsed(F.col("formatted")).alias("turns"),
        chat.masked(F.col("formatted"), F.col("loss")).alias("learnt"),
    )
    read = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return df.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(read, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query(f"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents),
    t AS (
        SELECT r, lang, source, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM d),
    kept AS (
        SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {audit.LEAST_DOCS}),
    counts AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
    sources AS (
        SELECT lang, source, coalesce(total, 0)::HUGEINT AS total, coalesce(v, 0)::HUGEINT AS v,
               coalesce(lang_total, 0)::HUGEINT AS lang_total
        FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN langs USING (lang) LEFT JOIN totals USING (lang, source)),
    shares AS (
        SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, 1 + {audit.SCALE} * (coalesce(n, 0) + 2)::HUGEINT // (total + 2 * v) AS p,
               1 + {audit.SCALE} * (lang_n + 2)::HUGEINT // (lang_total + 2 * v) AS q
        FROM sources s JOIN kept k ON s.lang = k.lang
        LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    pairs AS (
        SELECT s.lang, s.source, o.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM sources s JOIN sources o ON s.lang = o.lang AND s.source <> o.source
        LEFT JOIN (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
        ON x.lang = s.lang AND x.source = s.source AND x.item = o.source),
    terms AS (
        SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, rank FROM (
        SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
        FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL BY NAME SELECT *, 'term' AS part FROM terms))
    WHERE part = 'pair' OR rank <= {audit.TOP}""")
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audited(table(spark, sf_dir, "documents"))
