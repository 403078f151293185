"""Scans, sinks, projections, filters, joins by key and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import numbers, strings
from gleaner.operators import prepare
from gleaner.plans.registry import query
from gleaner.sources import files, sheets

PREPARED = """
WITH typed AS (
    SELECT project_id, name, descr, keywords, country, currency,
           TRY_CAST(trunc(TRY_CAST(goal AS DOUBLE)) AS INTEGER) AS goal,
           CAST(deadline AS INTEGER) AS deadline, CAST(created_at AS INTEGER) AS created_at,
           CAST(launched_at AS INTEGER) AS launched_at, CAST(final_status AS INTEGER) AS final_status
    FROM campaigns),
timed AS (
    SELECT project_id, lower(name) AS name, lower(descr) AS descr, lower(keywords) AS keywords, goal, final_status,
           coalesce(CASE WHEN country = 'False' THEN currency ELSE country END, 'unknown') AS country2,
           coalesce(CASE WHEN length(currency) = 3 THEN currency END, 'unknown') AS currency2,
           strftime(make_timestamp(CAST(deadline AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS deadline2,
           strftime(make_timestamp(CAST(created_at AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at2,
           strftime(make_timestamp(CAST(launched_at AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS launched_at2,
           CAST(deadline // 86400 - launched_at // 86400 AS INTEGER) AS days_campaign,
           round((launched_at - created_at) / 36e2, 3) AS hours_prepa
    FROM typed WHERE final_status IN (0, 1))
SELECT *, concat_ws(' ', name, descr, keywords) AS text
FROM timed WHERE hours_prepa >= 0 AND days_campaign >= 0 AND goal > 0"""


@query(PREPARED, views=("campaigns",))
def campaign_prepare(t):
    return prepare.prepare_campaigns(t["campaigns"])


# -- scans and sinks ---------------------------------------------------------------------


@query("SELECT * FROM campaigns", views=("campaigns",))
def csv_string_scan(t):
    path = files.scratch_dir(t.spark, "campaigns")
    files.write_csv(t["campaigns"], path)
    return files.read_csv(t.spark, path, schema=", ".join(f"{c} string" for c in t["campaigns"].columns))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_infer_scan(t):
    path = files.scratch_dir(t.spark, "orders")
    files.write_csv(t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    # the inferred integer width depends on the data; the result's must not
    return files.read_csv(t.spark, path, infer=True).withColumns(
        {c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")}
    )


@query(
    """SELECT department, CAST(headcount AS INTEGER) AS headcount,
              CAST(nullif(plain_fees, 'nc') AS DOUBLE) AS plain_fees, CAST(nullif(extra_fees, 'nc') AS DOUBLE) AS extra_fees
       FROM fees""",
    views=("fees",),
)
def csv_null_marker(t):
    path = files.scratch_dir(t.spark, "fees")
    files.write_csv(t["fees"], path)
    schema = "department string, headcount int, plain_fees double, extra_fees double"
    return files.read_csv(t.spark, path, schema=schema, null_marker="nc")


@query(
    """SELECT r_name AS "Region", n_name AS "Nation", c_custkey AS "Customer_key", c_mktsegment AS "Customer_segment",
              c_acctbal AS "Customer_balance" FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def sheet_two_headers(t):
    """A sheet with two header rows whose region and nation stand in the first row of their block only."""
    nations = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t["customer"].join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    first_of = lambda key, name: rows.groupBy(key).agg(F.min(F.struct("n_regionkey", "c_nationkey", "c_custkey")).alias(name))
    rows = rows.join(first_of("n_regionkey", "r_first"), "n_regionkey").join(first_of("c_nationkey", "n_first"), "c_nationkey")
    place = F.struct("n_regionkey", "c_nationkey", "c_custkey")
    shown = lambda name, first: F.when(F.col(first) == place, F.col(name)).otherwise("")
    cells = [shown("r_name", "r_first"), shown("n_name", "n_first"), *(F.col(c) for c in ("c_custkey", "c_mktsegment", "c_acctbal"))]
    lines = rows.select(place.alias("place"), F.concat_ws(",", *cells).alias("line"))
    none = F.lit(None).cast(lines.schema["place"].dataType).alias("place")
    heads = t.spark.range(2).select(none, F.when(F.col("id") == 0, "Region,Nation,Customer,,").otherwise(",,key,segment,balance").alias("line"))
    path = files.scratch_dir(t.spark, "sheet")
    # the header rows have no place and come first, the upper one begins with a letter
    lines.unionByName(heads).orderBy("place", F.desc("line")).select("line").write.text(path)
    sheet = sheets.read_sheet(t.spark, path, header_rows=2, index_columns=2)
    return sheet.select(
        "Region", "Nation", F.col("Customer_key").cast("long"), "Customer_segment", F.col("Customer_balance").cast("double")
    )


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def parquet_roundtrip(t):
    return files.staged(t["customer"], "customer")


@query("SELECT p_partkey AS id, CAST(trunc(p_retailprice) AS INTEGER) AS prediction FROM part")
def csv_submission(t):
    path = files.scratch_dir(t.spark, "submission")
    files.write_csv(t["part"].select(F.col("p_partkey").alias("id"), F.col("p_retailprice").cast("int").alias("prediction")), path)
    return files.read_csv(t.spark, path, schema="id long, prediction int")


# -- projections -------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def project(t):
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    """SELECT project_id, """
    + ", ".join(f"TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INTEGER) AS {c}" for c in prepare.CAMPAIGN_INTEGERS)
    + " FROM campaigns",
    views=("campaigns",),
)
def cast_int_lenient(t):
    return prepare.cast_integers(t["campaigns"]).select("project_id", *prepare.CAMPAIGN_INTEGERS)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def drop_columns(t):
    return t["orders"].drop("o_custkey", "o_orderdate")


@query("SELECT s_name AS name, s_nationkey AS nation, s_suppkey AS supplier, s_acctbal AS balance FROM supplier")
def rename_columns(t):
    renamed = t["supplier"].toDF("supplier", "name", "nation", "balance")
    return renamed.select("name", "nation", "supplier", "balance")


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def numeric_columns(t):
    return t["lineitem"].select(*prepare.numeric_columns(t["lineitem"]))


@query(
    """SELECT nullif(regexp_extract(zone, '([0-9]{2,3}) - (.*)', 1), '') AS num_dep,
              nullif(regexp_extract(zone, '([0-9]{2,3}) - (.*)', 2), '') AS nom_dep, speciality, number FROM doctors""",
    views=("doctors",),
)
def regex_extract_dept(t):
    number, name = strings.department_parts(F.col("zone"))
    return t["doctors"].select(number.alias("num_dep"), name.alias("nom_dep"), "speciality", "number")


@query(
    """SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity * l_quantity + l_tax * l_tax), 6) AS direct_distance,
              l_quantity * l_quantity AS quantity_squared FROM lineitem"""
)
def derived_features(t):
    return t["lineitem"].select(
        "l_orderkey", "l_linenumber",
        F.round(F.hypot("l_quantity", "l_tax"), 6).alias("direct_distance"),
        F.pow("l_quantity", F.lit(2.0)).alias("quantity_squared"),
    )


@query("SELECT doc_id, text FROM documents WHERE substr(md5(concat('7:', doc_id)), 1, 8) < '19999999'")
def sample_fraction(t):
    return prepare.sample_rows(t["documents"], "doc_id", 0.1, seed=7).select("doc_id", "text")


@query(
    """SELECT o_orderkey, CASE WHEN substr(md5(concat('100:', o_orderkey)), 1, 8) < 'b3333333'
                               THEN 'train' ELSE 'test' END AS part FROM orders"""
)
def random_split(t):
    """Both parts in one scan; a job that needs one of them filters."""
    first = prepare.key_hash_below(F.col("o_orderkey"), 0.7, seed=100)
    return t["orders"].select("o_orderkey", F.when(first, "train").otherwise("test").alias("part"))


# -- filters -----------------------------------------------------------------------------


@query("SELECT project_id, currency FROM campaigns WHERE country = 'False'", views=("campaigns",))
def filter_eq(t):
    return t["campaigns"].filter(F.col("country") == "False").select("project_id", "currency")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber IN (0, 1)")
def filter_isin(t):
    return t["lineitem"].filter(F.col("l_linenumber").isin(0, 1)).select("l_orderkey", "l_linenumber")


@query("SELECT event_id, value FROM events WHERE value >= 5 AND value < 50")
def filter_range(t):
    value = F.col("value")
    return t["events"].filter((value >= 5) & (value < 50)).select("event_id", "value")


@query("SELECT zone, speciality FROM doctors WHERE regexp_matches(zone, '^[0-9]{2,3}.*')", views=("doctors",))
def filter_regex(t):
    return t["doctors"].filter(F.col("zone").rlike(strings.STARTS_WITH_NUMBER)).select("zone", "speciality")


@query("SELECT row_key, messid, bs_lat FROM messages WHERE bs_lat <> 395e-1", views=("messages",))
def filter_expr(t):
    return t["messages"].filter("bs_lat <> 395e-1").select("row_key", "messid", "bs_lat")


FEES = """SELECT nullif(regexp_extract(department, '([0-9]{2,3})- (.*)', 1), '') AS num_dep,
    CAST(headcount AS INTEGER) AS headcount, CAST(nullif(plain_fees, 'nc') AS DOUBLE) AS plain_fees,
    CAST(nullif(extra_fees, 'nc') AS DOUBLE) AS extra_fees FROM fees
    WHERE plain_fees <> 'nc' AND extra_fees <> 'nc'"""


def typed_fees(t):
    """Fees as numbers with the department number, rows with anything missing dropped."""
    number, _ = strings.department_parts(F.col("department"), strings.DEPARTMENT_TIGHT)
    amounts = {c: F.nullif(F.col(c), F.lit("nc")).try_cast("double") for c in ("plain_fees", "extra_fees")}
    typed = t["fees"].withColumns({"num_dep": number, "headcount": numbers.lenient_int(F.col("headcount")), **amounts})
    return typed.select("num_dep", "headcount", "plain_fees", "extra_fees").na.drop("any")


@query(FEES, views=("fees",))
def drop_nulls(t):
    return typed_fees(t)


@query(
    """SELECT project_id, coalesce(TRY_CAST(trunc(TRY_CAST(goal AS DOUBLE)) AS INTEGER), -1) AS goal,
              coalesce(country, 'unknown') AS country, coalesce(descr, '') AS descr FROM campaigns""",
    views=("campaigns",),
)
def fill_nulls(t):
    typed = prepare.cast_integers(t["campaigns"], ["goal"]).select("project_id", "goal", "country", "descr")
    return prepare.fill_nulls(typed, {"goal": -1, "country": "unknown", "descr": ""})


@query(
    """SELECT project_id, CASE WHEN country = 'False' THEN currency ELSE country END AS country2,
              CASE WHEN length(currency) = 3 THEN currency END AS currency2 FROM campaigns""",
    views=("campaigns",),
)
def repair_country_currency(t):
    return prepare.repair_country_currency(t["campaigns"].select("project_id", "country", "currency"))


@query("SELECT zone, number FROM doctors WHERE speciality = 'MACHINERY'", views=("doctors",))
def cross_section(t):
    return prepare.cross_section(t["doctors"], "speciality", "MACHINERY")


@query("SELECT zone, speciality, number FROM doctors WHERE speciality IS DISTINCT FROM 'BUILDING'", views=("doctors",))
def drop_label(t):
    return prepare.drop_label(t["doctors"], "speciality", "BUILDING")


@query("SELECT count(*) AS n FROM campaigns WHERE disable_communication = 'False'", views=("campaigns",))
def sql_filter_count(t):
    t["campaigns"].createOrReplaceTempView("gleaner_campaigns")
    return t.spark.sql("SELECT count(*) AS n FROM gleaner_campaigns WHERE disable_communication = 'False'")


@query(
    f"""SELECT p_partkey, trim(regexp_replace(translate(lower(trim(concat(p_brand, ' É ', p_name))),
               '{strings.ACCENTED}', '{strings.PLAIN}'), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
               lpad(CAST(p_size AS STRING), 4, '0') AS padded, TRY_CAST(substr(p_brand, 7) AS DOUBLE) AS brand_number
        FROM part WHERE p_retailprice BETWEEN 901 AND 1800"""
)
def slug_key(t):
    kept = t["part"].filter(F.col("p_retailprice").between(901, 1800))
    return kept.select(
        "p_partkey",
        strings.slug(F.concat("p_brand", F.lit(" É "), "p_name")).alias("slug"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
        F.substring("p_brand", 7, 100).try_cast("double").alias("brand_number"),
    )


# -- scalar expressions ------------------------------------------------------------------


@query(
    "SELECT project_id, concat_ws(' ', lower(name), lower(descr), lower(keywords)) AS text FROM campaigns",
    views=("campaigns",),
)
def text_concat(t):
    return t["campaigns"].select("project_id", prepare.joined_text("name", "descr", "keywords").alias("text"))


@query(
    """WITH typed AS (SELECT project_id, CAST(deadline AS BIGINT) AS deadline, CAST(created_at AS BIGINT) AS created_at,
                             CAST(launched_at AS BIGINT) AS launched_at FROM campaigns)
       SELECT project_id, strftime(make_timestamp(deadline * 1000000), '%Y-%m-%d %H:%M:%S') AS deadline2,
              strftime(make_timestamp(created_at * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at2,
              strftime(make_timestamp(launched_at * 1000000), '%Y-%m-%d %H:%M:%S') AS launched_at2,
              CAST(deadline // 86400 - launched_at // 86400 AS INTEGER) AS days_campaign,
              round((launched_at - created_at) / 36e2, 3) AS hours_prepa FROM typed""",
    views=("campaigns",),
)
def campaign_durations(t):
    typed = prepare.cast_integers(t["campaigns"]).select("project_id", "deadline", "created_at", "launched_at")
    return prepare.add_durations(typed).drop("deadline", "created_at", "launched_at")


@query(
    r"""SELECT c_custkey, string_split(cell, ' (')[1] AS login,
               nullif(regexp_extract(cell, '\((.+)\)', 1), '') AS full_name FROM contributors""",
    views=("contributors",),
)
def login_and_name(t):
    cell = F.col("cell")
    return t["contributors"].select(
        "c_custkey", strings.login_of(cell).alias("login"), strings.full_name_of(cell).alias("full_name")
    )


@query(
    r"""SELECT p_partkey, 1e6 * CAST(p_size AS DOUBLE) + 67e4 AS amount,
               CASE WHEN p_size % 2 = 0 THEN -1 ELSE 1 END * p_size + 0e0 AS percent FROM part"""
)
def parse_amounts(t):
    amount = F.concat(F.col("p_size").cast("string"), F.lit(".67 "))
    percent = F.concat(F.when(F.col("p_size") % 2 == 0, "-").otherwise("+"), F.col("p_size").cast("string"), F.lit("%"))
    return t["part"].select(
        "p_partkey", numbers.millions(amount).alias("amount"), numbers.percentage(percent).alias("percent")
    )


# -- joins by key ------------------------------------------------------------------------


SCORES = """SELECT string_split(c.cell, ' (')[1] AS login, coalesce(s.score, 0e0) AS score
    FROM contributors c LEFT JOIN (SELECT login, round_even(avg(stargazers_count), 1) AS score
                                   FROM repositories GROUP BY login) s ON s.login = string_split(c.cell, ' (')[1]"""


def login_scores(t):
    """Mean stars per login, 0 for logins without a repository."""
    scores = t["repositories"].groupBy("login").agg(F.bround(F.avg("stargazers_count"), 1).alias("score"))
    logins = t["contributors"].select(strings.login_of(F.col("cell")).alias("login"))
    return logins.join(scores, "login", "left").select("login", F.coalesce("score", F.lit(0.0)).alias("score"))


@query(SCORES, views=("contributors", "repositories"))
def scores_left_default(t):
    return login_scores(t)


@query(SCORES + " ORDER BY score DESC, login LIMIT 5", views=("contributors", "repositories"))
def top_scores(t):
    return login_scores(t).orderBy(F.desc("score"), "login").limit(5)


@query(
    f"""WITH specialists AS (
            SELECT regexp_extract(zone, '([0-9]{{2,3}}) - (.*)', 1) AS num_dep, CAST(sum(number) AS BIGINT) AS doctors
            FROM doctors WHERE speciality = 'Specialists' AND regexp_matches(zone, '^[0-9]{{2,3}}.*') GROUP BY 1),
        paid AS (SELECT num_dep, CAST(sum(headcount) AS BIGINT) AS headcount, sum(plain_fees) AS plain_fees
                 FROM ({FEES}) GROUP BY num_dep)
        SELECT s.num_dep, s.doctors, p.headcount, p.plain_fees, q.population
        FROM specialists s JOIN paid p ON s.num_dep = p.num_dep LEFT JOIN population q ON s.num_dep = q.num_dep""",
    views=("doctors", "fees", "population"),
)
def dept_join(t):
    """Each side is reduced to one row per department before the join, so none can be hot."""
    number, _ = strings.department_parts(F.col("zone"))
    listed = t["doctors"].filter(F.col("zone").rlike(strings.STARTS_WITH_NUMBER) & (F.col("speciality") == "Specialists"))
    specialists = listed.groupBy(number.alias("num_dep")).agg(F.sum("number").alias("doctors"))
    paid = typed_fees(t).groupBy("num_dep").agg(
        F.sum("headcount").alias("headcount"), F.sum("plain_fees").alias("plain_fees")
    )
    return specialists.join(paid, "num_dep").join(t["population"], "num_dep", "left")


# -- set operations ----------------------------------------------------------------------


@query("SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    left = t["customer"].select(F.col("c_nationkey").alias("nationkey"))
    return left.union(t["supplier"].select("s_nationkey")).distinct().orderBy("nationkey")


@query(
    """SELECT s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier
       UNION ALL SELECT c_name, c_acctbal, c_mktsegment FROM customer"""
)
def union_by_name(t):
    suppliers = t["supplier"].select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = t["customer"].select(
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    return prepare.append_pages(suppliers, customers)
