"""Extraction from page sources and JSON payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import html as H
from gleaner.functions.strings import login_of
from gleaner.operators import webpages
from gleaner.plans.registry import query

LINK = r'<li>\s*<a\s+href="([^"]*)"[^>]*>([^<]*)</a>'
LINKS = f"""WITH found AS (SELECT page_id, url, regexp_extract_all(html, '{LINK}', 1) AS hrefs,
                                  regexp_extract_all(html, '{LINK}', 2) AS texts FROM pages WHERE length(html) > 0),
    links AS (SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS text,
                     CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos FROM found)"""


def pages(t):
    return webpages.page_sources(t.spread("pages", "page_id"))


@query("SELECT page_id, url, length(html) AS n_chars FROM pages WHERE length(html) > 0")
def pages_scan(t):
    return pages(t).select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query(LINKS + " SELECT page_id, pos, href, text FROM links")
def nav_items(t):
    return webpages.links(pages(t), "page_id")


@query(LINKS + " SELECT page_id, pos, text FROM links WHERE pos < 3")
def first_n_items(t):
    return webpages.links(pages(t), "page_id", first=3).select("page_id", "pos", "text")


@query(
    LINKS
    + r""" SELECT regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, count(*) AS n_links,
                  count(DISTINCT page_id) AS n_pages FROM links GROUP BY 1"""
)
def links_by_host(t):
    """Links are counted per page inside the row, so nothing is exploded or made distinct."""
    per_page = pages(t).select(
        F.try_parse_url("url", F.lit("HOST")).alias("host"), H.link_count(F.col("html")).cast("long").alias("n")
    ).filter("n > 0")
    return per_page.groupBy("host").agg(F.sum("n").alias("n_links"), F.count("*").alias("n_pages"))


@query(
    """SELECT page_id, 0 AS pos, split_part(regexp_extract(html, '<tbody><tr><td>([^<]*)', 1), ' (', 1) AS login,
              split_part(regexp_extract(html, '<a href="/c">([^<]*)', 1), ' (', 1) AS city FROM ranking_pages
       UNION ALL SELECT page_id, 1, concat('next', page_id), 'Town' FROM ranking_pages""",
    views=("ranking_pages",),
)
def table_cells(t):
    rows = webpages.table_rows(t.spread("ranking_pages", "page_id"), "page_id", first=2)
    login, city = (login_of(webpages.cell_text(F.col("row"), n)) for n in (0, 1))
    return rows.select("page_id", "pos", login.alias("login"), city.alias("city"))


PRICES = """WITH found AS (SELECT offer_id, brand,
        list_transform(regexp_extract_all(html, 'class="price">([^<]*)<', 1),
                       lambda x: CAST(replace(x, '€', '.') AS DOUBLE)) AS prices,
        list_transform(regexp_extract_all(html, 'class="prdtPrBILSt">([^<]*)€<', 1),
                       lambda x: CAST(replace(x, ',', '.') AS DOUBLE)) AS marked FROM offers)"""


def one_kind(name: str) -> str:
    return f"SELECT offer_id, '{name}' AS kind, unnest({name}) AS price, CAST(unnest(range(len({name}))) AS INTEGER) AS pos FROM found"


@query(f"{PRICES} {one_kind('prices')} UNION ALL {one_kind('marked')}", views=("offers",))
def parse_prices(t):
    """Every price of an offer, list prices and marked-down ones, in the order of the page."""
    offers = webpages.priced_offers(t.spread("offers", "offer_id"), "offer_id")
    kind = lambda name, column: F.transform(
        column, lambda price, pos: F.struct(F.lit(name).alias("kind"), pos.alias("pos"), price.alias("price"))
    )
    return offers.select("offer_id", F.inline(F.concat(kind("prices", "prices"), kind("marked", "marked_down"))))


@query(
    """SELECT offer_id, 0 AS pos, concat(size, brand, 'x') AS text FROM nested_offers
       UNION ALL SELECT offer_id, 1, kind FROM nested_offers
       UNION ALL SELECT offer_id, 2, kind FROM nested_offers WHERE offer_id % 3 = 0
       UNION ALL SELECT offer_id, CASE WHEN offer_id % 3 = 0 THEN 3 ELSE 2 END, concat('open ', brand) FROM nested_offers""",
    views=("nested_offers",),
)
def nested_texts(t):
    """Elements that hold elements of their own tag, of their own class, void and unclosed ones."""
    return webpages.class_texts(t.spread("nested_offers", "offer_id"), webpages.PRICE_CLASS, "offer_id")


@query(
    PRICES
    + """, sums AS (SELECT brand, CAST(sum(CAST(list_sum(prices) AS DECIMAL(18,2))) AS DOUBLE) AS price,
                           CAST(sum(CAST(coalesce(list_sum(marked), 0e0) AS DECIMAL(18,2))) AS DOUBLE) AS marked,
                           sum(len(prices)) AS n, sum(len(marked)) AS n_marked FROM found GROUP BY brand)
          SELECT brand, CAST(round_even(marked * 100 / price, 0) AS BIGINT) AS discount_pct,
                 CAST(round_even(price - marked, 0) AS BIGINT) AS saved_total,
                 CAST(round_even(n_marked * 100 / n, 0) AS BIGINT) AS discounted_share FROM sums""",
    views=("offers",),
)
def discount_metrics(t):
    return webpages.discount_metrics(t.spread("offers", "offer_id"))


@query(
    """SELECT p_partkey AS page_id, round((p_size * 1000 + 6677e-1) * 1e6, 2) AS sales_mean,
              round(((p_size + 1) * 1000 + 1005e-1) * 1e6, 2) AS sales_high,
              round(((p_size - 1) * 1000 + 90025e-2) * 1e6, 2) AS sales_low, p_retailprice AS share_price,
              CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END * (p_size % 9 + 25e-2) AS change_pct,
              round(p_size + 57e-2, 2) AS owned_pct,
              CASE WHEN p_partkey % 17 <> 0 THEN p_size % 5 + 1e-1 END AS dividend_company,
              CASE WHEN p_partkey % 17 <> 0 THEN 25e-1 END AS dividend_industry,
              CAST(NULL AS DOUBLE) AS dividend_sector FROM part"""
)
def company_record(t):
    return webpages.company_records(t.spread("company_pages", "page_id"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse(t):
    return t["events"].select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


@query(
    """WITH kept AS (SELECT p_partkey AS payload_id, p_size, p_brand FROM part WHERE p_partkey % 23 <> 0 AND p_partkey % 19 <> 0)
       SELECT payload_id, p_size * 10 AS nombre_de_reservations, p_brand AS auteur,
              '2017-01-26T11:17:33+00:00' AS record_timestamp FROM kept
       UNION ALL SELECT payload_id, p_size, NULL, '2018-02-03T04:05:06+00:00' FROM kept"""
)
def json_flatten(t):
    return webpages.flattened_payloads(t.spread("payloads", "payload_id"))


@query(
    """WITH items AS (SELECT p_partkey AS id, p_partkey % 19 <> 0 AS filled FROM part WHERE p_partkey % 23 <> 0),
    paths AS (SELECT * FROM (VALUES ('$', 'OBJECT', 1, 0), ('$.nhits', 'BIGINT', 1, 0), ('$.parameters', 'OBJECT', 1, 0),
        ('$.records', 'ARRAY', 1, 0), ('$.records[]', 'OBJECT', 0, 2), ('$.records[].datasetid', 'STRING', 0, 2),
        ('$.records[].recordid', 'STRING', 0, 2), ('$.records[].fields', 'OBJECT', 0, 2),
        ('$.records[].fields.nombre_de_reservations', 'BIGINT', 0, 2), ('$.records[].fields.auteur', 'STRING', 0, 1),
        ('$.records[].fields.titre', 'STRING', 0, 2), ('$.records[].record_timestamp', 'STRING', 0, 2)) AS x(path, kind, page, record))
    SELECT path, kind, CAST(sum(page + CASE WHEN filled THEN record ELSE 0 END) AS BIGINT) AS n FROM items, paths GROUP BY path, kind
    HAVING sum(page + CASE WHEN filled THEN record ELSE 0 END) > 0"""
)
def json_paths(t):
    """Which fields answers of unknown layout have, of which type and how often."""
    fields = webpages.json_fields(t.spread("payloads", "payload_id"), "payload", "payload_id", depth=5)
    return fields.groupBy("path", "kind").agg(F.count("*").alias("n"))


@query(
    """WITH kept AS (SELECT p_partkey AS payload_id, p_size, p_brand, p_name, p_type FROM part WHERE p_partkey % 23 <> 0 AND p_partkey % 19 <> 0)
       SELECT payload_id, concat('a', payload_id) AS recordid, p_brand AS auteur, p_name AS titre, CAST(p_size * 10 AS BIGINT) AS places FROM kept
       UNION ALL SELECT payload_id, concat('b', payload_id), NULL, p_type, p_size FROM kept"""
)
def json_varied_records(t):
    """Records whose fields vary, by paths into the variant; what a record lacks is NULL."""
    answers = t.spread("payloads", "payload_id").select("payload_id", F.try_parse_json("payload").alias("answer"))
    listed = F.try_variant_get("answer", "$.records", "array<variant>")
    records = answers.select("payload_id", F.explode(listed).alias("r"))
    take = lambda path, kind: F.try_variant_get("r", path, kind)
    return records.select(
        "payload_id", take("$.recordid", "string").alias("recordid"), take("$.fields.auteur", "string").alias("auteur"),
        take("$.fields.titre", "string").alias("titre"), take("$.fields.nombre_de_reservations", "bigint").alias("places"),
    )
