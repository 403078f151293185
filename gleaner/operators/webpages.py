"""Typed rows out of page sources and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import html as H
from gleaner.functions.numbers import marked_down_price, millions, percentage, shop_price

# fixed values: classes of the shop pages
PRICE_CLASS = "price"
MARKED_DOWN_CLASS = "prdtPrBILSt"

# fixed values: the nested service answer
PAYLOAD = """nhits int, records array<struct<
    datasetid: string, recordid: string,
    fields: struct<nombre_de_reservations: int, auteur: string, titre: string>,
    record_timestamp: string>>"""


def page_sources(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages that arrived: those with a non-empty source."""
    return pages.filter(F.length(html) > 0)


def priced_offers(offers: DataFrame, *keep: str) -> DataFrame:
    """Arrays of list prices and marked-down prices per page."""
    prices = F.transform(H.texts_by_class(F.col("html"), PRICE_CLASS), shop_price)
    marked = F.transform(H.texts_by_class(F.col("html"), MARKED_DOWN_CLASS), marked_down_price)
    return offers.select(*keep, prices.alias("prices"), marked.alias("marked_down"))


def _total(name: str) -> Column:
    # exact cents, so the order in which partial sums meet does not matter
    per_page = F.aggregate(
        name, F.lit(0).cast("decimal(38,2)"),
        lambda total, price: (total + F.coalesce(price, F.lit(0.0)).cast("decimal(18,2)")).cast("decimal(38,2)"),
    )
    return F.sum(per_page).cast("double")


def _number(name: str) -> Column:
    return F.sum(F.size(name))


def discount_metrics(offers: DataFrame, key: str = "brand") -> DataFrame:
    """Marked-down share of the turnover, total saved and share of marked-down offers, each
    rounded half-even to an integer; shares are NULL without prices. The arrays are summed per page before the shuffle."""
    metrics = {
        "discount_pct": F.try_divide(_total("marked_down") * 100, _total("prices")),
        "saved_total": _total("prices") - _total("marked_down"),
        "discounted_share": F.try_divide(_number("marked_down") * 100, _number("prices")),
    }
    grouped = priced_offers(offers, key).groupBy(key)
    return grouped.agg(*(F.bround(value).cast("long").alias(name) for name, value in metrics.items()))


def company_records(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One typed record per financial page; whatever is missing is NULL.

    Narrowed step by step - page, column, module, row, cell - so that each split runs once
    per page on the shortest source that holds what it looks for.
    """
    # fixed values: positions of the modules, rows and cells on the page
    module, row, span = H.class_tag("module", "div"), H.tag("tr"), H.tag("span")
    left = H.nth_block(F.col("html"), H.class_tag("column1"), 0)
    right = H.nth_block(F.col("html"), H.class_tag("column2"), 0)
    parts = pages.select(
        key,
        H.nth_block(F.col("html"), r'<[a-z]+[^>]*\sid="sectionHeader"[^>]*>', 0).alias("header"),
        F.split(H.before(left, H.class_tag("column2")), module).alias("left"),
        H.nth_block(right, module, 3).alias("owned"),
    )
    rows = parts.select(
        key,
        H.nth_block(H.nth(F.col("left"), 2), row, 2).alias("sales"),
        H.nth_block(H.nth(F.col("left"), 4), row, 1).alias("dividends"),
        H.nth_block(F.col("owned"), row, 0).alias("owned"),
        H.nth_block(F.col("header"), H.class_tag("nasdaqChange"), 0).alias("price"),
        H.nth_block(F.col("header"), H.class_tag("priceChange"), 0).alias("change"),
    )
    cells = rows.select(
        key,
        *(F.split(name, H.class_tag("data")).alias(name) for name in ("sales", "dividends", "owned")),
        *(F.split(H.before(F.col(name), "</div>"), span).alias(name) for name in ("price", "change")),
    )

    def text(column: str, position: int) -> Column:
        return F.trim(H.plain_text(H.before(H.nth(F.col(column), position + 1), "</t[dh]>")))

    sales = {f"sales_{name}": millions(text("sales", n)) for n, name in ((1, "mean"), (2, "high"), (3, "low"))}
    dividends = {f"dividend_{name}": text("dividends", n) for n, name in enumerate(("company", "industry", "sector"))}
    return cells.select(
        key,
        *(value.alias(name) for name, value in sales.items()),
        text("price", 1).try_cast("double").alias("share_price"),
        text("change", 2).try_cast("double").alias("change_pct"),
        percentage(text("owned", 0)).alias("owned_pct"),
        *(value.try_cast("double").alias(name) for name, value in dividends.items()),
    )


def links(pages: DataFrame, *keep: str, first: int | None = None) -> DataFrame:
    """(position, href, text) per list link, optionally the first few of each page."""
    items = H.link_items(F.col("html"))
    rows = pages.select(*keep, F.posexplode(items).alias("pos", "item")).select(*keep, "pos", "item.href", "item.text")
    return rows if first is None else rows.filter(F.col("pos") < first)


def table_rows(pages: DataFrame, *keep: str, first: int | None = None) -> DataFrame:
    """(pos, row) per body row of the first table of each page, optionally the first few. Tables
    inside a cell belong to their row."""
    first_of = lambda source, name: H.nth(H.elements(source, H.tag(name), outermost=True), 0)
    # one expression inside the generator: each step runs once a page, and no filter on it can move down to the scan,
    # below the shuffle that spreads the pages
    found = H.let(
        first_of(F.col("html"), "table"),
        lambda table: H.let(first_of(table, "tbody"), lambda body: H.elements(body, H.tag("tr"), outermost=True)),
    )
    found = found if first is None else F.slice(found, 1, first)
    return pages.select(*keep, F.posexplode(found).alias("pos", "row"))


def cell_text(row: Column, column: int) -> Column:
    """Text of a cell of a table row."""
    return H.plain_text(H.nth(H.elements(row, H.tag("t[dh]"), outermost=True), column))


def class_texts(pages: DataFrame, name: str, *keep: str) -> DataFrame:
    """(pos, text) of every element of a class, each up to its own closing tag."""
    return pages.select(*keep, F.posexplode(H.texts_by_class(F.col("html"), name)).alias("pos", "text"))


def flattened_payloads(payloads: DataFrame, key: str = "payload_id") -> DataFrame:
    """One row per nested record; broken payloads and empty record lists give none."""
    records = F.from_json("payload", PAYLOAD).getField("records")
    rows = payloads.select(key, F.explode(records).alias("r"))
    return rows.select(
        key,
        F.col("r.fields.nombre_de_reservations").alias("nombre_de_reservations"),
        F.col("r.fields.auteur").alias("auteur"),
        F.col("r.record_timestamp").alias("record_timestamp"),
    )


def json_fields(df: DataFrame, name: str, key: str, depth: int = 12) -> DataFrame:
    """(key, path, kind, value) of every value inside the JSON texts of a column, whatever their layout.

    Paths name fields by ``.name`` and every item of a list by ``[]``; kind is the type, OBJECT and ARRAY for
    containers, VOID for JSON nulls; value is the variant itself. Texts that are not JSON, and nulls, have no row. Every
    level of nesting is one step of the plan; texts nested deeper than ``depth`` keep their containers there.
    """
    spark = df.sparkSession
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    level = df.select(key, F.lit("$").alias("path"), F.try_parse_json(name).alias("value")).filter("value IS NOT NULL")
    found = level = level.withColumn("kind", kind)
    for _ in range(depth):
        held = level.filter(F.col("kind").isin("OBJECT", "ARRAY")).select(key, F.col("path").alias("parent"), F.col("value").alias("whole"))
        inner = held.lateralJoin(spark.tvf.variant_explode(F.col("whole").outer()))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
        level = inner.select(F.col(key), F.concat("parent", step).alias("path"), F.col("value")).withColumn("kind", kind)
        found = found.unionByName(level)
    return found.select(key, "path", "kind", "value")
