"""Element extraction from page source.

Elements end at their own closing tag: the tags of a page are read in order, and a counter per
open element goes up at tags of its name and down at their ends. Blocks are cut at opening tags
alone. Positions are zero-based and follow document order. A missing position is NULL, never an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag(name: str) -> str:
    """Pattern of an opening tag."""
    return rf"<{name}(?:\s[^>]*)?>"


def class_tag(name: str, tag: str = "[a-zA-Z0-9]+") -> str:
    """Pattern of an opening tag that carries the class ``name``, alone or among others, in double
    quotes, single quotes or none."""
    name = re.escape(name)
    quoted = "|".join(rf"{q}(?:[^{q}]*?\s)?{name}(?:\s[^{q}]*)?{q}" for q in "\"'")
    return rf"<{tag}\s(?:[^>]*?\s)?class\s*=\s*(?:{quoted}|{name}(?=[\s>]))[^>]*>"


def plain_text(fragment: Column) -> Column:
    """Text of a fragment without its tags, the common entities decoded."""
    text = F.regexp_replace(fragment, "<[^>]*>", "")
    # fixed values; the ampersand comes last so that it is not decoded twice
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


# fixed values: elements without content and without a closing tag
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
# source that holds no elements, whatever it looks like
HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"


def let(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value computed once a row, however often ``build`` and its lambdas use it."""
    return F.get(F.transform(F.array(value), build), 0)


def nodes(html: Column) -> Column:
    """Every tag of a page with the text up to the next one; without comments, scripts and styles."""
    return F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit("<[^>]*>[^<]*"), F.lit(0))


def spans(found: Column, opening: str, outermost: bool = False) -> Column:
    """(first, last) of every element whose tag matches ``opening``, among the ``nodes`` of a page: the places of
    its own tag and of its closing tag, in document order.

    An element ends where the tags of its name are balanced again, so elements inside it may have the same
    name. One that is never closed ends with the page; one without content ends where it begins. With ``outermost``,
    elements inside a found one are left out.
    """
    mark = F.transform(
        found,
        lambda node, at: F.struct(
            at.alias("at"),
            F.lower(F.regexp_extract(node, "^</?([a-zA-Z][a-zA-Z0-9]*)", 1)).alias("name"),
            F.when(node.startswith("</"), -1).when(node.rlike("^<[^>]*/>"), 0).otherwise(1).alias("step"),
            node.rlike("^(?:" + opening + ")").alias("hit"),
        ),
    )
    open_type, done_type = "array<struct<name:string,depth:int,first:int>>", "array<struct<first:int,last:int>>"
    start = F.struct(F.array().cast(open_type).alias("open"), F.array().cast(done_type).alias("done"))

    def after(state: Column, m: Column) -> Column:
        step = F.when(m["name"].isin(*VOID), 0).otherwise(m["step"])
        moved = F.transform(
            state["open"],
            lambda o: F.struct(
                o["name"].alias("name"), (o["depth"] + F.when(o["name"] == m["name"], step).otherwise(0)).alias("depth"),
                o["first"].alias("first"),
            ),
        )
        ended = F.transform(
            F.filter(moved, lambda o: o["depth"] <= 0), lambda o: F.struct(o["first"].alias("first"), m["at"].alias("last"))
        )
        begins = m["hit"] & (F.size(state["open"]) == 0 if outermost else F.lit(True))
        own = F.array(F.struct(m["name"].alias("name"), F.lit(1).alias("depth"), m["at"].alias("first")))
        alone = F.array(F.struct(m["at"].alias("first"), m["at"].alias("last")))
        still = F.filter(moved, lambda o: o["depth"] > 0)
        return F.struct(
            F.when(begins & (step == 1), F.concat(still, own)).otherwise(still).cast(open_type).alias("open"),
            F.when(begins & (step == 0), F.concat(state["done"], ended, alone))
            .otherwise(F.concat(state["done"], ended)).cast(done_type).alias("done"),
        )

    def closed(state: Column) -> Column:
        rest = F.transform(state["open"], lambda o: F.struct(o["first"].alias("first"), F.size(found).alias("last")))
        return F.sort_array(F.concat(state["done"], rest).cast(done_type))

    def fold(marks: Column) -> Column:
        names = F.array_distinct(F.transform(F.filter(marks, lambda m: m["hit"]), lambda m: m["name"]))
        own = let(names, lambda some: F.filter(marks, lambda m: F.array_contains(some, m["name"])))
        return F.aggregate(own, start, after, closed)

    return let(mark, fold)


def inner(found: Column, span: Column) -> Column:
    """Source between an element's tags."""
    text = F.regexp_replace(F.get(found, span["first"]), "^<[^>]*>", "")
    rest = F.slice(found, span["first"] + 2, F.greatest(span["last"] - span["first"] - 1, F.lit(0)))
    return F.when(span["first"] == span["last"], "").otherwise(F.concat(text, F.array_join(rest, "")))


def elements(html: Column, opening: str, outermost: bool = False) -> Column:
    """Inner sources of all elements whose tag matches ``opening``, each up to its own closing tag."""
    some = let(nodes(html), lambda found: F.transform(spans(found, opening, outermost), lambda s: inner(found, s)))
    return F.when(html.rlike(opening), some).when(html.isNotNull(), F.array().cast("array<string>"))


def texts_by_class(html: Column, name: str) -> Column:
    """Texts of all elements of a class, those of the elements inside them included."""
    return F.transform(elements(html, class_tag(name)), plain_text)


def nth(items: Column, position: int) -> Column:
    """Zero-based element, NULL when absent."""
    return F.get(items, position)


def nth_block(html: Column, opening: str, position: int) -> Column:
    """Source between the match number ``position`` of the opening pattern and the next one."""
    return F.get(F.split(html, opening, position + 3), position + 1)


def before(html: Column, closing: str) -> Column:
    """Source up to the first match of a closing pattern."""
    return F.get(F.split(html, closing, 2), 0)


LINK = r"(?is)<a\s(?:[^>]*?\s)?href\s*=[^>]*>.*?</a\s*>"
HREF = r"""(?is)^<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def link_items(html: Column) -> Column:
    """(href, text) of every ``<a … href=…>`` in document order: any other attributes, any form of
    quotes; tags inside the text are left out."""

    def item(link: Column) -> Column:
        href = F.concat(*(F.regexp_extract(link, HREF, n) for n in (1, 2, 3)))
        return F.struct(href.alias("href"), F.regexp_replace(link, "(?s)<[^>]*>", "").alias("text"))

    return F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(0)), item)


def link_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit(LINK))
