import collections
import re

import pytest
from brute import LOWER

from gleaner.llm import audit

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def plain(rows, least_docs, top=10):
    """The audit of (lang, source, text) rows by dictionaries."""
    docs, counts = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def shares(count, kept=kept):
            whole = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // whole for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), collections.Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s, own in p.items():
            pairs = [(-sum(f(own[t], x[t]) for t in kept), o.encode(), o) for o, x in p.items() if o != s]
            terms = [(-f(own[t], q[t]), t.encode(), t) for t in kept if groups[s][t] and own[t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, k) for k, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def rows():
    out = []
    for i in range(120):
        lang, source = ("en", "de", "fr", None)[i % 4], (f"s{i % 7}" if i % 5 else None)
        body = " ".join(f"Word{'abcdefghij'[k * i % 10]},x-{'klmno'[(i + k) % 5]}\u00c4 don't" for k in range(i % 11))
        out.append((lang, source, body if i % 13 else None))
    return [
        *out, ("en", "s1", "rare"), ("xx", "only", "rare words"), ("en", "long", "zebra " * 60000 + "z" * 300000),
        ("en", "bare", "12 34 . -"), ("en", "s1", "rare"), ("yy", "a", ""), ("yy", "b", None),
    ]


@pytest.fixture(scope="module")
def table(spark):
    schema = "lang string, source string, text string, tile int, rank string"
    return spark.createDataFrame([(*r, 1, "x") for r in rows()], schema)


@pytest.mark.parametrize(("least", "settings"), [(3, {}), (1, {"bundle_words": 40, "tile": 2, "cells": 9}), (3, {"tile": 3, "top": 2})])
def test_against_dictionaries(table, least, settings):
    assert found(audit.audited(table, least, **settings)) == plain(rows(), least, settings.get("top", 10))


def test_odd_tables(spark, table):
    assert found(audit.audited(table.limit(0))) == []
    same = spark.createDataFrame([("en", s, "a b c") for s in "xy" for _ in range(10)], "lang string, source string, text string")
    got = found(audit.audited(same))
    assert got == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]  # equal use: no term stands out
    # repeated rows are documents of their own; nine copies are too few
    few = spark.createDataFrame([("en", "x", "a b")] * 9, "lang string, source string, text string")
    assert audit.term_counts(few).count() == 0 and audit.term_counts(few.unionAll(few)).count() == 2


def test_shares_are_exact(spark):
    n, whole = 10**12 + 7, 3 * 10**12 + 1
    df = spark.createDataFrame([(n, whole, 10**9)], "n long, whole long, terms long")
    got = df.select(audit.share(df.n, df.whole, df.terms)).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (whole + 2 * 10**9)


def test_terms_of_a_source_are_not_gathered(table):
    text = audit.audited(table, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and "CartesianProduct" not in text and "NestedLoop" not in text
