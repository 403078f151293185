from collections import Counter

import pytest
from brute import words

from gleaner.llm import rules, urls


def repeated(w):
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)})


def test_rules(spark):
    long = " ".join(f"the{i % 7000}" for i in range(20000))
    texts = [
        None, "", " \n\t ", "one two", "a b c d e a b c d e f", "a a a a a a a", long, "x\ny\nx\n\n \nx", "# * $ | é ü 日本",
        "the quick brown fox and the dog ran to the house in a storm", "the quick brown fox and the dog ran to the house in a storm",
    ]
    df = spark.createDataFrame([(i if i else None, t, 5) for i, t in enumerate(texts)], "doc_id int, text string, n_words int")
    got = {r.doc_id: r for r in rules.judge(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r, w = got[i if i else None], words(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), len("".join(w)), repeated(w))
        assert r.n_symbols == sum(c in rules.SYMBOLS for c in text or "") and r.n_dup_lines == len(lines) - len(set(lines))
        assert r.base_failed == (len(w) < 10 or 100 * repeated(w) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert got[9].kept and got[10].kept
    assert rules.judge(df.limit(0)).count() == 0


def test_threshold_table_decides(spark):
    text = "the quick brown fox and the dog ran to the house in a storm"
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    strict = (rules.Rule("mean_word_chars", high=1.0),)
    assert not rules.judge(df, strict).first().kept and rules.judge(df, ()).first().kept
    assert "Python" not in rules.judge(df)._jdf.queryExecution().executedPlan().toString()


URLS = [
    ("http://porn.example.com/x", "block"), ("http://pornography.example.com/x", "allow"), ("HTTP://A.EXAMPLE.COM/XXX", "block"),
    ("http://a.com/casino", "allow"), ("http://casino.com/adult/", "block"), ("http://casino.com/casino/casino", "allow"),
    ("http://free.com/cheap-loan", "block"), ("http://free.com/download", "allow"), (None, "allow"), ("", "allow"),
    ("no scheme porn", "block"), ("http://x.net", "allow"), ("http://x.net/", "block"), ("http://X.Example.NET/en/a?b", "allow"),
    ("http://example.com/de/", "block"), ("http://notexample.com/de/", "allow"), ("http://a.org/fr/porn", "allow"), ("http://a.org/frx/porn", "block"),
]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h") for i, (u, _) in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: v for i, (_, v) in enumerate(URLS)}
    assert got[13].rule == "example.net/en/" and got[13].host == "x.example.net" and got[13].path == "/en/a"
    assert got[8].host == got[8].path == got[10].host == "" and got[11].rule is None and got[12].rule == "net/"
    assert urls.judge(df.limit(0)).count() == 0


@pytest.mark.parametrize("key", [None, 2**60 + 1])
def test_page_ids_stay_exact(spark, key):
    df = spark.createDataFrame([(key, "http://a.b/" + "porn" * 50000), (3, "x")], "page_id long, url string")
    assert {r.page_id for r in urls.judge(df).collect()} == {key, 3}
