"""Known answers of the column expressions."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import html as H
from gleaner.functions import numbers, strings
from gleaner.functions.geodesy import distance_km


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def mapped(spark, values, expression):
    return [row[0] for row in texts(spark, values).select(expression(F.col("s"))).collect()]


def test_lenient_int(spark):
    given = ["12.7", "abc", None, "0", "20000000000", "1e3", " 8 ", "-3.9", "12.x", "5.", "", "NaN", "12.7.8"]
    assert mapped(spark, given, numbers.lenient_int) == [12, None, None, 0, None, None, 8, -3, None, 5, None, None, None]


def test_localised_numbers(spark):
    assert mapped(spark, ["4,081.25", " 7 ", "n/a"], numbers.millions) == [4081250000.0, 7000000.0, None]
    assert mapped(spark, ["3.04%", "-0.5%", "%"], numbers.percentage) == [3.04, -0.5, None]
    assert mapped(spark, ["1299€99", "1 299,99", "x"], numbers.shop_price) == [1299.99, 1299.99, None]
    assert mapped(spark, ["999,99€", "12€", "€"], numbers.marked_down_price) == [999.99, 12.0, None]


def test_ends_key(spark):
    assert mapped(spark, ["lantern", "Oboe", "q", "mud"], strings.ends_key) == ["larn", "Oboe", "", "muud"]


@pytest.mark.parametrize(
    "words,expected",
    [
        (["level", "tent", "ox", "o"], 2),
        (["", "k", "kk", "kek", "kea"], 2),
        (["Anna", "rotor", "oslo"], 2),
    ],
)
def test_same_ends(spark, words, expected):
    assert sum(mapped(spark, words, strings.same_ends)) == expected


def test_rewrite_span(spark):
    given = ["The plan was not all that bad, she said", "not bad", "The soup was not warm", "bad luck, not mine"]
    assert mapped(spark, given, lambda s: strings.rewrite_span(s, "not", "bad", "good")) == [
        "The plan was good, she said", "good", "The soup was not warm", "bad luck, not mine",
    ]


def test_login_and_name(spark):
    given = ["kiwi-7 (Ada Moss)", "zed (Zoë | 北)", "nobody"]
    assert mapped(spark, given, strings.login_of) == ["kiwi-7", "zed", "nobody"]
    assert mapped(spark, given, strings.full_name_of) == ["Ada Moss", "Zoë | 北", None]


def test_tokens(spark):
    given = ["a b  ", "", "   ", "A  b", "x\ty"]
    assert mapped(spark, given, strings.line_tokens) == [["a", "b"], [""], [], ["A", "", "b"], ["x\ty"]]
    assert mapped(spark, given, strings.space_tokens)[0] == ["a", "b", "", ""]
    assert mapped(spark, given, strings.word_tokens) == [["a", "b"], [], [], ["a", "b"], ["x", "y"]]


def test_word_lengths(spark):
    lengths = lambda s: F.transform(strings.space_tokens(s), F.length)
    assert mapped(spark, ["three blind mice", "a 22 c4c"], lengths) == [[5, 5, 4], [1, 2, 3]]


def test_slug_and_departments(spark):
    assert mapped(spark, [" Côte d'Or  "], strings.slug) == ["cote-d-or"]
    label = texts(spark, ["01 - Ain", "Alsace", "971 - Guadeloupe"])
    rows = label.select(*(c.alias(str(n)) for n, c in enumerate(strings.department_parts(F.col("s"))))).collect()
    assert [tuple(r) for r in rows] == [("01", "Ain"), (None, None), ("971", "Guadeloupe")]


def test_elements_by_class(spark):
    page = '<div class="hot price">1 <b>299</b>&amp;</div><span class="prices">no</span><p id="x" class="price">7</p>'
    assert mapped(spark, [page, None, "<p>none</p>"], lambda s: H.texts_by_class(s, "price")) == [["1 299&", "7"], None, []]


NESTED = [
    ('<div class="price">1<div>x</div>2</div>', ["1x2"]),
    ('<div class=price>1<br>2<div class="price">in<img/></div>3</div>z', ["12in3", "in"]),
    ("<p class=price>open<b>x", ["openx"]),
    ('<br class="price">z', [""]),
    ("<DIV class=price>a<!-- </div> -->b<script>\"</div>\"</script>c</div>d", ["abc"]),
    ('</div><div class="price">1</div></div>', ["1"]),
    ('<ul><li class="price">a<ul><li>b</li></ul></li><li class="price">c</ul>', ["ab", "c"]),
    ("<i class=price></i>" * 300, [""] * 300),
    ("<div class=price>" + "<div>" * 400 + "x" + "</div>" * 401 + "y", ["x"]),
    ("", []), (None, None),
]


def test_elements_end_at_their_own_tag(spark):
    got = mapped(spark, [page for page, _ in NESTED], lambda s: H.texts_by_class(s, "price"))
    assert got == [texts for _, texts in NESTED]


def test_outermost_elements(spark):
    page = "<table><tr><td>1<table><tr><td>in</td></tr></table>2</td><th>3</th></tr><tr/></table>"
    outer = mapped(spark, [page], lambda s: H.elements(s, H.tag("tr"), outermost=True))
    assert outer == [["<td>1<table><tr><td>in</td></tr></table>2</td><th>3</th>"]]
    assert len(mapped(spark, [page], lambda s: H.elements(s, H.tag("tr")))[0]) == 2


def test_blocks(spark):
    page = '<div class="module">a<div>deep</div></div><div class="module">b</div>'
    second = lambda s: H.nth_block(s, H.class_tag("module", "div"), 1)
    fifth = lambda s: H.nth_block(s, H.class_tag("module", "div"), 5)
    assert mapped(spark, [page], second) == ["b</div>"]
    assert mapped(spark, [page], fifth) == [None]


def points(spark, rows):
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    return [row[0] for row in frame.select(distance_km(*(F.col(c) for c in "abcd"))).collect()]


def test_distance(spark):
    there = (39.60669, -104.95849, 39.617794, -104.954917)
    got = points(spark, [there, (*there[2:], *there[:2]), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 1.0)])
    assert got[0] == pytest.approx(1.270454, abs=1e-6)
    assert got[1] == pytest.approx(got[0], abs=1e-9)
    assert got[2] == 0.0
    assert got[3] == pytest.approx(111.319491, abs=1e-5)  # one degree of the equator


def test_distance_without_answer(spark):
    # nearly antipodal points do not converge; missing coordinates have no distance
    assert points(spark, [(0.0, 0.0, 0.5, 179.7), (None, 0.0, 1.0, 1.0)]) == [None, None]


def test_links_in_any_form(spark):
    from gleaner.functions import html

    page = """<li class="a"><a id=x href='/one' rel="z">One <b>bold</b></a></li><p><A HREF=/two>Two</A> <a name="n">no</a>
        <a href="/three"
        >T</a></p>"""
    row = spark.createDataFrame([(page,)], "h string").select(html.link_items(F.col("h")).alias("x"), html.link_count(F.col("h")).alias("n")).first()
    assert [tuple(x) for x in row["x"]] == [("/one", "One bold"), ("/two", "Two"), ("/three", "T")] and row["n"] == 3


def test_classes_in_any_quotes(spark):
    from gleaner.functions import html

    page = "<span class='price'>1</span><span class=price>2</span><span class=\"a price b\">3</span><span class='prices'>4</span><i id=q class = 'x price'>5</i>"
    row = spark.createDataFrame([(page,)], "h string").select(html.texts_by_class(F.col("h"), "price").alias("x")).first()
    assert row["x"] == ["1", "2", "3", "5"]
