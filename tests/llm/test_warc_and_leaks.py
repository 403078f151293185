import os
import random

import pytest

from gleaner.llm import decontam, warc
from gleaner.sources.files import scratch_dir

LONG = "z" * 200
PAGES = [
    (1, "http://a", LONG), (1, "http://b", LONG), (2, None, LONG), (None, "http://c", LONG), (3, "u\r\nv", None), (4, "", ""),
    (5, "q", "short"), (6, "q", "short"), (-7, "é", "日本" * 100000), (9, "q", "z" * 99), (10, "q", "z" * 99), (11, "q", "z" * 100), (12, "q", "z" * 100),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string")


def written(spark, df, **sizes):
    return warc.write(df, scratch_dir(spark, "warc-test"), **sizes)


def test_round_trip(spark, pages):
    rows = warc.read(spark, written(spark, pages)).collect()
    assert len(rows) == len(PAGES)
    by_id = {(r.page_id, r.url): r for r in rows}
    assert {k: r.refers_to for k, r in by_id.items() if r.record_type == "revisit"} == {(2, None): 1, (None, "http://c"): 1, (12, "q"): 11}
    for page_id, url, html in PAGES:
        r = by_id[page_id, url if url is None else url.replace("\r", "%0D").replace("\n", "%0A")]
        assert r.payload_bytes == len((html or "").encode())
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or bytes(r.payload) == (html or "").encode())
    assert warc.read(spark, written(spark, pages.limit(0))).count() == 0


def test_same_bytes_whatever_the_partitions(spark, pages):
    listed = lambda m: sorted((os.path.basename(r.path), r.records, r.sha256) for r in m.collect())
    a = listed(written(spark, pages, shard_bytes=1000, roll_bytes=300))
    assert a == listed(written(spark, pages.repartition(5), shard_bytes=1000, roll_bytes=300)) and len(a) > 5
    assert sum(n for _, n, _ in a) == len(PAGES)


def test_damage_is_found(spark, pages):
    manifest = written(spark, pages)
    path = manifest.first().path.removeprefix("file:")
    with open(path, "r+b") as file:
        file.seek(40)
        file.write(b"?")
    with pytest.raises(Exception, match="damaged"):
        warc.read(spark, manifest).collect()


ITEMS = [
    (1, "If Tom buys 3 apples for 5 dollars and Mary buys 7 pears, how many does Tom have?"), (2, "Short one."), (3, None),
    (4, "Seven words are enough for one item"),
]
DOCS = [
    (1, "Well. If Anna buys 9 apples for 11 euros and Bob buys 12 pears, how many does Anna have? Yes", True),
    (2, "If Anna buys 9 apples for 11 euros and Bob buys 12 pears, how many does Bob have?", False),
    (3, None, False), (4, "", False),
    (5, "if tom buys 3 apples for 5 dollars and mary buys 7 pears , how many does tom have", True),
    (6, "If Tom buys 9 apples for 9 dollars and Mary buys 7 pears, how many does Tom have?", True),
    (7, "x " * 30000 + ITEMS[0][1], True), (8, "they said: seven WORDS are enough, for one item!", True), (9, "7 7 7 7 7 7 7 7 7 7 7 7", False),
    (None, ITEMS[0][1], True),
]


def test_templates(spark):
    docs = spark.createDataFrame([(i, t, "k") for i, t, _ in DOCS] + [(5, DOCS[4][1], "k")], "doc_id long, text string, k string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, items).collect()}
    assert {k for k, _ in found} == {i for i, _, leak in DOCS if leak}
    assert found[7, 1].verbatim and not found[1, 1].verbatim and found[8, 4].n_windows == 1
    assert {r.doc_id for r in decontam.decontaminate(docs, items).collect()} == {None, 2, 3, 4, 9}
    assert decontam.matches(docs.limit(0), items).count() == 0 == decontam.matches(docs, items.limit(0)).count()


LONG_ITEM = (
    "If Tom buys 3 apples for 5 dollars and later sells them at the old market near the river to people who pass by there every "
    "single morning on their way to work, then what is the whole profit that our friend Tom makes after 7 long days?"
)


def test_a_conflict_removes_only_its_windows(spark):
    texts = {
        1: LONG_ITEM.replace("friend Tom", "friend Bob"),  # one of two uses changed, the rest word for word
        2: LONG_ITEM.replace("3 apples for 5", "9 apples for 9"),  # two values became equal
        3: LONG_ITEM.replace("3 apples for 5", "9 apples for 9").replace("7 long", "4 long").replace("Tom", "Ann"),
        4: " ".join(LONG_ITEM.replace("3 apples for 5", "9 apples for 9").split()[:17]),  # in few words as well
        5: " ".join(LONG_ITEM.replace("friend Tom", "friend Bob").split()[-17:]).replace("7 long days", "7 long days, 7 of 9"),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, LONG_ITEM), (2, LONG_ITEM.replace("7 long", "5 long"))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.verbatim for r in decontam.matches(docs, items).collect()}
    assert {d for d, i in found if i == 1} == {1, 2, 3, 4, 5} and not found[2, 1]
    # equal values of the item that became different ones
    assert {d for d, i in found if i == 2} >= {1, 3}


def test_exact_copies_of_every_item(spark):
    items = {
        1: "12 + 15 = 27, 30 - 4 = 26, 8 * 9 = 72, 5 + 6 = 11, 90 / 3 = 30", 2: "6 * 7 = 42", 3: "Name the capital.", 4: "km 5 7 9 m 3 4",
        5: "5 km 3 kg 2 m 9 g and 7", 6: "What is 3 + 4 * 5 - 6 / 2 + 8, Tom?",
    }
    docs = {i: f"Some words first {i} then: {t} And more after that." for i, t in items.items()}
    docs |= {11: items[1].replace("26", "27").replace("11", "12").replace("72", "71"), 12: "6 * 7 = 43", 13: "the capital name"}
    frame = lambda d, key: spark.createDataFrame(list(d.items()), f"{key} long, text string")
    found = decontam.matches(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(i, i) for i in items}
    assert not {r.doc_id for r in found} & {11, 12, 13}


def test_items_of_one_word_are_sentences_of_their_own(spark):
    docs = {
        1: "I went to Paris last year.", 2: "Where? Paris. Yes", 3: "Paris", 4: "paris, of course", 5: "In New York.", 6: "Where? New York!",
        7: "New York Times",
    }
    frame = lambda d, key: spark.createDataFrame(list(d.items()), f"{key} long, text string")
    found = decontam.matches(frame(docs, "doc_id"), frame({1: "Paris", 2: "New York"}, "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(2, 1), (3, 1), (6, 2)}


NAMES = ["Tom", "Anna", "Bob", "Mary"]


def plain_templates(text):
    """Windows of ten words of a text in which only numbers and the names above are parameters."""
    w = text.replace(",", "").replace(".", "").replace("?", "").split()
    kinds = ["#" if x.isdigit() else "@" if x in NAMES else x.lower() for x in w]
    return [(tuple(kinds[i : i + 10]), tuple(x for x, k in zip(w[i : i + 10], kinds[i : i + 10], strict=True) if k in "#@")) for i in range(len(w) - 9)]


def test_parameters_against_a_plain_version(spark):
    draw = random.Random(8)
    line = lambda n: " ".join(draw.choice("the cat sells red old fish near its river house while many buy".split()) for _ in range(n))
    items, docs, want = {}, {}, set()
    for i in range(12):
        parts = [line(4) for _ in range(4)]
        items[i] = f"so {parts[0]} {draw.randrange(50)} {parts[1]} Tom {parts[2]} {draw.randrange(50)} {parts[3]} end"
    for d in range(60):
        text = items[d % 12]
        for old in {x for x in text.split() if x.isdigit()}:
            text = " ".join(str(draw.randrange(3)) if x == old and d % 3 else x for x in text.split())
        text = text.replace("Tom", draw.choice(NAMES))
        if d % 5 == 0:
            text = line(30)
        docs[d] = f"{line(6)} {text} {line(6)}"
    for d, text in docs.items():
        held = plain_templates(text)
        for i, item in items.items():
            pooled = {}
            for at, (template, values) in enumerate(plain_templates(item)):
                for place, (other, found) in enumerate(held):
                    if other == template:
                        pooled.setdefault(place - at, set()).update(zip(values, found, strict=True))
            if any(len(pairs) == len({a for a, _ in pairs}) for pairs in pooled.values()):
                want.add((d, i))
    frame = lambda rows, key: spark.createDataFrame(list(rows.items()), f"{key} long, text string")
    found = decontam.matches(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) >= 35


def test_stretches():
    windows = [(0, {(1, 1)}), (1, {(1, 1), (2, 2)}), (2, {(2, 2)}), (3, {(2, 3)}), (5, set()), (6, {(2, 3)})]
    assert decontam.stretch(windows) == (3, {(1, 1), (2, 2)})
    assert decontam.stretch([(0, {(1, 2), (3, 2)}), (1, {(4, 2)})]) == (2, {(1, 2), (3, 2), (4, 2)})
    assert decontam.stretch([(0, {(1, 2), (1, 3)}), (1, {(1, 4)})]) == (1, {(1, 4)}) and decontam.stretch([]) == (0, set())


def test_every_planted_item(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [(r.item_id, r.text) for r in items.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in texts if t in (r.text or "")}
    assert {(r.doc_id, r.item_id) for r in decontam.matches(docs, items).collect()} == want
