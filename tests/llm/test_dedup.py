import random

import pytest
from brute import components, shingles, substrings
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import lines, neardup
from gleaner.llm.components import components as connected
from gleaner.llm.fmindex import FMIndex
from gleaner.llm.substrings import deduplicated


def test_fm_index():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(60):
        n, s, cap = int(rng.integers(1, 60)), int(rng.integers(2, 5)), int(rng.integers(1, 8))
        text = np.append(rng.integers(0, s, n), 0)
        index = FMIndex(text, cap)
        sizes = rng.integers(0, 12, rng.integers(1, 6))
        queries = rng.integers(1, s + 1, sizes.sum())
        length, low, high = index.matching_statistics(queries, sizes)
        ends = np.cumsum(sizes)
        for e, z in zip(ends, sizes, strict=True):
            for i in range(e - z, e):
                places = lambda m: [j for j in range(n + 1 - m + 1) if (text[j : j + m] == queries[i : i + m]).all()]  # noqa: B023, E731
                best = max((m for m in range(1, min(cap, e - i) + 1) if places(m)), default=0)
                assert length[i] == best
                if best:
                    assert sorted(index.suffixes[low[i] : high[i]]) == places(best)


@pytest.mark.parametrize("width", [3, 7])
@pytest.mark.parametrize("often", [2, 10_000])
def test_substrings(spark, width, often):
    random.seed(width)
    rows = [(i % 17 if i % 23 else None, " ".join(random.choices("abc", k=random.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a " * 3000), (103, "a " * 3000), (3, "x y z"), (3, "x y z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int").coalesce(1)
    out = deduplicated(df, width, bundle_words=100, often=often).collect()
    got = [(r.doc_id, r.n_words, sum(s.last - s.first + 1 for s in r.spans), r.kept) for r in out]
    assert sorted(got, key=str) == sorted(substrings(rows, width), key=str)
    assert deduplicated(df.limit(0)).count() == 0


def lines_brute(rows, t):
    """Kept text by row; rows in order of (id, text), nulls first."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        all_ = (text or "").split("\n")
        worded = [(p, x.strip(" \t\x0b\x0c\r")) for p, x in enumerate(all_) if x.strip(" \t\x0b\x0c\r")]
        gone = set()
        for s in range(len(worded) - t + 1):
            key = tuple(x for _, x in worded[s : s + t])
            if key in seen:
                gone |= set(range(worded[s][0], worded[s + t - 1][0] + 1))
            seen.add(key)
        out[i, text] = text if not gone else "\n".join(x for p, x in enumerate(all_) if p not in gone)
    return out


@pytest.mark.parametrize(("t", "gram"), [(2, 1), (3, 2), (4, 2), (3, 1)])
def test_lines(spark, t, gram):
    random.seed(t)
    rows = [(i, "\n".join(random.choice(["a", "b", " a\t", "c d", "", " "]) for _ in range(random.randint(0, 12)))) for i in range(40)]
    rows += [(50, None), (51, ""), (None, "a\nb\nc d"), (52, "\n".join(f"l{i}" for i in range(5000))), (53, "\n".join(f"l{i}" for i in range(5000))), (1, rows[1][1])]
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], "doc_id long, text string, kept string, n int")
    want = lines_brute(rows, t)
    got = lines.marked(df, t, gram).select("doc_id", "text", F.col("line_dedup.kept").alias("k")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.k == want[r.doc_id, r.text], r
    plan = lines.marked(df, t, gram)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    left = {r.doc_id for r in lines.dedup(df, t, gram).collect()}
    assert {50, 51, 52} <= left and 53 not in left
    assert lines.dedup(df, t, gram).columns == df.columns and lines.dedup(df.limit(0)).count() == 0


def test_long_single_lines(spark):
    long, other, short = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("a", 51), ("b", 60), ("c", 50)))
    rows = [
        (1, f"first\n{long}\nlast"), (2, f"x\n\n {long}\t\ny"), (3, long), (4, other), (5, other), (6, f"{short}\nu"), (7, f"v\n{short}"),
        (8, f"p\n{other}\nq\n{other}"), (9, "d " * 51 + "\ne\n" + "d " * 51), (10, None), (11, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(rows) | {2: "x\n\ny", 8: "p\nq", 9: "d " * 51 + "\ne"}
    got = lines.dedup(df, long_words=lines.LONG_WORDS)
    assert {r.doc_id: r.text for r in got.collect()} == {k: v for k, v in want.items() if k not in (3, 5)}
    assert {r.doc_id: r.text for r in lines.dedup(df).collect()} == dict(rows)
    after = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_lines(spark, df.selectExpr("*", "0L AS n_chars"), "").collect()}
    assert after[2] == want[2] and 3 not in after and 5 not in after


def test_components(spark):
    random.seed(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90 + i) for i in range(9)] + [(random.randint(200, 400), random.randint(200, 400)) for _ in range(90)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = components({x: {x} for e in edges for x in e}, 101)
    for _ in edges:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == {k: v for k, v in want.items() if any(k in e and e[0] != e[1] for e in edges)}
    assert connected(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def noisy(base, share):
    return [w if random.random() > share else random.choice("mnopq") + str(random.randint(0, 999)) for w in base]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size, monkeypatch):
    random.seed(size)
    vocabulary = [f"v{i}" for i in range(400)]
    base = random.choices(vocabulary, k=120)
    rows = [(i, " ".join(noisy(base, random.choice([0.01, 0.03, 0.06])))) for i in range(150)]
    rows += [(200 + i, " ".join(random.choices(vocabulary, k=random.randint(0, 60)))) for i in range(60)]
    rows += [(300 + i, rows[i][1].upper()) for i in range(20)]
    rows += [(400, None), (401, ""), (402, "one"), (403, "ONE"), (404, "w " * 5000), (405, "w " * 4000)]
    sets = {i: s for i, t in rows if (s := shingles(t, size))}
    want = {i: i for i, _ in rows} | components(sets, 80)
    # parts and blocks so small that buckets and clusters are cut (the driver makes these expressions)
    monkeypatch.setattr(neardup, "PART", 16)
    monkeypatch.setattr(neardup, "BLOCK", 32)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, rep string")
    got = neardup.grouped(df, size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) and r.n_shingles == len(sets.get(r.doc_id, ())) for r in got)
    assert {r.doc_id for r in neardup.dedup(df, size).collect()} == set(want.values())


def test_near_duplicates_without_id_or_rows(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.kept) for r in neardup.grouped(df).collect()) == [("1", True), ("1", True), ("None", True), ("None", True)]
    assert neardup.grouped(df.limit(0)).count() == 0
