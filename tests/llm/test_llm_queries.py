"""The registered queries against their SQL, and the pipeline stage by stage."""

import pytest
from brute import components, shingles

import corpus_pipeline
from gleaner.llm import ORACLES, QUERIES
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "EvalPython" not in text
    good, remark = compare(result, duck, name)
    assert good, remark


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, items = docs.columns, [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, docs, SF)
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.keys() <= before.keys()
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            assert all(labels.get(i) != 0 for i in after) and len(after) > 0.8 * len(before)
        if name == "near_duplicates":
            sets = {i: s for i, t in before.items() if (s := shingles(t, 5))}
            assert set(after) == set(({i: i for i in before} | components(sets, 80)).values())
        if name == "benchmark":
            assert set(after) == {i for i, t in before.items() if not any(x in (t or "") for x in items)}
        if name == "tokens":
            assert after == before
    assert corpus_pipeline.run(spark, SF).count() == len(after)


def test_pipeline_stages_on_odd_tables(spark):
    """Nulls in every column, empty, long and repeated texts, an empty table, and columns named as the operators'
    own: no stage fails, columns stay, and rows go only for their texts."""
    good = (
        "The man went to the river and looked at the boats that were on the water, and then he walked home to his house in the town. "
        "It was late, and the lamps of the street were lit when his wife saw him from the window and called the children."
    )
    names = ["doc_id", "text", "lang", "source", "n_chars", "_held", "_gone", "line_dedup", "row", "th", "d", "score", "kept", "words", "docs"]
    rows = [
        (None, good + " One."), (1, good), (1, good), (2, None), (3, ""), (4, good + "\n" + good.replace("river", "sea") * 300),
        (5, "x"), (None, None), (6, " \n\t "),
    ]
    kind = ", ".join(f"`{n}` {'long' if n in ('doc_id', 'n_chars') else 'string'}" for n in names)
    table = spark.createDataFrame([(i, t, *([None] * 3), *names[5:]) for i, t in rows], kind)
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == names and out.dtypes == docs.dtypes, name
            got = out.collect()
            assert all(r["docs"] == "docs" and r["line_dedup"] == "line_dedup" for r in got)
            if name == "near_duplicates":
                # one text of a group, by its id; rows without id, or without words, have no group
                assert len(got) == docs.count()
            if name == "benchmark":
                assert len(got) == docs.count()
            if name == "quality" and got:
                assert {r["doc_id"] for r in got} >= {1, None} and not {r["doc_id"] for r in got} & {2, 3, 6}
        done = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert sorted(r.text for r in done) == sorted(r.text or "" for r in docs.collect())
