from pyspark.sql import functions as F

from gleaner.functions import strings
from gleaner.operators import words

LINES = ["a b  ", "", "   ", "A  b", "tab\there", "b b"]


def frame(spark):
    return spark.createDataFrame([(n, line) for n, line in enumerate(LINES)], "id int, line string")


def counts(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_counting_and_regrouping_agree(spark):
    df = frame(spark)
    direct = counts(words.count_words(df, strings.line_tokens(F.lower("line"))))
    regrouped = counts(words.regroup_lower(words.count_words(df, strings.line_tokens(F.col("line")))))
    assert direct == regrouped == {"a": 2, "b": 4, "": 2, "tab\there": 1}


def test_characters(spark):
    got = {r["ch"]: r["n"] for r in words.count_characters(frame(spark).filter("id in (0, 3)"), "line").collect()}
    assert got == {"a": 1, "A": 1, "b": 2, " ": 5}


def test_token_maps(spark):
    maps = words.token_maps(frame(spark), "id", strings.word_tokens(F.col("line")))
    assert {r["id"]: r["counts"] for r in maps.collect()}[5] == {"b": 2}


def test_priority_sort(spark):
    for given, expected in [
        (["pear", "x9", "fig", "x10", "x"], ["x", "x10", "x9", "fig", "pear"]),
        (["Xenon", "xylem", "oak", ""], ["xylem", "", "Xenon", "oak"]),
    ]:
        df = spark.createDataFrame([(w,) for w in given], "w string")
        assert [r[0] for r in words.priority_sorted(df, "w", "x").collect()] == expected


def test_sort_by_last(spark):
    for given, expected in [
        ([(40, 8), (5,), (0, 0, -1)], [(0, 0, -1), (5,), (40, 8)]),
        ([(6, 10), (9, 2, 4), (7, 11)], [(9, 2, 4), (6, 10), (7, 11)]),
    ]:
        df = spark.createDataFrame([(list(t),) for t in given], "t array<int>")
        assert [tuple(r[0]) for r in df.orderBy(F.element_at("t", -1)).collect()] == expected


def test_early_signal(spark):
    rows = [(k, n, v) for k, vs in {"x": [5, 7, 6, 9, 8], "y": [5, 6, 7, 8, 9, 9], "z": [9, 9, 9]}.items() for n, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    got = {r["k"]: r["flag"] for r in words.early_signal(df, "k", ["n"], F.col("v") == 9).collect()}
    assert got == {"x": True, "y": False, "z": False}


def test_early_signal_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = words.early_signal(df, "k", ["id"], F.col("id") == 1)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:]


def test_blocking_groups(spark):
    df = spark.createDataFrame([("spring",), ("spying",), ("other",)], "w string")
    assert [tuple(r) for r in words.blocking_groups(df, strings.ends_key(F.col("w"))).collect()] == [("spng", 2)]


def test_token_maps_move_counts_only(spark):
    maps = words.token_maps(frame(spark), "id", strings.word_tokens(F.col("line")))
    plan = maps._jdf.queryExecution().executedPlan().toString()
    # tokens are counted on both sides of the first exchange; no text and no array of tokens is sorted
    assert plan.count("Exchange") <= 2 and "partial_count" in plan and "sort_array" not in plan
    spread = frame(spark).repartition(3, "id")
    plan = words.token_maps(spread, "id", strings.word_tokens(F.col("line")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the one by which the rows were spread
    assert {r["id"]: r["counts"] for r in maps.collect()} == {
        0: {"a": 1, "b": 1}, 3: {"a": 1, "b": 1}, 4: {"tab": 1, "here": 1}, 5: {"b": 2},
    }


def test_tables_in_few_row_groups_are_spread(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from gleaner.sources.tables import Tables

    cores = spark.sparkContext.defaultParallelism
    rows = pa.table({"doc_id": list(range(40 * cores)), "text": [f"a b{n}" for n in range(40 * cores)]})
    held = lambda df: {r["p"]: r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for name, group in (("one", 40 * cores), ("many", 10)):
            (tmp_path / name).mkdir()
            pq.write_table(rows, tmp_path / name / "documents.parquet", row_group_size=group)
            bytes_ = (tmp_path / name / "documents.parquet").stat().st_size
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_ // (2 * cores)))
            tables = Tables(spark, str(tmp_path / name))
            assert tables["documents"].rdd.getNumPartitions() >= cores
            # one row group is read by one task, whatever the number of splits
            assert (len(held(tables["documents"])) == 1) == (name == "one")
            spread = tables.spread("documents", "doc_id")
            assert max(held(spread).values()) < 20 * cores and spread.count() == 40 * cores
            assert ("Exchange" in spread._jdf.queryExecution().executedPlan().toString()) == (name == "one")
            maps = words.token_maps(tables.spread("documents", "doc_id", keyed=True), "doc_id", strings.word_tokens(F.col("text")))
            assert maps._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
            assert maps.count() == 40 * cores
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
