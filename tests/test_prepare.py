import json

from pyspark.sql import functions as F

from gleaner.operators import prepare, profile
from gleaner.sources import files

COLUMNS = (
    "project_id string, name string, descr string, keywords string, goal string, deadline string, "
    "state_changed_at string, created_at string, launched_at string, backers_count string, "
    "disable_communication string, country string, currency string, final_status string"
)
MIDNIGHT = 1_400_025_600  # 2014-05-14 00:00:00 UTC


def campaign(n, goal="100", country="US", currency="USD", status="1", descr="Some Text", launched=MIDNIGHT, **times):
    created = times.get("created", launched - 3_601)
    deadline = times.get("deadline", launched + 86_400)
    return (
        f"p{n}", "NAME", descr, "Key", goal, str(deadline), "0", str(created), str(launched), "1", "False",
        country, currency, status,
    )


def dirty(spark):
    rows = [
        campaign(1, goal="12.7"),
        campaign(2, goal="abc"),
        campaign(3, goal=None),
        campaign(4, goal="0"),
        campaign(5, goal="20000000000"),
        campaign(6, country="False", currency="GBP"),
        campaign(7, country=None, currency="USDOLLAR"),
        campaign(8, country="False", currency=None),
        campaign(9, created=MIDNIGHT + 5),  # launched before it was created
        campaign(10, deadline=MIDNIGHT - 90_000),  # ends before it starts
        campaign(11, launched=MIDNIGHT - 6, deadline=MIDNIGHT + 5, descr=None),  # 11 s across midnight
        campaign(12, status="2"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_prepare_campaigns(spark):
    rows = {r["project_id"]: r for r in prepare.prepare_campaigns(dirty(spark)).collect()}
    assert sorted(rows) == ["p1", "p11", "p6", "p7", "p8"]
    assert rows["p1"]["goal"] == 12
    assert rows["p1"]["hours_prepa"] == 1.0
    assert rows["p1"]["text"] == "name some text key"
    assert rows["p1"]["launched_at2"] == "2014-05-14 00:00:00"
    assert (rows["p6"]["country2"], rows["p6"]["currency2"]) == ("GBP", "GBP")
    assert (rows["p7"]["country2"], rows["p7"]["currency2"]) == ("unknown", "unknown")
    assert (rows["p8"]["country2"], rows["p8"]["currency2"]) == ("unknown", "unknown")
    assert rows["p11"]["days_campaign"] == 1
    assert rows["p11"]["text"] == "name key"


def test_prepare_on_a_stream(spark, tmp_path):
    """The same operator on a streaming scan: it keeps no state."""
    source = str(tmp_path / "in")
    dirty(spark).write.parquet(source)
    stream = prepare.prepare_campaigns(spark.readStream.schema(COLUMNS).parquet(source))
    running = stream.writeStream.format("memory").queryName("prepared").outputMode("append").start()
    running.processAllAvailable()
    running.stop()
    assert spark.table("prepared").count() == 5


def test_labels(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "label string, n int")
    assert [tuple(r) for r in prepare.cross_section(df, "label", "a").collect()] == [(1,)]
    assert {r["n"] for r in prepare.drop_label(df, "label", "a").collect()} == {2, 3}


def test_append_pages(spark):
    left = spark.createDataFrame([(1, "x")], "id int, a string")
    right = spark.createDataFrame([(2.5, 2)], "b double, id int")
    rows = prepare.append_pages(left, right).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, 2.5)]


def test_split_is_a_partition(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    first, second = prepare.split_rows(df, "k", 0.7, seed=100)
    assert first.count() + second.count() == 10_000
    assert first.intersect(second).count() == 0
    assert abs(first.count() / 10_000 - 0.7) < 0.02
    assert abs(prepare.sample_rows(df, "k", 0.1, seed=1).count() / 10_000 - 0.1) < 0.02


def test_numeric_columns_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (2, 4.0, None)], "i int, d double, s string")
    assert prepare.numeric_columns(df) == ["i", "d"]
    row = profile.describe(df, ["d"]).first()
    assert (row["n"], row["mean"], row["stddev"], row["min"], row["max"]) == (2, 3.0, 1.4142, 2.0, 4.0)
    assert tuple(profile.shape(df).first()) == (2, 3)


def test_csv_files(spark, tmp_path):
    df = spark.createDataFrame([("a,\"b\"", "nc"), (None, "2")], "s string, n string")
    path = str(tmp_path / "c")
    files.write_csv(df, path, one_file=True)
    assert len(list((tmp_path / "c").glob("part-*"))) == 1
    back = files.read_csv(spark, path, schema="s string, n int", null_marker="nc")
    assert {tuple(r) for r in back.collect()} == {('a,"b"', None), (None, 2)}
    assert files.read_csv(spark, path).dtypes == [("s", "string"), ("n", "string")]


def test_text_files(spark, tmp_path):
    (tmp_path / "t.txt").write_text("We are\nnot what\r\n\n  -- we")
    path = str(tmp_path / "t.txt")
    assert [r[0] for r in files.read_lines(spark, path).collect()] == ["We are", "not what", "", "  -- we"]
    assert files.read_whole_texts(spark, path).first()[0] == "We are\nnot what\r\n\n  -- we"


def test_scratch_needs_a_shared_folder(spark):
    path = files.scratch_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir", "/tmp").rstrip("/"))
    assert path != files.scratch_dir(spark, "x")


def test_json_fixture(spark):
    from gleaner.operators.webpages import flattened_payloads

    answer = {
        "nhits": 1, "parameters": {},
        "records": [{"recordid": "r", "fields": {"nombre_de_reservations": 1094, "auteur": "Author, A"}, "record_timestamp": "t"}],
    }
    given = [(1, json.dumps(answer)), (2, '{"records": []}'), (3, '{"records": ['), (4, "{}"), (5, None)]
    df = spark.createDataFrame(given, "payload_id int, payload string")
    assert [tuple(r) for r in flattened_payloads(df).collect()] == [(1, 1094, "Author, A", "t")]


def test_pages_fixture(spark):
    from gleaner.operators import webpages

    pages = spark.createDataFrame(
        [
            (1, '<table><tbody><tr><td>login (user name)</td></tr><tr><td>b<table><tr><td>c</td></tr></table></td></tr></tbody></table>'),
            (2, "<p>no table</p>"),
            (3, None),
        ],
        "id int, html string",
    )
    rows = webpages.table_rows(webpages.page_sources(pages), "id").select("id", "pos", webpages.cell_text(F.col("row"), 0))
    assert [tuple(r) for r in rows.orderBy("id", "pos").collect()] == [(1, 0, "login (user name)"), (1, 1, "bc")]


def test_rows_of_tables_are_cut_after_the_pages_are_spread(spark):
    from gleaner.operators import webpages

    pages = spark.range(40).selectExpr("id", "concat('<table><tbody><tr><td>a', id, '</td></tr><tr></tr></tbody></table>') AS html")
    rows = webpages.table_rows(pages.repartition(4, "id"), "id", first=1)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    scan = plan[plan.index("RepartitionByExpression"):]
    assert "aggregate(" not in scan and "aggregate(" in plan and "Filter" not in plan
    assert {tuple(r) for r in rows.collect()} == {(n, 0, f"<td>a{n}</td>") for n in range(40)}


def test_fields_of_unknown_json(spark):
    from gleaner.operators import webpages

    given = [(1, '{"a": [1, {"b": "x"}], "c": null, "d": {"b": 1.5}}'), (2, "[]"), (3, "{"), (4, None), (5, "7"), (6, '[[true]]')]
    df = spark.createDataFrame(given, "id int, body string")
    got = sorted((r["id"], r["path"], r["kind"]) for r in webpages.json_fields(df, "body", "id").select("id", "path", "kind").collect())
    assert got == [
        (1, "$", "OBJECT"), (1, "$.a", "ARRAY"), (1, "$.a[]", "BIGINT"), (1, "$.a[]", "OBJECT"), (1, "$.a[].b", "STRING"),
        (1, "$.c", "VOID"), (1, "$.d", "OBJECT"), (1, "$.d.b", "DECIMAL"), (2, "$", "ARRAY"), (5, "$", "BIGINT"),
        (6, "$", "ARRAY"), (6, "$[]", "ARRAY"), (6, "$[][]", "BOOLEAN"),
    ]


def test_sketches_of_parts_are_united(spark):
    from gleaner.operators import profile

    df = spark.range(60000).selectExpr("id % 7 AS part", "id % 20011 AS x", "cast(id AS double) AS v")
    parts = profile.distinct_sketches(df, "x", "part")
    estimate = profile.united_distinct(parts).first()["estimate"]
    assert parts.count() == 7 and abs(estimate - 20011) <= 20011 * profile.HLL_ERROR
    found = profile.united_quantile(profile.quantile_sketches(df, "v", "part"), 0.25).first()
    assert found["n"] == 60000 and abs(found["estimate"] / 60000 - 0.25) <= profile.KLL_ERROR
