import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import functions as F

from gleaner.operators import learn
from gleaner.plans.learning import STOP_WORDS


def reviews(spark):
    rows = []
    for n in range(60):
        good = n % 2
        words = "great lovely superb" if good else "awful broken poor"
        rows.append((n, f"The item {words} number{n % 5}", good, float(n % 7), "en" if n % 3 else "fr"))
    return spark.createDataFrame(rows, "id int, text string, label int, size double, lang string")


def test_stop_words_of_the_check_are_those_of_the_stage(spark):
    assert sorted(STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_tokens(spark):
    df = spark.createDataFrame([("The été's Big-Boat",)], "text string")
    row = learn.clean_tokens(df).first()
    assert row["tokens"] == ["the", "t", "s", "big", "boat"]
    assert row["tokens_clean"] == ["big", "boat"]


def test_vocabulary(spark):
    terms = {r["term"]: r for r in learn.vocabulary(learn.clean_tokens(reviews(spark)), 20.0).collect()}
    assert set(terms) == {"item", "great", "lovely", "superb", "awful", "broken", "poor"}
    assert terms["great"]["df"] == 30
    assert terms["great"]["idf"] == pytest.approx(np.log(61 / 31))


def test_categories(spark):
    df = spark.createDataFrame([(c,) for c in ["US", "US", "FR", "BE"]], "c string")
    indexed = {r["c"]: r["c_index"] for r in learn.indexed_categories(df, "c").collect()}
    assert indexed == {"US": 0.0, "BE": 1.0, "FR": 2.0}
    onehot = {r["c"]: list(r["c_onehot"].toArray()) for r in learn.one_hot(df, "c").collect()}
    assert onehot == {"US": [1.0, 0.0], "BE": [0.0, 1.0], "FR": [0.0, 0.0]}


@pytest.mark.parametrize("compat", [False, True])
def test_text_classifier(spark, compat):
    df = reviews(spark)
    stages, _, _ = learn.text_classifier("label", ["size"], ["lang"], max_iter=10, min_df=2.0, compat_indexed=compat)
    scored = learn.fit_on_text(stages, df).transform(df)
    assert learn.f1_evaluator("label").evaluate(scored) == 1.0
    assert sum(r["n"] for r in learn.confusion(scored, "label", "predictions").collect()) == 60


def test_defaults_of_the_classifier():
    assert learn.MAX_ITERATIONS == 300 and learn.TRAIN_RATIO == 0.7


def test_tuning(spark):
    df = reviews(spark)
    tuner = learn.tuned_text_classifier("label", ["size"], ["lang"], 1, max_iter=5, min_documents=(2.0, 40.0))
    tuned = learn.fit_on_text(tuner, df).stages[-1]
    params = {r["param"]: r["value"] for r in learn.chosen_params(spark, tuned, tuned.validationMetrics).collect()}
    assert params["LogisticRegressionModel.regParam"] == "1e-07" and params["LogisticRegressionModel.maxIter"] == "5"
    assert params["CountVectorizerModel.minDF"] == "2.0"
    assert float(params["score_0"]) == 1.0 > float(params["score_1"])


def blobs(spark, n=150):
    rng = np.random.default_rng(5)
    rows = [(k, Vectors.dense([float(x) for x in rng.normal(loc=3 * (k % 3), size=4)]), float(k % 3)) for k in range(n)]
    return spark.createDataFrame(rows, ["id", "features", "label"])


def test_trees(spark):
    df = blobs(spark)
    accuracy = learn.f1_evaluator("label", "prediction", "accuracy")
    tree = learn.decision_tree("label").fit(df)
    assert accuracy.evaluate(tree.transform(df)) == 1.0
    assert tree.getMaxDepth() == 30 and tree.getMaxBins() == 45 and tree.getImpurity() == "entropy"
    assert accuracy.evaluate(learn.random_forest("label", numTrees=5).fit(df).transform(df)) > 0.9


def test_components_are_tuned(spark):
    df = blobs(spark)
    estimator, components = learn.component_tree("label", maxDepth=3)
    grid = learn.ParamGridBuilder().addGrid(components.k, [1, 2]).build()
    evaluator = learn.f1_evaluator("label", "prediction", "accuracy")
    model = learn.cross_validated(estimator, grid, evaluator, folds=3, seed=1).fit(df)
    params = {r["param"]: r["value"] for r in learn.chosen_params(spark, model, model.avgMetrics).collect()}
    assert params["PCAModel.k"] in ("1", "2") and float(params["score_0"]) > 0.9


def test_metrics_by_hand(spark):
    pairs = [(1.0, 1.0)] * 3 + [(1.0, 0.0)] + [(0.0, 0.0)] * 4 + [(0.0, 1.0)] * 2
    df = spark.createDataFrame(pairs, "label double, predictions double")
    got = {r["metric"]: r["value"] for r in learn.metrics(df, "label", "predictions").collect()}
    f1 = 0.4 * (6 / 9) + 0.6 * (8 / 11)
    assert got == pytest.approx({"f1": f1, "accuracy": 0.7})


def test_components(spark):
    df = blobs(spark)
    data = np.array([r["features"].toArray() for r in df.orderBy("id").collect()])
    got = np.array([r["components"] for r in learn.projected(df, 2).orderBy("id").collect()])
    _, vectors = np.linalg.eigh(np.cov(data.T))
    expected = data @ vectors[:, ::-1][:, :2]
    for n in range(2):  # the sign of a component is arbitrary
        assert np.abs(got[:, n]) == pytest.approx(np.abs(expected[:, n]), abs=1e-8)


def test_vectors_from_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "embedding array<float>")
    assert learn.with_vector(df, "embedding").select(F.col("features")).first()[0] == Vectors.dense([1.0, 2.0])


def test_vocabulary_has_no_cap(spark):
    rows = spark.range(300_000).selectExpr("array(concat('t', id), 'both') AS tokens_clean")
    found = learn.vocabulary(rows.union(rows), 2.0)
    assert found.count() == 300_001 and found.filter("term = 'both'").first()["df"] == 600_000
    assert learn.vocabulary(rows.union(rows), 0.5).count() == 1


def test_a_loaded_tuner_fits_as_the_saved_one(spark, tmp_path):
    df = reviews(spark)
    tokens = learn.clean_tokens(df).drop("text", "tokens")
    tuner = learn.tuned_text_classifier("label", ["size"], ["lang"], 1, max_iter=3, min_documents=(2.0, 40.0))
    tuner.write().save(str(tmp_path / "tuner"))
    loaded = TrainValidationSplit.load(str(tmp_path / "tuner"))
    assert type(loaded.getEstimator()) is learn.StagedPipeline and loaded.getTrainRatio() == tuner.getTrainRatio()
    first, again = tuner.fit(tokens), loaded.fit(tokens)
    first.write().save(str(tmp_path / "tuned"))
    tuned = TrainValidationSplitModel.load(str(tmp_path / "tuned"))
    assert first.validationMetrics == pytest.approx(again.validationMetrics)
    assert first.validationMetrics == pytest.approx(tuned.validationMetrics)
    scores = [[r["predictions"] for r in m.transform(tokens).orderBy("id").collect()] for m in (first, again, tuned)]
    assert scores[0] == scores[1] == scores[2]


def test_a_staged_pipeline_is_saved_under_its_own_name(spark, tmp_path):
    pipeline, counts, _ = learn.text_classifier("label", ["size"], ["lang"], max_iter=3, min_df=2.0)
    pipeline.write().save(str(tmp_path / "pipeline"))
    loaded = learn.StagedPipeline.load(str(tmp_path / "pipeline"))
    assert loaded.uid == pipeline.uid and [s.uid for s in loaded.getStages()] == [s.uid for s in pipeline.getStages()]
    assert loaded.getStages()[0].getMinDF() == counts.getMinDF()


def test_folds_and_splits_follow_the_key(spark):
    df = spark.range(900).selectExpr("id", "id % 3 AS label")
    one, other = (learn.with_folds(df.repartition(n), "id", 5, 7) for n in (1, 13))
    assert sorted(one.collect()) == sorted(other.collect())
    sizes = [r["count"] for r in one.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and min(sizes) > 130
    assert learn.with_folds(df.selectExpr("CAST(null AS INT) AS id"), "id", 5, 7).select("fold").distinct().count() == 1


def test_scores_do_not_depend_on_partitions(spark):
    df = blobs(spark).withColumn("label", F.when(F.col("id") % 7 == 0, 1.0).otherwise(F.col("label")))
    tree = learn.decision_tree("label", maxDepth=4)
    grid = learn.ParamGridBuilder().addGrid(tree.maxDepth, [1, 4]).build()
    evaluator = learn.f1_evaluator("label", "prediction", "accuracy")
    scores = []
    for parts in (1, 7):
        rows = learn.with_folds(df.repartition(parts), "id", 3, 1)
        crossed = learn.cross_validated(tree, grid, evaluator, 3, 1, "fold").fit(rows)
        held = learn.tuned_on_held_out(tree, grid, evaluator, df.repartition(parts), "id", 0.7, 1)
        scores.append([*crossed.avgMetrics, *held.scores])
        assert held.bestModel.getMaxDepth() == 4
    assert scores[0] == pytest.approx(scores[1])


def test_a_classifier_on_three_hundred_thousand_terms(spark):
    n = 300_000
    rows = spark.range(3000).selectExpr("id AS key", "id % 2 AS label")
    tokens = rows.selectExpr(
        "key", "concat(transform(sequence(0, 99), k -> concat('t', key * 100 + k)), array(if(label = 1, 'yes', 'no'))) AS tokens_clean"
    )
    cells, terms = learn.term_cells(tokens, "key", 1.0)
    assert terms.count() == n + 2 and terms.agg(F.max("slot")).first()[0] == n + 1
    table = learn.sparse_rows(cells, rows, "key", "label", n + 2)
    assert table.first()["features"].size == n + 3
    model = LogisticRegression(maxIter=5, regParam=0.01).fit(table)
    keyed = learn.sparse_rows(cells, rows, "key", "key", n + 2)
    scored = model.transform(keyed).select(F.col("label").cast("long").alias("key"), "prediction").join(rows, "key")
    assert scored.filter("prediction = label").count() == 3000


def test_sparse_rows_without_cells(spark):
    rows = spark.createDataFrame([(1, 1.0), (2, 0.0)], "key long, label double")
    cells = spark.createDataFrame([(1, 0, 2.5), (1, 7, 1.0)], "key long, slot long, value double")
    got = {r["label"]: r["features"] for r in learn.sparse_rows(cells, rows, "key", "label", 8).collect()}
    assert list(got[1.0].toArray()) == [2.5, 0, 0, 0, 0, 0, 0, 1.0, 0] and not got[0.0].toArray().any()


def test_candidates_are_fitted_side_by_side_with_the_same_scores(spark):
    df = spark.createDataFrame([(Vectors.dense(n % 7, n % 3), float(n % 7 > 3)) for n in range(200)], ["features", "label"])
    tree = learn.decision_tree("label")
    grid = learn.ParamGridBuilder().addGrid(tree.maxDepth, [1, 2, 3]).build()
    tuner = learn.cross_validated(tree, grid, learn.f1_evaluator("label", "prediction", "accuracy"), 3, 1)
    assert tuner.getParallelism() > 1
    assert tuner.fit(df).avgMetrics == tuner.copy({tuner.parallelism: 1}).fit(df).avgMetrics


def test_rows_of_trees_are_dealt_out_in_bounded_parts(spark):
    df = spark.range(20_000).coalesce(1)
    parts = learn.dealt(df, "id", rows=1_000)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 1_300 and sum(sizes) == 20_000
    assert learn.dealt(df, "id").rdd.getNumPartitions() == 1


def test_held_out_search_decides_its_rows_once(spark):
    class Probe:
        seen = []

        def fitMultiple(self, train, grid):
            self.seen.append((train.storageLevel.useMemory, train.columns))
            return iter([(0, self)])

        def transform(self, held):
            self.seen.append((held.storageLevel.useMemory, held.columns))
            return held

        def fit(self, df, params):
            return self

        def evaluate(self, df):
            return 1.0

        def isLargerBetter(self):
            return True

    probe, df = Probe(), spark.range(100).withColumn("label", F.lit(1.0))
    assert learn.tuned_on_held_out(probe, [{}], probe, df, "id", 0.7, 1).scores == [1.0]
    assert probe.seen == [(True, ["label"])] * 2
