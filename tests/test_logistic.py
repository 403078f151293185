import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gleaner.operators import learn, logistic


def table(spark, width, rows, seed=0):
    """Rows of few values, one column constant and one without values; labels that follow the values, not strictly."""
    random = np.random.default_rng(seed)
    weights, made = random.normal(size=width), []
    for _ in range(rows):
        slots = np.sort(random.choice(width - 2, 12, replace=False))
        values = random.exponential(size=12)
        label = int(random.random() < 1 / (1 + np.exp(-(weights[slots] @ values))))
        made.append((label, Vectors.sparse(width, [*map(int, slots), width - 1], [*map(float, values), 7.3])))
    return spark.createDataFrame(made, ["label", "features"]).repartition(3)


@pytest.mark.parametrize("penalty", [1e-7, 1e-2])
def test_blocks_fit_like_mllib(spark, monkeypatch, penalty):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    monkeypatch.setattr(logistic, "FEATURES", 17)
    monkeypatch.setattr(logistic, "CELLS", 200)
    monkeypatch.setattr(logistic, "WRITTEN", 4)
    df = table(spark, 60, 400).cache()
    estimator = LogisticRegression(maxIter=24, regParam=penalty, tol=1e-6)
    expected, model = estimator.fit(df), logistic.fit(estimator, df)
    assert not model.hasSummary
    assert np.allclose(model.coefficients.toArray(), expected.coefficients.toArray(), rtol=1e-6, atol=1e-8)
    assert model.intercept == pytest.approx(expected.intercept, rel=1e-6)
    assert model.extractParamMap() == expected.extractParamMap() and model.uid == expected.uid
    assert logistic.fit(estimator, df).coefficients.toArray() == pytest.approx(model.coefficients.toArray(), rel=1e-9)


def test_line_search_lowers_a_steep_loss(spark, monkeypatch):
    """Rows of one label and far apart: the first steps are too long or too short and the search has to zoom."""
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    rows = [(int(n % 7 == 0), Vectors.dense([float(n % 7 == 0) * 1e4 + n % 3, float(n % 5), float(n) ** 3])) for n in range(70)]
    df = spark.createDataFrame(rows, ["label", "features"])
    estimator = LogisticRegression(maxIter=25, regParam=1e-7)
    expected, model = estimator.fit(df), logistic.fit(estimator, df)
    assert np.allclose(model.coefficients.toArray(), expected.coefficients.toArray(), rtol=1e-4)


def test_other_jobs_are_left_to_mllib(spark, monkeypatch):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    df = table(spark, 20, 50)
    three = df.withColumn("label", F.col("label") + (F.rand(1) > 0.5).cast("int"))
    assert logistic.fit(LogisticRegression(maxIter=2), three).numClasses == 3
    assert logistic.fit(LogisticRegression(maxIter=2, elasticNetParam=0.5, regParam=0.1), df).hasSummary
    one = df.withColumn("label", F.lit(1))
    assert logistic.fit(LogisticRegression(maxIter=2), one).intercept == float("inf")


def test_gradients_of_many_features_do_not_reach_the_driver(spark, tmp_path):
    """40 000 weights and 300 steps are 96 MB of gradients in MLlib's fit, which leaves a summary."""
    df = table(spark, 40_000, 60).withColumnRenamed("features", "cells")
    regression = LogisticRegression(featuresCol="features", labelCol="label", predictionCol="predictions", maxIter=300, regParam=1e-2)
    stages = [VectorAssembler(inputCols=["cells"], outputCol="features"), regression]
    model, expected = learn.StagedPipeline(stages=stages).fit(df), Pipeline(stages=stages).fit(df)
    assert not model.stages[-1].hasSummary and expected.stages[-1].hasSummary
    assert np.allclose(model.stages[-1].coefficients.toArray(), expected.stages[-1].coefficients.toArray(), rtol=1e-4, atol=1e-6)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = type(model).load(str(tmp_path / "model")).transform(df).select("predictions").collect()
    assert again == model.transform(df).select("predictions").collect()


def test_tuned_model_of_blocks_is_saved_and_scores_alike(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    rows = [(n, f"item {'great lovely' if n % 2 else 'awful poor'} number{n % 5}", n % 2, float(n % 7), "en" if n % 3 else "fr") for n in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, label int, size double, lang string")
    tuner = learn.tuned_text_classifier("label", ["size"], ["lang"], 1, max_iter=3, min_documents=(2.0, 40.0))
    model = learn.fit_on_text(tuner, df)
    assert not model.stages[-1].bestModel.stages[-1].hasSummary
    tuner.write().overwrite().save(str(tmp_path / "tuner"))
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    first, second = (m.transform(df).select("id", "predictions", "probability").orderBy("id").collect() for m in (model, again))
    assert first == second and [r["predictions"] for r in first] == [float(n % 2) for n in range(60)]


def jobs_of(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        return work(), len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def odd_rows(spark):
    """Sparse and dense rows side by side, some without values."""
    df = table(spark, 60, 300)
    random = np.random.default_rng(3)
    more = [(int(n % 3 == 0), Vectors.dense(*random.normal(size=60) * (random.random(60) < 0.2))) for n in range(60)]
    more += [(n % 2, Vectors.sparse(60, [], [])) for n in range(20)]
    return df.union(spark.createDataFrame(more, ["label", "features"])).repartition(5).cache()


@pytest.mark.parametrize("way", ["task", "files", "shuffles"])
def test_each_way_fits_like_mllib(spark, monkeypatch, tmp_path, way):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    monkeypatch.setattr(logistic, "FEATURES", 17)
    monkeypatch.setattr(logistic, "CELLS", 200)
    monkeypatch.setattr(logistic, "FILE_CELLS", 300)
    monkeypatch.setattr(logistic, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    if way != "task":
        monkeypatch.setattr(logistic, "TASK_CELLS", 0)
    if way == "shuffles":
        monkeypatch.setattr(logistic, "mounted", lambda *_: None)
    df = odd_rows(spark)
    estimator = LogisticRegression(maxIter=20, regParam=1e-4, tol=1e-6)
    expected, model = estimator.fit(df), logistic.fit(estimator, df)
    assert not model.hasSummary
    assert np.allclose(model.coefficients.toArray(), expected.coefficients.toArray(), rtol=1e-6, atol=1e-8)
    assert model.intercept == pytest.approx(expected.intercept, rel=1e-6)
    assert list(tmp_path.iterdir()) == []


def test_files_of_an_evaluation_go_with_it(spark, monkeypatch, tmp_path):
    """Rows stay, and of weights and images no more than the last steps need."""
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    monkeypatch.setattr(logistic, "TASK_CELLS", 0)
    monkeypatch.setattr(logistic, "FEATURES", 30)
    monkeypatch.setattr(logistic, "FILE_CELLS", 500)
    monkeypatch.setattr(logistic, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    held, taken = [], logistic.InFiles.taken
    monkeypatch.setattr(logistic.InFiles, "taken", lambda self, point, done: held.append({p.name for p in tmp_path.glob("*/*")}) or taken(self, point, done))
    logistic.fit(LogisticRegression(maxIter=25, regParam=1e-7), table(spark, 60, 400))
    assert len(held) == 25 and not any(name.startswith("pull") for name in held[-1])
    assert max(len({n.split("-")[1] for n in names if n.startswith("weights")}) for names in held) <= logistic.HISTORY + 2
    assert {n for n in held[0] if n.startswith("rows")} == {n for n in held[-1] if n.startswith("rows")}


def test_a_small_fit_costs_no_job_per_step(spark, monkeypatch):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    df = table(spark, 60, 400).cache()
    estimator = LogisticRegression(maxIter=24, regParam=1e-7)
    model, jobs = jobs_of(spark, "small-fit", lambda: logistic.fit(estimator, df))
    assert not model.hasSummary and jobs <= 8
    assert logistic.fit(estimator, df).coefficients == model.coefficients


def test_a_step_in_files_is_two_jobs_of_a_stage(spark, monkeypatch):
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    monkeypatch.setattr(logistic, "TASK_CELLS", 0)
    monkeypatch.setattr(logistic, "FILE_CELLS", 500)
    searches, minimised = [], logistic.Search.minimised
    monkeypatch.setattr(logistic.Search, "minimised", lambda self: searches.append(self) or minimised(self))
    df = table(spark, 60, 400).cache()
    estimator = LogisticRegression(maxIter=24, regParam=1e-7)
    _, jobs = jobs_of(spark, "files-fit", lambda: logistic.fit(estimator, df))
    assert type(searches[0].work) is logistic.InFiles and searches[0].steps == 24
    sc = spark.sparkContext
    ids = sc.statusTracker().getJobIdsForGroup("files-fit")
    stages = [len(info.stageIds) for info in map(sc.statusTracker().getJobInfo, ids) if info]
    assert jobs - 2 * (searches[0].work.number + 1) <= 8 and sorted(stages)[len(stages) // 2] == 1


def test_tuned_model_of_a_wide_table_takes_no_job_per_step(spark, tmp_path):
    """A model that is tuned, saved, loaded and scored, over the terms that MLlib would send gradients of: as many jobs with ten
    times the steps."""
    df = spark.range(120).selectExpr(
        "id", "CAST(id % 2 AS INT) AS label", "CAST(id % 7 AS DOUBLE) AS size", "if(id % 3 = 0, 'fr', 'en') AS lang",
        "concat(if(id % 2 = 0, 'awful poor ', 'great lovely '), array_join(transform(sequence(0, 799), k -> concat('t', (id * 400 + k) % 48000)), ' ')) AS text",
    )

    def work(steps):
        tuner = learn.tuned_text_classifier("label", ["size"], ["lang"], 1, max_iter=steps, min_documents=(1.0, 1.5))
        model = learn.fit_on_text(tuner, df)
        path = f"{tmp_path}/model-{steps}"
        model.write().overwrite().save(path)
        scored = model.transform(df).withColumnRenamed("predictions", "first").select("id", "text", "size", "lang", "first")
        same = PipelineModel.load(path).transform(scored).filter("first = predictions").count()
        return model.stages[-1].bestModel.stages[-1], same

    (few, same_few), few_jobs = jobs_of(spark, "few-steps", lambda: work(60))
    (many, same_many), many_jobs = jobs_of(spark, "many-steps", lambda: work(600))
    assert few.numFeatures > 40_000 and not few.hasSummary and not many.hasSummary
    assert same_few == same_many == 120 and many_jobs <= few_jobs + 5 and few_jobs < 200


def test_fits_side_by_side_keep_their_files_apart(spark, monkeypatch, tmp_path):
    """Two candidates at a time, each in files of its own: the scores of one after the other."""
    monkeypatch.setattr(logistic, "DRIVER_BYTES", 0)
    monkeypatch.setattr(logistic, "TASK_CELLS", 0)
    monkeypatch.setattr(logistic, "FILE_CELLS", 300)
    rows = [(n, f"item {'great lovely' if n % 2 else 'awful poor'} number{n % 5}", n % 2, float(n % 7), "en" if n % 3 else "fr") for n in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, label int, size double, lang string")
    tokens = learn.clean_tokens(df).drop("text", "tokens").cache()
    tuner = learn.tuned_text_classifier("label", ["size"], ["lang"], 1, max_iter=4, min_documents=(2.0, 40.0))
    both, single = tuner.fit(tokens), tuner.copy({tuner.parallelism: 1}).fit(tokens)
    assert tuner.getParallelism() == 2 and both.validationMetrics == single.validationMetrics
    # terms of equal counts have no fixed order
    weights = [dict(zip(m.bestModel.stages[0].vocabulary, m.bestModel.stages[-1].coefficients.toArray())) for m in (both, single)]
    assert weights[0] == pytest.approx(weights[1], rel=1e-6, abs=1e-9)
