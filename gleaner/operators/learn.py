"""MLlib feature stages, models, tuning and evaluation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    OneHotEncoder,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.operators import logistic
from gleaner.operators.prepare import split_rows
from gleaner.operators.ranks import numbered_rows
from gleaner.sources.files import scratch_dir, staged

# fixed values of the text classifier
TOKEN_GAPS = r"\W+"
TOLERANCE = 1.0e-6
MAX_ITERATIONS = 300
REGULARISATION = (10e-8,)
MIN_DOCUMENTS = (55.0, 75.0, 95.0)
TRAIN_RATIO = 0.7
# fixed values of the multi-class tree
COMPONENTS = (3, 10, 20, 30)
TREE = {"maxDepth": 30, "maxBins": 45, "impurity": "entropy"}
#: Rows that a task of a tree's fit holds: two hundred bytes each with twenty trees
TREE_ROWS = 500_000
#: Candidates that are fitted side by side: the many short jobs of a small tree leave most cores idle
PARALLEL_FITS = 4


def tokenizer() -> RegexTokenizer:
    return RegexTokenizer(pattern=TOKEN_GAPS, gaps=True, inputCol="text", outputCol="tokens")


def stop_word_remover() -> StopWordsRemover:
    return StopWordsRemover(inputCol="tokens", outputCol="tokens_clean")


def clean_tokens(df: DataFrame) -> DataFrame:
    """``tokens`` and ``tokens_clean`` next to the text."""
    return stop_word_remover().transform(tokenizer().transform(df))


def vocabulary(tokens: DataFrame, min_df: float) -> DataFrame:
    """(term, df, idf) of every term of ``tokens_clean`` in at least ``min_df`` rows, or in that
    share of them if it is below one. Counted where the rows are; nothing reaches the driver."""
    total = tokens.agg(F.count("*")).scalar()
    least = F.lit(min_df) if min_df >= 1 else total * F.lit(min_df)
    terms = tokens.select(F.explode(F.array_distinct("tokens_clean")).alias("term"))
    counted = terms.groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= least)
    return counted.select("term", "df", F.log((total + 1).cast("double") / (F.col("df") + 1)).alias("idf"))


def term_cells(tokens: DataFrame, key: str, min_df: float) -> tuple[DataFrame, DataFrame]:
    """Weights of terms for any number of terms: (key, slot, value) cells, value the count times the idf, and the
    terms with their slots, numbered in alphabetical order by ranges. ``tokens`` has a row per key."""
    terms = vocabulary(tokens, min_df).select(F.lit(0).alias("all"), "term", "idf")
    numbered = staged(numbered_rows(terms, "all", "term", name="slot").select("term", "idf", "slot"), "terms")
    counts = tokens.select(key, F.explode("tokens_clean").alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))
    cells = counts.join(numbered, "term").select(key, "slot", (F.col("n") * F.col("idf")).alias("value"))
    return cells, numbered


def sparse_rows(cells: DataFrame, rows: DataFrame, key: str, label: str, width: int) -> DataFrame:
    """(label, features) of every row, features a sparse vector of its cells, for any ``width``.

    Written and read in the text format of MLlib's own sparse source, so no row leaves the JVM and no vocabulary the
    cluster. ``label`` is numeric: a class to learn, or a number of the row to know it by when it is scored.
    """
    entry = F.struct("slot", F.concat((F.col("slot") + 1).cast("string"), F.lit(":"), F.col("value").cast("string")).alias("text"))
    lists = cells.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("cells"))
    full = rows.select(key, F.col(label).cast("double").cast("string").alias("label")).join(lists, key, "left")
    # a slot of its own beyond the last one keeps rows without cells in the format
    text = F.concat_ws(" ", "label", F.array_join(F.coalesce("cells.text", F.array().cast("array<string>")), " "), F.lit(f"{width + 1}:0.0"))
    path = scratch_dir(rows.sparkSession, "sparse")
    full.select(F.regexp_replace(text, " +", " ").alias("value")).write.text(path)
    return rows.sparkSession.read.format("libsvm").option("numFeatures", str(width + 1)).load(path)


def indexed_categories(df: DataFrame, name: str) -> DataFrame:
    """Categories with their index by falling frequency; equal counts in name order."""
    return _indexer(name).fit(df).transform(df)


def _indexer(name: str) -> StringIndexer:
    return StringIndexer(inputCol=name, outputCol=f"{name}_index", handleInvalid="skip")


def one_hot(df: DataFrame, name: str) -> DataFrame:
    """Adds ``<name>_onehot``, the last category all zeros."""
    encoder = OneHotEncoder(inputCol=f"{name}_index", outputCol=f"{name}_onehot")
    return Pipeline(stages=[_indexer(name), encoder]).fit(df).transform(df)


class StagedPipelineWriter(MLWriter):
    def __init__(self, instance: StagedPipeline):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, paramMap={})
        Pipeline(stages=self.instance.getStages()).write().save(f"{path}/stages")


class StagedPipelineReader(MLReader):
    def load(self, path: str) -> StagedPipeline:
        uid = DefaultParamsReader.loadMetadata(path, self.sparkSession)["uid"]
        return StagedPipeline(stages=Pipeline.load(f"{path}/stages").getStages())._resetUid(uid)


class StagedPipeline(Pipeline):
    """Fits like ``Pipeline``, but hands the last stage a written feature table.

    The assembled column names every feature in its metadata. Left in the lineage, those
    names travel with every task of every iteration of the last fit: 0.9 MB for 25 000
    terms, where the table without them made twenty iterations 2.6 times as fast.

    It is saved under its own name, alone or inside a tuner, so that what is loaded fits the same way.
    """

    def write(self) -> MLWriter:
        return StagedPipelineWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return StagedPipelineReader()

    @property
    def _to_java(self):
        # tuners save an estimator that has a form in the JVM as that form, here a plain pipeline
        raise AttributeError("a staged pipeline lives in Python")

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        *feature_stages, last = self.getStages()
        features = Pipeline(stages=feature_stages).fit(dataset)
        unnamed = F.col(last.getFeaturesCol()).alias(last.getFeaturesCol(), metadata={"names": "dropped"})
        table = staged(features.transform(dataset).select(last.getLabelCol(), unnamed), "features")
        return PipelineModel(stages=[*features.stages, logistic.fit(last, table)])


def text_classifier(
    label: str,
    numeric: list[str],
    categories: list[str],
    max_iter: int = MAX_ITERATIONS,
    min_df: float = MIN_DOCUMENTS[0],
    compat_indexed: bool = False,
    vocab_size: int = 1 << 18,
) -> tuple[Pipeline, CountVectorizer, LogisticRegression]:
    """Counts, idf, indexed and one-hot categories, logistic regression over ``tokens_clean``.

    ``compat_indexed`` feeds the category indexes instead of the one-hot vectors. ``vocab_size``
    bounds the features: the model has a weight for each of the most frequent terms.
    """
    counts = CountVectorizer(inputCol="tokens_clean", outputCol="counts", minDF=min_df, vocabSize=vocab_size)
    idf = IDF(inputCol="counts", outputCol="tfidf")
    suffix = "index" if compat_indexed else "onehot"
    encoders = [OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_onehot") for c in categories]
    columns = ["tfidf", *numeric, *(f"{c}_{suffix}" for c in categories)]
    regression = LogisticRegression(
        featuresCol="features",
        labelCol=label,
        predictionCol="predictions",
        rawPredictionCol="raw_predictions",
        elasticNetParam=0.0,
        fitIntercept=True,
        standardization=True,
        tol=TOLERANCE,
        maxIter=max_iter,
    )
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    stages = [counts, idf, *map(_indexer, categories), *encoders, assembler, regression]
    return StagedPipeline(stages=stages), counts, regression


def fit_on_text(estimator, train: DataFrame) -> PipelineModel:
    """Fit an estimator of ``tokens_clean`` and return a model of the raw ``text``.

    Neither the tokenizer nor the stop words are fitted or tuned, so the tokens are written
    once instead of being cut again for every pass of every candidate.
    """
    tokens = staged(clean_tokens(train).drop("text", "tokens"), "tokens")
    return PipelineModel(stages=[tokenizer(), stop_word_remover(), estimator.fit(tokens)])


def f1_evaluator(label: str, prediction: str = "predictions", metric: str = "f1") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)


def tuned_text_classifier(
    label: str, numeric: list[str], categories: list[str], seed: int, max_iter: int = MAX_ITERATIONS,
    regularisation=REGULARISATION, min_documents=MIN_DOCUMENTS, parallelism: int = 2,
) -> TrainValidationSplit:
    """Grid over regularisation and vocabulary threshold, best weighted f1 on the held-out 30 %."""
    classifier, counts, regression = text_classifier(label, numeric, categories, max_iter)
    grid = (
        ParamGridBuilder()
        .addGrid(regression.regParam, list(regularisation))
        .addGrid(counts.minDF, list(min_documents))
        .build()
    )
    return TrainValidationSplit(
        estimator=classifier, evaluator=f1_evaluator(label), estimatorParamMaps=grid, trainRatio=TRAIN_RATIO, seed=seed,
        parallelism=parallelism,
    )


def with_vector(df: DataFrame, name: str) -> DataFrame:
    """Array column as the vector column ``features``."""
    return df.withColumn("features", array_to_vector(F.col(name)))


def dealt(df: DataFrame, key: str, rows: int = TREE_ROWS) -> DataFrame:
    """``df`` in as many parts as its rows ask for, dealt out by a unique ``key``.

    Fits of trees keep their rows in memory by parts and read a part whole in every pass. The files of a compact
    table make few parts, which would grow with it. Pass a staged table, because its rows are counted.
    """
    wanted = math.ceil(df.count() / rows)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, key)


def decision_tree(label: str, features: str = "features", **params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, **{**TREE, "seed": 0, **params})


def random_forest(label: str, features: str = "features", seed: int = 100, **params) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params)


def component_tree(label: str, **params) -> tuple[Pipeline, PCA]:
    """Tree on principal components, and the stage whose ``k`` is tuned."""
    components = PCA(k=COMPONENTS[0], inputCol="features", outputCol="components")
    return Pipeline(stages=[components, decision_tree(label, "components", **params)]), components


def with_folds(df: DataFrame, key: str, folds: int, seed: int, name: str = "fold") -> DataFrame:
    """``df`` with a fold 0 ... folds - 1 that is a function of the key and the seed, whatever the partitions."""
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 8)
    return df.withColumn(name, F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(folds)).cast("int"))


def cross_validated(estimator, grid, evaluator, folds: int, seed: int, fold_col: str = "") -> CrossValidator:
    """``fold_col`` names the folds of :func:`with_folds`; without it rows are dealt out by their places."""
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=seed, foldCol=fold_col,
        parallelism=PARALLEL_FITS,
    )


@dataclass
class HeldOut:
    """The model of the best parameters, refitted on all rows, and every candidate's score on the held-out ones."""

    bestModel: object
    best: dict
    scores: list[float]


def tuned_on_held_out(estimator, grid, evaluator, df: DataFrame, key: str, ratio: float, seed: int) -> HeldOut:
    """A grid searched on one split that is a function of the key; of equal scores the first candidate wins."""
    # all candidates pass over the two parts, so their rows are decided once
    train, held = (part.drop(key).persist() for part in split_rows(df, key, ratio, seed))
    scores = [0.0] * len(grid)
    for at, model in estimator.fitMultiple(train, grid):
        scores[at] = evaluator.evaluate(model.transform(held))
    train.unpersist()
    held.unpersist()
    best = (max if evaluator.isLargerBetter() else min)(range(len(grid)), key=scores.__getitem__)
    return HeldOut(estimator.fit(df, grid[best]), grid[best], scores)


def projected(df: DataFrame, k: int, name: str = "features") -> DataFrame:
    """First ``k`` principal components as the array ``components``."""
    model = PCA(k=k, inputCol=name, outputCol="pca").fit(df)
    return model.transform(df).withColumn("components", vector_to_array("pca")).drop("pca")


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count("*").alias("n")
    )


def metrics(df: DataFrame, label: str, prediction: str, names=("f1", "accuracy")) -> DataFrame:
    rows = [(name, float(f1_evaluator(label, prediction, name).evaluate(df))) for name in names]
    return df.sparkSession.createDataFrame(rows, "metric string, value double")


def chosen_params(spark, model, scores) -> DataFrame:
    """(param, value) of every stage of the best model, and the score of every candidate."""
    stages = getattr(model.bestModel, "stages", [model.bestModel])
    rows = [
        (f"{type(stage).__name__}.{param.name}", str(value))
        for stage in stages
        for param, value in stage.extractParamMap().items()
    ]
    rows += [(f"score_{n}", f"{score:.6f}") for n, score in enumerate(scores)]
    return spark.createDataFrame(sorted(rows), "param string, value string")
