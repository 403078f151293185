"""Feature stages, models, tuning and evaluation over documents and embeddings."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit, TrainValidationSplitModel
from pyspark.sql import functions as F

from gleaner.operators import learn, prepare
from gleaner.plans.cleaning import PREPARED
from gleaner.plans.registry import query
from gleaner.sources import files

# fixed values: the English stop words of the stop-word stage
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

SEED = 2810
MIN_DF = 5.0  # the operator's default suits larger collections

GAPS = "regexp_split_to_array(lower(text), '\\W+')"
TOKENS = f"WITH tokens AS (SELECT doc_id, list_filter({GAPS}, lambda w: w <> '') AS tokens FROM documents)"
STOP_LIST = "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS) + "]"
CLEAN = TOKENS + f""", clean AS (SELECT doc_id, list_filter(tokens, lambda w: NOT list_contains({STOP_LIST}, w)) AS tokens
                                 FROM tokens)"""
VOCABULARY = (
    CLEAN
    + f""", terms AS (SELECT DISTINCT doc_id, unnest(tokens) AS term FROM clean),
    vocabulary AS (SELECT term, count(*) AS df FROM terms GROUP BY term HAVING count(*) >= {int(MIN_DF)})"""
)


# -- feature stages -----------------------------------------------------------------------


def documents(t):
    return t.spread("documents", "doc_id")


def cleaned(t):
    return learn.clean_tokens(documents(t)).select("tokens_clean")


@query(TOKENS + " SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM tokens")
def ml_tokens(t):
    tokens = learn.tokenizer().transform(documents(t))
    return tokens.select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(CLEAN + " SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM clean")
def ml_tokens_clean(t):
    return learn.clean_tokens(documents(t)).select("doc_id", F.array_join("tokens_clean", " ").alias("tokens"))


@query(VOCABULARY + " SELECT term, df FROM vocabulary")
def ml_vocabulary_df(t):
    return learn.vocabulary(cleaned(t), MIN_DF).select("term", "df")


@query(
    VOCABULARY
    + " SELECT term, round(ln(((SELECT count(*) FROM documents) + 1) / CAST(df + 1 AS DOUBLE)), 9) AS idf FROM vocabulary"
)
def ml_idf(t):
    return learn.vocabulary(cleaned(t), MIN_DF).select("term", F.round("idf", 9).alias("idf"))


@query(
    VOCABULARY
    + """, places AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / CAST(df + 1 AS DOUBLE)) AS idf,
                             row_number() OVER (ORDER BY term) - 1 AS slot FROM vocabulary),
    counts AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM clean) GROUP BY ALL)
    SELECT doc_id, slot, round(n * idf, 9) AS value FROM counts JOIN places USING (term)"""
)
def ml_term_cells(t):
    """Weights of terms in long form: nothing of the vocabulary reaches the driver."""
    tokens = learn.clean_tokens(documents(t)).select("doc_id", "tokens_clean")
    cells, _ = learn.term_cells(files.staged(tokens, "tokens"), "doc_id", MIN_DF)
    return cells.select("doc_id", "slot", F.round("value", 9).alias("value"))


INDEXED = """WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
    indexed AS (SELECT event_type, n, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS idx,
                       count(*) OVER () AS n_types FROM counts)"""


@query(INDEXED + " SELECT event_type, CAST(idx AS INTEGER) AS idx, n FROM indexed")
def ml_string_index(t):
    indexed = learn.indexed_categories(t["events"].select("event_type"), "event_type")
    return indexed.groupBy("event_type", F.col("event_type_index").cast("int").alias("idx")).agg(F.count("*").alias("n"))


@query(
    INDEXED
    + """ SELECT event_type, array_to_string(list_transform(range(n_types - 1),
                 lambda i: CASE WHEN i = idx THEN '1' ELSE '0' END), ',') AS onehot, n FROM indexed"""
)
def ml_onehot(t):
    encoded = learn.one_hot(t["events"].select("event_type"), "event_type")
    cells = F.transform(vector_to_array("event_type_onehot"), lambda x: x.cast("int").cast("string"))
    return encoded.groupBy("event_type", F.array_join(cells, ",").alias("onehot")).agg(F.count("*").alias("n"))


# -- evaluation ---------------------------------------------------------------------------

RULE = """SELECT quality AS label, CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS prediction
    FROM labels JOIN documents USING (doc_id)"""


def rule_predictions(t):
    """Labels against a plain length rule: input for the evaluators."""
    rows = t["labels"].join(t["documents"].select("doc_id", "n_chars"), "doc_id")
    prediction = (F.col("n_chars") >= 1000).cast("int").cast("double")
    return rows.select(F.col("quality").cast("double").alias("label"), prediction.alias("predictions"))


@query(f"SELECT label, prediction, count(*) AS n FROM ({RULE}) GROUP BY label, prediction")
def confusion_matrix(t):
    return learn.confusion(rule_predictions(t), "label", "predictions")


@query(
    f"""WITH rows AS ({RULE}), classes AS (SELECT unnest([0, 1]) AS c),
    counts AS (SELECT c, count(*) FILTER (WHERE label = c) AS actual, count(*) FILTER (WHERE prediction = c) AS predicted,
                      count(*) FILTER (WHERE label = c AND prediction = c) AS hit, count(*) AS n FROM rows, classes GROUP BY c)
    SELECT 'f1' AS metric, round(sum(CASE WHEN hit = 0 THEN 0e0 ELSE 2e0 * hit / (actual + predicted) END * actual / n), 8) AS value
    FROM counts
    UNION ALL SELECT 'accuracy', round(sum(hit) / CAST(max(n) AS DOUBLE), 8) FROM counts"""
)
def eval_metrics(t):
    found = learn.metrics(rule_predictions(t), "label", "predictions")
    return found.withColumn("value", F.round("value", 8))


# -- text classifier ----------------------------------------------------------------------


def labelled_documents(t):
    rows = documents(t).select("doc_id", "text", "lang", "source", "n_chars")
    return rows.join(t["labels"].select("doc_id", "quality"), "doc_id")


CATEGORIES = ["lang", "source"]


@query()
def text_quality_model(t):
    train, test = prepare.split_rows(labelled_documents(t), "doc_id", 0.9, SEED)
    classifier, _, _ = learn.text_classifier("quality", ["n_chars"], CATEGORIES, min_df=MIN_DF)
    model = learn.fit_on_text(classifier, train)
    return model.transform(test).select("doc_id", "quality", F.col("predictions").cast("int").alias("prediction"))


@query()
def tvs_best_params(t):
    train, _ = prepare.split_rows(labelled_documents(t), "doc_id", 0.9, SEED)
    tuner = learn.tuned_text_classifier(
        "quality", ["n_chars"], CATEGORIES, seed=SEED, min_documents=(MIN_DF, 2 * MIN_DF, 4 * MIN_DF)
    )
    tuned = learn.fit_on_text(tuner, train).stages[-1]
    return learn.chosen_params(t.spark, tuned, tuned.validationMetrics)


@query(
    """SELECT count(*) AS n, count(*) AS n_same FROM labels JOIN documents USING (doc_id)
       WHERE substr(md5(concat('2810:', doc_id)), 1, 8) >= 'e6666666'"""
)
def ml_reload_same_predictions(t):
    """Save the tuned model and its tuner, load the model, score again: all predictions must agree."""
    train, test = prepare.split_rows(labelled_documents(t), "doc_id", 0.9, SEED)
    tuner = learn.tuned_text_classifier(
        "quality", ["n_chars"], CATEGORIES, seed=SEED, min_documents=(MIN_DF, 2 * MIN_DF, 4 * MIN_DF)
    )
    model = learn.fit_on_text(tuner, train)
    path = files.scratch_dir(t.spark, "model")
    tuner.write().overwrite().save(f"{path}/tuner")
    model.write().overwrite().save(f"{path}/model")
    again = PipelineModel.load(f"{path}/model")
    scored = model.transform(test).select("doc_id", "text", "lang", "source", "n_chars", F.col("predictions").alias("first"))
    both = again.transform(scored)
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("first") == F.col("predictions")).alias("n_same"))


@query(
    """SELECT count(*) AS n, count(*) AS n_same, true AS same_scores, true AS same_estimator FROM labels JOIN documents USING (doc_id)
       WHERE substr(md5(concat('2810:', doc_id)), 1, 8) >= 'e6666666'"""
)
def ml_reload_tuner(t):
    """Save a tuner, load it and fit it again on the same rows: scores, parameters and predictions must agree."""
    train, test = prepare.split_rows(labelled_documents(t), "doc_id", 0.9, SEED)
    tuner = learn.tuned_text_classifier(
        "quality", ["n_chars"], CATEGORIES, seed=SEED, max_iter=10, min_documents=(MIN_DF, 4 * MIN_DF)
    )
    tokens, held = (files.staged(learn.clean_tokens(x).drop("text", "tokens"), "tokens") for x in (train, test))
    path = files.scratch_dir(t.spark, "tuner")
    tuner.write().overwrite().save(f"{path}/tuner")
    first = tuner.fit(tokens)
    first.write().overwrite().save(f"{path}/tuned")
    loaded, tuned = TrainValidationSplit.load(f"{path}/tuner"), TrainValidationSplitModel.load(f"{path}/tuned")
    again = loaded.fit(tokens)
    scored = held
    for name, model in (("first", first), ("again", again), ("tuned", tuned)):
        # one probability vector is enough to tell models apart
        made = model.transform(scored)
        more = [c for c in made.columns if c not in scored.columns and c != "predictions"]
        scored = made.drop(*more).withColumnRenamed("predictions", name)
    metrics = [first.validationMetrics, again.validationMetrics, tuned.validationMetrics]
    same = F.lit(all(max(abs(a - b) for a, b in zip(metrics[0], m, strict=True)) < 1e-9 for m in metrics[1:]))
    kind = F.lit(type(loaded.getEstimator()) is type(tuner.getEstimator()))
    agree = (F.col("first") == F.col("again")) & (F.col("first") == F.col("tuned"))
    return scored.agg(
        F.count("*").alias("n"), F.count_if(agree).alias("n_same"), F.bool_and(same).alias("same_scores"),
        F.bool_and(kind).alias("same_estimator"),
    )


# -- models of labels that follow a rule, which SQL states ----------------------------------

RULE_WORDS = """SELECT doc_id, CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS label FROM documents"""


def ruled_documents(t):
    rows = documents(t).select("doc_id", "text", "lang", "source", "n_chars")
    return rows.withColumn("label", (F.col("lang") == "en").cast("int"))


@query(
    f"SELECT count(*) AS n, true AS good FROM ({RULE_WORDS}) WHERE substr(md5(concat('{SEED}:', doc_id)), 1, 8) >= 'b3333333'"
)
def text_rule_model(t):
    """The text classifier on labels that a category decides: whether over nine in ten rows that it was not fitted to
    are placed right."""
    train, test = prepare.split_rows(ruled_documents(t), "doc_id", 0.7, SEED)
    classifier, _, _ = learn.text_classifier("label", ["n_chars"], ["lang"], max_iter=50, min_df=MIN_DF)
    scored = learn.fit_on_text(classifier, train).transform(test)
    right = F.avg((F.col("predictions") == F.col("label")).cast("double"))
    return scored.agg(F.count("*").alias("n"), (right > 0.9).alias("good"))


@query(
    f"SELECT count(*) AS n, true AS good FROM ({RULE_WORDS}) WHERE substr(md5(concat('{SEED}:', doc_id)), 1, 8) >= 'b3333333'"
)
def term_model(t):
    """The language of a text by the weights of its terms alone, with no bound on their number: whether over nine in
    ten texts that the model has not seen are placed right."""
    tokens = learn.clean_tokens(ruled_documents(t)).select("doc_id", "label", "tokens_clean")
    tokens = files.staged(tokens, "tokens")
    cells, terms = learn.term_cells(tokens, "doc_id", MIN_DF)
    cells, width = files.staged(cells, "cells"), terms.count()
    train, test = prepare.split_rows(tokens.select("doc_id", "label"), "doc_id", 0.7, SEED)
    table = learn.sparse_rows(cells, train, "doc_id", "label", width)
    model = LogisticRegression(maxIter=30, regParam=1e-3).fit(table)
    scored = model.transform(learn.sparse_rows(cells, test, "doc_id", "doc_id", width))
    placed = scored.select(F.col("label").cast("long").alias("doc_id"), "prediction").join(test, "doc_id")
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    return placed.agg(F.count("*").alias("n"), (right > 0.9).alias("good"))


# three classes by two whole-number columns; the third column says nothing
ITEM_CLASS = """CASE WHEN l_linenumber <= 2 THEN 0 WHEN CAST(round(l_discount * 100) AS INTEGER) < 5 THEN 1 ELSE 2 END"""
ITEMS = f"""SELECT l_orderkey * 10 + l_linenumber AS item, min({ITEM_CLASS}) AS label FROM lineitem GROUP BY 1"""


def ruled_items(t):
    rows = t["lineitem"].groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item")).agg(
        F.min(F.expr(ITEM_CLASS)).cast("double").alias("label"), F.min("l_linenumber").alias("line"),
        F.min(F.round(F.col("l_discount") * 100)).alias("discount"), F.min(F.col("l_quantity") % 40).alias("noise"),
    )
    vectors = VectorAssembler(inputCols=["line", "discount", "noise"], outputCol="features").transform(rows)
    return files.staged(vectors.select("item", "features", "label"), "items")


HELD_ITEMS = f"SELECT item, label, label AS prediction FROM ({ITEMS}) WHERE substr(md5(concat('100:', item)), 1, 8) >= 'b3333333'"


def placed_items(t, estimator):
    train, test = prepare.split_rows(ruled_items(t), "item", 0.7, seed=100)
    scored = estimator.fit(learn.dealt(train, "item").drop("item")).transform(test)
    return scored.select("item", F.col("label").cast("int"), F.col("prediction").cast("int"))


@query(HELD_ITEMS)
def tree_rule_classes(t):
    return placed_items(t, learn.decision_tree("label"))


@query(HELD_ITEMS)
def forest_rule_classes(t):
    return placed_items(t, learn.random_forest("label", numTrees=20, maxDepth=12, featureSubsetStrategy="all"))


@query(f"SELECT round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6) AS accuracy, count(*) AS n FROM ({HELD_ITEMS})")
def tree_rule_accuracy(t):
    """Share of held-out rows that the tree places right."""
    scored = placed_items(t, learn.decision_tree("label"))
    return scored.agg(F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("accuracy"), F.count("*").alias("n"))


@query(f"SELECT search, 10 AS best_depth, 1e0 AS best_score, n FROM (SELECT count(*) AS n FROM ({ITEMS})), (VALUES ('folds'), ('held out')) AS x(search)")
def tree_grid(t):
    """A grid over the depth of a tree, once cross-validated and once on one split, both by key. A single question
    cannot tell three classes apart; of depths that can, the first one wins."""
    tree, rows = learn.decision_tree("label"), ruled_items(t)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 10, 20]).build()
    evaluator = learn.f1_evaluator("label", "prediction", "accuracy")
    rows = learn.dealt(rows, "item")
    # written with their folds, which would else be worked out anew for each part of each fold
    folded = learn.dealt(files.staged(learn.with_folds(rows, "item", 3, seed=100), "folds"), "item").drop("item")
    crossed = learn.cross_validated(tree, grid, evaluator, folds=3, seed=100, fold_col="fold").fit(folded)
    held = learn.tuned_on_held_out(tree, grid, evaluator, rows, "item", 0.7, seed=100)
    n = rows.count()
    found = [
        (name, int(model.bestModel.getMaxDepth()), float(max(scores)), n)
        for name, model, scores in (("folds", crossed, crossed.avgMetrics), ("held out", held, held.scores))
    ]
    return t.spark.createDataFrame(found, "search string, best_depth int, best_score double, n long")


@query(
    """WITH rows AS (SELECT l_orderkey * 10 + l_linenumber AS item, min(l_quantity) AS x, min(l_extendedprice) / 1e3 AS y FROM lineitem GROUP BY 1),
    turn AS (SELECT atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) / 2 AS a FROM rows)
    SELECT item, round(abs(x * cos(a) + y * sin(a)), 6) AS pc1, round(abs(y * cos(a) - x * sin(a)), 6) AS pc2 FROM rows, turn"""
)
def pca_two_columns(t):
    """Principal components of two columns, for which a rotation is the closed form; their signs are arbitrary."""
    rows = t["lineitem"].groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item")).agg(
        F.min("l_quantity").alias("x"), (F.min("l_extendedprice") / 1e3).alias("y")
    )
    made = learn.projected(VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(files.staged(rows, "columns")), 2)
    return made.select("item", *(F.round(F.abs(F.col("components")[n]), 6).alias(f"pc{n + 1}") for n in range(2)))


@query(
    f"""SELECT project_id, CASE WHEN country2 = 'US' THEN 1 ELSE 0 END AS label, CASE WHEN country2 = 'US' THEN 1 ELSE 0 END AS prediction
        FROM ({PREPARED}) WHERE substr(md5(concat('{SEED}:', project_id)), 1, 8) >= 'b3333333'""",
    views=("campaigns",),
)
def campaign_model(t):
    """The classifier on the prepared campaigns: their text, amounts, times and categories; the label follows one of them."""
    rows = files.staged(prepare.prepare_campaigns(t["campaigns"]), "prepared")
    rows = rows.select("project_id", "text", "days_campaign", "hours_prepa", "goal", "country2", "currency2")
    rows = rows.withColumn("label", (F.col("country2") == "US").cast("int"))
    train, test = prepare.split_rows(rows, "project_id", 0.7, SEED)
    numeric, categories = ["days_campaign", "hours_prepa", "goal"], ["country2", "currency2"]
    classifier, _, _ = learn.text_classifier("label", numeric, categories, max_iter=50, min_df=MIN_DF)
    scored = learn.fit_on_text(classifier, train).transform(test)
    return scored.select("project_id", "label", F.col("predictions").cast("int").alias("prediction"))


# -- multi-class models -------------------------------------------------------------------


def vectors(t):
    rows = learn.with_vector(t["embeddings"], "embedding").select("vec_id", "features", F.col("label").cast("double"))
    return files.staged(rows, "vectors")


def fitted_predictions(t, estimator):
    train, test = prepare.split_rows(vectors(t), "vec_id", 0.7, seed=100)
    scored = estimator.fit(learn.dealt(train, "vec_id")).transform(test)
    return scored.select("vec_id", F.col("label").cast("int"), F.col("prediction").cast("int"))


@query()
def tree_multiclass(t):
    return fitted_predictions(t, learn.decision_tree("label"))


@query()
def forest_multiclass(t):
    return fitted_predictions(t, learn.random_forest("label"))


@query()
def tree_submission(t):
    """Score rows that were not trained on and write (id, prediction) as CSV."""
    path = files.scratch_dir(t.spark, "scored")
    scored = fitted_predictions(t, learn.decision_tree("label"))
    files.write_csv(scored.select(F.col("vec_id").alias("id"), "prediction"), path)
    return files.read_csv(t.spark, path, schema="id long, prediction int")


@query()
def pca_project(t):
    return learn.projected(vectors(t), 3).select(
        "vec_id", *(F.round(F.col("components")[n], 6).alias(f"pc{n + 1}") for n in range(3))
    )


@query()
def cv_best_params(t):
    """How many principal components serve a tree best, by three-fold cross-validation."""
    estimator, components = learn.component_tree("label")
    grid = ParamGridBuilder().addGrid(components.k, list(learn.COMPONENTS)).build()
    evaluator = learn.f1_evaluator("label", "prediction", "accuracy")
    train, _ = prepare.split_rows(vectors(t), "vec_id", 0.7, seed=100)
    model = learn.cross_validated(estimator, grid, evaluator, folds=3, seed=100).fit(train)
    return learn.chosen_params(t.spark, model, model.avgMetrics)
