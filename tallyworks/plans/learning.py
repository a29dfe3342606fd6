"""l01 - l15: models, search, evaluation and similar texts."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyworks.operators import evaluation, features, learners, words as text
from tallyworks.operators.quantiles import exact_quantiles
from tallyworks.plans.inputs import WEIGHTS_SQL, WORDS_SQL
from tallyworks.plans.registry import query, rounded
from tallyworks.session import discard, fresh_path, materialize
from tallyworks.sources import files, models

PART_FEATURES = ["p_size", "p_brand_code", "p_type_code", "p_partkey_part"]


def part_rows(t):
    """Parts with coded columns, stored once for the many passes of a fit; the
    price grows with the low digits of the key."""
    rows = t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice",
                         (F.col("p_partkey") % 1000).alias("p_partkey_part"))
    coded = features.category_codes(features.category_codes(rows, "p_brand"), "p_type")
    vectors = features.assemble(coded, PART_FEATURES).select("p_partkey", "features", "p_retailprice")
    return materialize(vectors, "part-vectors")


IMPORTANCE_SQL = """(SELECT 'p_size' AS feature, power(corr(p_size, p_retailprice), 2) AS importance FROM part
  UNION ALL SELECT 'p_partkey_part', power(corr(p_partkey % 1000, p_retailprice), 2) FROM part
  UNION ALL SELECT 'p_name_length', power(corr(length(p_name), p_retailprice), 2) FROM part
  UNION ALL SELECT 'p_type_length', power(corr(length(p_type), p_retailprice), 2) FROM part) i"""


def price_correlations(t):
    """Importance of four columns for the price, by squared correlation."""
    rows = t.part.select("p_size", "p_retailprice", (F.col("p_partkey") % 1000).alias("p_partkey_part"),
                         F.length("p_name").alias("p_name_length"), F.length("p_type").alias("p_type_length"))
    names = ["p_size", "p_partkey_part", "p_name_length", "p_type_length"]
    return features.correlation_importances(rows, names, "p_retailprice")


def part_importances(t):
    model = learners.boosted("p_retailprice", rounds=5, depth=4).fit(part_rows(t))
    return learners.importances(model, PART_FEATURES, t.part)


def scores(t, estimator):
    """Measures of a regressor on the held-out part."""
    train, test = learners.split(part_rows(t), "p_partkey")
    return evaluation.measures(estimator.fit(train).transform(test), "p_retailprice")


@query("l01_random_forest")
def random_forest(t):
    train, test = learners.split(part_rows(t), "p_partkey")
    found = learners.forest_predicted(train, test, learners.forest("p_retailprice"))
    return evaluation.measures(found, "p_retailprice")


@query("l02_decision_tree")
def decision_tree(t):
    return scores(t, learners.tree("p_retailprice"))


@query("l03_boosted_trees")
def boosted_trees(t):
    """Depth and step of the boosting searched over shuffled folds."""
    model = learners.boosted("p_retailprice", rounds=5, step=0.3, depth=5)
    return scores(t, learners.searched(model, {"maxDepth": [3, 5], "stepSize": [0.1, 0.3]}, "p_retailprice"))


@query("l04_lasso_search")
def lasso_search(t):
    train, test = learners.split(part_rows(t), "p_partkey")
    found = learners.powered_lasso(train, test, "p_retailprice", [0.1, 1.0, 10.0])
    return evaluation.measures(found, "p_retailprice")


@query("l05_grid_search")
def grid_search(t):
    """Mean squared error of each tried setting of a tree and of a forest."""
    rows, found = part_rows(t), []
    for name, estimator, grid in (("tree", learners.tree("p_retailprice"), {"maxDepth": [4, 8]}),
                                  ("forest", learners.forest("p_retailprice", trees=5), {"maxDepth": [4, 8]})):
        search = learners.searched(estimator, grid, "p_retailprice")
        model = search.fit(rows)
        found += [(name, params[estimator.maxDepth], float(mse))
                  for params, mse in zip(search.getEstimatorParamMaps(), model.avgMetrics)]
    return t.spark.createDataFrame(found, "model string, max_depth int, mse double")


@query("l06_importances")
def feature_importances(t):
    return part_importances(t)


@query("l07_stacked_model")
def stacked(t):
    """A forest's prediction joins the more important features and a boosted model
    learns from both. The test part is set aside first: training rows get the
    prediction of a forest that has not seen them, test rows that of a forest fitted on
    the training part."""
    train, test = learners.split(part_rows(t), "p_partkey")
    importance = learners.boosted("p_retailprice", rounds=5, depth=4).fit(train)
    found = learners.importances(importance, PART_FEATURES, t.part)
    median = exact_quantiles(found, ["importance"], [0.5]).first()["quantiles"][0]
    names = [row["feature"] for row in features.important_features(found, median).orderBy("feature").collect()]
    forest = learners.forest("p_retailprice", depth=10, trees=5)
    parts = [learners.out_of_fold(train, "p_partkey", forest),
             forest.fit(train).transform(test).withColumnRenamed("prediction", "ensemble")]
    stacked_parts = []
    for part in parts:
        flat = part.withColumn("v", vector_to_array("features")).select(
            "p_partkey", "p_retailprice", "ensemble", *[F.col("v")[PART_FEATURES.index(n)].alias(n) for n in names])
        stacked_parts.append(features.assemble(flat, [*names, "ensemble"]))
    model = learners.boosted("p_retailprice", rounds=10, step=0.3, depth=5).fit(stacked_parts[0])
    return evaluation.measures(model.transform(stacked_parts[1]), "p_retailprice")


def embedding_columns(n):
    return [F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(n)]


@query("l08_kmeans")
def kmeans(t):
    names = [f"x{i}" for i in range(20)]
    rows = features.assemble(t.embeddings.select("vec_id", *embedding_columns(20)), names)
    return learners.clusters(k=8).fit(rows).transform(rows).select("vec_id", F.col("prediction").alias("cluster"))


def guessed_prices(t):
    """Prices guessed from the quantity: label and prediction columns."""
    return t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000).alias("p"))


GUESS_SQL = "(SELECT l_extendedprice AS y, l_quantity * 2000 AS p FROM lineitem) g"


@query("l09_absolute_squared_error", f"""SELECT round(avg(abs(y - p)), 4) AS mae, round(avg((y - p) * (y - p)), 1) AS mse
  FROM {GUESS_SQL}""")
def absolute_squared(t):
    y, p = F.col("y"), F.col("p")
    return guessed_prices(t).agg(rounded(evaluation.mean_absolute_error(y, p), 4).alias("mae"),
                                 rounded(evaluation.mean_squared_error(y, p), 1).alias("mse"))


@query("l10_r_squared", f"SELECT round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2 FROM {GUESS_SQL}")
def r_squared(t):
    return guessed_prices(t).agg(rounded(evaluation.r_squared(F.col("y"), F.col("p"))).alias("r2"))


@query("l11_percent_error", f"SELECT round(avg(abs(y - p) / y), 6) AS mape FROM {GUESS_SQL} WHERE y <> 0")
def percent_error(t):
    return guessed_prices(t).agg(rounded(evaluation.mean_percent_error(F.col("y"), F.col("p"))).alias("mape"))


@query("l12_explained_variance", f"SELECT round(1 - var_pop(y - p) / var_pop(y), 6) AS explained FROM {GUESS_SQL}")
def explained(t):
    return guessed_prices(t).agg(rounded(evaluation.explained_variance(F.col("y"), F.col("p"))).alias("explained"))


SIMILAR_SQL = """
  q_tf AS (SELECT word, count(*) AS tf FROM (SELECT {words} AS word FROM {source}) w GROUP BY 1),
  q_raw AS (SELECT word, tf * idf AS weight FROM q_tf JOIN idf USING (word) WHERE abs(tf * idf) > 1e-12),
  q AS (SELECT word, weight / sqrt(sum(weight * weight) OVER ()) AS query_weight FROM q_raw)
  SELECT doc_id, round(sum(weight * query_weight), 6) AS similarity FROM weights JOIN q USING (word)
  GROUP BY 1 ORDER BY round(sum(weight * query_weight), 9) DESC, doc_id LIMIT 20"""

QUERY_TEXT = "thing over the heed and onesen erblest, inenan thantion la queaux der verberst"


def similar_sql(source: str) -> str:
    return f"WITH {WEIGHTS_SQL}, {SIMILAR_SQL.format(words=WORDS_SQL.format('text'), source=source)}"


_text_models: dict[tuple, str] = {}


def text_model(t):
    """Index of the documents' weights, built once per application and state of the
    table's files; every later request reads the stored index."""
    key = (t.spark.sparkContext.applicationId, *files.listing(t.spark, f"{t.folder}/documents.parquet"))
    if key not in _text_models:
        path = fresh_path(t.spark, "text-model")
        weights, idf = text.text_weights(t.texts("documents", "doc_id", "text"), "doc_id", "text")
        models.save_text_model(weights, "doc_id", idf, path)
        for stored in (weights, idf):
            discard(stored)
        _text_models[key] = path
    return models.load_text_model(t.spark, _text_models[key])


def similar_documents(t, query_rows):
    index = text_model(t)
    return index.search(index.query(query_rows, "text")).withColumn("similarity", rounded("similarity"))


@query("l13_word_bounds", f"""WITH {WEIGHTS_SQL} SELECT word, count(*) AS texts, round(max(weight), 6) AS top
  FROM weights GROUP BY word""")
def word_bounds(t):
    """What the index knows of each word: the texts that hold it, and its highest weight."""
    return text_model(t).word_bounds().withColumn("top", rounded("top"))


@query("l13_similar_to_text", similar_sql(f"(SELECT '{QUERY_TEXT}' AS text) t"))
def similar_to_text(t):
    return similar_documents(t, t.spark.createDataFrame([(QUERY_TEXT,)], "text string"))


@query("l14_similar_to_items", similar_sql("benchmark"))
def similar_to_items(t):
    """All benchmark texts as one query, as a reader's watched items would be."""
    return similar_documents(t, t.benchmark)


@query("l15_text_sentiment")
def text_sentiment(t):
    """Labelled documents teach the classes; every document gets one."""
    docs = learners.with_words(t.texts("documents", "doc_id", "text"), "text").drop("text")
    train = docs.join(t.labels.select("doc_id", (1 - F.col("toxic")).cast("double").alias("label")), "doc_id")
    model = learners.word_pipeline("label").fit(train)
    return learners.two_class_label(model.transform(docs)).select("doc_id", "sentiment")
