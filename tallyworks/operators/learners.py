"""Regressors, classifiers, clustering and model search on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import HashingTF, IDF, PolynomialExpansion, StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyworks.functions.cells import words
from tallyworks.operators import forests, lasso as lasso_path
from tallyworks.operators.features import best_powers, in_training_part, scaled_like, yeo_johnson
from tallyworks.session import materialize

SEED = 42
# Rows that the trees of a forest on the driver may have together; a row can become two nodes of some 400 bytes.
FOREST_ROWS = 500_000


def split(df: DataFrame, key: str, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Training and test part, the same on every run."""
    train = in_training_part(F.col(key), share)
    return df.where(train), df.where(~train)


def forest(label: str, features: str = "features", depth: int = 20, bins: int = 128,
           trees: int = 20) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol=features, maxDepth=depth, maxBins=bins,
                                 numTrees=trees, maxMemoryInMB=1024, seed=SEED)


def forest_predicted(train: DataFrame, test: DataFrame, forest: RandomForestRegressor) -> DataFrame:
    """``test`` with a forest's predictions. Spark's forest keeps all trees on the driver, so it is used while they can have
    ``FOREST_ROWS`` rows in all; larger ones are grown in tasks (``forests``)."""
    if train.count() * forest.getNumTrees() <= FOREST_ROWS:
        return forest.fit(train).transform(test)
    return forests.predicted(train, test, forest)


def tree(label: str, features: str = "features", depth: int = 20, bins: int = 128) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(labelCol=label, featuresCol=features, maxDepth=depth, maxBins=bins,
                                 maxMemoryInMB=1024, seed=SEED)


def boosted(label: str, features: str = "features", rounds: int = 20, depth: int = 6, step: float = 0.05,
            rows: float = 0.9, columns: str = "0.6") -> GBTRegressor:
    return GBTRegressor(labelCol=label, featuresCol=features, maxIter=rounds, maxDepth=depth, stepSize=step,
                        subsamplingRate=rows, featureSubsetStrategy=columns, seed=SEED)


def searched(estimator: Estimator, grid: dict[str, Sequence], label: str, folds: int = 3,
             parallelism: int = 4) -> CrossValidator:
    """Grid search by mean squared error over shuffled folds."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(), numFolds=folds, seed=SEED,
                          evaluator=RegressionEvaluator(labelCol=label, metricName="mse"),
                          parallelism=parallelism)


def lasso(label: str, alphas: Sequence[float], folds: int = 3) -> Pipeline:
    """Degree-2 terms, scaling and L1 regression with its strength searched."""
    terms = PolynomialExpansion(degree=2, inputCol="features", outputCol="terms")
    scaled = StandardScaler(withMean=True, withStd=True, inputCol="terms", outputCol="scaled")
    line = LinearRegression(featuresCol="scaled", labelCol=label, elasticNetParam=1.0)
    return Pipeline(stages=[terms, scaled, searched(line, {"regParam": alphas}, label, folds)])


def powered_lasso(train: DataFrame, test: DataFrame, label: str, alphas: Sequence[float], folds: int = 3) -> DataFrame:
    """Predictions of ``test``: degree-2 terms, scaling, power transform, scaling, L1 regression.

    Means, deviations and powers come from the training part alone. All folds and strengths are
    fitted on the moments of one read (``operators.lasso``).
    """
    expand = PolynomialExpansion(degree=2, inputCol="features", outputCol="__terms")
    size = expand.transform(train.limit(1)).first()
    if size is None:
        return test.withColumn("prediction", F.lit(None).cast("double"))
    names = [f"__t{i}" for i in range(size["__terms"].size)]

    def wide(df: DataFrame) -> DataFrame:
        values = expand.transform(df).withColumn("__v", vector_to_array("__terms"))
        return values.select(*df.columns, *[F.col("__v")[i].alias(n) for i, n in enumerate(names)])
    train, test = wide(train), wide(test)
    train, test = scaled_like(train, names, train, test)
    powers = {row["column"]: row["power"] for row in best_powers(train, names, digits=2).collect()}
    train, test = (d.withColumns({n: yeo_johnson(F.col(n), F.lit(p)) for n, p in powers.items()})
                   for d in (train, test))
    train, test = (materialize(d, "scaled") for d in scaled_like(train, names, train, test))
    return lasso_path.search(train, names, label, alphas, folds).predicted(test, names)


def importances(model: Model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """One row per feature with its importance."""
    values = [(name, float(v)) for name, v in zip(names, model.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(values, "feature string, importance double")


def out_of_fold(df: DataFrame, key: str, estimator: Estimator, folds: int = 3,
                name: str = "ensemble") -> DataFrame:
    """Predict every row by a model that has not seen it."""
    fold = F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.lit(folds))
    parts = []
    for i in range(folds):
        model = estimator.fit(df.where(fold != i))
        scored = model.transform(df.where(fold == i)).withColumnRenamed("prediction", name)
        parts.append(scored.select(*df.columns, name))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def clusters(features: str = "features", k: int = 8) -> KMeans:
    return KMeans(k=k, featuresCol=features, predictionCol="prediction", seed=SEED)


def tree_classifier(label: str, features: str = "features", depth: int = 10) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=depth, seed=SEED)


def network_classifier(label: str, layers: Sequence[int], features: str = "features",
                       rounds: int = 50) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers),
                                          maxIter=rounds, seed=SEED)


def word_pipeline(label: str, dims: int = 1 << 18, rounds: int = 30) -> Pipeline:
    """Hashed word weights and two-class logistic regression, on a ``words`` array.

    Words share one of ``dims`` places; two words in one place count as one.
    """
    hashed = HashingTF(inputCol="words", outputCol="tf", numFeatures=dims)
    weighted = IDF(inputCol="tf", outputCol="features")
    line = LogisticRegression(labelCol=label, featuresCol="features", maxIter=rounds, regParam=0.01)
    return Pipeline(stages=[hashed, weighted, line])


def with_words(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("words", words(F.col(text)))


def two_class_label(df: DataFrame, probability: str = "probability", name: str = "sentiment") -> DataFrame:
    """'negative' only when class 0 is strictly more likely."""
    p = vector_to_array(F.col(probability))
    return df.withColumn(name, F.when(p[0] > p[1], "negative").otherwise("positive"))


def score_texts(df: DataFrame, text: str, load_model, name: str = "sentiment") -> DataFrame:
    """Label texts with a caller's model.

    ``load_model()`` runs once per task and returns a function from a list of
    texts to a list of (negative, positive) scores.
    """
    @F.pandas_udf(StringType())
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load_model()
        for texts in batches:
            yield pd.Series(["negative" if neg > pos else "positive" for neg, pos in predict(texts.tolist())])

    return df.withColumn(name, label(F.col(text)))
