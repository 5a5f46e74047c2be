"""A click predictor learned from labelled candidates."""

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from feedmill.operators.attention import with_pair_vectors


def pair_features(candidates: DataFrame, users: DataFrame, articles: DataFrame, dim: int) -> DataFrame:
    """Candidates with ``features``: the elementwise product of user and article vector."""
    pairs = with_pair_vectors(candidates, users, articles, dim)
    product = F.zip_with("user_vec", "article_vec", lambda x, y: x * y)
    return pairs.withColumn("features", array_to_vector(product)).drop("user_vec", "article_vec")


def fit_click_model(
    features: DataFrame, label: str = "label", weight_decay: float = 1e-5, max_iter: int = 500
) -> LogisticRegressionModel:
    """Logistic regression with an L2 penalty on the weights as they are, by distributed L-BFGS to convergence.

    A different, convex learner in place of stochastic gradient descent on the
    whole network: same inputs, same labels, other weights.
    """
    learner = LogisticRegression(
        featuresCol="features", labelCol=label, regParam=weight_decay, elasticNetParam=0.0, maxIter=max_iter,
        tol=1e-9, standardization=False,
    )
    return learner.fit(features)


def _log_odds(values, weights, intercept: float):
    return sum((F.get(values, F.lit(j)) * float(w) for j, w in enumerate(weights)), F.lit(float(intercept)))


def score_click_model(model: LogisticRegressionModel, features: DataFrame, name: str = "score") -> DataFrame:
    """Add the log-odds of a click; above 0 means a probability above one half.

    Written as an expression: a fitted model keeps its training summary and thereby the session,
    which tasks cannot receive, so ``model.transform`` fails in a session that has used an Observation.
    """
    return features.withColumn(name, _log_odds(vector_to_array("features"), model.coefficients.toArray(), model.intercept))


def mean_gradient(
    features: DataFrame, weights: list[float], intercept: float, weight_decay: float = 1e-5, label: str = "label",
    others: dict[str, tuple[list[float], float]] | None = None, totals: dict[str, Column] | None = None,
) -> DataFrame:
    """(dim, gradient, ``others``, ``totals``): the mean gradient of the penalised loss per weight, dim -1 the intercept.

    Zero everywhere exactly where the loss is lowest.  ``others`` names (weights, intercept) elsewhere: each row
    also has the whole gradient there as a list, the intercept's first.  ``totals`` names aggregates of the rows of ``features``.
    One aggregation for all of them.
    """
    others, totals = others or {}, totals or {}
    values = vector_to_array("features")

    def at(weights, intercept):
        miss = F.lit(1.0) / (F.lit(1.0) + F.exp(-_log_odds(values, weights, intercept))) - F.col(label)
        sums = [F.avg(miss * F.get(values, F.lit(j))) + weight_decay * float(w) for j, w in enumerate(weights)]
        return F.array(F.avg(miss), *sums)

    elsewhere = [at(*point).alias(name) for name, point in others.items()]
    sums = features.agg(at(weights, intercept).alias("g"), *elsewhere, *[total.alias(name) for name, total in totals.items()])
    rows = sums.select(F.posexplode("g").alias("i", "gradient"), *others, *totals)
    return rows.select((F.col("i") - 1).cast("bigint").alias("dim"), "gradient", *others, *totals)
