"""Small models on tables: logistic regression by formula and a decision tree with held-out rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import RFormula, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.operators.profile import mean_impute
from binledger.sources.tables import literal_table


def prepare(df: DataFrame, columns: Sequence[str], fill: str, required: Sequence[str]) -> DataFrame:
    """Keep the model's columns, fill one with its mean, drop rows lacking a required label."""
    return mean_impute(df.select(*columns), fill).dropna(subset=list(required))


def _logistic(df: DataFrame, formula: str) -> tuple[GeneralizedLinearRegressionModel, list[str]]:
    """Unpenalised binary logistic regression by reweighted least squares, and the terms in the model's order."""
    prepared = RFormula(formula=formula).fit(df)
    intercept = not formula.replace(" ", "").endswith("-1")
    model = GeneralizedLinearRegression(
        family="binomial", link="logit", regParam=0.0, maxIter=100, tol=1e-10, fitIntercept=intercept
    ).fit(prepared.transform(df))
    meta = prepared.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in meta.values() for a in kind}
    return model, [names[i] for i in range(model.numFeatures)] + ["(Intercept)"] * intercept


def logistic_summary(df: DataFrame, formula: str) -> DataFrame:
    """Per term: coefficient, standard error, z value and two-sided p value; the intercept is ``(Intercept)``.

    The errors come from the inverse of the Fisher information X'WX at the estimate, which every step of the fit sums
    up in one pass over the rows; only this matrix of terms by terms reaches the driver. A formula that ends in ``- 1`` has no
    intercept, and its first categorical term then has a coefficient for every category.
    """
    model, terms = _logistic(df, formula)
    values = [float(v) for v in model.coefficients] + ([float(model.intercept)] if model.getFitIntercept() else [])
    found = model.summary
    return literal_table(
        df.sparkSession,
        {
            "term": terms,
            "coefficient": values,
            "std_error": list(found.coefficientStandardErrors),
            "z_value": list(found.tValues),
            "p_value": list(found.pValues),
        },
    )


def logistic_fit(df: DataFrame, formula: str) -> DataFrame:
    """How well the model fits, in one row: deviance without and with the terms, their degrees of freedom, AIC, steps."""
    model, _ = _logistic(df, formula)
    found = model.summary
    return literal_table(
        df.sparkSession,
        {
            "null_deviance": [float(found.nullDeviance)],
            "null_degrees": [int(found.residualDegreeOfFreedomNull)],
            "residual_deviance": [float(found.deviance)],
            "residual_degrees": [int(found.residualDegreeOfFreedom)],
            "aic": [float(found.aic)],
            "iterations": [int(found.numIterations)],
        },
    )


def logistic_coefficients(df: DataFrame, formula: str) -> DataFrame:
    """Term and coefficient, the intercept included."""
    return logistic_summary(df, formula).select("term", "coefficient")


def tree_predictions(
    df: DataFrame, features: Sequence[str] | str, label: str, held_out: DataFrame, key: str, seed: int = 7
) -> DataFrame:
    """Fit on all rows but the held-out ones and predict those: key, label, prediction."""
    if isinstance(features, str):
        ready = df.withColumn("features", array_to_vector(features))
    else:
        ready = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    train = ready.join(held_out, key, "left_anti")
    test = ready.join(held_out, key, "left_semi")
    model = DecisionTreeClassifier(labelCol=label, featuresCol="features", seed=seed).fit(train)
    return model.transform(test).select(key, F.col(label), F.col("prediction").cast("int").alias("prediction"))
