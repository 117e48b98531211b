"""Model input: log transform, imputation and standard scaling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronscope.functions.columns import clip
from patronscope.functions.quantiles import exact_quantiles
from patronscope.schema import LOG_FEATURES, MEDIAN_FILLED, MODEL_FEATURES

SCALED = [f"z_{c}" for c in MODEL_FEATURES]


def add_logs(features: DataFrame) -> DataFrame:
    """Add ``log1p`` of the skewed columns, negative values taken as 0."""
    return features.withColumns(
        {f"{c}_log": F.log1p(clip(F.col(c).cast("double"), lower=0.0)) for c in LOG_FEATURES}
    )


def impute(features: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Fill the delivery and freight columns with their median and the other model
    features with 0."""
    filled = {}
    for c in MODEL_FEATURES:
        default = medians.get(c)
        filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(0.0 if default is None else float(default)))
    return features.withColumns(filled)


@dataclass
class Scaling:
    """Fitted constants: one number per feature."""

    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]

    def scaled(self, c: str) -> Column:
        return (F.col(c) - F.lit(self.means[c])) / F.lit(self.deviations[c])

    def transform(self, features: DataFrame) -> DataFrame:
        """Add the filled model features and their scaled ``z_`` columns."""
        return impute(add_logs(features), self.medians).withColumns(
            {f"z_{c}": self.scaled(c) for c in MODEL_FEATURES}
        )

    def stage(self) -> SQLTransformer:
        """The scaled columns as a pipeline stage, so that they are saved with a model."""
        parts = []
        for c in MODEL_FEATURES:
            raw = c
            if c.endswith("_log"):
                source = c.removesuffix("_log")
                raw = f"log1p(CASE WHEN {source} IS NOT NULL THEN greatest(CAST({source} AS DOUBLE), 0D) END)"
            default = self.medians.get(c)
            fill = 0.0 if default is None else float(default)
            parts.append(
                f"(coalesce(CAST({raw} AS DOUBLE), {fill!r}D) - ({self.means[c]!r}D)) / {self.deviations[c]!r}D AS z_{c}"
            )
        statement = f"SELECT *, {', '.join(parts)} FROM __THIS__"
        return SQLTransformer(statement=statement)


def fit_scaling(features: DataFrame) -> Scaling:
    """Medians, then mean and population deviation of the filled features in one scan.
    A constant feature is divided by 1."""
    quantiles = exact_quantiles(features, {c: [0.5] for c in MEDIAN_FILLED})
    medians = {c: quantiles[c][0] for c in MEDIAN_FILLED}
    row = impute(add_logs(features), medians).agg(
        *[F.avg(c).alias(f"m_{c}") for c in MODEL_FEATURES],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in MODEL_FEATURES],
    ).first()
    return Scaling(
        medians,
        {c: row[f"m_{c}"] or 0.0 for c in MODEL_FEATURES},
        {c: row[f"s_{c}"] or 1.0 for c in MODEL_FEATURES},
    )
