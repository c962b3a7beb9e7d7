"""Random-forest regression on prepared columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Deepest tree Spark grows; stands for "no limit".
MAX_DEPTH = 30


@dataclass(frozen=True)
class ForestModel:
    features: tuple[str, ...]
    forest: RandomForestRegressionModel

    def predict(self, df: DataFrame, output: str = "predicted") -> DataFrame:
        vectors = assemble(df, self.features)
        return self.forest.setPredictionCol(output).transform(vectors).drop("_features")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(df)


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    n_estimators: int = 100,
    max_depth: int | None = None,
    seed: int = 42,
) -> ForestModel:
    """All features are tried at every split; trees are grown on bootstrap samples. Without a
    given depth trees end at Spark's limit."""
    if max_depth is not None and max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth {max_depth} is above {MAX_DEPTH}, Spark's deepest tree")
    forest = RandomForestRegressor(
        featuresCol="_features",
        labelCol=target,
        numTrees=n_estimators,
        maxDepth=MAX_DEPTH if max_depth is None else max_depth,
        featureSubsetStrategy="all",
        seed=seed,
        maxMemoryInMB=1024,
    )
    return ForestModel(tuple(features), forest.fit(assemble(df, features)))


def importance_table(model: ForestModel, df: DataFrame) -> DataFrame:
    """``feature, importance``, largest first."""
    values = model.forest.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(model.features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
