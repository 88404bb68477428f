"""Model matrix: one-hot categories and standardised numbers in one vector column.

Fitting needs two small aggregates (category levels; mean and spread of every number).  The fitted
stages are ordinary Spark ML transformers, so the matrix can be saved with the model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger import constants as K
from riskledger.functions.wording import feature_name, sql_number


@dataclass
class Matrix:
    """Fitted preprocessing: ``stages`` adds ``features``; ``names`` are its columns in order."""

    stages: PipelineModel
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        temporary = [c for c in self.stages.stages[-1].getInputCols()]
        temporary += [c.replace("_hot", "_idx") for c in temporary if c.endswith("_hot")]
        return self.stages.transform(df).drop(*temporary)


def numeric_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, from one aggregate over all columns."""
    pairs = [agg for c in columns for agg in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = df.agg(*pairs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def fit_matrix(
    df: DataFrame,
    categories: Sequence[str] = K.CATEGORIES,
    numbers: Sequence[str] = K.MODEL_NUMERIC,
) -> Matrix:
    """Learn category levels and scaling from ``df``.

    Levels are in alphabetical order and none is dropped; a level unseen here, or a missing one, is
    all zeros later.
    """
    indexer = StringIndexer(
        inputCols=list(categories),
        outputCols=[f"{c}_idx" for c in categories],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(df)
    # The slot for unknown levels is the last one, and the encoder drops the last slot.
    encoder = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in categories],
        outputCols=[f"{c}_hot" for c in categories],
        dropLast=True,
    ).fit(indexer.transform(df.limit(1)))
    stats = numeric_statistics(df, numbers)
    scaled = ", ".join(
        # A constant column is only centred.
        f"(CAST(`{c}` AS DOUBLE) - {sql_number(m)}) / {sql_number(s or 1.0)} AS `{c}_std`"
        for c, (m, s) in stats.items()
    )
    scaler = SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")
    assembler = VectorAssembler(
        inputCols=[f"{c}_hot" for c in categories] + [f"{c}_std" for c in numbers],
        outputCol="features",
    )
    names = [feature_name(c, level) for c, levels in zip(categories, indexer.labelsArray) for level in levels]
    names += [feature_name(c) for c in numbers]
    return Matrix(PipelineModel([indexer, encoder, scaler, assembler]), names)


def matrix_columns(df: DataFrame, names: Sequence[str], features: str = "features") -> DataFrame:
    """The vector spread into one double column per feature, keeping the claim id."""
    values = vector_to_array(F.col(features))
    return df.select(K.KEY, values.alias("_v")).select(
        K.KEY, *[F.element_at("_v", i + 1).alias(n) for i, n in enumerate(names)]
    )
