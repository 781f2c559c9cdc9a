"""Feature pipelines: scaling and one-hot encoding fitted on the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    ElementwiseProduct,
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.operators.prepare import fill_most_frequent


@dataclass
class Features:
    """A fitted feature pipeline and the names of its vector slots."""

    model: PipelineModel
    names: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def fit_features(train: DataFrame, numeric: Sequence[str], categories: Sequence[str] = (), flags: Sequence[str] = (),
                 drop_first: bool = False, impute: bool = False, output: str = "features") -> Features:
    """Scale numbers (population deviation), one-hot categories, pass flags through.

    A category not seen in training becomes all zeros. ``drop_first`` leaves
    out the first category in alphabetical order. ``impute`` fills missing
    numbers with the training mean.
    """
    stages: list[Transformer] = []
    names: list[str] = []
    parts: list[str] = []
    work = train
    if numeric:
        columns = list(numeric)
        if impute:
            filler = Imputer(strategy="mean", inputCols=columns, outputCols=[f"_{c}_filled" for c in columns])
            stages.append(filler.fit(work))
            columns = [f"_{c}_filled" for c in columns]
            work = stages[-1].transform(work)
        stages.append(VectorAssembler(inputCols=columns, outputCol="_numbers"))
        work = stages[-1].transform(work)
        rows = work.count()
        stages.append(StandardScaler(withMean=True, withStd=True, inputCol="_numbers", outputCol="_sample_scaled").fit(work))
        to_population = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
        stages.append(ElementwiseProduct(
            scalingVec=Vectors.dense([to_population] * len(columns)), inputCol="_sample_scaled", outputCol="_scaled"))
        parts.append("_scaled")
        names.extend(numeric)
    for column in categories:
        indexer = StringIndexer(
            inputCol=column, outputCol=f"_{column}_index", handleInvalid="keep", stringOrderType="alphabetAsc").fit(train)
        labels = list(indexer.labels)
        encoder = OneHotEncoder(
            inputCol=f"_{column}_index", outputCol=f"_{column}_hot", dropLast=True, handleInvalid="error")
        encoder = encoder.fit(indexer.transform(train))
        stages += [indexer, encoder]
        slot = f"_{column}_hot"
        if drop_first and len(labels) > 1:
            stages.append(VectorSlicer(
                inputCol=slot, outputCol=f"_{column}_kept", indices=list(range(1, len(labels)))))
            slot, labels = f"_{column}_kept", labels[1:]
        parts.append(slot)
        names.extend(f"{column}_{label}" for label in labels)
    if flags:
        stages.append(VectorAssembler(inputCols=list(flags), outputCol="_flags"))
        parts.append("_flags")
        names.extend(flags)
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return Features(PipelineModel(stages), names)


def clean_inputs(df: DataFrame, categories: Sequence[str], flags: Sequence[str], fit_on: DataFrame) -> DataFrame:
    """Categories as text with gaps filled by the most frequent value; flags as 0/1."""
    text = {c: F.col(c).cast("string") for c in categories}
    typed = df.withColumns({**text, **{f: F.col(f).cast("int") for f in flags}})
    base = fit_on.withColumns(text) if text else fit_on
    return fill_most_frequent(typed, list(categories), base)


def weight_table(spark, names: Sequence[str], weights: Sequence[float], value: str = "coefficient") -> DataFrame:
    """Model weights with their feature names, largest first."""
    rows = [(name, float(weight)) for name, weight in zip(names, weights, strict=True)]
    return spark.createDataFrame(rows, f"feature string, {value} double").orderBy(F.desc(value), "feature")
