"""Fitted transforms and models as files, for scoring in another job."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.ml.preprocess import Prepared

MODELS = {"GBTClassificationModel": GBTClassificationModel, "LogisticRegressionModel": LogisticRegressionModel}
NUMBERS = ("fill", "mean", "scale")
FIELDS = "kind string, column string, position int, number double, text string"


def save_prepared(spark: SparkSession, prepared: Prepared, path: str) -> None:
    """One row per fitted number, mode and category; as many as the model is wide."""
    rows = [(k, c, i, float(x), None) for k in NUMBERS for i, (c, x) in enumerate(getattr(prepared, k).items())]
    rows += [("mode", c, i, None, t) for i, (c, t) in enumerate(prepared.mode.items())]
    rows += [("category", c, i, None, t) for c, values in prepared.categories.items() for i, t in enumerate(values)]
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("overwrite").parquet(path)


def load_prepared(spark: SparkSession, path: str) -> Prepared:
    out = Prepared()
    for r in spark.read.schema(FIELDS).parquet(path).orderBy("kind", "position", "column").collect():
        if r["kind"] in NUMBERS:
            getattr(out, r["kind"])[r["column"]] = r["number"]
        elif r["kind"] == "mode":
            out.mode[r["column"]] = r["text"]
        else:
            out.categories.setdefault(r["column"], []).append(r["text"])
    return out


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(spark: SparkSession, path: str):
    """The model of a folder, by the class its metadata names."""
    name = DefaultParamsReader.loadMetadata(path, spark)["class"].rpartition(".")[2]
    return MODELS[name].load(path)


def same_scores(a: DataFrame, b: DataFrame, keys: list[str], score: str = "proba") -> DataFrame:
    """Keys of both tables, whether their scores are equal, and whether they are probabilities."""
    other = b.select(*keys, F.col(score).alias("__other"))
    joined = a.select(*keys, score).join(other, keys, "full")
    equal = F.col(score).eqNullSafe(F.col("__other"))
    return joined.select(*keys, equal.alias("equal"), F.coalesce(F.col(score).between(0, 1), F.lit(False)).alias("in_range"))
