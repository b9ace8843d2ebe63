"""Library classifiers (survey: M4, M9, A11, S12)."""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def nb_fit(df: DataFrame, features: str = "features", label: str = "label",
           smoothing: float = 1.0, model_type: str = "multinomial") -> NaiveBayesModel:
    """M4: multinomial naive Bayes (Laplace ``smoothing``). The fit is one aggregate of
    per-class feature sums; only a classes x features matrix reaches the driver."""
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing,
                      modelType=model_type).fit(df)


def nb_predict(model: NaiveBayesModel, df: DataFrame) -> DataFrame:
    """Adds ``rawPrediction, probability, prediction``."""
    return model.transform(df)


def probability_columns(df: DataFrame, n: int, col: str = "probability", prefix: str = "p") -> DataFrame:
    arr = vector_to_array(F.col(col))
    return df.withColumns({f"{prefix}{i}": arr[i] for i in range(n)})


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(total, correct, accuracy)`` from one aggregate."""
    return pred.agg(F.count(F.lit(1)).alias("total"),
                    F.count_if(F.col(label) == F.col(prediction)).alias("correct")).select(
        "total", "correct", F.try_divide(F.col("correct"), F.col("total")).alias("accuracy"))


def hash_split(df: DataFrame, key: str, train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Train and test part by a hash of ``key`` (thousandths of its MD5): rows of one key
    fall on one side, and on the same in any run and partitioning. A null key counts as
    empty."""
    h = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    is_train = F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 1000 < int(round(train_fraction * 1000))
    return df.where(is_train), df.where(~is_train)


def train_eval(df: DataFrame, features: str, label: str, key: str, train_fraction: float = 0.8,
               smoothing: float = 1.0):
    """M9: split by a hash of ``key``, fit on the train part, predict the test part. Returns
    ``(model, predictions, accuracy_row)``."""
    train, test = hash_split(df, key, train_fraction)
    model = nb_fit(train, features, label, smoothing)
    pred = nb_predict(model, test)
    return model, pred, accuracy(pred, label)


def save_model(model: NaiveBayesModel, path: str, overwrite: bool = False) -> None:
    """S12."""
    (model.write().overwrite() if overwrite else model.write()).save(path)


def load_model(path: str) -> NaiveBayesModel:
    return NaiveBayesModel.load(path)
