"""Scores of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"), F.count("*").alias("n"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of all rows per (label, prediction)."""
    cells = df.groupBy(label, prediction).agg(F.count("*").alias("n"))
    # Only label x prediction cells reach this window.
    return cells.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
