"""Regression metrics (A10, F14) and the actual-vs-predicted table.

One aggregate pass per evaluated set, all numerically stable forms:

    MSE  = avg((y - p)^2)              RMSE = sqrt(MSE)
    MAE  = avg(|y - p|)                R2   = 1 - MSE / var_pop(y)
    explained variance = sum((p - mean y)^2) / n = var_pop(p) + (mean p - mean y)^2
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import squared_error, truncate_to_int

# The metric names, in report order.
METRIC_NAMES = ("test_mean_squared_error", "mse", "rmse", "r2", "mae", "explained_variance")


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       set_col: str = "set_name") -> DataFrame:
    """(set_name, metric, value): six rows per evaluated set."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    per_set = pred.groupBy(set_col).agg(
        F.avg(squared_error(y, p)).alias("_mse"),
        F.avg(F.abs(y - p)).alias("_mae"),
        F.var_pop(y).alias("_var_y"),
        F.var_pop(p).alias("_var_p"),
        F.avg(y).alias("_mean_y"),
        F.avg(p).alias("_mean_p"))
    values = per_set.select(
        set_col,
        F.col("_mse").alias("test_mean_squared_error"),
        F.col("_mse").alias("mse"),
        F.sqrt("_mse").alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("_mse"), F.col("_var_y"))).alias("r2"),
        F.col("_mae").alias("mae"),
        (F.col("_var_p") + F.pow(F.col("_mean_p") - F.col("_mean_y"), 2)).alias("explained_variance"))
    return values.unpivot([set_col], list(METRIC_NAMES), "metric", "value")


def actual_vs_predicted(pred: DataFrame, label: str = "label",
                        prediction: str = "prediction") -> DataFrame:
    """label and prediction truncated to int and their absolute difference."""
    a, p = truncate_to_int(label), truncate_to_int(prediction)
    return pred.select(a.alias("actual"), p.alias("predicted"), F.abs(a.cast("long") - p).alias("abs_diff"))
