"""Regression measures, each one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_absolute_error(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def mean_squared_error(y: Column, p: Column) -> Column:
    return F.avg((y - p) * (y - p))


def r_squared(y: Column, p: Column) -> Column:
    return 1 - F.try_divide(F.sum((y - p) * (y - p)), F.count(y - p) * F.var_pop(F.when(p.isNotNull(), y)))


def mean_percent_error(y: Column, p: Column) -> Column:
    """Rows with y = 0 would be infinite and are left out."""
    return F.avg(F.when(y != 0, F.abs(y - p) / y))


def explained_variance(y: Column, p: Column) -> Column:
    return 1 - F.try_divide(F.var_pop(y - p), F.var_pop(F.when(p.isNotNull(), y)))


def measures(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.agg(mean_absolute_error(y, p).alias("mae"), mean_squared_error(y, p).alias("mse"),
                  r_squared(y, p).alias("r2"), mean_percent_error(y, p).alias("mape"),
                  explained_variance(y, p).alias("explained_variance"))
