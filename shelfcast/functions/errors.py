"""Forecast errors as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean_absolute_error(actual: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(actual) - F.col(predicted)))


def mean_squared_error(actual: str, predicted: str) -> Column:
    error = F.col(actual) - F.col(predicted)
    return F.avg(error * error)


def root_mean_squared_error(actual: str, predicted: str) -> Column:
    return F.sqrt(mean_squared_error(actual, predicted))
