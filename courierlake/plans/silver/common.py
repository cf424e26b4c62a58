"""Pieces that several silver tables share."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: date) -> Column:
    """The run's current date. A parameter, so that a rerun gives the same rows."""
    return F.lit(as_of.isoformat()).cast("date")


def loaded_at(as_of: date) -> Column:
    return F.lit(f"{as_of.isoformat()} 00:00:00").cast("timestamp").alias("_loaded_at")


def rating_bucket(rating: Column) -> Column:
    return (
        F.when(rating >= 4.5, "Excellent")
        .when(rating >= 4.0, "Good")
        .when(rating >= 3.5, "Average")
        .otherwise("Poor")
    )
