"""Keeping costly expressions from running twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, *columns: Column) -> DataFrame:
    """Add columns whose values later filters reuse.

    A filter on a computed column is pushed below the projection, and the expression
    then runs in the filter and again in the projection.  Values that come out of a
    one-row generator stay where they are, so a regex in them runs once per row.
    """
    return df.select("*", F.inline(F.array(F.struct(*columns))))
