"""Columns that are costly to compute and are used by a filter as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read instead of computing it again.

    Spark moves a filter below the projection it refers to and repeats the
    expression there. It cannot move one below a generator, and a generator
    over a single value costs next to nothing. The outer form, because the
    inner one is given a filter of its own.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
