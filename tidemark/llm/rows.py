"""What the operators share: given tables, let-bindings, whole rows and working tables."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str = "text") -> Column:
    """The text, a missing one as an empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, unchanged and in order."""
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no added name can clash."""
    return F.struct(*[F.col(f"`{name}`") for name in docs.columns])


def unpacked(df: DataFrame, column: str = "doc") -> DataFrame:
    """Back to the columns that were packed."""
    return df.select(f"{column}.*")


def groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in a column of the sorted batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(value[1:] != value[:-1]) + 1).tolist(), len(value)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column(column)[0] != batch.column(column)[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def shipped(module: str) -> None:
    """Send a module's functions to the tasks by value: executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


shipped(__name__)
