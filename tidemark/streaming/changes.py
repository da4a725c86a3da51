"""Sets of changes that micro-batches append and readers fold.

A set lies in a folder that names its version, the run that wrote it and the
batch of that run: looking sets up reads folder names only. A run is what one
checkpoint stands for, also after restarts; a new checkpoint is a new run, even
at the place of an old one. A batch that is replayed finds the set it wrote and
overwrites that, so it is applied once; nothing else is ever overwritten. A
folded set stands for all sets of lower versions, which readers then leave out.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDED = "compacted"
# Sets that a reader folds at most, but for the last micro-batch, before they become one.
FOLD_AFTER = 64
_NAMES = "version bigint, run string, batch bigint"


def stored(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """Rows of all sets with their version, run and batch."""
    schema = f"{schema}, {_NAMES}"
    try:
        return spark.read.schema(schema).parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def current(spark: SparkSession, root: str, schema: str, but: tuple[str, int] | None = None) -> DataFrame:
    """Rows of the newest folded set and of all sets after it, with their version.

    ``but`` leaves out the set of a run and batch, which a replay is about to overwrite.
    """
    rows = stored(spark, root, schema)
    if but:
        rows = rows.filter(~((F.col("run") == but[0]) & (F.col("batch") == but[1])))
    base = rows.agg(F.max(F.when(F.col("run") == FOLDED, F.col("version")))).scalar()
    return rows.filter(F.col("version") >= F.coalesce(base, F.lit(0))).drop("run", "batch")


def run_of(batch: DataFrame) -> str:
    """The run of a micro-batch, inside ``foreachBatch``: the id that its query's checkpoint keeps."""
    run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise RuntimeError("not inside a micro-batch")
    return run


def other_runs(spark: SparkSession, root: str, schema: str, run: str) -> bool:
    """Whether any other run has written sets."""
    return not stored(spark, root, schema).filter((F.col("run") != run) & (F.col("run") != FOLDED)).isEmpty()


def write(changes: DataFrame, root: str, schema: str, run: str, batch: int) -> int:
    """Keep a set above all stored versions; the same batch of the same run overwrites its own. Returns the sets since the last fold."""
    sets = stored(changes.sparkSession, root, schema).select("version", "run", "batch").distinct()
    mine = F.max(F.when((F.col("run") == run) & (F.col("batch") == batch), F.col("version")))
    base = F.max(F.when(F.col("run") == FOLDED, F.col("version")))
    found = sets.agg(mine.alias("mine"), F.max("version").alias("last"), base.alias("base")).first()
    version = found.mine if found.mine is not None else (found.last or 0) + 1
    changes.write.mode("overwrite").parquet(f"{root}/version={version}/run={run}/batch={batch}")
    return version - (found.base or 0)


def fold(rows: DataFrame, root: str, schema: str) -> None:
    """Keep ``rows``, made of all sets so far, as the set that readers start from."""
    last = stored(rows.sparkSession, root, schema).agg(F.max("version").alias("last")).first().last
    if last is not None:
        rows.write.parquet(f"{root}/version={last + 1}/run={FOLDED}/batch=0")
