"""The whole run: prepare tables, lay out the grid, skip what a result table holds already, fit, append."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterloom.operators import prep
from clusterloom.plans import grid as grids
from clusterloom.sources.results import RESULT_SCHEMA, conform, write_results



def finished(spark: SparkSession, out: str) -> DataFrame:
    """The result rows below ``out``; an empty table before the first batch."""
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], RESULT_SCHEMA)
    return conform(spark.read.schema(RESULT_SCHEMA).parquet(out))


def run_experiment(
    tables: dict[str, tuple[DataFrame, str]], out: str, ks: Iterable[int] = grids.K_VALUES, runs: int = grids.RUNS,
    algorithms: Iterable[str] | None = None,
) -> DataFrame:
    """Every pending task of every table ``name: (rows with id, class column)``; returns all rows below ``out``.

    Each finished batch is appended to ``out`` (a folder all executors see), so a run that was stopped goes on where it
    was: a task with a result row is not run again. ``algorithms`` restricts a run. The task table is model-sized: its rows
    do not depend on the data. A task that fails has a row with ``error`` and is not repeated either.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    for name, (rows, class_col) in tables.items():
        features, _ = prep.prepare(rows, class_col=class_col)
        first = features.select(F.size("features").alias("width")).first()
        if first is None:
            continue
        sets = spark.createDataFrame([(name, first["width"])], "dataset string, n_features int")
        tasks = grids.grid(sets, ks, runs)
        if algorithms is not None:
            tasks = tasks.where(F.col("algorithm").isin(list(algorithms)))
        left = [r.asDict() for r in grids.pending(tasks, finished(spark, out)).collect()]
        if left:
            grids.run_tasks(name, features, left, on_batch=lambda batch: write_results(batch, out, fmt="parquet"))
    return finished(spark, out)
