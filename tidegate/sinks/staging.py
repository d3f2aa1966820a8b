"""Gates in the pass that writes: a batch is computed once, judged by what its write observed, then published."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegate.operators.quality import CheckFailed, Gate, enforce
from tidegate.session import scratch_dir
from tidegate.sinks import storage, tables


def write_observed(df: DataFrame, path: str, metrics: Mapping[str, Column]) -> DataFrame:
    """Write ``df`` and return one row of ``metrics``, aggregated by the same tasks while they wrote."""
    seen = Observation()
    watched = df.observe(seen, F.count("*").alias("_rows"), *[c.alias(n) for n, c in metrics.items()])
    watched.write.parquet(path)
    found = seen.get
    # Types as the aggregates have them; this is analysed, not run.
    kinds = df.agg(*[c.alias(n) for n, c in metrics.items()]).schema if metrics else None
    spark = df.sparkSession
    return spark.createDataFrame([tuple(found[n] for n in metrics)], kinds) if metrics else spark.range(1)


@contextmanager
def checked_batch(df: DataFrame, gate: Callable[[DataFrame], Gate] | None = None, **metrics: Column):
    """``with checked_batch(df, gate, newest=F.max("ts")) as (batch, values):`` the staged batch, once its gate holds.

    The source is read by one job, which writes the batch beside the table and observes the
    gate's aggregates and ``metrics``. Checks that need a shuffle (unique, foreign_key) read the
    staged copy. A gate that fails raises before the caller publishes anything; the
    staged copy is removed either way.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "staged")
    checks = gate(df) if gate is not None else None
    try:
        scalars = {f"_c{n}": c for n, c in enumerate(checks.scalars())} if checks else {}
        one = write_observed(df, path, scalars | metrics)
        staged = spark.read.schema(df.schema).parquet(path)
        if checks:
            enforce(checks.report(staged, one))
        yield staged, one.first().asDict()
    finally:
        storage.remove(spark, path)


def refresh_checked(df: DataFrame, path: str, gate: Callable[[DataFrame], Gate]) -> None:
    """A full refresh whose new files take the table's place only if the gate holds for them; they are written once."""
    spark, staging, checks = df.sparkSession, tables.beside(path, "new"), gate(df)
    try:
        one = write_observed(df, staging, {f"_c{n}": c for n, c in enumerate(checks.scalars())})
        enforce(checks.report(spark.read.schema(df.schema).parquet(staging), one))
        tables.swap_in(spark, staging, path)
    finally:
        storage.remove(spark, staging)


class Arrivals:
    """Counts a source's rows in the job that uses them, for "the source returned nothing"."""

    def __init__(self, df: DataFrame, table: str):
        self._seen, self._table = Observation(), table
        self.df = df.observe(self._seen, F.count("*").alias("rows"))

    def enforce(self, least: int = 1) -> None:
        """After the job that has read ``df``."""
        rows = self._seen.get["rows"]
        if rows < least:
            raise CheckFailed(f"{self._table}.min_rows: {rows} (limit {least})")
