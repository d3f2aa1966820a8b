"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import fit_shuffles, scratch_dir, tune
from tidegate.sinks import storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_OPENED: dict[tuple[str, str, str], DataFrame] = {}


class Tables:
    """The test tables of one folder, each opened once per application.

    Only the file listing and schema are kept; every query scans the files.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.used = spark, folder, set()

    def __getattr__(self, name: str) -> DataFrame:
        self.used.add(name)
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _OPENED or _OPENED[key].sparkSession is not self.spark:
            _OPENED[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return _OPENED[key]

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)


def portable(df: DataFrame) -> DataFrame:
    """Plain column types that every SQL engine prints alike.

    Decimals become doubles, dates ISO text, arrays comma-separated text.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c.cast("array<string>"))
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = Tables(tune(spark), folder)
            out = portable(fn(tables))
            # The result runs later, so the count may follow the tables that the plan turned out to use.
            fit_shuffles(spark, sum(storage.size_of(spark, f"{folder}/{name}.parquet") for name in tables.used))
            return out

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


# --- helpers for writing the SQL side ----------------------------------------


def R(x: str, n: int) -> str:
    """Half-up rounding through a decimal, returned as a double."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def PCT(a: str, b: str, n: int = 2) -> str:
    return R(f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)) * 100", n)


def RATIO(a: str, b: str, n: int) -> str:
    return R(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", n)


def D(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def DAY(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS VARCHAR)"


def MONEY(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def N(x: str) -> str:
    return f"CAST({x} AS BIGINT)"
