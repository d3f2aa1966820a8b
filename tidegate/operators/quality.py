"""Data-quality gates.

Scalar checks of one table share a single aggregation pass. Every check yields
one row ``(check, observed, threshold, passed, severity)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import ratio, round_dec
from tidegate.operators.joins import orphans

REPORT = ["check", "observed", "threshold", "passed", "severity"]


class CheckFailed(ValueError):
    """A check with severity ``fail`` did not pass."""


def _row(name: str, observed: Column, threshold, passed: Column, severity: Column | str) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        round_dec(observed, 4).cast("double").alias("observed"),
        F.lit(threshold).cast("double").alias("threshold"),
        F.coalesce(passed, F.lit(True)).alias("passed"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
    )


class Gate:
    """Collect checks on one table, then :meth:`report` them together."""

    def __init__(self, df: DataFrame, table: str):
        self.df, self.table = df, table
        self._aggs: list[tuple[Column, callable]] = []
        self._frames: list[Callable[[DataFrame], DataFrame]] = []

    def _scalar(self, name: str, agg: Column, threshold, test, severity="fail", observe=None) -> "Gate":
        alias = f"_c{len(self._aggs)}"
        label = f"{self.table}.{name}"

        def row() -> Column:
            value = F.col(alias)
            shown = value if observe is None else observe(value)
            level = severity(value) if callable(severity) else severity
            return _row(label, shown, threshold, test(value), level)

        self._aggs.append((agg.alias(alias), row))
        return self

    def min_rows(self, n: int, where: Column | None = None, name="min_rows", severity="fail") -> "Gate":
        agg = F.count("*") if where is None else F.count(F.when(where, 1))
        return self._scalar(name, agg, n, lambda v: v >= n, severity)

    def not_null(self, c: str, where: Column | None = None, severity="fail") -> "Gate":
        bad = F.col(c).isNull() if where is None else F.col(c).isNull() & where
        return self._scalar(f"not_null.{c}", F.count(F.when(bad, 1)), 0, lambda v: v == 0, severity)

    def value(self, name: str, ok: Column, severity="warn") -> "Gate":
        """``ok`` must hold wherever it is not null."""
        return self._scalar(f"value.{name}", F.count(F.when(~ok, 1)), 0, lambda v: v == 0, severity)

    def rate(self, c: str) -> "Gate":
        """Share of true values: above 100 % fails, zero warns, no rows pass."""
        num = F.col(c).cast("double")
        agg = ratio(F.sum(num), F.count(num))
        return self._scalar(
            f"rate.{c}",
            agg,
            1,
            lambda v: (v > 0) & (v <= 1),
            lambda v: F.when(v > 1, "fail").otherwise("warn"),
        )

    def threshold(self, name: str, bad: Column, limit: int = 0, severity="warn") -> "Gate":
        return self._scalar(name, F.count(F.when(bad, 1)), limit, lambda v: v <= limit, severity)

    def balance(self, credit: str, debit: str, tolerance: float = 0.01) -> "Gate":
        agg = F.abs(F.coalesce(F.sum(credit), F.lit(0)) - F.coalesce(F.sum(debit), F.lit(0)))
        return self._scalar("balance", agg, tolerance, lambda v: v <= tolerance)

    def no_errors(self, c: str = "errors") -> "Gate":
        return self._scalar("no_errors", F.count(c), 0, lambda v: v == 0)

    def match_rate(self, name: str, matched: Column, floor: float, severity="warn") -> "Gate":
        agg = ratio(F.count(F.when(matched, 1)), F.count("*"))
        return self._scalar(f"match_rate.{name}", agg, floor, lambda v: v >= floor, severity)

    def tolerance(self, name: str, observed: Column, expected: float, allowed: float, severity="warn") -> "Gate":
        """``observed`` is an aggregate that must lie within ``allowed`` of ``expected``."""
        return self._scalar(f"tolerance.{name}", F.abs(observed - expected), allowed, lambda v: v <= allowed, severity)

    def _frame(self, name: str, counted: Callable[[DataFrame], DataFrame], severity: str) -> "Gate":
        row = _row(f"{self.table}.{name}", F.col("n"), 0, F.col("n") == 0, severity)
        self._frames.append(lambda df: counted(df).agg(F.count("*").alias("n")).select(row.alias("r")).select("r.*"))
        return self

    def unique(self, keys: Sequence[str], severity="fail") -> "Gate":
        """Counts keys that occur more than once; needs its own shuffle."""
        return self._frame(
            f"unique.{'+'.join(keys)}", lambda df: df.groupBy(*keys).agg(F.count("*").alias("c")).filter("c > 1"), severity
        )

    def foreign_key(self, key: str, dim: DataFrame, severity="warn") -> "Gate":
        return self._frame(f"foreign_key.{key}", lambda df: orphans(df.select(key), dim, key), severity)

    def scalars(self) -> list[Column]:
        """The aggregates behind the scalar checks, to be observed while the table is written."""
        return [a for a, _ in self._aggs]

    def report(self, df: DataFrame | None = None, observed: DataFrame | None = None) -> DataFrame:
        """The verdicts. ``observed`` is one row of :meth:`scalars`, if they are known already; ``df`` a copy to check instead."""
        df = self.df if df is None else df
        frames = [frame(df) for frame in self._frames]
        if self._aggs:
            one = df.agg(*self.scalars()) if observed is None else observed
            rows = F.array(*[make() for _, make in self._aggs])
            frames.insert(0, one.select(F.inline(rows)))
        return reduce(DataFrame.unionByName, frames)


def enforce(report: DataFrame) -> DataFrame:
    """Raise when a failing check has severity ``fail``; only those rows are fetched."""
    broken = report.filter(~F.col("passed") & (F.col("severity") == "fail")).collect()
    if broken:
        raise CheckFailed("; ".join(f"{r['check']}: {r['observed']} (limit {r['threshold']})" for r in broken))
    return report
