"""Lookups, effective-dated contracts, orphan checks, hierarchies.

No side carries a broadcast hint: Catalyst broadcasts a side only below the
session's size threshold, and otherwise the join is sort-merge with adaptive
splitting of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import percent, round_dec
from tidegate.functions.rules import congestion_flag
from tidegate.functions.times import effective_on
from tidegate.operators.keys import dedupe_latest


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    cols: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    order_by: Sequence[Column | str] | None = None,
) -> DataFrame:
    """Left lookup that can never multiply rows when ``order_by`` is given."""
    keys = [on] if isinstance(on, str) else list(on)
    side = dim.select(*keys, *cols)
    if order_by is not None:
        side = dedupe_latest(dim, keys, order_by).select(*keys, *cols)
    out = df.join(side, keys, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows whose non-null key is absent from the dimension."""
    return fact.filter(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")


def with_manager(df: DataFrame, key: str, manager_key: str, cols: Sequence[str], prefix: str = "manager_") -> DataFrame:
    bosses = df.select(F.col(key).alias(manager_key), *[F.col(c).alias(prefix + c) for c in cols])
    return df.join(bosses, manager_key, "left")


def asof_contract(facts: DataFrame, contracts: DataFrame, run_date, key: str = "poi_id") -> DataFrame:
    """Contract in force on one date; of overlapping contracts the newest start wins."""
    live = contracts.filter(effective_on(run_date))
    live = dedupe_latest(live, [key], ["effective_from"]).select(
        key, F.col("contracted_cvc_gbps").alias("contracted_gbps")
    )
    return facts.join(live, key, "left")


def asof_contract_by_row(facts: DataFrame, contracts: DataFrame, date_col: str, key: str = "poi_id") -> DataFrame:
    """Contract in force on each row's own date.

    The rows are first reduced to the days each key appears on. Contracts are
    ranged against those days only, and the answer is joined back on key and
    day, so a busy key costs as many comparisons as it has days.
    """
    dated = facts.withColumn("_day", F.to_date(F.col(date_col)))
    days = dated.select(key, "_day").filter(F.col(key).isNotNull() & F.col("_day").isNotNull()).distinct()
    live = (F.col("effective_from") <= F.col("_day")) & (F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_day")))
    rate = (
        days.join(contracts.select(key, "effective_from", "effective_to", "contracted_cvc_gbps"), key)
        .filter(live)
        .groupBy(key, "_day")
        .agg(F.max_by("contracted_cvc_gbps", "effective_from").alias("contracted_gbps"))
    )
    return dated.join(rate, [key, "_day"], "left").drop("_day")


def cvc_utilisation(facts: DataFrame, contracts: DataFrame, run_date) -> DataFrame:
    """Throughput against contracted capacity, headroom and congestion flag."""
    joined = asof_contract(facts, contracts, run_date)
    return joined.withColumns(
        {
            "utilisation_pct": percent("throughput_gbps", "contracted_gbps"),
            "headroom_gbps": round_dec(F.col("contracted_gbps") - F.col("throughput_gbps"), 3),
        }
    ).withColumn("congestion_flag", congestion_flag("utilisation_pct"))


def congestion_alerts(utilisation: DataFrame) -> DataFrame:
    return utilisation.filter(F.coalesce(F.col("congestion_flag"), F.lit(False))).select(
        "poi_id", "hour_label", "utilisation_pct", "headroom_gbps"
    )
