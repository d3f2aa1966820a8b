"""Cross-system reconciliation of two order books and of two ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.numbers import ratio, round_dec
from tidegate.operators.keys import SPREAD, dedupe_latest, with_spread

TOLERANCE = "0.01"
ALERT_AT = 50


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """How many rows de-duplication would drop, per side."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("extra_rows")
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    compare: Sequence[str],
    rate: str,
    order_by: Sequence[str],
    tolerance: str = TOLERANCE,
) -> DataFrame:
    """Classify every key: GHOST, ORPHAN, MISMATCH, then RATE_ERR.

    One full outer join decides all four types. Rows without a key match
    nothing; a second join key spreads them over the partitions.
    """
    fields = [*compare, rate]
    on = [key, SPREAD]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        one = dedupe_latest(with_spread(df, [key]), on, order_by)
        return one.select(*on, *[F.col(c).alias(prefix + c) for c in fields], F.lit(True).alias(prefix + "in"))

    both = side(left, "l_").join(side(right, "r_"), on, "full_outer")
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col("l_" + c).eqNullSafe(F.col("r_" + c))
    gap = F.abs(F.coalesce(F.col("l_" + rate), F.lit(0)) - F.coalesce(F.col("r_" + rate), F.lit(0)))
    kind = (
        F.when(F.col("r_in").isNull(), "GHOST")
        .when(F.col("l_in").isNull(), "ORPHAN")
        .when(differs, "MISMATCH")
        .when(gap > F.lit(tolerance).cast("decimal(18,4)"), "RATE_ERR")
    )
    # The row shown is the billing side where it exists, else the other side.
    shown = [F.coalesce(F.col("l_" + c), F.when(F.col("l_in").isNull(), F.col("r_" + c))).alias(c) for c in fields]
    return (
        both.withColumn("discrepancy_type", kind)
        .filter(F.col("discrepancy_type").isNotNull())
        .select(
            key,
            *shown,
            "discrepancy_type",
            F.when(F.col("r_in").isNull(), "EBS_ONLY").when(F.col("l_in").isNull(), "SF_ONLY").alias("source"),
            F.when(F.col("discrepancy_type") == "MISMATCH", F.col("r_" + compare[0])).alias("sf_" + compare[0]),
            F.when(F.col("discrepancy_type") == "RATE_ERR", F.col("l_" + rate)).alias("ebs_rate"),
            F.when(F.col("discrepancy_type") == "RATE_ERR", F.col("r_" + rate)).alias("sf_rate"),
        )
    )


def recon_summary(discrepancies: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return discrepancies.groupBy(*by, "discrepancy_type").agg(F.count("*").alias("discrepancies"))


def exceeds(df: DataFrame, n: int = ALERT_AT, by: Sequence[str] = ()) -> DataFrame:
    """One row (or one per group): the count and whether it reaches ``n``."""
    counted = df.groupBy(*by).agg(F.count("*").alias("total"))
    return counted.withColumn("exceeded", F.col("total") >= n)


def ar_gl_reconciliation(ar: DataFrame, gl: DataFrame) -> DataFrame:
    """Invoiced against posted, per period and type, flagged within 1 %."""
    invoiced = ar.groupBy("period_name", "invoice_type").agg(F.sum("invoice_amount").alias("ar_total_invoiced"))
    posted = gl.groupBy("period_name", "invoice_type").agg(F.sum("accounted_cr").alias("gl_total_posted"))
    both = invoiced.join(posted, ["period_name", "invoice_type"], "full_outer")
    gap = F.coalesce(F.col("ar_total_invoiced"), F.lit(0)) - F.coalesce(F.col("gl_total_posted"), F.lit(0))
    return both.withColumn("variance_aud", round_dec(gap, 2)).withColumns(
        {
            "variance_pct": round_dec(ratio("variance_aud", "ar_total_invoiced"), 6),
            "reconciled_flag": F.coalesce(F.abs(ratio("variance_aud", "ar_total_invoiced")) < 0.01, F.lit(False)),
        }
    )
