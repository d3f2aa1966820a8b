"""Classification rules, each one ordered CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.numbers import _col, ratio, round_dec
from tidegate.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, count_words, keyword_hits
from tidegate.functions.times import as_date

# Codes, thresholds and accounts that decide the result.
STATUS_LABELS = {
    "ACT": "ACTIVE",
    "PND": "PENDING",
    "PRG": "IN_PROGRESS",
    "FAI": "FAILED",
    "CAN": "CANCELLED",
    "SUS": "SUSPENDED",
}
SLA_DAYS = {"residential": 15, "business": 5, "priority": 2}
DEFAULT_SLA_DAYS = 15
HEALTH_STEPS = {
    # column: (warning limit, critical limit, warning points, critical points)
    "availability_pct": (99.0, 95.0, 20, 40),
    "error_rate_pct": (0.1, 1.0, 15, 30),
    "cpu_utilisation_pct": (80.0, 95.0, 10, 20),
    "mem_utilisation_pct": (85.0, 95.0, 5, 10),
}
CONGESTION_PCT = 80
MASS_FAILURE_PREMISES = 2500
HOT_PCT, COLD_PCT, CABINET_PCT, URGENT_PCT = 85.0, 20.0, 90.0, 95.0
REVENUE_ACCOUNTS = {"CVC": "4100", "AVC": "4200", "INSTALL": "4200"}
DEFERRED_ACCOUNT = "4300"


def sla_met(status, priority, days) -> Column:
    """Null unless active; a missing duration counts as missed."""
    limit = F.lit(DEFAULT_SLA_DAYS)
    for name, n in SLA_DAYS.items():
        limit = F.when(F.lower(_col(priority)) == name, n).otherwise(limit)
    return F.when(_col(status) == "ACTIVE", F.coalesce(_col(days) <= limit, F.lit(False)))


def nps_category(score) -> Column:
    s = _col(score)
    return F.when(s >= 9, "promoter").when(s >= 7, "passive").when(s.isNotNull(), "detractor")


def sentiment(text, score) -> Column:
    t, s = _col(text), _col(score)

    def label(hits: Column) -> Column:
        pos, neg = count_words(hits, POSITIVE_WORDS), count_words(hits, NEGATIVE_WORDS)
        return (
            F.when((pos > neg) & (s >= 7), "positive")
            .when((neg > pos) | (s <= 4), "negative")
            .otherwise("neutral")
        )

    # Binding the hits as a lambda argument evaluates the scan once per text.
    hits = keyword_hits(t, POSITIVE_WORDS + NEGATIVE_WORDS)
    scored = F.element_at(F.transform(F.array(hits), label), 1)
    return F.when(F.coalesce(t, F.lit("")) == "", "neutral").otherwise(scored)


def _penalty(name: str, c: Column) -> Column:
    warn, crit, warn_pts, crit_pts = HEALTH_STEPS[name]
    if name == "availability_pct":
        return F.when(c < crit, crit_pts).when(c < warn, warn_pts).otherwise(0)
    return F.when(c > crit, crit_pts).when(c > warn, warn_pts).otherwise(0)


def health_score(availability, errors, cpu, memory) -> Column:
    cols = dict(zip(HEALTH_STEPS, map(_col, (availability, errors, cpu, memory))))
    lost = sum((_penalty(k, c) for k, c in cols.items()), F.lit(0))
    return F.greatest(F.lit(100) - lost, F.lit(0))


def health_status(score) -> Column:
    s = _col(score)
    return F.when(s < 40, "CRITICAL").when(s < 60, "WARNING").otherwise("HEALTHY")


def congestion_flag(utilisation) -> Column:
    return F.coalesce(_col(utilisation) > CONGESTION_PCT, F.lit(False))


def mass_failure(premises, resolved_at) -> Column:
    return (F.coalesce(_col(premises), F.lit(0)) >= MASS_FAILURE_PREMISES) & _col(resolved_at).isNull()


def budget_risk(utilisation) -> Column:
    u = _col(utilisation)
    return F.when(u > 100, "CRITICAL").when(u > 90, "WARNING").when(u > 75, "WATCH").otherwise("ON_TRACK")


def splitter_flag(utilisation) -> Column:
    u = _col(utilisation)
    return F.when(u > HOT_PCT, "HOT").when(u < COLD_PCT, "COLD").otherwise("OK")


def cabinet_flag(utilisation) -> Column:
    return F.when(_col(utilisation) > CABINET_PCT, "CRITICAL").otherwise("OK")


def payment_status(amount, remaining, due_date, today) -> Column:
    left = _col(remaining)
    return (
        F.when(left == 0, "Paid")
        .when((_col(due_date) < as_date(today)) & (left > 0), "Overdue")
        .when((left > 0) & (left < _col(amount)), "Partially Paid")
        .otherwise("Open")
    )


def purchase_status(ordered, received, deleted) -> Column:
    got = F.coalesce(_col(received), F.lit(0))
    return (
        F.when(F.coalesce(_col(deleted), F.lit(False)), "Cancelled")
        .when(got >= _col(ordered), "Completed")
        .when(got > 0, "Partially Received")
        .otherwise("Open")
    )


def reportable_fault(priority, category, impacted, state) -> Column:
    hit = _col(priority).isin(1, 2) & (_col(category) == "Network") & (_col(impacted) >= 1)
    return F.coalesce(hit & (_col(state) != "Cancelled"), F.lit(False))


def sentiment_category(score) -> Column:
    s = _col(score)
    return F.when(s > 0.2, "Positive").when(s < -0.2, "Negative").when(s.isNotNull(), "Neutral")


def lifecycle_status(deletion_flag, user_status) -> Column:
    return F.when(_col(deletion_flag) == "X", "Decommissioned").otherwise(_col(user_status))


def transaction_type(posted, po_backed) -> Column:
    return (
        F.when(F.coalesce(_col(posted), F.lit(False)), "Actual")
        .when(F.coalesce(_col(po_backed), F.lit(False)), "Committed")
        .otherwise("Forecast")
    )


def refresh_risk(age_years, utilisation, faults, out_of_warranty, weights=(25, 25, 25, 25)) -> Column:
    """0-100 from age (10 years = full), utilisation, faults (5 = full) and warranty."""
    w = [F.lit(float(x)) for x in weights]

    def share(x: Column) -> Column:
        return F.least(F.greatest(F.coalesce(x, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))

    return round_dec(
        w[0] * share(_col(age_years).cast("double") / 10)
        + w[1] * share(_col(utilisation).cast("double") / 100)
        + w[2] * share(_col(faults).cast("double") / 5)
        + w[3] * F.coalesce(_col(out_of_warranty), F.lit(False)).cast("double"),
        2,
    )


def nps_score(promoters, detractors, total) -> Column:
    return round_dec(ratio(_col(promoters) - _col(detractors), _col(total)) * 100, 2)
