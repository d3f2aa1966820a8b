"""Upsert, replace and recompute as pure DataFrame operators.

Parquet has no MERGE, so these return the table's new content. The path-level
versions in ``tidegate.sinks.tables`` limit the rewrite to the partitions a
batch touches.
"""

from __future__ import annotations

import datetime as dt
import operator
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.times import as_date, in_window
from tidegate.operators.keys import SPREAD, dedupe_latest, with_spread


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str] | None = None,
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Update on key match, insert otherwise; the newest source row of a key wins.

    Source rows with a null key match nothing and are inserted as they are,
    which is what MERGE does; of several source rows of one key one is taken, the
    newest by ``order_by`` and otherwise by all columns. Each input is read once.
    """
    keys = [*keys, SPREAD]
    s, t = with_spread(source, keys[:-1]), with_spread(target, keys[:-1])
    return with_source(t, dedupe_latest(s, keys, order_by or []), keys, update_cols).select(*target.columns)


def upsert_latest(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """``upsert`` of the newest source row of each key, rows without a key counted as one key.

    The source is dealt once, by the columns that the join needs, for the choice of the newest row as for the join.
    """
    no_key = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    s = source.withColumn(SPREAD, F.when(no_key, F.lit(-2)).otherwise(F.lit(-1)).cast("long"))
    t = with_spread(target, keys)
    keys = [*keys, SPREAD]
    return with_source(t, dedupe_latest(s, keys, order_by), keys).select(*target.columns)


def with_source(
    target: DataFrame, source: DataFrame, keys: list[str], update_cols: Sequence[str] | None = None
) -> DataFrame:
    """One full join on the keys. Matched rows take ``update_cols`` from the source and the rest from the target; without it, all columns."""
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in source.columns], F.lit(True).alias("_in_s"))

    def pick(c: str) -> Column:
        old = F.col(f"_t_{c}")
        new = F.col(f"_s_{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        if update_cols is None:
            use_new = F.col("_in_s").isNotNull()
        else:
            use_new = F.col("_in_s").isNotNull() if c in update_cols and c in source.columns else F.col("_in_t").isNull()
        return F.when(use_new, new).otherwise(old).alias(c)

    return t.join(s, keys, "full_outer").select(*keys, *[pick(c) for c in cols])


def replace_range(target: DataFrame, batch: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Drop rows with ``start <= ts < end`` and add the batch. Null times are kept."""
    outside = target.filter(~F.coalesce(in_window(ts_col, start, end), F.lit(False)))
    return outside.unionByName(batch)


def replace_date(target: DataFrame, batch: DataFrame, date_col: str, run_date) -> DataFrame:
    """Drop one business date and add the batch; an empty batch still clears it."""
    keep = ~F.coalesce(F.col(date_col) == as_date(run_date), F.lit(False))
    return target.filter(keep).unionByName(batch)


def soft_delete(target: DataFrame, deleted: DataFrame, key: str, set_cols: Mapping[str, object]) -> DataFrame:
    """Mark rows deleted at the source instead of removing them."""
    gone = deleted.select(key).distinct().withColumn("_gone", F.lit(True))
    marked = target.join(gone, key, "left")
    changed = {
        c: F.when(F.col("_gone"), v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)) for c, v in set_cols.items()
    }
    return marked.withColumns(changed).select(*target.columns)


def apply_retention(df: DataFrame, date_col: str, today, years: int = 3) -> DataFrame:
    return df.filter(F.col(date_col) >= F.add_months(as_date(today), -12 * years))


def reevaluate_recent(table: DataFrame, ts_col: str, now: dt.datetime, hours: int, rules: Mapping[str, Column]) -> DataFrame:
    """Evaluate ``rules`` again for rows of the last ``hours``; older rows keep what they have. The table is read once."""
    recent = F.coalesce(in_window(ts_col, now - dt.timedelta(hours=hours), now), F.lit(False))
    return table.withColumns({c: F.when(recent, rule).otherwise(F.col(c)) for c, rule in rules.items()})


def recompute_tail(
    mart: DataFrame,
    facts: DataFrame,
    date_col: str,
    today: str | dt.date,
    aggregate: Callable[[DataFrame], DataFrame],
    days: int = 7,
) -> DataFrame:
    """Clear the last ``days`` of a mart and aggregate them again from the facts."""
    cut = F.date_sub(as_date(today), days)
    old = mart.filter(F.col(date_col) < cut)
    return old.unionByName(aggregate(facts.filter(F.col(date_col) >= cut)))
