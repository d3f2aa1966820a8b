"""Unloads: Parquet/CSV/JSON prefixes, submissions, relational and keyed writers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tidegate.functions.times import iso_week_label


def unload(df: DataFrame, prefix: str, fmt: str = "parquet", overwrite: bool = True) -> str:
    writer = df.write.mode("overwrite" if overwrite else "append").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(prefix)
    return prefix


def ordered_extract(df: DataFrame, prefix: str, order_by: Sequence[str], fmt: str = "parquet") -> str:
    """Unload in order: sorted by range over the cluster, so the files in name order are the whole in order."""
    return unload(df.orderBy(*order_by), prefix, fmt)


def unload_csv_gz(df: DataFrame, prefix: str, header: bool = True, single: bool = False) -> str:
    """Gzipped CSV. ``single`` is the caller's explicit wish for one file."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("compression", "gzip").option("header", header).csv(prefix)
    return prefix


def write_submission(df: DataFrame, base: str, run_date: str) -> str:
    """One JSON object per line under the ISO week of the run date."""
    path = f"{base.rstrip('/')}/{iso_week_label(run_date)}/report"
    df.write.mode("overwrite").json(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000, **options: str) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize).options(
        **options
    ).mode(mode).save()


def write_keyed(df: DataFrame, writer: Callable[[list[tuple[str, Row]]], None], key: str, batch: int = 500) -> None:
    """Send ``(id, row)`` batches to a keyed store from every partition.

    ``writer`` runs inside the tasks. A task that is retried sends its rows
    again, so the store must overwrite by id, as key-value stores do.
    """

    def send(rows: Iterator[Row]) -> None:
        chunk: list[tuple[str, Row]] = []
        for row in rows:
            chunk.append((str(row[key]), row))
            if len(chunk) == batch:
                writer(chunk)
                chunk = []
        if chunk:
            writer(chunk)

    df.foreachPartition(send)


def as_string_items(df: DataFrame) -> DataFrame:
    """Every attribute as text, null as the empty string (key-value stores)."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])
