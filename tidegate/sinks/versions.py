"""Catalog tables whose content is replaced in one step: a new folder is written, then the table points to it.

A reader sees the old rows or the new ones and always a table. A query that started before the
step goes on reading the folder it began with, which stays until a later refresh drops it.
"""

from __future__ import annotations

import operator
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import merge
from tidegate.operators.keys import dedupe_latest
from tidegate.operators.quality import Gate, enforce
from tidegate.sinks import storage
from tidegate.sinks.staging import write_observed


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").select("data_type").collect()
    return rows[0][0].rstrip("/")


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of the table's versions below ``root``, oldest first; their names begin with their number."""
    return sorted(storage.folders(spark, f"{root.rstrip('/')}/v*"), key=lambda p: p.rsplit("/", 1)[1])


def refresh(
    df: DataFrame, table: str, root: str, gate: Callable[[DataFrame], Gate] | None = None, keep: int = 2
) -> str:
    """Write ``df`` as the next version of ``table`` and point the table to it; returns the version's folder.

    The table is created with the first version. A gate is judged by what the write observed, and if it
    fails the table stays as it is. Of the versions, the newest ``keep`` stay for running readers; a version
    whose job was lost before the step is dropped with the rest and was never visible.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    number = 1 + max((int(p.rsplit("/v", 1)[1].split("-")[0]) for p in known), default=0)
    path = f"{root.rstrip('/')}/v{number:08d}-{uuid.uuid4().hex[:8]}"
    checks = gate(df) if gate is not None else None
    one = write_observed(df, path, {f"_c{n}": c for n, c in enumerate(checks.scalars())} if checks else {})
    if checks:
        try:
            enforce(checks.report(spark.read.schema(df.schema).parquet(path), one))
        except ValueError:
            storage.remove(spark, path)
            raise
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{path}'")
    now = location(spark, table).rsplit("/", 1)[1]
    current = [p for p in versions(spark, root) if p.rsplit("/", 1)[1] <= now]
    for old in current[:-keep]:
        storage.remove(spark, old)
    return path


# --- merging into tables that are bucketed by their key ---------------------------------------------


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> None:
    """``df`` as a table of ``buckets`` files per write, hashed and sorted by the keys."""
    (
        df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    )


def merge_bucketed(source: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, order_by: Sequence[str] = ()) -> None:
    """Upsert ``source`` into a bucketed table, as a new table at ``path`` that takes its name.

    Only the batch is shuffled, into the table's own buckets; the table is read bucket by bucket, in the
    order of its keys, joined, and written again without an exchange. Rows without a key are inserted as they are.
    """
    spark = source.sparkSession
    rows = merged_bucketed(spark.table(table), source, keys, order_by, buckets)
    new = f"{table}__{uuid.uuid4().hex[:8]}"
    rows.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(new)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")


def merged_bucketed(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> DataFrame:
    """The target's rows with the source's in their place: a full join on the keys alone, so that the buckets are used."""
    no_key = reduce(operator.or_, [F.col(k).isNull() for k in keys])
    # Dealt into the target's buckets once; picking the newest row and the join both use that.
    batch = dedupe_latest(source.filter(~no_key).repartition(buckets, *keys), keys, order_by)
    rows = merge.with_source(target, batch, list(keys)).select(*target.columns)
    return rows.unionByName(source.filter(no_key).select(*target.columns))
