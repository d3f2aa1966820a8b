"""Path-level table writers: append, replace, merge, full refresh.

A rerun of the same batch leaves the same rows, except for ``append``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.times import as_date, in_window
from tidegate.operators.keys import dedupe_latest
from tidegate.operators.merge import upsert_latest
from tidegate.sinks import storage


def partition_path(base: str, domain: str, table: str, run_date: str | None = None) -> str:
    root = f"{base.rstrip('/')}/{domain}/{table}/"
    return root if run_date is None else f"{root}run_date={run_date}/"


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``."""
    # One exchange on the partition columns bounds the number of files; the
    # adaptive rebalance still splits a partition value that is too large.
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, date_col: str, run_date: str) -> None:
    """Replace one business date. An empty batch clears it, as delete-then-insert does."""
    spark = df.sparkSession
    batch = df.filter(F.col(date_col) == as_date(run_date))
    if batch.isEmpty():
        storage.remove(spark, partition_folder(spark, path, date_col, run_date))
    else:
        overwrite_partitions(batch, path, [date_col])


def read_partitioned(spark: SparkSession, path: str, column: T.StructField) -> DataFrame:
    """A partitioned table whose partition column keeps the declared type (``007`` stays text)."""
    schema = spark.read.parquet(path).schema
    return spark.read.schema(T.StructType([f for f in schema.fields if f.name != column.name] + [column])).parquet(path)


def partition_folder(spark: SparkSession, path: str, column: str, value: str | None) -> str:
    """Folder of one partition value, escaped as Spark's writers do it."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{utils.getPartitionPathString(column, value)}"


def replace_hour(df: DataFrame, path: str, ts_col: str, start: str, end: str) -> None:
    """Replace the rows of ``[start, end)`` in a table partitioned by ``hour``.

    Hours without rows are cleared. Of an hour that the range cuts, the rows
    outside the range are written again.
    """
    spark = df.sparkSession
    hour, name = dt.timedelta(hours=1), "%Y-%m-%dT%H"
    first, last = dt.datetime.fromisoformat(start), dt.datetime.fromisoformat(end)
    low = first.replace(minute=0, second=0, microsecond=0)
    hours = [(low + n * hour).strftime(name) for n in range(max(0, -(-(last - low) // hour)))]
    batch = df.filter(in_window(ts_col, first, last))
    batch = batch.withColumn("hour", F.date_format(ts_col, "yyyy-MM-dd'T'HH"))
    cut = {h for h, edge in ((hours[0], first), (hours[-1], last)) if edge != edge.replace(minute=0, second=0, microsecond=0)} if hours else ()
    if cut and storage.exists(spark, path):
        held = read_partitioned(spark, path, T.StructField("hour", T.StringType()))
        outside = ~F.coalesce(in_window(ts_col, first, last), F.lit(False))
        batch = batch.unionByName(held.filter(F.col("hour").isin(sorted(cut)) & outside), allowMissingColumns=True)
    batch = batch.persist()
    try:
        present = {r[0] for r in batch.select("hour").distinct().collect()}
        if present:
            overwrite_partitions(batch, path, ["hour"])
        for h in hours:
            if h not in present:
                storage.remove(spark, partition_folder(spark, path, "hour", h))
    finally:
        batch.unpersist()


def full_refresh(df: DataFrame, path: str) -> None:
    """Write beside the table, then swap, so a lost job never leaves it half written.

    The swap is two renames, between which the table is not there; on an object
    store a rename copies. Readers that must never miss it need a table format.
    """
    staging = beside(path, "new")
    df.write.mode("error").parquet(staging)
    swap_in(df.sparkSession, staging, path)


def beside(path: str, kind: str) -> str:
    """An unused folder next to a table."""
    return f"{path.rstrip('/')}__{kind}_{uuid.uuid4().hex}"


def swap_in(spark: SparkSession, staging: str, path: str) -> None:
    path, old = path.rstrip("/"), beside(path, "old")
    if storage.exists(spark, path):
        storage.rename(spark, path, old)
    storage.rename(spark, staging, path)
    storage.remove(spark, old)


def merge_into(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str,
    order_by: Sequence[Column | str],
    newest_wins: bool = False,
    null_safe: Sequence[str] = (),
    staged: bool = False,
    stamped: bool = False,
) -> None:
    """Upsert into a partitioned Parquet table, rewriting only what changes.

    The batch wins over the table, as in MERGE. With ``newest_wins`` the newer
    row of the two wins, for input that may arrive out of order. A null in a key
    matches nothing, except in the keys named ``null_safe``, where it equals a null. Rows
    without a partition value lie in a partition of their own and move out of it when the value appears.

    Touched partitions are those of batch rows that the table does not hold alike, plus those that hold
    their keys today. They are found by one join of keys and hashes of whole rows; the partition filter then prunes
    the rewrite to them, and a batch that was merged before rewrites nothing. Where no row can be alike, as
    in a batch ``stamped`` with the time of its load, all partitions of the batch are touched and
    key and partition columns of the others are searched, unless the partition column is part of the key.

    A partition that the batch leaves empty is removed after the others are written: a job lost in between
    shows its moved keys twice until the merge is run again, which ends it.
    """
    # The batch is read to find partitions, to find matches and to write, so it
    # is kept, unless it is a ``staged`` copy; lost pieces are computed again from the source.
    batch = source if staged else source.persist()
    try:
        _merge(batch, path, list(keys), partition_by, order_by, newest_wins, list(null_safe), stamped)
    finally:
        if not staged:
            batch.unpersist()


def _never_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys that compare null-safe: a struct is not null and equals one whose field is null too."""
    return df.withColumns({f"_key_{c}": F.struct(c) for c in names})


def _merge(
    batch: DataFrame, path: str, keys: list[str], partition_by: str, order_by, newest_wins: bool, null_safe: list[str], stamped: bool
) -> None:
    spark = batch.sparkSession
    if not storage.exists(spark, path):
        overwrite_partitions(dedupe_latest(batch, keys, order_by), path, [partition_by])
        return
    column = F.col(partition_by)
    target = _never_null(read_partitioned(spark, path, batch.schema[partition_by]), null_safe)
    helpers = [f"_key_{c}" for c in null_safe]
    batch = _never_null(batch, null_safe)
    by_partition = partition_by in keys
    keys = [f"_key_{c}" if c in null_safe else c for c in keys]
    # Only partition values travel to the driver, here and below; their texts name the folders.
    values = [column.alias("value"), column.cast("string").alias("text")]
    plain = [f for f in target.columns if f not in helpers]
    if stamped or set(plain) != set(batch.columns) - set(helpers) or not _hashable(target.schema) or not _hashable(batch.schema):
        touched = {tuple(r) for r in batch.select(*values).distinct().collect()}
        if not by_partition:
            fresh = {partition_folder(spark, "", partition_by, text) for _, text in touched}
            if any(f"/{name}" not in fresh for name in storage.subfolders(spark, path) if "=" in name):
                held = target.filter(~_among(column, touched)).join(batch.select(*keys), keys, "left_semi").select(*values)
                touched |= {tuple(r) for r in held.distinct().collect()}
    else:
        touched = {tuple(r) for r in _changed(target, batch, keys, plain, F.struct(*values)).collect()}
    if not touched:
        return
    batch = batch.filter(_among(column, touched))
    current = target.filter(_among(column, touched))
    if newest_wins:
        rows = dedupe_latest(current.unionByName(batch), keys, order_by)
    else:
        rows = upsert_latest(current, batch, keys, order_by)
    # A partition whose last row moved elsewhere is not in the output: drop it.
    seen = Observation()
    alive = [F.collect_set(column.cast("string")).alias("alive"), F.max(column.isNull()).alias("none")]
    overwrite_partitions(rows.drop(*helpers).observe(seen, *alive), path, [partition_by])
    if not by_partition:
        written = {*seen.get["alive"], *([None] if seen.get["none"] else [])}
        for text in {text for _, text in touched} - written:
            storage.remove(spark, partition_folder(spark, path, partition_by, text))


def _hashable(schema: T.StructType) -> bool:
    return not any(kind in schema.json() for kind in ('"map"', '"variant"'))


def _changed(target: DataFrame, batch: DataFrame, keys: list[str], columns: list[str], partition: Column) -> DataFrame:
    """Distinct partitions of batch rows unlike the table's row of their key, and of those rows of the table.

    Rows are alike by 96 bits of hash over the values and which of them are null.
    """
    kinds = batch.schema
    parts = [F.col(f"`{c}`").cast(kinds[c].dataType) for c in columns]
    marks = [F.xxhash64(*parts, *[x.isNull() for x in parts]), F.hash(*[x.isNull() for x in parts], *parts)]
    new = batch.select(*keys, *[m.alias(f"_new_{n}") for n, m in enumerate(marks)], partition.alias("_new"))
    old = target.select(*keys, *[m.alias(f"_old_{n}") for n, m in enumerate(marks)], partition.alias("_old"))
    alike = (F.col("_new_0") == F.col("_old_0")) & (F.col("_new_1") == F.col("_old_1"))
    unlike = new.join(old, keys, "left").filter(~F.coalesce(alike, F.lit(False)))
    return unlike.select(F.explode(F.array("_new", "_old")).alias("at")).filter("at IS NOT NULL").select("at.*").distinct()


def _among(column: Column, values: set[tuple]) -> Column:
    """Whether the column has one of the ``values`` (value, text); never null."""
    some = [v for v, _ in values if v is not None]
    listed = F.coalesce(column.isin(some), F.lit(False)) if some else F.lit(False)
    return listed | column.isNull() if any(v is None for v, _ in values) else listed & column.isNotNull()


def register_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    df.createOrReplaceTempView(name)
    return spark.table(name)


def refresh_mart(build: Callable[[], DataFrame], path: str) -> None:
    full_refresh(build(), path)


def add_partitions(spark: SparkSession, table: str, specs: Sequence[dict[str, str]]) -> None:
    """Register partitions; one that is already there is not an error."""
    parts = " ".join(
        "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in spec.items()) + ")" for spec in specs
    )
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
