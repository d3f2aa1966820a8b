"""Hour windows, drains, dead letters, stream upserts and de-duplication.

The scheduled drains of closed hours become ``availableNow`` queries: the
checkpoint takes the place of acknowledgements and offsets, and every sink is
idempotent per batch, so a batch that is run again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions.times import as_timestamp
from tidegate.session import scratch_dir
from tidegate.sinks.tables import merge_into
from tidegate.sources.parsing import as_struct, parse_records


def read_events(spark: SparkSession, fmt: str, options: dict[str, str], schema: str, streaming: bool = True) -> DataFrame:
    """Any event source: Kafka on a cluster, files in tests."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt).options(**{k: o for k, o in options.items() if k != "path"})
    if fmt == "kafka":
        # A payload that does not parse is no event; deadletter_sink over messages() keeps it.
        good = parse_records(messages(reader.load()), BODY, schema).filter(~F.col("_bad"))
        return good.select(*as_struct(schema).fieldNames())
    return reader.schema(as_struct(schema)).load(options["path"])


BODY = "body"


def messages(raw: DataFrame) -> DataFrame:
    """Payload and time of the rows of a message topic."""
    return raw.select(F.col("value").cast("string").alias(BODY), F.col("timestamp").alias("arrival_ts"))


def closed_hour_options(start: dt.datetime, end: dt.datetime) -> dict[str, str]:
    """Options with which a batch read of a topic takes exactly the messages of ``[start, end)``, given in UTC."""
    at = [str(int(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)) for x in (start, end)]
    return {"startingTimestamp": at[0], "endingTimestamp": at[1], "startingOffsetsByTimestampStrategy": "latest"}


def hourly_stream(df: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], delay: str = "10 minutes") -> DataFrame:
    """Tumbling one-hour aggregate; an hour is final once the watermark passes it."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour"), *keys)
        .agg(*aggs)
        .withColumn("hour_label", F.col("window.start").cast("timestamp_ntz"))
        .drop("window")
    )


def dedupe_stream(df: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries that arrive within the delay."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def read_drops(
    spark: SparkSession, folder: str, fmt: str, schema: str, archive: str | None = None, per_trigger: int = 1000,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Files dropped into ``folder``, each taken once: the checkpoint of the drain knows which were seen.

    With ``archive`` a file moves there, under its whole path, once the batch after its own has been
    planned, so the folder does not grow; ``archive`` must lie outside ``folder``. A file that is delivered again under a
    name already seen is not read again.
    """
    reader = spark.readStream.format(fmt).schema(as_struct(schema)).options(**options or {}).option("maxFilesPerTrigger", per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder)


def drain(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Process everything available now, then stop. Restarting resumes, never repeats."""
    where = checkpoint or scratch_dir(df.sparkSession, "stream")
    query = (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", where)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    query.awaitTermination()
    return query


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def deadletter_sink(schema: str, body: str, good_path: str, dead_path: str, keep: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Two tables from one parse; each batch owns its partition, so replays overwrite."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_records(batch, body, schema, keep).persist()
        try:
            _write_batch(parsed.filter(~F.col("_bad")).drop("_bad").withColumnRenamed(body, "payload"), good_path, batch_id)
            _write_batch(parsed.filter("_bad").select(*keep, body), dead_path, batch_id)
        finally:
            parsed.unpersist()

    return handle


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch owns its partition, so a batch that is run again replaces its own rows."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        _write_batch(batch, path, batch_id)

    return handle


def upsert_sink(
    path: str, keys: Sequence[str], partition_by: str, order_by: Sequence[str], newest_wins: bool = False
) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        # The merge keeps its batch, so stateful input runs once per trigger.
        merge_into(batch, path, keys, partition_by, order_by, newest_wins)

    return handle


def late_sink(ts: str, closed_before, on_time: Callable[[DataFrame, int], None], late_path: str) -> Callable[[DataFrame, int], None]:
    """Rows of an hour that is already closed go to a side table instead of vanishing."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        late = F.coalesce(F.col(ts) < as_timestamp(closed_before), F.lit(False))
        kept = batch.persist()
        try:
            on_time(kept.filter(~late), batch_id)
            _write_batch(kept.filter(late), late_path, batch_id)
        finally:
            kept.unpersist()

    return handle
