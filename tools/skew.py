"""Time operators on an even key distribution and with one key holding a third of the rows.

    python tools/skew.py [rows]

Broadcast joins are switched off, so every join is a shuffle join.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = 500_000


def main() -> None:
    from pyspark.sql import functions as F

    from tidegate.operators import aggregates, joins, keys
    from tidegate.session import build_session

    n = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
    spark = build_session("skew", "local[8]", **{
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.log.level": "ERROR",
    })

    def frame(hot: bool):
        third = (F.hash("id") % 3 == 0) & F.lit(hot)
        at = F.timestamp_seconds(F.lit(1_500_000_000) + F.pmod(F.hash("id", "id"), F.lit(100_000_000)))
        return spark.range(0, n, 1, 16).select(
            "id",
            F.when(third, 7).otherwise(F.col("id") % KEYS).alias("k"),
            at.cast("timestamp_ntz").alias("ts"),
            F.pmod(F.hash("id"), F.lit(5000)).alias("v"),
        )

    dim = spark.range(KEYS).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    null_key = F.when(F.col("k") != 7, F.col("k"))
    runs = {
        "scan": lambda d: d,
        "dedupe_latest": lambda d: keys.dedupe_latest(d, ["k"], ["ts"]),
        "rework_flag": lambda d: keys.rework_flag(d, "k", "ts"),
        "exact_percentile": lambda d: aggregates.exact_percentile(d, ["k"], "v", 0.95, "p"),
        "with_group_max": lambda d: keys.with_group_max(d, "k", "ts", "m"),
        "lookup_null_keys": lambda d: joins.lookup(d.withColumn("k", null_key), dim, "k", ["x"]),
    }

    def seconds(df) -> float:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 1)

    seconds(frame(False))
    for name, run in runs.items():
        print(f"{name}: even {seconds(run(frame(False)))} s, hot third {seconds(run(frame(True)))} s", flush=True)


if __name__ == "__main__":
    main()
