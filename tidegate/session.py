"""Session settings and scratch space shared by every job."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan relies on. All are per-session SQL settings, so
# they can be applied to a session somebody else created.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lets "row_number() <= k" prune inside each map task before the shuffle,
    # which is what keeps the de-duplication operators safe on hot keys.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to an existing session and return it."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024


# What each application had set before the first query raised it.
_FIRST_COUNT: dict[str, tuple[int, int]] = {}


def fit_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = SHUFFLE_TARGET_BYTES) -> int:
    """Set the shuffle partition count to suit the input, never below what the session came with.

    Adaptive execution merges partitions that turn out small, but it cannot
    split the map output of too few, so the count must start high enough. A
    count that somebody else set meanwhile becomes the new lower bound.
    """
    app, now = spark.sparkContext.applicationId, int(spark.conf.get("spark.sql.shuffle.partitions"))
    least, ours = _FIRST_COUNT.get(app, (now, now))
    if now != ours:
        least = now
    wanted = max(least, -(-input_bytes // per_partition))
    if wanted != now:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    _FIRST_COUNT[app] = (least, wanted)
    return wanted


def build_session(app: str = "tidegate", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


_PRIVATE: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's own checkpoint folder.

    Without one only a session in a single process (master ``local``) may go on,
    with one private folder per application that is deleted at its end: elsewhere
    each executor would write to a disk of its own and reads would miss its files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _PRIVATE:
        _PRIVATE[context.applicationId] = tempfile.mkdtemp(prefix="tidegate-")
        atexit.register(shutil.rmtree, _PRIVATE[context.applicationId], ignore_errors=True)
    return _PRIVATE[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidegate/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage so later stages can be re-run from it."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
