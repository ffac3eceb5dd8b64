"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution picks the reducer count, splits skewed join partitions and
#: turns a shuffle join into a broadcast one when a side proves small at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


#: Input bytes that a shuffle task is meant to handle, and Spark's own number of tasks.
BYTES_PER_TASK = 128 * 1024 * 1024
DEFAULT_PARTITIONS = 200


def initial_partitions(input_bytes: int, least: int = DEFAULT_PARTITIONS) -> int:
    return max(least, -(-input_bytes // BYTES_PER_TASK))


def build_session(
    app_name: str = "tallyline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """Start (or fetch) a session. ``master`` is left to the launcher when not given.

    Adaptive execution merges shuffle partitions but never adds any, so a large input needs
    many to begin with: one for each ``BYTES_PER_TASK`` of ``input_bytes``.

    ``conf`` keys use ``__`` for the dots: ``spark__driver__memory="20g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if input_bytes:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            initial_partitions(input_bytes, shuffle_partitions or DEFAULT_PARTITIONS)
        )
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
