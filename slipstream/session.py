"""Session settings the library is written for.

Any session works; these are the settings under which the plans were tuned. Nothing here is
needed for correct results: time zones are avoided by using dates and zone-less timestamps, and
every cast or division that may fail under ANSI mode is written so that it cannot.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time instead of landing in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "slipstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session; leave ``master`` unset on a cluster.

    ``shuffle_partitions`` should give shuffle blocks of 100-200 MB (input bytes / 128 MB is a
    good start); AQE merges the small ones, it cannot split a partition that no join reads.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
