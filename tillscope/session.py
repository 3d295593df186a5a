"""Spark sessions for file mode and catalog mode."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

APP_NAME = "MerchantAnalytics"

# Hour and month are read in the session's zone, so the zone is pinned. Skewed joins are
# split at run time; small shuffle partitions are merged. How many partitions, how much
# memory: that is for the cluster's own settings, which nothing here overrides.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tasks that run side by side share the executors.
    "spark.scheduler.mode": "FAIR",
    # Joins and groupings are sized by the statistics kept with catalog tables, where there are any.
    "spark.sql.cbo.enabled": "true",
    # Without this, small partitions of a cached result are not merged.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

def create_session(
    app_name: str = APP_NAME,
    *,
    catalog: bool = False,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session; ``conf`` overrides the defaults in both modes.

    With ``catalog=True`` tables live in a Hive-compatible catalog. Its address is taken
    from ``HIVE_METASTORE_URI`` when that is set.
    """
    settings = dict(DEFAULT_CONF)
    if catalog:
        metastore = os.environ.get("HIVE_METASTORE_URI")
        if metastore:
            settings["spark.hadoop.hive.metastore.uris"] = metastore
    settings.update(conf or {})

    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if catalog:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def create_spark_session(app_name: str = APP_NAME) -> SparkSession:
    """File-mode session with the default settings."""
    return create_session(app_name)


def get_spark_with_hive(app_name: str = APP_NAME) -> SparkSession:
    """Catalog-mode session with the default settings."""
    return create_session(app_name, catalog=True)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut lineage.

    ``spark.checkpoint.dir`` names it; there is no other place that is sure to be shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir (or --work-dir) to a folder that all executors share")
    return configured.rstrip("/")
