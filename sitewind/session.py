"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times without a zone are UTC, and joins split keys that hold most rows.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def create_session(app_name: str = "sitewind", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings above. Executor sizing is left to ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
