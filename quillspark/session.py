"""Session builder with the settings that every query here assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, partitions: int | None = None, app: str = "quillspark") -> SparkSession:
    """A session in UTC with adaptive execution on. `partitions` is left to Spark where it is None."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", os.environ.get("QUILL_DRIVER_MEMORY", "8g"))
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()
