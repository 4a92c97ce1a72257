"""A session with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", name: str = "foldmark", **conf: str) -> SparkSession:
    """UTC days, adaptive execution, ANSI errors left on; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.master(master).appName(name)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.ui.enabled": "false"}
    for key, value in (settings | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
