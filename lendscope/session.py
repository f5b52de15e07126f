"""Session settings the jobs are designed for.

Only ``build_session`` sets anything; library functions take the caller's
session as it is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a fact-to-dimension sort-merge join splits a hot key at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "lendscope", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
