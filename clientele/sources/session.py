"""Session handle."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app_name: str) -> SparkSession:
    """The running session, or a new one on whatever the environment sets up.
    No master and no settings are forced, so it also fits remote clients."""
    return SparkSession.builder.appName(app_name).getOrCreate()
