"""Building large column expressions once.

An unresolved column mentions column names only, so it can serve every frame that has
them. Building one costs a call into the JVM per operator, which adds up to seconds for
the widest; the result is therefore kept for the life of the application.
"""

from __future__ import annotations

from functools import lru_cache, wraps

from pyspark.sql import SparkSession


def per_application(build):
    """Cache ``build(*args)`` per Spark application. Arguments must be hashable."""

    @lru_cache(maxsize=64)
    def cached(application_id: str, *args):
        return build(*args)

    @wraps(build)
    def call(*args):
        return cached(SparkSession.active().sparkContext.applicationId, *args)

    return call
