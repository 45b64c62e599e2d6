"""What a job leaves on the executors' disks between its steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# --- fixed value: Spark's setting that removes the shuffle files of an execution at its end ---
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed within go when each execution ends.

    Otherwise they stay until the driver collects its garbage, and a job of many loads holds the shuffles of them all. A frame
    executed again shuffles again.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
