"""How many whole texts a task hands to its Python worker at a time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Rows of whole texts that a task holds as one Arrow batch, in the executor and once more in its worker.
BATCH_SIZE = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries within hand texts to workers in batches of at most BATCH_ROWS; the session's own setting comes back."""
    before = spark.conf.get(BATCH_SIZE)
    # 0 or less stands for no limit.
    spark.conf.set(BATCH_SIZE, str(min(int(before), BATCH_ROWS) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SIZE, before)
