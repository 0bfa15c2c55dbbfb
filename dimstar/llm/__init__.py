"""Operators of a training-data pipeline; nothing else in the library imports them.

Functions that run on executors are sent by value, so the package need not be installed there.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import SparkSession

from dimstar.session import configure

register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 1000


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, and batches of texts that a worker can hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)
    return configure(spark)
