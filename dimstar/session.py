"""Session settings this package relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only; sizes such as spark.sql.shuffle.partitions stay the cluster's choice.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and settled tables that all executors can reach.

    It is the one the cluster names in ``spark.checkpoint.dir``; only a local session
    without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="dimstar-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def settled(df: DataFrame, settings: Mapping[str, str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back from there.

    Used where two branches must see the very same partitioning even if executors
    are lost in between, or where several read what is costly to compute. A written
    table is columnar, so each branch reads only its columns, and Spark knows its size.
    ``settings`` hold while it is planned and written, and no longer.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled/{uuid.uuid4()}"
    before = {key: spark.conf.get(key, None) for key in settings or {}}
    try:
        for key, value in (settings or {}).items():
            spark.conf.set(key, value)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)
