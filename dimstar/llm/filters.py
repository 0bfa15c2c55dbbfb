"""Filters of fixed size for rows by a hash, so that only those that may be wanted are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 1 << 23


def filter_of(hashes: DataFrame) -> np.ndarray:
    """One bit for each value of ``h`` modulo SIZE: 1 MB for any number of rows."""
    cell = F.pmod("h", F.lit(SIZE))
    words = hashes.select(
        F.shiftright(cell, 6).alias("at"), F.pmod(cell, F.lit(64)).cast("int").alias("bit")
    )
    rows = words.groupBy("at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toPandas()
    out = np.zeros(SIZE // 64, np.int64)
    out[rows["at"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out


def hit(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    cell = np.mod(h, SIZE)
    return ((bits[cell >> 6] >> (cell & 63)) & 1).astype(bool)


def hits(rows: DataFrame, bits: np.ndarray, inverted: bool = False) -> DataFrame:
    """The rows whose ``h`` the filter has, and now and then one more; or all others."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = hit(shared.value, batch.column("h").to_numpy())
            yield batch.filter(pa.array(found != inverted))

    return rows.mapInArrow(run, rows.schema)
