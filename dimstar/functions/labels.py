"""Status labels and null placement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_ladder(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """First matching rule wins; a NULL condition does not match."""
    out: Column | None = None
    for condition, label in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    if out is None:
        return F.lit(otherwise)
    return out.otherwise(F.lit(otherwise)) if otherwise is not None else out


def asc(col: str | Column) -> Column:
    """Ascending with NULL as the largest value."""
    return (F.col(col) if isinstance(col, str) else col).asc_nulls_last()


def desc(col: str | Column) -> Column:
    """Descending with NULL as the largest value."""
    return (F.col(col) if isinstance(col, str) else col).desc_nulls_first()
