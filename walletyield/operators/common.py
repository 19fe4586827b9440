"""Small shared DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row of ``df``.

    ``one_row`` is one row by construction: an aggregate without grouping
    keys (period bounds, totals, the newest entry) or a literal row built on
    ``spark.range(1)``. Its broadcast is a single row evaluated map-side,
    never a pairing of two tables.
    """
    return df.crossJoin(F.broadcast(one_row))
