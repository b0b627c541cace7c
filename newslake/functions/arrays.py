"""Array helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_with_pos(df: DataFrame, keep: list[Column | str], arr: Column, pos: str = "pos", value: str = "value") -> DataFrame:
    """``posexplode`` that evaluates ``arr`` once per row.

    A plain ``posexplode`` of an expensive expression (regex extraction, JSON parsing)
    makes Catalyst infer a ``size(arr) > 0`` filter and push it under the projection,
    which evaluates the expression again. ``posexplode_outer`` infers nothing; the row
    it emits for an empty or NULL array is dropped by the position test.
    """
    return df.select(*keep, F.posexplode_outer(arr).alias(pos, value)).filter(F.col(pos).isNotNull())
