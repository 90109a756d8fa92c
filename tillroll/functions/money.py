"""Money columns.

Marts keep money as double, as the source computes it. For presentation and
for exact comparison with other engines, ``money`` rounds to cents as a
decimal: float sums differ in their last bits between engines, and a group
netting to zero would otherwise show as ``-0.0`` in one and ``0.0`` in another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(18,2)"


def money(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c, 2).cast(MONEY_TYPE)


def as_money(df: DataFrame, *cols: str) -> DataFrame:
    """Replace each named double column by its cents-rounded decimal."""
    return df.withColumns({c: money(c) for c in cols})
