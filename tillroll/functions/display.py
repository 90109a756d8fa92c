"""Display formatting of mart values, French locale style.

``format_number`` groups thousands with ``,`` and uses ``.`` for decimals;
the French style uses a narrow no-break space and a decimal comma. A single
``translate`` swaps both characters at once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# French grouping separator (U+202F), decimal comma, euro suffix.
FR_GROUP = "\u202f"
FR_DECIMAL = ","
EURO_SUFFIX = " \u20ac"


def _fr(c: Column, digits: int) -> Column:
    return F.translate(F.format_number(c, digits), ",.", FR_GROUP + FR_DECIMAL)


def fr_money(col: str | Column, with_currency: bool = True) -> Column:
    """Two decimals, French separators, optionally followed by `` €``."""
    c = F.col(col) if isinstance(col, str) else col
    # Adding zero turns a rounded negative zero into zero.
    text = _fr(F.round(c, 2) + F.lit(0.0), 2)
    return F.concat(text, F.lit(EURO_SUFFIX)) if with_currency else text


def fr_integer(col: str | Column) -> Column:
    """Whole number with French thousands grouping."""
    c = F.col(col) if isinstance(col, str) else col
    return _fr(c, 0)
