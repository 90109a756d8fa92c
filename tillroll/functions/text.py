"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The byte order mark, as read correctly and as UTF-8 bytes
# decoded as ISO-8859-1.
BOM_FORMS = ("\ufeff", "\u00ef\u00bb\u00bf")

# Chart labels are cut to 25 characters and marked with "...".
LABEL_WIDTH = 25
LABEL_ELLIPSIS = "..."


def clean_header(name: str) -> str:
    """Strip a leading byte order mark (either form) and outer whitespace."""
    for bom in BOM_FORMS:
        if name.startswith(bom):
            name = name[len(bom):]
    return name.strip()


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename every column through ``clean_header`` (a metadata-only change)."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def trim_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Trim leading/trailing spaces (not tabs) of the named string columns."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})


def short_label(col: str | Column, width: int = LABEL_WIDTH) -> Column:
    """Text longer than ``width`` is cut to ``width`` characters plus ``...``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(
        F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit(LABEL_ELLIPSIS))
    ).otherwise(c)
