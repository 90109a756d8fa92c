"""Invoice date handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the extract's date text, such as 12/1/2009 7:45.
INVOICE_DATE_FORMAT = "M/d/yyyy H:mm"


def parse_invoice_date(col: str | Column = "InvoiceDate") -> Column:
    """Text to timestamp; unparseable text gives NULL instead of an error.

    ``try_to_timestamp`` keeps the old non-ANSI behaviour (bad date -> NULL,
    which the order rules then quarantine) while the session stays ANSI.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(INVOICE_DATE_FORMAT))


def date_parts(df: DataFrame, source: str = "InvoiceDate") -> DataFrame:
    """Add integer ``year``/``month``/``day`` parsed from the date text.

    The parsed timestamp is only an intermediate expression, so the result
    keeps the original text column unchanged.
    """
    ts = parse_invoice_date(source)
    return df.withColumns(
        {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    )


def day_label(year: str = "year", month: str = "month", day: str = "day") -> Column:
    """``YYYY-MM-DD`` with zero-padded month and day."""
    return F.concat_ws(
        "-",
        F.col(year).cast("string"),
        F.lpad(F.col(month).cast("string"), 2, "0"),
        F.lpad(F.col(day).cast("string"), 2, "0"),
    )
