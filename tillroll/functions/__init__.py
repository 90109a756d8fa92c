"""Column-level helpers: every one returns a built-in Spark ``Column``.

No Python UDF is involved, so all of these stay inside whole-stage codegen.
"""

from tillroll.functions.dates import (
    INVOICE_DATE_FORMAT,
    date_parts,
    day_label,
    parse_invoice_date,
)
from tillroll.functions.display import fr_integer, fr_money
from tillroll.functions.money import as_money, money
from tillroll.functions.text import clean_header, normalise_headers, short_label, trim_columns

__all__ = [
    "INVOICE_DATE_FORMAT",
    "as_money",
    "clean_header",
    "date_parts",
    "day_label",
    "fr_integer",
    "fr_money",
    "money",
    "normalise_headers",
    "parse_invoice_date",
    "short_label",
    "trim_columns",
]
