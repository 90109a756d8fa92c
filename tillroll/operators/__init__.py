"""DataFrame operators: validation, cleaning, marts and serving."""

from tillroll.operators import cleaning, marts, serving, validation

__all__ = ["cleaning", "marts", "serving", "validation"]
