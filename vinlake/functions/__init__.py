"""Column expressions shared by the models. All are built-ins, so they stay in generated code."""

from vinlake.functions.dates import calendar_month, mixed_date, mixed_timestamp
from vinlake.functions.money import dotted_amount, price_class
from vinlake.functions.text import blank_to_null, strip_space, title_words

__all__ = [
    "blank_to_null",
    "calendar_month",
    "dotted_amount",
    "mixed_date",
    "mixed_timestamp",
    "price_class",
    "strip_space",
    "title_words",
]
