from pyspark.sql import Column
from pyspark.sql import functions as F

from vinlake.fixed_values import PRICE_BANDS, PRICE_HIGH_ABOVE


def dotted_amount(text: Column) -> Column:
    """``350.000.000`` as a BIGINT, NULL where the text is no number."""
    return F.replace(text, F.lit("."), F.lit("")).try_cast("bigint")


def price_class(amount: Column) -> Column:
    """Class of a price or of an average price; NULL and prices below all bands are UNDEFINED."""
    cases = F.when(amount > PRICE_HIGH_ABOVE, "HIGH")
    for name, low, high in PRICE_BANDS:
        cases = cases.when(amount.between(low, high), name)
    return cases.otherwise("UNDEFINED")
