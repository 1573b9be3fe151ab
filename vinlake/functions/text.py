from pyspark.sql import Column
from pyspark.sql import functions as F

from vinlake.fixed_values import MISSING_TEXTS


def strip_space(text: Column) -> Column:
    """Strip every kind of white space at both ends; ``trim`` would only strip blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title_words(text: Column) -> Column:
    """Capitalise each run of letters: ``rt/rw`` gives ``Rt/Rw``, where ``initcap`` gives ``Rt/rw``."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def blank_to_null(text: Column) -> Column:
    """Turn the empty text and the texts that stand for a missing value into NULL."""
    return F.when((text != "") & ~text.isin(*MISSING_TEXTS), text)
