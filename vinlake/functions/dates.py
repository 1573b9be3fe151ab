from pyspark.sql import Column
from pyspark.sql import functions as F

from vinlake.fixed_values import DOB_SHAPES


def mixed_date(text: Column) -> Column:
    """Date from one of the known text shapes, NULL for any other text or an impossible day."""
    return F.coalesce(
        *[F.when(text.rlike(shape), F.try_to_date(text, pattern)) for shape, pattern in DOB_SHAPES]
    )


_NAMES = "january february march april may june july august september october november december".split()
_MONTHS = {name[:size]: number for number, name in enumerate(_NAMES, 1) for size in (3, len(name))} | {"sept": 9}
_TIME = r"[T\s]+(\d{1,2}):(\d{2})(?::(\d{2})(\.\d+)?)?\s*([AaPp][Mm])?\s*(?:[Zz]|UTC|GMT|[+-]\d{2}:?\d{2})?$"


def _iso_day(text: Column) -> Column:
    """The day at the beginning of a text as year-month-day, NULL if there is none."""

    def part(pattern: str, place: int) -> Column:
        return F.regexp_extract(text, pattern, place)

    def joined(year: Column, month: Column, day: Column) -> Column:
        return F.concat_ws("-", year, month.cast("string"), day)

    year_first, digits = r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})(?!\d)", r"^(\d{4})(\d{2})(\d{2})(?!\d)"
    year_last = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})(?!\d)"
    name_first = r"^([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?!\d)"
    day_first = r"^(\d{1,2})(?:st|nd|rd|th)?[-\s]+([A-Za-z]{3,9})\.?,?[-\s]+(\d{4})(?!\d)"
    one, other, year = (part(year_last, place) for place in (1, 2, 3))
    months = F.create_map(*[F.lit(x) for pair in _MONTHS.items() for x in pair])

    def named(pattern: str, month: int, day: int) -> Column:
        number = F.try_element_at(months, F.lower(part(pattern, month)))
        return F.when(number.isNotNull(), joined(part(pattern, 3), number, part(pattern, day)))

    return (
        F.when(text.rlike(year_first), joined(part(year_first, 1), part(year_first, 2), part(year_first, 3)))
        .when(text.rlike(digits), joined(part(digits, 1), part(digits, 2), part(digits, 3)))
        .when(text.rlike(year_last), F.when(one.try_cast("int") > 12, joined(year, other, one)).otherwise(joined(year, one, other)))
        .when(text.rlike(name_first), named(name_first, 1, 2))
        .when(text.rlike(day_first), named(day_first, 2, 1))
    )


def _iso_time(rest: Column) -> Column:
    """The time that follows a day, midnight if nothing follows, NULL for any other text."""
    hour, half = F.regexp_extract(rest, _TIME, 1).try_cast("int"), F.lower(F.regexp_extract(rest, _TIME, 5))
    on_the_clock = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
    second = F.regexp_extract(rest, _TIME, 3)
    second = F.concat(F.when(second == "", "00").otherwise(second), F.regexp_extract(rest, _TIME, 4))
    timed = F.concat(on_the_clock.cast("string"), F.lit(":"), F.regexp_extract(rest, _TIME, 2), F.lit(":"), second)
    digits = F.regexp_replace(F.trim(rest), r"^(\d{2})(\d{2})(\d{2})$", "$1:$2:$3")
    return F.when(F.trim(rest) == "", "00:00:00").when(rest.rlike(_TIME), timed).when(rest.rlike(r"^\s+\d{6}$"), digits)


def mixed_timestamp(text: Column) -> Column:
    """Zone-free timestamp, NULL where the text is none.

    Known days: year first with ``-``, ``/`` or ``.``; eight digits; year last, where the first number is
    the month unless it is above 12, which makes it the day; month names in English, long or short,
    before or after the day. A time may follow: 24 hours, 12 hours with AM or PM, or six digits. A zone
    may follow the time and is dropped: the column is a wall clock and keeps the time as written.
    The parts are put into the ISO shape and cast, so that the session time zone (and its
    daylight-saving gaps) plays no part.
    """
    tidy = F.trim(text)
    length = F.length(F.regexp_extract(tidy, _DAY, 0))
    rest = F.when(length > 0, F.substring(tidy, length + 1, F.length(tidy)))
    return F.concat(_iso_day(tidy), F.lit(" "), _iso_time(rest)).try_cast("timestamp_ntz")


# Any of the known days, to find where it ends.
_DAY = (
    r"^(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}(?!\d)|\d{8}(?!\d)|\d{1,2}[-/.]\d{1,2}[-/.]\d{4}(?!\d)"
    r"|[A-Za-z]{3,9}\.?\s+\d{1,2}(?:st|nd|rd|th)?,?\s+\d{4}(?!\d)"
    r"|\d{1,2}(?:st|nd|rd|th)?[-\s]+[A-Za-z]{3,9}\.?,?[-\s]+\d{4}(?!\d))"
)


def calendar_month(day: Column) -> Column:
    """``2025-03`` for any day of March 2025."""
    return F.date_format(day, "yyyy-MM")
