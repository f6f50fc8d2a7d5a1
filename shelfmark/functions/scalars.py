"""Scalar clean-up functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The brand text that names an author, the currency sign in front
# of a price, and the one accepted date layout.
AUTHOR_PAGE = r"^Visit Amazon's(.*?) Page$"
CURRENCY_SIGN = r"^\$"
REVIEW_DATE_LAYOUT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"

# The seconds of the years 1 to 9999.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def author_from_brand(brand: Column, trim: bool = False) -> Column:
    """Author named by a brand text; '' when the text names none, NULL for NULL.

    The captured text keeps its leading space unless ``trim`` is set.
    """
    author = F.regexp_extract(brand, AUTHOR_PAGE, 1)
    return F.trim(author) if trim else author


def price_to_float(price: Column) -> Column:
    """Price text to float; NULL when the text is not a plain number."""
    return F.regexp_replace(price, CURRENCY_SIGN, "").try_cast("float")


def parse_review_date(text: Column) -> Column:
    """ISO text to a zone-free timestamp; any other layout gives NULL."""
    return F.when(text.rlike(REVIEW_DATE_LAYOUT), text.try_cast("timestamp_ntz"))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a zone-free UTC timestamp, whatever the session zone.

    NULL outside the years 1 to 9999, which a time in milliseconds would be.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), epoch + F.make_dt_interval(secs=seconds))


def iso_text(when: Column) -> Column:
    """ISO text of a zone-free timestamp of whole seconds, in any session zone."""
    return F.translate(when.cast("string"), " ", "T")


def strip_nul(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit(""))


def rating_to_int(rating: Column) -> Column:
    """Truncates towards zero; NaN and unparsable values give NULL."""
    return rating.try_cast("int")


def nan_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(float("nan")))


def array_mean_int(values: Column) -> Column:
    """Mean of an array cut to an int; NULL for a NULL or empty array."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values)).try_cast("int")


def has_zero_or_nan(values: Column) -> Column:
    return F.array_contains(values, 0.0) | F.array_contains(values, float("nan"))


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def thousands(number: Column) -> Column:
    return F.format_number(number, 0)
