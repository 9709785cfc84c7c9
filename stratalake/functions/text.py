"""Text and date clean-up. All functions take and return Columns."""

from pyspark.sql import Column, functions as F

# Fixed value: four digits, two digits, two digits.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"


def tidy(name: str) -> Column:
    """The text without blanks around it."""
    return F.trim(F.col(name).cast("string"))


def tidy_key(name: str) -> Column:
    """As :func:`tidy`, and a blank-only value becomes null, so that it can never pass as a key."""
    return F.nullif(tidy(name), F.lit(""))


def title_case(name: str) -> Column:
    return F.initcap(tidy(name))


def iso_date(name: str) -> Column:
    """Parse ``yyyy-MM-dd``. Unreadable text becomes null, also in ANSI mode.

    The cast alone would take other forms too, such as ``2024-1-5``. Together with the pattern it is still
    much faster than parsing by a format string.
    """
    text = tidy(name)
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def unreadable_date(name: str) -> Column:
    """True where there is text but :func:`iso_date` cannot read it."""
    return tidy_key(name).isNotNull() & iso_date(name).isNull()
