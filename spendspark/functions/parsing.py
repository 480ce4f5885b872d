"""Text to typed values, with the forgiving rules of the input files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendspark.schemas import MONEY

# Texts that count as a missing cell in a transactions file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Optional sign, digits with an optional point, optional exponent, blanks around.
_PLAIN_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def present(text: Column) -> Column:
    """The trimmed text, or null for a blank or missing-value marker."""
    trimmed = F.trim(text)
    return F.when(~trimmed.isin(MISSING_TEXTS), trimmed)


def parse_date(text: Column, date_format: str | None = None) -> Column:
    """Calendar day of a date or timestamp text; missing gives null, other text raises.

    Without a format the text is an ISO date or timestamp.
    """
    day = F.nullif(present(text), F.lit("NaT"))
    return F.to_date(day) if date_format is None else F.to_date(day, date_format)


def parse_amount(text: Column) -> Column:
    """Money with six decimals; anything that is not a plain finite number gives 0.

    The pattern decides what a number is, because a cast alone would also take ``12d`` or
    ``NaN``. A number too large for the money type gives null, and its row is rejected.
    """
    return F.when(text.rlike(_PLAIN_NUMBER), F.trim(text).try_cast(MONEY)).otherwise(F.lit(0).cast(MONEY))


def parse_id(text: Column) -> Column:
    """Whole-number key; ``7.0`` is accepted, since nullable id columns are exported that way."""
    return present(text).cast("decimal(38,6)").cast("bigint")
