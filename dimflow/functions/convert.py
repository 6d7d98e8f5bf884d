"""Type and format conversions that give NULL for bad input, whether or not the session runs in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings, compared lower-case and trimmed
TRUE_WORDS = ("yes", "y", "true", "t", "1")
FALSE_WORDS = ("no", "n", "false", "f", "0")

# sign and whole digits of a plain number, with white space or control characters around it
_WHOLE_PART = r"^[\x00-\x20\x7f]*([+-]?[0-9]*)(?:\.[0-9]*)?[\x00-\x20\x7f]*$"
_FRACTION_ONLY = r"^[\x00-\x20\x7f]*[+-]?\.[0-9]*[\x00-\x20\x7f]*$"


def cast_int_lenient(c: Column, kind: str = "int", numeric: bool = False) -> Column:
    """Text, or with ``numeric`` a number, to INT or BIGINT: fractions are cut off, anything else that is no number in
    range becomes NULL."""
    if numeric:
        return c.try_cast(kind)
    whole = F.regexp_extract(c, _WHOLE_PART, 1)
    return (F.when(whole.isin("", "+", "-"), F.when(c.rlike(_FRACTION_ONLY), F.lit(0)))
            .otherwise(whole.try_cast(kind)))


def fill_null(c: Column, default: int, kind: str = "int", numeric: bool = False) -> Column:
    """NULL to the default, other values as :func:`cast_int_lenient`; malformed text becomes NULL, not the default."""
    return F.when(c.isNull(), F.lit(default)).otherwise(cast_int_lenient(c, kind, numeric))


def convert_date(c: Column, from_format: str, to_format: str) -> Column:
    """Reformat a date held as text."""
    return F.date_format(F.try_to_timestamp(c, F.lit(from_format)), to_format)


def convert_zone(c: Column, source: str, target: str) -> Column:
    """Wall-clock time in one zone to wall-clock time in another."""
    return F.convert_timezone(F.lit(source), F.lit(target), c)


def normalize_bool(c: Column) -> Column:
    word = F.lower(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))
