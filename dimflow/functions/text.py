"""Text expressions: cleaning, addresses, splitting, prompt templates."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
ADDRESS_PREFIX = "whatsapp:"
MESSAGE_LIMIT = 1500


def trim_initcap(c: Column) -> Column:
    """Strip spaces at both ends; upper-case the first letter after each space and lower-case the rest."""
    return F.initcap(F.trim(c))


def normalize_text(c: Column) -> Column:
    """Strip Unicode white space and the separator controls at both ends, lower-case."""
    return F.lower(F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", ""))


def pad(c: Column, length: int, fill: str = " ", side: str = "left") -> Column:
    """Pad to a length; longer values are cut to it."""
    if side not in ("left", "right"):
        raise ValueError(f"side must be left or right, got {side!r}")
    return (F.lpad if side == "left" else F.rpad)(c, length, fill)


def standardize(c: Column, case: str | None = None, collapse_ws: bool = True,
                mapping: Mapping[str, str] | None = None, default: str | None = None) -> Column:
    """Collapse white space, fold case, then replace codes. Values outside the mapping become the default, or stay
    as they are when there is none. Large code tables belong in ``operators.cleaning.map_codes``."""
    if collapse_ws:
        c = F.trim(F.regexp_replace(c, r"\s+", " "))
    if case is not None:
        c = {"upper": F.upper, "lower": F.lower, "title": F.initcap}[case](c)
    if mapping:
        codes = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
        known = F.try_element_at(codes, c)
        c = F.when(c.isNotNull(), F.coalesce(known, c if default is None else F.lit(default)))
    return c


def normalize_address(c: Column) -> Column:
    """The number with the channel prefix in front."""
    return F.when(c.startswith(ADDRESS_PREFIX), c).otherwise(F.concat(F.lit(ADDRESS_PREFIX), c))


def strip_address(c: Column) -> Column:
    """The number without any occurrence of the channel prefix."""
    return F.replace(c, F.lit(ADDRESS_PREFIX), F.lit(""))


def split_text(c: Column, limit: int = MESSAGE_LIMIT) -> Column:
    """The text as an array of pieces of at most ``limit`` characters; their concatenation is the text."""
    # one pass; cutting with substring would count characters from the start for every piece
    return F.when(F.length(c) > 0, F.regexp_extract_all(c, F.lit(f"(?s).{{1,{limit}}}"), F.lit(0)))


def with_default(c: Column, default: Column | str) -> Column:
    """The default in place of NULL or empty text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default) if isinstance(default, str) else default)


def render_prompt(template: str, **slots: Column) -> Column:
    """Fill the named slots of a format template; doubled braces are literal braces. A NULL slot reads ``None``."""
    pieces: list[Column] = []
    for literal, name, spec, conversion in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            if spec or conversion:
                raise ValueError("format specifications are not supported")
            pieces.append(F.coalesce(slots[name].cast("string"), F.lit("None")))
    return F.concat(*pieces) if pieces else F.lit("")
