"""Text cleansing and safe casts of all-text landing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values read as TRUE in a text flag; anything else, NULL included, is FALSE.
TRUE_WORDS = ("true", "yes", "1")


def title_case(value: Column) -> Column:
    """Upper-case the first letter after every character that is no letter or
    digit (``self-employed`` -> ``Self-Employed``); the built-in ``initcap``
    only starts a word after a blank."""
    pieces = F.regexp_extract_all(value, F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}])"), F.lit(1))
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substr(p, F.lit(2))))),
        "",
    )


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def to_type(value: Column, type_name: str, strict: bool) -> Column:
    """Blank -> NULL, then cast. ``strict`` raises on a bad value; tolerant
    casting yields NULL, and the reject job reports the row."""
    text = blank_to_null(value)
    return text.cast(type_name) if strict else text.try_cast(type_name)


def is_bad(value: Column, type_name: str) -> Column:
    """True where a non-blank text does not convert to ``type_name``."""
    text = blank_to_null(value)
    return text.isNotNull() & text.try_cast(type_name).isNull()


def digits_and_dot(value: Column) -> Column:
    """Strip everything but digits and dots (currency signs, commas, minus)."""
    return F.regexp_replace(value, "[^0-9.]", "")


def region_id(city: Column, state: Column) -> Column:
    """Business key of a region; NULL when a part is NULL."""
    return F.md5(F.concat(F.lower(F.trim(city)), F.lit("|"), F.lower(F.trim(state))))
