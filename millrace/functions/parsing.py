"""Column functions over delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_fields(text: Column, sep: str = ",") -> Column:
    """Split on a one-character separator; trailing empty fields are dropped.

    Quotes have no meaning. A line of separators only has no fields at all, an
    empty line has one empty field.
    """
    trimmed = F.rtrim(text, F.lit(sep))
    only_separators = (F.length(trimmed) == 0) & (F.length(text) > 0)
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "\\" + sep)
    )


def to_number(text: Column, dtype: str, lenient: bool = False) -> Column:
    """Text to a number: bad text is an error (under ANSI), or NULL if lenient."""
    return text.try_cast(dtype) if lenient else text.cast(dtype)
