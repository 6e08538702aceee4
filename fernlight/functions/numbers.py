"""Number functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def compact_count(value: Column) -> Column:
    """2.5K as 2500. 0 without a number; null where the number can't be read, so that the row can be skipped.

    The letter behind the number counts even where it begins a word.
    """
    text = F.replace(value, F.lit(" "), F.lit(" "))
    pattern = r"([0-9,.]+)\s*([KkMm]?)"
    digits = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit(""))
    suffix = F.lower(F.regexp_extract(text, pattern, 2))
    scale = F.when(suffix == "k", F.lit(1000.0)).when(suffix == "m", F.lit(1000000.0)).otherwise(F.lit(1.0))
    number = digits.try_cast("double") * scale
    found = F.coalesce(text.rlike(r"[0-9,.]"), F.lit(False))
    return F.when(~found, F.lit(0)).otherwise(F.floor(number)).cast("bigint")


def round6(x: Column) -> Column:
    return F.round(x, 6)
