"""String helpers of the list normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_chars(column: Column, chars: str) -> Column:
    """Remove any of `chars` from both ends."""
    return F.btrim(column, F.lit(chars))


def quoted_items(column: Column | str) -> Column:
    """The single-quoted items of a list written as text, quotes removed."""
    column = F.col(column) if isinstance(column, str) else column
    return F.regexp_extract_all(column, F.lit("'([^']*)'"), F.lit(1))
