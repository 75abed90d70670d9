"""Words of a text, as column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def whole(text: Column) -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than space and the controls 9 to 13. NULL and blank texts have none."""
    bare = F.btrim(whole(text), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def short_hash(value: Column) -> Column:
    """The first 60 bits of MD5 as a number: any SQL engine gives the same."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")
