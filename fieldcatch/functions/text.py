"""Text columns: blanks, case, site ids, composite keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_blanks(c: Column) -> Column:
    """Blank field stays blank text; the text NA is missing."""
    return F.when(c == "NA", F.lit(None)).otherwise(F.coalesce(c, F.lit("")))


def blanks_missing(c: Column) -> Column:
    """Blank fields and the text NA are both missing; outer spaces are dropped."""
    trimmed = F.trim(c)
    return F.when(trimmed.isin("", "NA"), F.lit(None)).otherwise(trimmed)


def upper_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.upper(n) for n in names})


def without(c: Column, literal: str) -> Column:
    return F.replace(c, F.lit(literal), F.lit(""))


def number_in(c: Column) -> Column:
    """The number left once letters are removed; missing when that is no number."""
    return F.regexp_replace(c, "[A-Za-z]", "").try_cast("double")


def first_capitals(c: Column) -> Column:
    """First run of capital letters; missing when there is none."""
    return F.nullif(F.regexp_extract(c, "[A-Z]+", 0), F.lit(""))


def paste(*cols: Column, sep: str = " ") -> Column:
    """Join as text, writing a missing value as NA so that it still takes part in the key."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def not_blank(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def is_in(c: Column, values) -> Column:
    """Membership that is false, not missing, for a missing value."""
    return F.coalesce(c.isin(*values), F.lit(False))


def is_not(c: Column, value) -> Column:
    """Exclusion test that keeps rows with a missing value."""
    return ~c.eqNullSafe(F.lit(value))


def fill_blank(df: DataFrame, names: list[str]) -> DataFrame:
    return df.na.fill("", subset=names)


def append_where(c: Column, condition: Column, suffix: Column) -> Column:
    """Split a merged id: add the suffix where the condition holds."""
    return F.when(condition, paste(c, suffix, sep="")).otherwise(c)
