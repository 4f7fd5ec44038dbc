"""Coded fields: recaptures, sex and condition, sample type, backfills."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions.text import is_in, not_blank


def _answer(code: Column, answers: dict, other: Column) -> Column:
    return (
        F.when(code.isin(*answers["Y"]), "Y").when(code.isin(*answers["N"]), "N").otherwise(other)
    )


def tag_recap(code: Column) -> Column:
    return _answer(code, config.TAG_RECAP, F.lit(None).cast("string"))


def clip_recap(code: Column) -> Column:
    return _answer(code, config.CLIP_RECAP, F.lit(None).cast("string"))


def tag_recap_or_code(code: Column) -> Column:
    """As `tag_recap`, but a code outside the list is kept as it is."""
    return _answer(code, config.TAG_RECAP, code)


def clip_recap_or_code(code: Column) -> Column:
    return _answer(code, config.CLIP_RECAP, code)


def sex_condition(sex: Column, condition: Column) -> Column:
    """A fish of unknown sex cannot be ripe or gravid."""
    return F.when((sex == "U") & condition.isin("R", "G"), "N").otherwise(condition)


def reclass_sites(sample_type: Column, site: Column, sites, new_type: int) -> Column:
    return F.when(is_in(site, sites), F.lit(new_type)).otherwise(sample_type)


def backfill_mile(own: Column, listed: Column, site: Column) -> Column:
    """Own value, then the site list's, then the slough's centre point."""
    slough = F.when(site.contains(config.SLOUGH_MARK), F.lit(config.SLOUGH_MILE))
    return F.coalesce(own, listed, slough)


def backfill_side(own: Column, listed: Column, site: Column) -> Column:
    """As for the mile; the slough rule needs the side to be missing, not merely blank."""
    return (
        F.when(not_blank(own), own)
        .when(not_blank(listed), listed)
        .when(own.isNull() & site.contains(config.SLOUGH_MARK), F.lit(config.SLOUGH_SIDE))
    )


def backfill_note(note: Column, ts: Column, cutoff: datetime | Column, text: str | Column) -> Column:
    """Fill a blank note of work done before the cutoff."""
    edge = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("timestamp_ntz")
    filled = text if isinstance(text, Column) else F.lit(text)
    return F.when((ts < edge) & (note == ""), filled).otherwise(note)


def pick(flag: bool | Column, yes: Column, no: Column) -> Column:
    """`yes` or `no`, as a setting of the job or of each row says."""
    if isinstance(flag, Column):
        return F.when(flag, yes).otherwise(no)
    return yes if flag else no


def hoop_end_clock(gear: Column, end_clock: Column) -> Column:
    """Only mini hoop nets record an end time; electrofishing leaves it blank."""
    return F.when(gear == "MHB", end_clock).when(gear == "EL", "")


def caught(species: Column) -> Column:
    """1 for a specimen, 0 for the row that says no fish was caught; missing species counts."""
    return F.when(species == config.NO_FISH, 0).otherwise(1)
