"""The SAMPLE and SPECIMEN tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch import config, schemas
from fieldcatch.functions.codes import (
    clip_recap,
    clip_recap_or_code,
    hoop_end_clock,
    pick,
    tag_recap,
    tag_recap_or_code,
)
from fieldcatch.functions.measures import round_half_even
from fieldcatch.functions.text import fill_blank, first_capitals, paste
from fieldcatch.functions.times import (
    clock,
    hours_between,
    iso_date,
    plus_seconds,
    us_date,
    us_datetime,
)
from fieldcatch.operators.lookups import join_water


# What a sample row is made of. Rows are made distinct on these alone; everything computed from
# them, and the constants, are added to the distinct rows.
_PLACE_AND_TIME = ["S_SITE_ID", "S_TRIP_ID", "S_SAMPLE_TYPE", "S_START_DATE_TIME", "S_CREW", "S_CLIPBOARD"]
_SURROUNDINGS = ["S_HABITAT", "S_HYDRAULIC", "S_SUBSTRATE", "S_COVER", "S_SAMPLE_NOTES"]
_ELECTROFISHING = [*_PLACE_AND_TIME, "S_RM_START", "S_RM_END", "S_EF_AMPS", "S_EF_VOLTS",
                   "EF_TOTAL_SECONDS", *_SURROUNDINGS]
_HOOP = [*_PLACE_AND_TIME, "S_END_DATE_TIME", "S_GEAR", "S_RIVER_MILE", "S_GPS_ID", *_SURROUNDINGS]
# Names of the tables and the report.
_RENAMED = {
    "S_TRIP_ID": "TRIP_ID", "S_SAMPLE_TYPE": "SAMPLE_TYPE", "S_CREW": "CREW",
    "S_CLIPBOARD": "CLIPBOARD", "S_HABITAT": "HABITAT_CODE", "S_HYDRAULIC": "HYDRAULIC_CODE",
    "S_SUBSTRATE": "SUBSTRATE_CODE", "S_COVER": "COVER_CODE", "S_SAMPLE_NOTES": "SAMPLE_NOTES",
}


def sample_columns(gear_columns: str, side: str | None = None) -> list[str]:
    """What samples are made of, for a job that stores no more than it needs."""
    return [*([side] if side else []), *(_HOOP if gear_columns == "hoop" else _ELECTROFISHING), "SPECIES"]


def electrofishing_samples(export: DataFrame, side: str, extra: list[str] = ()) -> DataFrame:
    """Distinct samples, still under the export's names, with `extra` columns that follow from the others."""
    return export.select(side, *_ELECTROFISHING, *extra).distinct()


def hoop_samples(export: DataFrame, extra: list[str] = ()) -> DataFrame:
    return export.select(*_HOOP, *extra).distinct()


def _times(start: Column, end: Column) -> dict[str, Column]:
    return {
        "START_DATE": us_date(start), "START_TIME": clock(start),
        "END_DATE": us_date(end), "END_TIME": clock(end),
        "START_DATETIME": start, "END_DATETIME": end,
        "RIVER_CODE": F.lit(config.RIVER_CODE),
        "DATASHEET_SAMPLE_ID": F.col("S_SITE_ID"),
    }


def _with_water(rows: DataFrame, water: DataFrame | None, names: list[str]):
    """The water table is met on the ISO date, before dates are written the US way."""
    if water is None:
        return rows, names
    dated = rows.withColumn("START_DATE", iso_date(F.col("S_START_DATE_TIME")))
    return join_water(dated, water), [*names, "TURBIDITY_NTU", "WATER_TEMP"]


def sample_table_electrofishing(samples: DataFrame, side: str, water: DataFrame | None) -> DataFrame:
    """`samples` are the distinct samples with ACCESS_SAMPLE_ID and TOTAL_CATCH."""
    rows, names = _with_water(samples, water, schemas.names(schemas.SAMPLE_ELECTROFISHING))
    start = F.col("S_START_DATE_TIME")
    end = plus_seconds(start, F.col("EF_TOTAL_SECONDS"))
    columns = _times(start, end) | {
        "START_DATETIME": us_datetime(start), "END_DATETIME": us_datetime(end),
        "SIDE_CODE": F.col(side), "START_RM": F.col("S_RM_START"), "END_RM": F.col("S_RM_END"),
        "STATION_ID": paste(F.lit("S"), F.col("S_SITE_ID"), sep=""),
        "GPS_START_WAYPOINT": F.col("S_SITE_ID"),
        "GEAR_CODE": F.lit(config.ELECTROFISHING_GEAR), "TURBIDITY": F.lit(config.TURBIDITY_CODE),
        "EF_AMPS": F.col("S_EF_AMPS"), "EF_VOLTS": F.col("S_EF_VOLTS"),
    }
    table = rows.withColumns(columns).withColumnsRenamed(_RENAMED).select(*names)
    return fill_blank(table, ["SAMPLE_NOTES"])


def sample_table_hoop(samples: DataFrame, water: DataFrame | None, with_hours: bool | Column = True) -> DataFrame:
    """As for electrofishing; END_TIME depends on the gear, and net hours may be left out: as a column, or,
    where each row says so, as values."""
    names = [n for n in schemas.names(schemas.SAMPLE_HOOP) if with_hours is not False or n != "TOTAL_HOURS"]
    rows, names = _with_water(samples, water, names)
    start, end = F.col("S_START_DATE_TIME"), F.col("S_END_DATE_TIME")
    columns = _times(start, end) | {
        "END_TIME": hoop_end_clock(F.col("S_GEAR"), clock(end)),
        "TOTAL_HOURS": pick(with_hours, round_half_even(hours_between(start, end), 2), F.lit(None).cast("double")),
        "SIDE_CODE": first_capitals(F.col("S_SITE_ID")), "START_RM": F.col("S_RIVER_MILE"),
        "STATION_ID": F.col("S_GPS_ID"), "GEAR_CODE": F.col("S_GEAR"),
    }
    return rows.withColumns(columns).withColumnsRenamed(_RENAMED).select(*names)


# What a specimen row is made of.
# Names of the tables and the report.
SPECIMEN_COLUMNS = [
    "SPECIES", "TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT", "SEX", "SEX_COND", "SEX_CHAR",
    "RECAP_YES_NO", "FINCLIP1", "FISH_TAG", "DISPOSITION", "SPECIMEN_NOTES",
]


def specimen_table(
    keyed: DataFrame, keep_codes: bool | Column = False, blanks: bool = True, extra: list[Column] = ()
) -> DataFrame:
    """`keyed` is the export with both keys. `keep_codes`, for all rows or as each row says, lets recapture
    codes outside the list through; `blanks` writes missing text as blank; `extra` columns come last."""
    code = F.col("RECAP_YES_NO")
    tag = pick(keep_codes, tag_recap_or_code(code), tag_recap(code))
    clip = pick(keep_codes, clip_recap_or_code(code), clip_recap(code))
    finclip = pick(keep_codes, F.coalesce(F.col("FINCLIP1"), F.lit("")), F.col("FINCLIP1"))
    table = keyed.select(
        "ACCESS_FISH_ID", "ACCESS_SAMPLE_ID", F.col("SPECIES").alias("SPECIES_CODE"),
        "TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT",
        F.col("SEX").alias("SEX_CODE"), F.col("SEX_COND").alias("SEX_COND_CODE"),
        F.col("SEX_CHAR").alias("SEX_CHAR_CODE"), clip.alias("FINCLIP1_RECAP"),
        finclip.alias("FINCLIP1"), tag.alias("PITTAG_RECAP"),
        F.col("FISH_TAG").alias("PITTAG"), F.col("DISPOSITION").alias("DISPOSITION_CODE"),
        "SPECIMEN_NOTES", *extra,
    )
    return fill_blank(table, schemas.SPECIMEN_TEXT) if blanks else table
