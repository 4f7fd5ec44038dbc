"""Columns and types of the files read and the tables written."""

from __future__ import annotations

from pyspark.sql import types as T

# Export columns in file order with the type each is read as.
ELECTROFISHING_EXPORT = (
    ("S_START_DATE_TIME", "string"), ("S_SAMPLE_TYPE", "int"), ("S_GEAR", "string"),
    ("S_CREW", "string"), ("S_CLIPBOARD", "string"), ("S_SITE_ID", "string"),
    ("S_RM_START", "double"), ("S_RM_END", "double"), ("S_SIDE", "string"),
    ("S_EF_MINUTES", "int"), ("S_EF_SECONDS", "int"), ("S_EF_VOLTS", "double"),
    ("S_EF_AMPS", "double"), ("S_TRIP_ID", "string"), ("S_HABITAT", "string"),
    ("S_COVER", "string"), ("S_SUBSTRATE", "string"), ("S_HYDRAULIC", "string"),
    ("S_SAMPLE_NOTES", "string"), ("SPECIES", "string"), ("TOTAL_LENGTH", "double"),
    ("FORK_LENGTH", "double"), ("WEIGHT", "double"), ("SEX", "string"), ("SEX_COND", "string"),
    ("SEX_CHAR", "string"), ("RECAP_YES_NO", "string"), ("FINCLIP1", "string"),
    ("FISH_TAG", "string"), ("FISH_TAG_READER_TIME", "string"), ("DISPOSITION", "string"),
    ("SPECIMEN_NOTES", "string"), ("FISH_TAG_READER_NUM", "string"), ("ID", "string"),
    ("SAMPLE_ID", "string"),
)

# The hoop-net export. Measurements arrive as text and are cast later.
HOOP_EXPORT = (
    ("S_START_DATE_TIME", "string"), ("S_END_DATE_TIME", "string"), ("S_SAMPLE_TYPE", "int"),
    ("S_GEAR", "string"), ("S_CREW", "string"), ("S_CLIPBOARD", "string"),
    ("S_SITE_ID", "string"), ("S_RIVER_MILE", "string"), ("S_GPS_ID", "string"),
    ("S_SET_NUM", "string"), ("S_TRIP_ID", "string"), ("S_HABITAT", "string"),
    ("S_COVER", "string"), ("S_SUBSTRATE", "string"), ("S_HYDRAULIC", "string"),
    ("S_SAMPLE_NOTES", "string"), ("SPECIES", "string"), ("TOTAL_LENGTH", "string"),
    ("FORK_LENGTH", "string"), ("WEIGHT", "string"), ("SEX", "string"), ("SEX_COND", "string"),
    ("SEX_CHAR", "string"), ("RECAP_YES_NO", "string"), ("FINCLIP1", "string"),
    ("FISH_TAG", "string"), ("FISH_TAG_READER_TIME", "string"), ("DISPOSITION", "string"),
    ("SPECIMEN_NOTES", "string"), ("FISH_TAG_READER_NUM", "string"), ("ID", "string"),
    ("SAMPLE_ID", "string"),
)

# The 2019 export, source name -> (table name, type).
LEGACY_EXPORT = (
    ("SPECIMEN_ID", "ACCESS_FISH_ID", "string"), ("FISH_TAG", "PITTAG", "string"),
    ("S_SAMPLE_TYPE", "SAMPLE_TYPE", "int"), ("S_SAMPLE_NOTES", "SAMPLE_NOTES", "string"),
    ("SPECIMEN_NOTES", "SPECIMEN_NOTES", "string"), ("S_CLIPBOARD", "CLIPBOARD", "string"),
    ("S_TEMPERATURE", "WATER_TEMP", "double"), ("S_TURBIDITY_NTU", "TURBIDITY_NTU", "double"),
    ("S_SITE_ID", "DATASHEET_SAMPLE_ID", "string"), ("S_RIVER_MILE", "START_RM", "double"),
    ("S_SIDE", "SIDE_CODE", "string"), ("S_TURBIDITY", "TURBIDITY", "string"),
    ("S_GEAR", "GEAR_CODE", "string"), ("S_SET_NUM", "EL_SECONDS", "string"),
    ("S_TRIP_ID", "TRIP_ID", "string"), ("S_END_DATE_TIME", "END_DATETIME", "string"),
    ("S_START_DATE_TIME", "START_DATETIME", "string"), ("RECAP_YES_NO", "RECAP_YES_NO", "string"),
    ("WEIGHT", "WEIGHT", "double"), ("FORK_LENGTH", "FORK_LENGTH", "double"),
    ("SEX_CHAR", "SEX_CHAR_CODE", "string"), ("SEX_COND", "SEX_COND_CODE", "string"),
    ("DISPOSITION", "DISPOSITION_CODE", "string"), ("SEX", "SEX_CODE", "string"),
    ("TOTAL_LENGTH", "TOTAL_LENGTH", "double"), ("SPECIES", "SPECIES_CODE", "string"),
)

# Site lists and water tables.
SITE_LIST = (
    ("id", "int"), ("rm_start", "double"), ("rm_end", "double"), ("side", "string"),
    ("S_SITE_ID", "string"), ("end_site_id", "string"), ("latitude", "double"),
    ("longitude", "double"), ("section", "string"), ("select", "string"), ("NO_start", "string"),
    ("NO_end", "string"), ("type", "string"), ("inside_slough", "string"), ("comments", "string"),
)
RIVER_SITE_LIST = (
    ("SiteID", "string"), ("RiverMile_100ths", "double"), ("RiverSide", "string"),
    ("reach", "string"), ("id", "int"),
)
WATER = (("START_DATE", "string"), ("TURBIDITY_NTU", "double"), ("WATER_TEMP", "double"))
WATER_ALIASES = {"date": "START_DATE", "temperature": "WATER_TEMP", "TurbidityNTU": "TURBIDITY_NTU"}

# The tables written.
SAMPLE_ELECTROFISHING = (
    ("ACCESS_SAMPLE_ID", "bigint"), ("DATASHEET_SAMPLE_ID", "string"), ("TRIP_ID", "string"),
    ("SAMPLE_TYPE", "int"), ("START_DATE", "string"), ("START_TIME", "string"),
    ("END_DATE", "string"), ("END_TIME", "string"), ("START_DATETIME", "string"),
    ("END_DATETIME", "string"), ("RIVER_CODE", "string"), ("SIDE_CODE", "string"),
    ("START_RM", "double"), ("END_RM", "double"), ("STATION_ID", "string"),
    ("GPS_START_WAYPOINT", "string"), ("CREW", "string"), ("CLIPBOARD", "string"),
    ("GEAR_CODE", "string"), ("TOTAL_CATCH", "bigint"), ("EF_AMPS", "double"),
    ("EF_VOLTS", "double"), ("EF_TOTAL_SECONDS", "int"), ("HABITAT_CODE", "string"),
    ("HYDRAULIC_CODE", "string"), ("SUBSTRATE_CODE", "string"), ("COVER_CODE", "string"),
    ("TURBIDITY", "string"), ("SAMPLE_NOTES", "string"),
)
SAMPLE_HOOP = (
    ("ACCESS_SAMPLE_ID", "bigint"), ("DATASHEET_SAMPLE_ID", "string"), ("TRIP_ID", "string"),
    ("SAMPLE_TYPE", "int"), ("START_DATE", "string"), ("START_TIME", "string"),
    ("END_DATE", "string"), ("END_TIME", "string"), ("START_DATETIME", "timestamp_ntz"),
    ("END_DATETIME", "timestamp_ntz"), ("TOTAL_HOURS", "double"), ("RIVER_CODE", "string"),
    ("SIDE_CODE", "string"), ("START_RM", "double"), ("STATION_ID", "string"),
    ("CREW", "string"), ("CLIPBOARD", "string"), ("GEAR_CODE", "string"),
    ("TOTAL_CATCH", "bigint"), ("HABITAT_CODE", "string"), ("HYDRAULIC_CODE", "string"),
    ("SUBSTRATE_CODE", "string"), ("COVER_CODE", "string"), ("SAMPLE_NOTES", "string"),
)
SPECIMEN = (
    ("ACCESS_FISH_ID", "bigint"), ("ACCESS_SAMPLE_ID", "bigint"), ("SPECIES_CODE", "string"),
    ("TOTAL_LENGTH", "double"), ("FORK_LENGTH", "double"), ("WEIGHT", "double"), ("SEX_CODE", "string"),
    ("SEX_COND_CODE", "string"), ("SEX_CHAR_CODE", "string"), ("FINCLIP1_RECAP", "string"),
    ("FINCLIP1", "string"), ("PITTAG_RECAP", "string"), ("PITTAG", "string"),
    ("DISPOSITION_CODE", "string"), ("SPECIMEN_NOTES", "string"),
)
SPECIMEN_TEXT = [n for n, t in SPECIMEN if t == "string" and n != "SPECIES_CODE"]


def names(columns) -> list[str]:
    return [c[0] for c in columns]


def conforms(df, columns) -> list[str]:
    """Differences between a frame and a target table; empty when they agree in order and type."""
    have, want = df.dtypes, [(n, t) for n, t in columns]
    return [f"{h} is not {w}" for h, w in zip(have, want) if h != w] + [
        f"missing {w}" for w in want[len(have):]
    ] + [f"extra {h}" for h in have[len(want):]]


def as_text(columns) -> T.StructType:
    return T.StructType([T.StructField(c[0], T.StringType()) for c in columns])
