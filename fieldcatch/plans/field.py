"""Nightly field summary: sampling nights, corrections, counts per night."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.config import TripConfig
from fieldcatch.functions import codes, text, times
from fieldcatch.operators import columns, summary


@dataclass(frozen=True)
class FieldSummary:
    export: DataFrame
    sites_per_night: DataFrame
    species_by_night: DataFrame
    species: DataFrame


def tidy(export: DataFrame) -> DataFrame:
    """Drop empty columns, descriptions that repeat codes, and two unused columns."""
    out = columns.drop_all_missing(export)
    out = columns.select_by_name(out, suffix="_DESC", keep=False)
    return out.drop("RECMOD", "S_END_DATE_TIME")


def with_night(export: DataFrame, first_night) -> DataFrame:
    start = F.col("S_START_DATE_TIME")
    return export.withColumns({
        "S_date": start.cast("date"), "S_night": times.sampling_night(start, first_night)})


def shift_sites(export: DataFrame, sites, days: int = 1) -> DataFrame:
    """Move the start of the listed sites by whole days."""
    start = F.col("S_START_DATE_TIME")
    moved = F.when(text.is_in(F.col("S_SITE_ID"), sites), times.plus_days(start, days))
    return export.withColumn("S_START_DATE_TIME", moved.otherwise(start))


def sample_columns(export: DataFrame) -> DataFrame:
    return columns.select_by_name(export, prefix="S_").distinct()


def field_summary(
    export: DataFrame, cfg: TripConfig, late_sites=(), notes: dict[str, str] | None = None
) -> FieldSummary:
    """`late_sites` were fished after midnight and carry the day before; `notes` sets the
    sample note of a whole site."""
    first = times.trip_date(F.lit(cfg.trip_id))
    out = export.withColumn("S_SITE_ID", F.upper("S_SITE_ID"))
    out = out.withColumn("S_SAMPLE_TYPE", codes.reclass_sites(
        F.col("S_SAMPLE_TYPE"), F.col("S_SITE_ID"), config.SLOUGH_SITES, config.NON_NATIVE))
    out = with_night(shift_sites(out, late_sites), first)
    if notes and "S_SAMPLE_NOTES" not in out.columns:  # dropped when nobody wrote a note
        out = out.withColumn("S_SAMPLE_NOTES", F.lit(None).cast("string"))
    for site, note in (notes or {}).items():
        here = F.col("S_SITE_ID") == site
        out = out.withColumn(
            "S_SAMPLE_NOTES", F.when(here, F.lit(note)).otherwise(F.col("S_SAMPLE_NOTES")))
    return FieldSummary(
        export=out,
        sites_per_night=summary.counts(sample_columns(out), "S_night", "S_SAMPLE_TYPE"),
        species_by_night=summary.counts(out, "SPECIES", "S_night"),
        species=summary.counts(out, "SPECIES"),
    )
