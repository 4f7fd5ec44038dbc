"""Jobs from files to files."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcatch import schemas
from fieldcatch.functions import times
from fieldcatch.operators import columns
from fieldcatch.plans import field, trip, trips
from fieldcatch.plans.presets import Preset, apply_preset, corrections_frame
from fieldcatch.runtime import drop_stored, stored_paths
from fieldcatch.sources import files


def trip_tables(
    spark: SparkSession, preset: Preset, export: str, sites: str | None = None,
    water: str | None = None, store: bool = True,
):
    """SAMPLE and SPECIMEN tables of one trip; the paths may be globs or folders of its files.

    Files named after another trip are refused: `trips` takes several trips at once.
    """
    options = dict(preset.options)
    others = trips.named_otherwise(spark.read.text(export).inputFiles(), preset.config.trip_id)
    if others:
        raise ValueError(f"files of other trips than {preset.config.trip_id}: {others[:5]}")
    daily = files.scan_water(spark, water) if water else None
    correct = partial(apply_preset, preset=preset) if preset.rounds else None
    if preset.gear == "hoop":
        rows = trip.parse_export_times(files.scan_export(spark, export, schemas.HOOP_EXPORT, multiline="split"))
        listed = files.scan_river_sites(spark, sites) if sites else None
        cleaned = trip.clean_hoop(
            rows, listed, preset.config, correct, earliest=options.pop("earliest", None),
            upper=options.pop("upper", trip.UPPER_HOOP))
        if preset.late:
            options["late_fixes"] = corrections_frame(spark, preset, late=True)
        return trip.HoopTables(cleaned, preset.config, daily, store=store, **options)
    rows = trip.parse_export_times(files.scan_export(spark, export, schemas.ELECTROFISHING_EXPORT, multiline="split"))
    if preset.gear == "backfilled":
        listed = files.scan_sites(spark, sites)
        cleaned = trip.clean_backfilled(rows, listed, preset.config, correct, **options)
        return trip.ElectrofishingTables(cleaned, preset.config, "S_SIDE", store=store)
    listed = trip.end_miles(files.scan_river_sites(spark, sites))
    cleaned = trip.clean_electrofishing(rows, listed, preset.config, correct, **options)
    return trip.ElectrofishingTables(cleaned, preset.config, "RiverSide", daily, store=store)


def run_trip(
    spark: SparkSession, preset: Preset | list[Preset], output_dir: str, *paths, one_file: bool = False,
) -> None:
    """`trip_tables`, written below `output_dir` as the trip's script does; the stored tables of the job are
    deleted at its end, also after a failure. A list of presets runs their trips as one job."""
    if isinstance(preset, list):
        trips.run_trips(spark, preset, output_dir, *paths)
        return
    before = stored_paths(spark)
    try:
        out = trip_tables(spark, preset, *paths)
        trip.write_trip(
            out, replace(preset.config, output_dir=output_dir), one_file, preset.missing, preset.export_missing)
    finally:
        drop_stored(spark, keep=before)


def legacy_tables(spark: SparkSession, export: str) -> trip.LegacyTables:
    return trip.LegacyTables(files.scan_legacy(spark, export))


def run_legacy(spark: SparkSession, export: str, output_dir: str) -> trip.LegacyTables:
    """The 2019 job: both tables, with NA for missing values."""
    out = legacy_tables(spark, export)
    files.write_delimited(out.specimen, f"{output_dir}/fish.csv", missing="NA")
    files.write_delimited(out.sample, f"{output_dir}/site.csv", missing="NA")
    return out


def field_tables(spark: SparkSession, preset: Preset, export: str) -> field.FieldSummary:
    rows = field.tidy(files.scan_any(spark, export))
    rows = columns.mutate_ending(rows, "START_DATE_TIME", times.parse_minute)
    rows = rows.withColumn("S_SAMPLE_TYPE", F.col("S_SAMPLE_TYPE").try_cast("int"))
    return field.field_summary(rows, preset.config, **preset.options)


def write_field_export(out: field.FieldSummary, path: str) -> None:
    files.write_delimited(out.export, path, missing="NA", sep="\t")


def report_tables(spark: SparkSession, sample: str, specimen: str) -> tuple[DataFrame, DataFrame]:
    """Stage-one output read back for the report."""
    kinds = dict(schemas.SAMPLE_ELECTROFISHING)
    samples = files.scan_export(spark, sample, list(kinds.items()), sep=",", multiline="split")
    specimens = files.scan_export(spark, specimen, schemas.SPECIMEN, sep=",", multiline="split")
    return samples, specimens
