"""Many trips in one job.

What differs from trip to trip (key offsets, cutoffs, spellings, corrections) is a table with a row per trip
and is joined to the rows, so that a job over a folder of exports is one plan, whatever the number of trips.
The trip of a row is that of the file it stands in. Keys, catch and corrections are per trip. Outputs are
partitioned by trip and replace the partitions of the trips in the job alone, so a trip can be loaded again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcatch import config, schemas
from fieldcatch.functions import codes, times
from fieldcatch.functions.text import append_where
from fieldcatch.operators.corrections import apply_corrections
from fieldcatch.operators.lookups import attach
from fieldcatch.plans import loads, trip
from fieldcatch.plans.presets import Preset
from fieldcatch.runtime import drop_stored, materialise, stored_paths
from fieldcatch.sources import files

TRIP = trip.TRIP
#: A trip id in a path: two letters and a day.
TRIP_ID = "[A-Za-z]{2}[0-9]{8}"
SETTINGS = (
    f"{TRIP} string, samples_before bigint, specimens_before bigint, earliest timestamp_ntz, cutoff timestamp_ntz, "
    "early_note string, key_by_site boolean, with_hours boolean, keep_codes boolean, upper array<string>"
)
_FLAGS = ("earliest", "cutoff", "early_note", "key_by_site", "with_hours", "keep_codes", "upper")
FIXES = f"{TRIP} string, late boolean, round int, column string, key_column string, key_value string, new_value string"
SPLITS = f"{TRIP} string, round int, turn int, key_column string, key_value string, suffix string"


def settings_frame(spark: SparkSession, presets: Iterable[Preset]) -> DataFrame:
    """One row per trip; `upper` lists the columns its script puts in capitals."""
    rows = []
    for p in presets:
        default = trip.UPPER_HOOP if p.gear == "hoop" else trip.UPPER_ELECTROFISHING
        rows.append((
            p.config.trip_id, p.config.samples_before, p.config.specimens_before, p.options.get("earliest"),
            p.options.get("cutoff"), p.options.get("early_note"), p.options.get("key_by_site", False),
            p.options.get("with_hours", True), p.options.get("keep_codes", False), p.options.get("upper", default),
        ))
    return spark.createDataFrame(rows, SETTINGS)


def fixes_frame(spark: SparkSession, presets: Iterable[Preset]) -> DataFrame:
    """The corrections of all trips; those marked late come after the catch has been counted."""
    return spark.createDataFrame([
        (p.config.trip_id, late, number, column, key_column, value, new)
        for p in presets for late, rounds in ((False, p.rounds), (True, p.late))
        for number, entries in enumerate(rounds, start=1)
        for column, key_column, pairs in entries for value, new in pairs
    ], FIXES)


def splits_frame(spark: SparkSession, presets: Iterable[Preset]) -> DataFrame:
    return spark.createDataFrame([
        (p.config.trip_id, before, turn, key_column, value, suffix)
        for p in presets for turn, (before, key_column, value, suffix) in enumerate(p.splits)
    ], SPLITS)


def trip_of(path: Column) -> Column:
    """The last trip id in a path, in capitals; null if there is none."""
    found = F.upper(F.regexp_extract(path, f"^.*(?:^|[^A-Za-z])({TRIP_ID})", 1))
    return F.when(found != "", found)


def named_otherwise(paths: Iterable[str], trip_id: str) -> list[str]:
    """Files whose name holds the id of another trip."""
    ids = {p: re.findall(f"(?:^|[^A-Za-z])({TRIP_ID})", os.path.basename(p)) for p in paths}
    return sorted(p for p, found in ids.items() if found and trip_id.upper() not in map(str.upper, found))


def strange_files(paths: Iterable[str], known: set[str]) -> list[str]:
    """Files whose path names no known trip."""
    ids = {p: re.findall(f"(?:^|[^A-Za-z])({TRIP_ID})", p) for p in paths}
    return sorted(p for p, found in ids.items() if not found or found[-1].upper() not in known)


def by_trip(rows: DataFrame, settings: DataFrame) -> DataFrame:
    """`rows` with the settings of their trip, under names that begin with an underscore."""
    return attach(rows, settings.select(TRIP, *[F.col(c).alias(f"_{c}") for c in _FLAGS]), [TRIP])


def capitals(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({
        c: F.when(F.array_contains("_upper", c), F.upper(c)).otherwise(F.col(c)) for c in columns if c != TRIP
    })


def correct(rows: DataFrame, fixes: DataFrame, splits: DataFrame, layout: list[tuple], turns: list[tuple]) -> DataFrame:
    """Every trip's splits and corrections, round by round. `layout` and `turns` list the (round, key column,
    column) and (round, turn, key column) in use, which are few however many trips there are."""
    out = rows
    for number in sorted({r for r, *_ in layout} | {r for r, *_ in turns}):
        for before, turn, key_column in sorted(t for t in turns if t[0] == number):
            here = splits.filter((F.col("round") == before) & (F.col("turn") == turn) & (F.col("key_column") == key_column))
            marks = here.select(TRIP, F.col("key_value").alias("_value"), F.struct("suffix").alias("_split"))
            out = attach(out.withColumn("_value", F.col(key_column)), marks, [TRIP, "_value"]).withColumn(
                "SAMPLE_ID", append_where(F.col("SAMPLE_ID"), F.col("_split").isNotNull(),
                                          F.coalesce("_split.suffix", "S_SITE_ID")),
            ).drop("_value", "_split")
        out = apply_corrections(out, fixes, [u for u in layout if u[0] == number], by=(TRIP,))
    return out


def _layout(presets: list[Preset], late: bool) -> list[tuple[int, str, str]]:
    return sorted({
        (number, key_column, column) for p in presets
        for number, entries in enumerate(p.late if late else p.rounds, start=1) for column, key_column, _ in entries
    })


def many_hoop_tables(cleaned: DataFrame, water: DataFrame | None = None, store: bool = True,
                     only: str | None = None) -> trip.HoopTables:
    """`HoopTables` whose options come from the settings of each trip, which `cleaned` carries."""
    by_site = F.col("_key_by_site")
    ordered = cleaned.withColumns({
        "_order_1": F.when(by_site, F.col("SAMPLE_ID")).otherwise(F.col("START_DATE")),
        "_order_2": F.when(~by_site, F.col("S_CLIPBOARD")),
    })
    return trip.HoopTables(
        ordered, config.TripConfig(""), water, by_site, F.col("_with_hours"), F.col("_keep_codes"), store=store,
        many=True, order=["_order_1", "_order_2", "S_END_DATE_TIME", "ID"], flags=["_with_hours", "_keep_codes"],
        only=only,
    )


def clean_many_hoop(rows: DataFrame, settings: DataFrame, sites: DataFrame | None = None, fix=None) -> DataFrame:
    """`clean_hoop` over rows that carry their trip."""
    told = capitals(by_trip(rows, settings), trip.UPPER_HOOP)
    return trip.clean_hoop(told, sites, None, fix, earliest=F.col("_earliest"), upper=[])


def clean_many_electrofishing(rows: DataFrame, settings: DataFrame, sites: DataFrame, fix=None,
                              on_duplicate: str = "all") -> DataFrame:
    told = capitals(by_trip(rows, settings), trip.UPPER_ELECTROFISHING)
    # every trip's columns are in capitals already where its settings say so
    return trip.clean_electrofishing(told, sites, None, fix, on_duplicate, upper=[])


def clean_many_backfilled(rows: DataFrame, settings: DataFrame, sites: DataFrame, fix=None,
                          on_duplicate: str = "all") -> DataFrame:
    told = capitals(by_trip(rows, settings), trip.UPPER_ELECTROFISHING)
    out = trip.clean_backfilled(told, sites, None, fix, on_duplicate=on_duplicate, upper=[])
    start, edge = F.col("S_START_DATE_TIME"), F.col("_cutoff")
    kind = times.type_by_cutoff(start, edge, config.SUPPLEMENTAL, config.MONITORING)
    note = codes.backfill_note(F.col("S_SAMPLE_NOTES"), start, edge, F.col("_early_note"))
    return out.withColumns({
        "S_SAMPLE_TYPE": F.when(edge.isNull(), F.col("S_SAMPLE_TYPE")).otherwise(kind),
        "S_SAMPLE_NOTES": F.when(edge.isNull() | F.col("_early_note").isNull(), F.col("S_SAMPLE_NOTES")).otherwise(note),
    })


def tables_of(spark: SparkSession, presets: list[Preset], export, sites: str | None = None, water: str | None = None,
              store: bool = True):
    """The tables of trips of one gear, from a folder or glob of their exports."""
    gear, known = presets[0].gear, {p.config.trip_id for p in presets}
    if len({p.gear for p in presets}) > 1 or len(known) < len(presets):
        raise ValueError("trips of one job have one gear and ids of their own")
    settings = materialise(settings_frame(spark, presets), "settings")  # of known size, see there
    all_fixes = fixes_frame(spark, presets)
    fixes, late = all_fixes.filter("NOT late").drop("late"), all_fixes.filter("late").drop("late")
    turns = sorted({(before, turn, key) for p in presets for turn, (before, key, *_) in enumerate(p.splits)})
    layout = _layout(presets, False)
    fix = partial(correct, fixes=fixes, splits=splits_frame(spark, presets), layout=layout, turns=turns) if layout or turns else None
    columns = schemas.HOOP_EXPORT if gear == "hoop" else schemas.ELECTROFISHING_EXPORT
    scanned = files.scan_trips(spark, export, columns, multiline="split")
    strange = strange_files(scanned.inputFiles(), known)
    if strange:
        raise ValueError(f"files of no known trip: {strange[:5]}")
    rows = trip.parse_export_times(scanned).withColumn(TRIP, trip_of(F.col("TRIP_FILE"))).drop("TRIP_FILE")
    daily = files.scan_water(spark, water) if water else None
    if gear == "hoop":
        listed = files.scan_river_sites(spark, sites) if sites else None
        out = many_hoop_tables(clean_many_hoop(rows, settings, listed, fix), daily, store)
        if any(p.late for p in presets):
            out.late_fixes, out.late_layout = late, _layout(presets, True)
    elif gear == "backfilled":
        cleaned = clean_many_backfilled(rows, settings, files.scan_sites(spark, sites), fix)
        out = trip.ElectrofishingTables(cleaned, config.TripConfig(""), "S_SIDE", store=store, many=True)
    else:
        listed = trip.end_miles(files.scan_river_sites(spark, sites))
        cleaned = clean_many_electrofishing(rows, settings, listed, fix)
        out = trip.ElectrofishingTables(cleaned, config.TripConfig(""), "RiverSide", daily, store=store, many=True)
    out.before = settings.select(TRIP, "samples_before", "specimens_before")
    return out


def sizes(cleaned: DataFrame, unit: str, gear: str) -> DataFrame:
    """(trip, gear, n_samples, n_specimens): the keys each trip of a job needs, a sample for each `unit`."""
    counted = cleaned.groupBy(F.col(TRIP).alias("trip"), unit).agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy("trip").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum("_n").cast("bigint").alias("n_specimens")
    ).withColumn("gear", F.lit(gear))


def run_trips(spark: SparkSession, presets: list[Preset], output_dir: str, export, sites: str | None = None,
              water: str | None = None, continue_keys: bool = False) -> None:
    """Write the tables of all trips below `output_dir`, each partitioned by trip.

    With `continue_keys` offsets come from the register of loads in `output_dir` in place of the presets, and the
    job's loads are entered there once their tables are written. A job that failed is run again as it is.
    """
    held, gear = stored_paths(spark), presets[0].gear
    try:
        out = tables_of(spark, presets, export, sites, water)
        register = os.path.join(output_dir, "_loads")
        taken = None
        if continue_keys:
            taken = loads.register(sizes(out.cleaned, out.unit, gear), register)
            out.before = taken.select(F.col("trip").alias(TRIP), "samples_before", "specimens_before")
        for marker in sorted({p.missing for p in presets}):
            ids = [p.config.trip_id for p in presets if p.missing == marker]
            for name, table in (("sample", out.sample), ("specimen", out.specimen)):
                files.write_delimited(
                    table.filter(F.col("trip").isin(*ids)), os.path.join(output_dir, gear, name),
                    missing=marker, partition_by=("trip",), replace=True)
        # the corrected export, of the trips whose scripts write one; one pass per way to print missing values
        checked = sorted({p.export_missing for p in presets if p.export_missing is not None})
        for marker in checked:
            rows = out.keyed.filter(F.col(TRIP).isin(*[p.config.trip_id for p in presets if p.export_missing == marker]))
            files.write_delimited(
                rows.drop(*[c for c in rows.columns if c.startswith("_")]).withColumn("trip", F.col(TRIP)),
                os.path.join(output_dir, gear, "errorchecked"), missing=marker, partition_by=("trip",), replace=True)
        if taken is not None:
            loads.write_loads(taken, register)
    finally:
        drop_stored(spark, keep=held)
