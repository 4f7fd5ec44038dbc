"""Export to SAMPLE and SPECIMEN tables, for both kinds of gear and the 2019 format."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch import config, schemas
from fieldcatch.config import TripConfig
from fieldcatch.functions import codes, measures, text, times
from fieldcatch.operators import catch, columns, corrections, lookups, ordering, summary, tables
from fieldcatch.runtime import materialise
from fieldcatch.sources.files import write_delimited

# The columns the scripts put in capitals.
UPPER_ELECTROFISHING = ["S_TRIP_ID", "S_SITE_ID", "S_CLIPBOARD", "S_CREW", "FISH_TAG"]
UPPER_HOOP = [*UPPER_ELECTROFISHING, "S_GPS_ID"]
Correction = Callable[[DataFrame], DataFrame]
VISIT = "S_SITE_ID_2"
NET = "S_NET"
TRIP = "S_TRIP_ID"


def next_load(cfg: TripConfig, samples: DataFrame, specimens: DataFrame | None = None) -> TripConfig:
    """`cfg` with its keys starting behind those of the tables loaded so far."""
    most = summary.high_water(samples, "ACCESS_SAMPLE_ID").first()[0]
    last = summary.high_water(specimens, "ACCESS_FISH_ID").first()[0] if specimens is not None else None
    return replace(cfg, samples_before=most or 0, specimens_before=last or cfg.specimens_before)


def end_miles(sites: DataFrame) -> DataFrame:
    """Add `end_rm`: the start mile of the next site down the same side. Only the two banks
    have a next site; others are dropped."""
    banks = sites.filter(F.col("RiverSide").isin("L", "R"))
    return materialise(ordering.neighbour(banks, ["RiverSide"], ["site_seq"], {"start_rm": "end_rm"}, step=1), "sites")


def parse_export_times(export: DataFrame) -> DataFrame:
    """Text times of a scanned export to timestamps."""
    out = columns.mutate_ending(export, "DATE_TIME", times.parse_minute)
    return columns.mutate_ending(out, "READER_TIME", times.parse_second)


def normalise(export: DataFrame, cfg: TripConfig | None, upper: list[str]) -> DataFrame:
    """Capitals where they belong; the configured trip id replaces what was typed."""
    out = text.upper_columns(export, upper)
    return out.withColumn("S_TRIP_ID", F.lit(cfg.trip_id)) if cfg else out


def visit_key(site: str = "S_SITE_ID", start: str = "S_START_DATE_TIME"):
    return text.paste(F.col(site), times.iso_text(F.col(start)))


def boat_key():
    start, end = F.col("S_START_DATE_TIME"), F.col("S_END_DATE_TIME")
    return text.paste(times.iso_date(start), F.col("S_CLIPBOARD"), times.iso_text(end))


def _decoded(export: DataFrame) -> DataFrame:
    return export.withColumns({
        "PITTAG_RECAP": codes.tag_recap(F.col("RECAP_YES_NO")),
        "FINCLIP1_RECAP": codes.clip_recap(F.col("RECAP_YES_NO")),
        "SEX_COND": codes.sex_condition(F.col("SEX"), F.col("SEX_COND")),
    })


def clean_electrofishing(
    export: DataFrame, sites: DataFrame, cfg: TripConfig | None = None,
    correct: Correction | None = None, on_duplicate: str = "all", upper: list[str] = UPPER_ELECTROFISHING,
) -> DataFrame:
    """Corrected export with list miles, effort and decoded recaptures (river list)."""
    out = normalise(export, cfg, upper)
    if correct is not None:
        out = correct(out)
    out = lookups.join_sites(out, sites, ["start_rm", "end_rm", "RiverSide", "reach"], on_duplicate)
    out = out.withColumns({
        "S_RM_START": F.col("start_rm"), "S_RM_END": F.col("end_rm"),
        "EF_TOTAL_SECONDS": times.effort_seconds(F.col("S_EF_MINUTES"), F.col("S_EF_SECONDS")),
    })
    return _decoded(out.drop("S_EF_MINUTES", "S_EF_SECONDS"))


def clean_backfilled(
    export: DataFrame, sites: DataFrame, cfg: TripConfig | None = None,
    correct: Correction | None = None, cutoff: datetime | None = None,
    early_note: str | None = None, on_duplicate: str = "all", upper: list[str] = UPPER_ELECTROFISHING,
) -> DataFrame:
    """As above for the reach with a slough: only monitoring sites are listed, and miles and
    sides missing from the list are backfilled. With a `cutoff`, work before it is recoded
    as supplemental and work after it as monitoring."""
    listed = sites.filter(F.col("type") == "monitoring").select(
        "S_SITE_ID", "side", "rm_start", "rm_end", *(["site_seq"] if on_duplicate == "first" else [])
    ).distinct()
    out = normalise(export, cfg, upper)
    if correct is not None:
        out = correct(out)
    out = lookups.join_sites(out, listed, ["side", "rm_start", "rm_end"], on_duplicate)
    start, site = F.col("S_START_DATE_TIME"), F.col("S_SITE_ID")
    if cutoff is not None:
        out = out.withColumn("S_SAMPLE_TYPE", times.type_by_cutoff(
            start, cutoff, config.SUPPLEMENTAL, config.MONITORING))
        if early_note:
            out = out.withColumn("S_SAMPLE_NOTES", codes.backfill_note(
                F.col("S_SAMPLE_NOTES"), start, cutoff, early_note))
    none = F.lit(None).cast("double")
    out = out.withColumns({
        "S_RM_START": codes.backfill_mile(none, F.col("rm_start"), site),
        "S_RM_END": codes.backfill_mile(none, F.col("rm_end"), site),
        "S_SIDE": codes.backfill_side(F.col("S_SIDE"), F.col("side"), site),
        "EF_TOTAL_SECONDS": times.effort_seconds(F.col("S_EF_MINUTES"), F.col("S_EF_SECONDS")),
    })
    out = out.drop("rm_start", "rm_end", "side", "S_EF_MINUTES", "S_EF_SECONDS")
    return _decoded(out)


class _Tables:
    """What the tables of all gears share: the stored cleaned export, and keys by trip or for one trip.

    Each table is planned when it is first asked for, so a job that wants only samples does not
    number specimens. `store` writes the cleaned export to the shared folder once and lets
    everything else read it from there, pruned to the columns it needs. Where `only` names the one table that
    is wanted, `sample` or `specimen`, no other columns are stored.

    With `many`, rows of several trips are kept apart by their trip id: keys are dense in each trip, behind
    the offsets of `before`, a frame of (S_TRIP_ID, samples_before, specimens_before).
    """

    def __init__(self, cleaned: DataFrame, cfg: TripConfig, unit: str, store: bool, many: bool,
                 needs: dict[str, list[str]], only: str | None):
        self.cfg, self.unit, self.many = cfg, unit, many
        self.keys = [TRIP, unit] if many else [unit]
        self.before: DataFrame | None = None
        if only:
            cleaned = cleaned.select(*dict.fromkeys([TRIP, unit, *needs[only]]))
        self.cleaned = materialise(cleaned, "cleaned") if store else cleaned

    def _number(self, rows: DataFrame, order: list[str], out: str, before: str) -> DataFrame:
        if not self.many:
            return ordering.number_rows(rows, order, out, getattr(self.cfg, before))
        return ordering.number_within(rows, TRIP, order, out, self.before.select(TRIP, F.col(before).alias("before")))

    def _trip(self) -> list[Column]:
        """The trip beside rows that do not name it otherwise."""
        return [F.col(TRIP).alias("trip")] if self.many else []


class ElectrofishingTables(_Tables):
    """SAMPLE and SPECIMEN tables of a cleaned electrofishing export."""

    order = ["SAMPLE_ID", "S_START_DATE_TIME", "ID", "S_RM_START", "S_RM_END"]

    def __init__(self, cleaned: DataFrame, cfg: TripConfig, side: str,
                 water: DataFrame | None = None, store: bool = True, many: bool = False, only: str | None = None):
        self.side, self.water = side, water
        needs = {"sample": tables.sample_columns("electrofishing", side),
                 "specimen": [*self.order, *tables.SPECIMEN_COLUMNS]}
        super().__init__(cleaned.withColumn(VISIT, visit_key()), cfg, VISIT, store, many, needs, only)

    @cached_property
    def visits(self) -> DataFrame:
        """Key and catch of every visit to a site."""
        totals = catch.total_catch(self.cleaned, self.keys)
        return self._number(totals, [VISIT], "ACCESS_SAMPLE_ID", "samples_before")

    def _key(self, rows: DataFrame) -> DataFrame:
        numbered = self._number(rows, self.order, "ACCESS_FISH_ID", "specimens_before")
        return lookups.attach(numbered, self.visits, self.keys)

    @cached_property
    def keyed(self) -> DataFrame:
        """The corrected export with both keys and the catch of the visit."""
        return self._key(self.cleaned)

    @cached_property
    def sample(self) -> DataFrame:
        rows = tables.electrofishing_samples(self.cleaned, self.side, [VISIT])
        rows = lookups.attach(rows, self.visits, self.keys)
        made = tables.sample_table_electrofishing(rows, self.side, self.water)
        return made.withColumn("trip", F.col("TRIP_ID")) if self.many else made

    @cached_property
    def specimen(self) -> DataFrame:
        """Built on `keyed` where that exists; else only the columns of the table are sorted."""
        if "keyed" in self.__dict__:
            return tables.specimen_table(self.keyed, extra=self._trip())
        narrow = self.cleaned.select(*self.keys, *self.order, *tables.SPECIMEN_COLUMNS)
        return tables.specimen_table(self._key(narrow), extra=self._trip())


def clean_hoop(
    export: DataFrame, sites: DataFrame | None = None, cfg: TripConfig | None = None,
    correct: Correction | None = None, earliest: datetime | Column | None = None,
    upper: list[str] = UPPER_HOOP,
) -> DataFrame:
    """Corrected hoop-net export with effort hours and the side taken from the site id.

    All corrections come first and the site list is joined once, which gives what joining,
    correcting and joining again does.
    """
    out = normalise(export, cfg, upper)
    out = out.withColumns({
        c: F.col(c).try_cast("double")
        for c in ("S_RIVER_MILE", "TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT")
    })
    if correct is not None:
        out = correct(out)
    if sites is not None:
        out = lookups.join_sites(out, sites, ["RiverSide"])
    if earliest is not None:
        out = out.withColumn(
            "S_START_DATE_TIME", times.repair_year(F.col("S_START_DATE_TIME"), earliest))
    return out.withColumns({
        "EFFORT_HOURS": times.hours_between(F.col("S_START_DATE_TIME"), F.col("S_END_DATE_TIME")),
        "S_SIDE": text.first_capitals(F.col("S_SITE_ID")),
        "START_DATE": times.iso_date(F.col("S_START_DATE_TIME")),
    })


class HoopTables(_Tables):
    """SAMPLE and SPECIMEN tables of a cleaned hoop-net export, planned when asked for.

    The catch of a net is that of its site. `key_by_site` numbers sites instead of lifts.
    `late_fixes` correct specimens after the catch has been counted, as blank species are;
    `keep_codes` lets unknown recapture codes through.
    """

    def __init__(self, cleaned: DataFrame, cfg: TripConfig, water: DataFrame | None = None,
                 key_by_site: bool | Column = False, with_hours: bool | Column = True,
                 keep_codes: bool | Column = False, late_fixes: DataFrame | None = None, store: bool = True,
                 many: bool = False, order: list[str] | None = None, flags: list[str] = (), only: str | None = None):
        self.water, self.with_hours = water, with_hours
        self.keep_codes, self.late_fixes, self.late_layout = keep_codes, late_fixes, None
        self.flags = list(flags)  # columns of settings that the tables still need
        self.order = order or (
            ["SAMPLE_ID", "S_END_DATE_TIME", "ID"] if key_by_site
            else ["START_DATE", "S_CLIPBOARD", "S_END_DATE_TIME", "ID"])
        net = codes.pick(key_by_site, F.col("S_SITE_ID"), boat_key())
        needs = {"sample": [*tables.sample_columns("hoop"), *self.flags],
                 "specimen": [*self.order, *tables.SPECIMEN_COLUMNS, *self.flags]}
        super().__init__(cleaned.withColumn(NET, net), cfg, NET, store, many, needs, only)

    @cached_property
    def nets(self) -> DataFrame:
        return self._number(self.cleaned.select(*self.keys).distinct(), [NET], "ACCESS_SAMPLE_ID", "samples_before")

    @cached_property
    def totals(self) -> DataFrame:
        return catch.total_catch(self.cleaned, ["S_TRIP_ID", "S_SITE_ID"])

    def _key(self, rows: DataFrame) -> DataFrame:
        numbered = self._number(rows, self.order, "ACCESS_FISH_ID", "specimens_before")
        return lookups.attach(numbered, self.nets, self.keys)

    @cached_property
    def keyed(self) -> DataFrame:
        keyed = self._key(self.cleaned)
        if self.late_fixes is not None:
            keyed = corrections.apply_corrections(
                keyed, self.late_fixes, self.late_layout, by=(TRIP,) if self.many else ())
        return keyed

    @cached_property
    def sample(self) -> DataFrame:
        rows = tables.hoop_samples(self.cleaned, [NET, *self.flags])
        rows = lookups.attach(rows, self.nets, self.keys)
        rows = lookups.attach(rows, self.totals, [TRIP, "S_SITE_ID"])
        made = tables.sample_table_hoop(rows, self.water, self.with_hours)
        return made.withColumn("trip", F.col("TRIP_ID")) if self.many else made

    @cached_property
    def specimen(self) -> DataFrame:
        keyed = self.__dict__.get("keyed")
        if keyed is None and self.late_fixes is None:
            columns = [*self.keys, *self.order, *tables.SPECIMEN_COLUMNS, *self.flags]
            keyed = self._key(self.cleaned.select(*columns))
        if keyed is None:
            keyed = self.keyed
        return tables.specimen_table(keyed, self.keep_codes, blanks=False, extra=self._trip())


# Columns of the 2019 tables.
LEGACY_SAMPLE = [
    "SAMPLE_TYPE", "SAMPLE_NOTES", "CLIPBOARD", "WATER_TEMP", "TURBIDITY_NTU",
    "DATASHEET_SAMPLE_ID", "START_RM", "GEAR_CODE", "TRIP_ID", "SIDE_CODE", "END_DATETIME",
    "START_DATETIME", "EF_TOTAL_SECONDS",
]
LEGACY_DROPS = ["SAMPLE_NOTES", "WATER_TEMP", "TURBIDITY_NTU", "TURBIDITY", "TOTAL_HOURS"]


class LegacyTables:
    """The 2019 format: no numeric keys, effort as mm:ss text in the set number."""

    def __init__(self, export: DataFrame):
        kept = export.filter(text.is_not(F.col("S_SAMPLE_NOTES"), "test"))
        f = kept.select(*[F.col(src).alias(new) for src, new, _ in schemas.LEGACY_EXPORT])
        code = F.col("RECAP_YES_NO")
        self.cleaned = f.withColumns({
            "PITTAG_RECAP": codes.tag_recap(code),
            "FINCLIP1_RECAP": codes.clip_recap(code),
            "START_DATETIME": times.parse_second(F.col("START_DATETIME")),
            "END_DATETIME": times.parse_second(F.col("END_DATETIME")),
            "EF_TOTAL_SECONDS": times.mmss_seconds(F.col("EL_SECONDS")),
            "START_RM": measures.round_half_even(F.col("START_RM"), 2),
            "DATASHEET_SAMPLE_ID": F.upper("DATASHEET_SAMPLE_ID"),
        }).drop("RECAP_YES_NO", "EL_SECONDS")
        self.sample = self.cleaned.select(*LEGACY_SAMPLE).distinct()
        self.specimen = self.cleaned.drop(*LEGACY_DROPS)


def write_trip(
    out, cfg: TripConfig, one_file: bool = False, missing: str = "", export_missing: str | None = "",
) -> None:
    """Both import tables, with missing values as `missing`, and the corrected export, with missing values as
    `export_missing`; none is written if that is None.

    `one_file` makes the single file per table that an import by hand needs; it is for one
    trip's worth of rows.
    """
    parts = {}
    if export_missing is not None:  # first: specimens are cut from it
        parts["_errorchecked.csv"] = out.keyed, export_missing
    parts |= {"_sample.csv": (out.sample, missing), "_specimen.csv": (out.specimen, missing)}
    for name, (df, marker) in parts.items():
        write_delimited(df, cfg.output_path(name), missing=marker, one_file=one_file)
