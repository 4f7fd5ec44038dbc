"""Whole jobs and file round trips: SAMPLE and SPECIMEN tables, the report, scans and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fieldcatch import schemas
from fieldcatch.config import TripConfig
from fieldcatch.functions import text
from fieldcatch.operators import catch, lookups
from fieldcatch.operators.corrections import apply_corrections
from fieldcatch.plans import report, trip
from fieldcatch.runtime import fresh_path
from fieldcatch.sources import files
from fieldcatch.workload.adapter import CORRECTIONS_LAYOUT, REPORT_SAMPLES, SPECIMEN_SIDE
from fieldcatch.workload.registry import query
from fieldcatch.workload.scalars import SQL_FISH

SPECIMEN_ID = SPECIMEN_SIDE["ID"]
_CFG = TripConfig("GC20210403", samples_before=175, specimens_before=1536)
_TAG = "CASE WHEN RECAP_YES_NO IN ('BY', 'PY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'FY') THEN 'N' {other} END"
_CLIP = "CASE WHEN RECAP_YES_NO IN ('BY', 'FY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'PY') THEN 'N' {other} END"
_SEX_COND = "CASE WHEN SEX = 'U' AND SEX_COND IN ('R', 'G') THEN 'N' ELSE SEX_COND END"
_CAUGHT = "cast(sum(CASE WHEN SPECIES = 'NFC' THEN 0 ELSE 1 END) AS bigint)"

# The electrofishing export after cleaning, with the visit key.
_EF = f"""
listed AS (SELECT S_SITE_ID, start_rm, lead(start_rm) OVER (PARTITION BY RiverSide ORDER BY site_seq) AS end_rm, RiverSide, reach
  FROM sites WHERE RiverSide IN ('L', 'R')),
u AS (SELECT e.* EXCLUDE (S_SITE_ID, S_CLIPBOARD, S_CREW, FISH_TAG, S_RM_START, S_RM_END, SEX_COND, S_TRIP_ID), 'GC20210403' AS S_TRIP_ID,
    upper(S_SITE_ID) AS S_SITE_ID, upper(S_CLIPBOARD) AS S_CLIPBOARD, upper(S_CREW) AS S_CREW, upper(FISH_TAG) AS FISH_TAG,
    {_SEX_COND} AS SEX_COND, S_EF_MINUTES * 60 + S_EF_SECONDS AS EF_TOTAL_SECONDS FROM export e),
d AS (SELECT u.*, l.start_rm AS S_RM_START, l.end_rm AS S_RM_END, l.RiverSide,
    concat(u.S_SITE_ID, ' ', strftime(S_START_DATE_TIME, '%Y-%m-%d %H:%M:%S')) AS visit,
    S_START_DATE_TIME + EF_TOTAL_SECONDS * INTERVAL '1' SECOND AS e_end
  FROM u LEFT JOIN listed l ON u.S_SITE_ID = l.S_SITE_ID),
v AS (SELECT visit, dense_rank() OVER (ORDER BY visit) + 175 AS ACCESS_SAMPLE_ID, {_CAUGHT} AS TOTAL_CATCH FROM d GROUP BY visit)
"""


def _sites(t):
    return trip.end_miles(t.sites.select("S_SITE_ID", "site_seq", "RiverSide", "start_rm", "reach"))


def _electrofishing(t, only):
    cleaned = trip.clean_electrofishing(t.export, _sites(t), _CFG)
    return trip.ElectrofishingTables(cleaned, _CFG, "RiverSide", t.water, only=only)


def _sample_sql(side: str, water: bool) -> str:
    return f"""SELECT DISTINCT v.ACCESS_SAMPLE_ID, S_SITE_ID AS DATASHEET_SAMPLE_ID, S_TRIP_ID AS TRIP_ID, S_SAMPLE_TYPE AS SAMPLE_TYPE,
  strftime(S_START_DATE_TIME, '%m/%d/%Y') AS START_DATE, strftime(S_START_DATE_TIME, '%H:%M') AS START_TIME,
  strftime(e_end, '%m/%d/%Y') AS END_DATE, strftime(e_end, '%H:%M') AS END_TIME,
  strftime(S_START_DATE_TIME, '%m/%d/%Y %H:%M:%S') AS START_DATETIME, strftime(e_end, '%m/%d/%Y %H:%M:%S') AS END_DATETIME,
  'COR' AS RIVER_CODE, {side} AS SIDE_CODE, S_RM_START AS START_RM, S_RM_END AS END_RM, concat('S', S_SITE_ID) AS STATION_ID,
  S_SITE_ID AS GPS_START_WAYPOINT, S_CREW AS CREW, S_CLIPBOARD AS CLIPBOARD, 'EL' AS GEAR_CODE, v.TOTAL_CATCH, S_EF_AMPS AS EF_AMPS,
  S_EF_VOLTS AS EF_VOLTS, EF_TOTAL_SECONDS, S_HABITAT AS HABITAT_CODE, S_HYDRAULIC AS HYDRAULIC_CODE, S_SUBSTRATE AS SUBSTRATE_CODE,
  S_COVER AS COVER_CODE, 'L' AS TURBIDITY, coalesce(S_SAMPLE_NOTES, '') AS SAMPLE_NOTES{', w.TURBIDITY_NTU, w.WATER_TEMP' if water else ''}
FROM d JOIN v USING (visit){" LEFT JOIN water w ON w.START_DATE = strftime(S_START_DATE_TIME, '%Y-%m-%d')" if water else ''}"""


@query("sample_table_ef", f"WITH {_EF} {_sample_sql('RiverSide', True)}")
def _(t):
    return _electrofishing(t, "sample").sample


_SPECIMEN = f"""SELECT row_number() OVER (ORDER BY SAMPLE_ID, S_START_DATE_TIME, ID, S_RM_START, S_RM_END) + 1536 AS ACCESS_FISH_ID,
  v.ACCESS_SAMPLE_ID, SPECIES AS SPECIES_CODE, TOTAL_LENGTH, FORK_LENGTH, WEIGHT, coalesce(SEX, '') AS SEX_CODE,
  coalesce(SEX_COND, '') AS SEX_COND_CODE, coalesce(SEX_CHAR, '') AS SEX_CHAR_CODE, coalesce({_CLIP.format(other='')}, '') AS FINCLIP1_RECAP,
  coalesce(FINCLIP1, '') AS FINCLIP1, coalesce({_TAG.format(other='')}, '') AS PITTAG_RECAP, coalesce(FISH_TAG, '') AS PITTAG,
  coalesce(DISPOSITION, '') AS DISPOSITION_CODE, coalesce(SPECIMEN_NOTES, '') AS SPECIMEN_NOTES FROM d JOIN v USING (visit)"""


@query("specimen_table", f"WITH {_EF} {_SPECIMEN}")
def _(t):
    return _electrofishing(t, "specimen").specimen


# The reach with a slough: recoded sample types, notes and backfilled miles, no water table.
_LF = f"""
listed AS (SELECT DISTINCT S_SITE_ID, side, rm_start, rm_end FROM sites WHERE type = 'monitoring'),
u AS (SELECT e.* EXCLUDE (S_SITE_ID, S_CLIPBOARD, S_CREW, FISH_TAG, S_RM_START, S_RM_END, S_SIDE, SEX_COND, S_TRIP_ID, S_SAMPLE_TYPE, S_SAMPLE_NOTES),
    'GC20210403' AS S_TRIP_ID, upper(S_SITE_ID) AS S_SITE_ID, upper(S_CLIPBOARD) AS S_CLIPBOARD, upper(S_CREW) AS S_CREW,
    upper(FISH_TAG) AS FISH_TAG, {_SEX_COND} AS SEX_COND, S_SIDE AS own_side, S_EF_MINUTES * 60 + S_EF_SECONDS AS EF_TOTAL_SECONDS,
    CASE WHEN S_START_DATE_TIME < TIMESTAMP '1998-03-08 22:15:00' THEN 97 WHEN S_START_DATE_TIME > TIMESTAMP '1998-03-08 22:15:00' THEN 96 END AS S_SAMPLE_TYPE,
    CASE WHEN S_START_DATE_TIME < TIMESTAMP '1998-03-08 22:15:00' AND S_SAMPLE_NOTES = '' THEN 'rate set too low' ELSE S_SAMPLE_NOTES END AS S_SAMPLE_NOTES
  FROM export e),
d AS (SELECT u.*, coalesce(rm_start, CASE WHEN contains(u.S_SITE_ID, 'SLOUGH') THEN cast(-12.15 AS double) END) AS S_RM_START,
    coalesce(rm_end, CASE WHEN contains(u.S_SITE_ID, 'SLOUGH') THEN cast(-12.15 AS double) END) AS S_RM_END,
    CASE WHEN own_side <> '' THEN own_side WHEN side <> '' THEN side WHEN own_side IS NULL AND contains(u.S_SITE_ID, 'SLOUGH') THEN 'L' END AS S_SIDE,
    concat(u.S_SITE_ID, ' ', strftime(S_START_DATE_TIME, '%Y-%m-%d %H:%M:%S')) AS visit,
    S_START_DATE_TIME + EF_TOTAL_SECONDS * INTERVAL '1' SECOND AS e_end
  FROM u LEFT JOIN listed l ON u.S_SITE_ID = l.S_SITE_ID),
v AS (SELECT visit, dense_rank() OVER (ORDER BY visit) + 175 AS ACCESS_SAMPLE_ID, {_CAUGHT} AS TOTAL_CATCH FROM d GROUP BY visit)
"""


@query("sample_table_backfilled", f"WITH {_LF} {_sample_sql('S_SIDE', False)}")
def _(t):
    cleaned = trip.clean_backfilled(
        t.export, t.sites, _CFG, cutoff=datetime(1998, 3, 8, 22, 15), early_note="rate set too low")
    return trip.ElectrofishingTables(cleaned, _CFG, "S_SIDE", only="sample").sample


# Hoop nets.
_HOOP = f"""
u AS (SELECT e.* EXCLUDE (S_SITE_ID, S_CLIPBOARD, S_CREW, FISH_TAG, S_GPS_ID, S_START_DATE_TIME), upper(S_SITE_ID) AS S_SITE_ID,
    upper(S_CLIPBOARD) AS S_CLIPBOARD, upper(S_CREW) AS S_CREW, upper(FISH_TAG) AS FISH_TAG, upper(S_GPS_ID) AS S_GPS_ID,
    CASE WHEN S_START_DATE_TIME < TIMESTAMP '1996-01-01 01:01:01' THEN S_START_DATE_TIME + INTERVAL '366' DAY ELSE S_START_DATE_TIME END AS S_START_DATE_TIME
  FROM export e),
d AS (SELECT u.*, strftime(S_START_DATE_TIME, '%Y-%m-%d') AS day, concat(strftime(S_START_DATE_TIME, '%Y-%m-%d'), ' ', S_CLIPBOARD, ' ',
    strftime(S_END_DATE_TIME, '%Y-%m-%d %H:%M:%S')) AS net FROM u),
v AS (SELECT net, dense_rank() OVER (ORDER BY net) + 267 AS ACCESS_SAMPLE_ID FROM d GROUP BY net),
c AS (SELECT S_SITE_ID, {_CAUGHT} AS TOTAL_CATCH FROM d GROUP BY 1)
"""
_HOOP_CFG = TripConfig("GC20200621", samples_before=267, specimens_before=2686)


def _hoop(t, **options):
    cleaned = trip.clean_hoop(t.export, cfg=_HOOP_CFG, earliest=datetime(1996, 1, 1, 1, 1, 1))
    return trip.HoopTables(cleaned, _HOOP_CFG, t.water, **options)


@query("sample_table_hoop", f"""WITH {_HOOP}
SELECT DISTINCT v.ACCESS_SAMPLE_ID, S_SITE_ID AS DATASHEET_SAMPLE_ID, 'GC20200621' AS TRIP_ID, S_SAMPLE_TYPE AS SAMPLE_TYPE,
  strftime(S_START_DATE_TIME, '%m/%d/%Y') AS START_DATE, strftime(S_START_DATE_TIME, '%H:%M') AS START_TIME,
  strftime(S_END_DATE_TIME, '%m/%d/%Y') AS END_DATE, CASE WHEN S_GEAR = 'MHB' THEN strftime(S_END_DATE_TIME, '%H:%M') WHEN S_GEAR = 'EL' THEN '' END AS END_TIME,
  S_START_DATE_TIME AS START_DATETIME, S_END_DATE_TIME AS END_DATETIME,
  round_even(date_diff('second', S_START_DATE_TIME, S_END_DATE_TIME) / 3600.0, 2) AS TOTAL_HOURS, 'COR' AS RIVER_CODE,
  nullif(regexp_extract(S_SITE_ID, '[A-Z]+'), '') AS SIDE_CODE, S_RIVER_MILE AS START_RM, S_GPS_ID AS STATION_ID, S_CREW AS CREW,
  S_CLIPBOARD AS CLIPBOARD, S_GEAR AS GEAR_CODE, TOTAL_CATCH, S_HABITAT AS HABITAT_CODE, S_HYDRAULIC AS HYDRAULIC_CODE,
  S_SUBSTRATE AS SUBSTRATE_CODE, S_COVER AS COVER_CODE, S_SAMPLE_NOTES AS SAMPLE_NOTES, w.TURBIDITY_NTU, w.WATER_TEMP
FROM d JOIN v USING (net) JOIN c USING (S_SITE_ID) LEFT JOIN water w ON w.START_DATE = day""")
def _(t):
    return _hoop(t, only="sample").sample


@query("specimen_table_hoop", f"""WITH {_HOOP}
SELECT row_number() OVER (ORDER BY day, S_CLIPBOARD, S_END_DATE_TIME, ID) + 2686 AS ACCESS_FISH_ID, v.ACCESS_SAMPLE_ID, SPECIES AS SPECIES_CODE,
  cast(TOTAL_LENGTH AS double) AS TOTAL_LENGTH, cast(FORK_LENGTH AS double) AS FORK_LENGTH, cast(WEIGHT AS double) AS WEIGHT, SEX AS SEX_CODE,
  SEX_COND AS SEX_COND_CODE, SEX_CHAR AS SEX_CHAR_CODE, {_CLIP.format(other='ELSE RECAP_YES_NO')} AS FINCLIP1_RECAP, coalesce(FINCLIP1, '') AS FINCLIP1,
  {_TAG.format(other='ELSE RECAP_YES_NO')} AS PITTAG_RECAP, FISH_TAG AS PITTAG, DISPOSITION AS DISPOSITION_CODE, SPECIMEN_NOTES
FROM d JOIN v USING (net)""")
def _(t):
    return _hoop(t, keep_codes=True, only="specimen").specimen


# The 2019 format.
_LEGACY = f"""f AS (SELECT ID AS ACCESS_FISH_ID, FISH_TAG AS PITTAG, S_SAMPLE_TYPE AS SAMPLE_TYPE, S_SAMPLE_NOTES AS SAMPLE_NOTES, SPECIMEN_NOTES,
  S_CLIPBOARD AS CLIPBOARD, S_TEMPERATURE AS WATER_TEMP, S_TURBIDITY_NTU AS TURBIDITY_NTU, upper(S_SITE_ID) AS DATASHEET_SAMPLE_ID,
  round_even(cast(S_RIVER_MILE AS double), 2) AS START_RM, S_SIDE AS SIDE_CODE, S_GEAR AS GEAR_CODE, S_TRIP_ID AS TRIP_ID,
  try_strptime(regexp_extract(S_END_DATE_TIME, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}} \\d{{1,2}}:\\d{{2}}:\\d{{2}}'), '%m/%d/%Y %H:%M:%S') AS END_DATETIME,
  try_strptime(regexp_extract(S_START_DATE_TIME, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}} \\d{{1,2}}:\\d{{2}}:\\d{{2}}'), '%m/%d/%Y %H:%M:%S') AS START_DATETIME,
  WEIGHT, FORK_LENGTH, SEX_CHAR AS SEX_CHAR_CODE, SEX_COND AS SEX_COND_CODE, DISPOSITION AS DISPOSITION_CODE, SEX AS SEX_CODE, TOTAL_LENGTH,
  SPECIES AS SPECIES_CODE, {_TAG.format(other='')} AS PITTAG_RECAP, {_CLIP.format(other='')} AS FINCLIP1_RECAP,
  CASE WHEN cast(split_part(S_SET_NUM, ':', 1) AS integer) <= 59
    THEN cast(split_part(S_SET_NUM, ':', 1) AS integer) * 60 + cast(split_part(S_SET_NUM, ':', 2) AS integer) END AS EF_TOTAL_SECONDS
  FROM raw_export WHERE S_SAMPLE_NOTES IS DISTINCT FROM 'test')"""


def _legacy(t):
    raw = t.raw_export.withColumnRenamed("ID", "SPECIMEN_ID")
    return trip.LegacyTables(raw.withColumn("S_RIVER_MILE", F.col("S_RIVER_MILE").try_cast("double")))


@query("legacy_split", f"""WITH {_LEGACY} SELECT DISTINCT SAMPLE_TYPE, SAMPLE_NOTES, CLIPBOARD, WATER_TEMP, TURBIDITY_NTU, DATASHEET_SAMPLE_ID,
  START_RM, GEAR_CODE, TRIP_ID, SIDE_CODE, END_DATETIME, START_DATETIME, EF_TOTAL_SECONDS FROM f""")
def _(t):
    return _legacy(t).sample


@query("legacy_split_fish", f"WITH {_LEGACY} SELECT * EXCLUDE (SAMPLE_NOTES, WATER_TEMP, TURBIDITY_NTU) FROM f")
def _(t):
    return _legacy(t).specimen


# Report --------------------------------------------------------------------------------------

_WIDE = f"""{SQL_FISH},
counts AS (SELECT ACCESS_SAMPLE_ID, count(*) FILTER (WHERE SPECIES_CODE = 'BNT') AS BNT, count(*) FILTER (WHERE SPECIES_CODE = 'RBT') AS RBT,
  {', '.join(f"count(*) FILTER (WHERE grp = '{g}') AS " + chr(34) + n + chr(34) for g, n in report.GROUP_NAMES.items())}
  FROM fish GROUP BY 1),
wide AS (SELECT s.*, counts.* EXCLUDE (ACCESS_SAMPLE_ID), nullif(s.EF_TOTAL_SECONDS, 0) / cast(60 AS double) AS minutes
  FROM report_samples s JOIN counts ON s.ACCESS_SAMPLE_ID = counts.ACCESS_SAMPLE_ID)"""
_LONG = " UNION ALL ".join(
    f"""SELECT ACCESS_SAMPLE_ID, '{c}' AS SPECIES_CODE, "{c}" AS n, "{c}" / minutes AS CPUE FROM wide WHERE SAMPLE_TYPE = 96"""
    for c in report.SUMMARY_COLUMNS)


def _report(t):
    return report.trip_report(t.report_samples, t.report_fish)


@query("species_crosstab", """
SELECT ACCESS_SAMPLE_ID, count(*) FILTER (WHERE SPECIES_CODE = 'BNT') AS BNT, count(*) FILTER (WHERE SPECIES_CODE = 'CRP') AS CRP,
  count(*) FILTER (WHERE SPECIES_CODE = 'FHM') AS FHM, count(*) FILTER (WHERE SPECIES_CODE = 'HBC') AS HBC,
  count(*) FILTER (WHERE SPECIES_CODE = 'RBT') AS RBT, count(*) FILTER (WHERE SPECIES_CODE = '') AS blank FROM report_fish GROUP BY 1""")
def _(t):
    return catch.crosstab(t.report_fish, "SPECIES_CODE")


# A blank species pastes as the bare label of a missing size class.
_GROUPS = [*report.REPORT_GROUPS, "CRPNA", "FHMNA", "HBCNA", "NA"]


@query("group_crosstab", f"""WITH {SQL_FISH} SELECT ACCESS_SAMPLE_ID,
  {', '.join(f"count(*) FILTER (WHERE grp = '{g}' AND SPECIES_CODE IS NOT NULL) AS " + chr(34) + g + chr(34) for g in _GROUPS)} FROM fish GROUP BY 1""")
def _(t):
    return catch.crosstab(report.with_measures(t.report_fish), "group")


@query("cpue_by_species", f"WITH {_WIDE} SELECT ACCESS_SAMPLE_ID, round(BNT / minutes, 6) AS CPUE_BNT, round(RBT / minutes, 6) AS CPUE_RBT FROM wide")
def _(t):
    effort = catch.effort_minutes(t.report_samples)
    _, cpue = report.rates(t.report_fish, effort, "SPECIES_CODE", report.REPORT_SPECIES)
    return cpue.select("ACCESS_SAMPLE_ID", *[F.round(f"CPUE_{s}", 6).alias(f"CPUE_{s}") for s in report.REPORT_SPECIES])


@query("cpue_by_size_class", f"""WITH {_WIDE} SELECT ACCESS_SAMPLE_ID,
  {', '.join(f'round("{n}" / minutes, 6) AS "CPUE_{n}"' for n in report.GROUP_NAMES.values())} FROM wide""")
def _(t):
    fish, effort = report.with_measures(t.report_fish), catch.effort_minutes(t.report_samples)
    _, cpue = report.rates(fish, effort, "group", report.REPORT_GROUPS, report.GROUP_NAMES)
    return cpue.select("ACCESS_SAMPLE_ID", *[
        F.round(f"`CPUE_{n}`", 6).alias(f"CPUE_{n}") for n in report.GROUP_NAMES.values()])


@query("join_counts_inner", f"""WITH {_WIDE} SELECT ACCESS_SAMPLE_ID, DATASHEET_SAMPLE_ID, SAMPLE_TYPE, BNT, RBT, "RBT.152",
  round(RBT / minutes, 6) AS CPUE_RBT FROM wide""")
def _(t):
    wide = _report(t).samples
    return wide.select("ACCESS_SAMPLE_ID", "DATASHEET_SAMPLE_ID", "SAMPLE_TYPE", "BNT", "RBT", "`RBT.152`",
                       F.round("CPUE_RBT", 6).alias("CPUE_RBT"))


def _monitoring(t):
    return _report(t).samples.filter("SAMPLE_TYPE = 96")


@query("cpue_long", f"WITH {_WIDE}, long AS ({_LONG}) SELECT ACCESS_SAMPLE_ID, SPECIES_CODE, round(CPUE, 6) AS CPUE FROM long")
def _(t):
    long = catch.longer(_monitoring(t), ["ACCESS_SAMPLE_ID"], [f"CPUE_{c}" for c in report.SUMMARY_COLUMNS],
                        "SPECIES_CODE", "CPUE", strip="CPUE_")
    return long.withColumn("CPUE", F.round("CPUE", 6))


@query("counts_long", f"WITH {_WIDE}, long AS ({_LONG}) SELECT ACCESS_SAMPLE_ID, SPECIES_CODE, n FROM long")
def _(t):
    return _report(t).sample_sizes


def _signif_sql(x: str) -> str:
    e = f"(2 - floor(log10(abs({x}))))"
    return (f"CASE WHEN {x} = 0 THEN 0 WHEN {e} >= 0 THEN round_even({x} * pow(10, {e}), 0) / pow(10, {e}) "
            f"ELSE round_even({x} / pow(10, -{e}), 0) * pow(10, -{e}) END")


@query("cpue_summary", f"""WITH {_WIDE}, long AS ({_LONG}),
a AS (SELECT SPECIES_CODE, avg(CPUE) AS m, count(*) AS n_sites, stddev_samp(CPUE) AS sd FROM long GROUP BY 1),
b AS (SELECT SPECIES_CODE, {_signif_sql('m')} AS mean_cpue, n_sites, sd, cast(1.959963984540054 AS double) * sd / sqrt(n_sites) AS ci FROM a),
c AS (SELECT *, mean_cpue - ci AS lo, mean_cpue + ci AS hi FROM b),
d AS (SELECT *, {_signif_sql('lo')} AS lo3, {_signif_sql('hi')} AS hi3 FROM c)
SELECT SPECIES_CODE, round(mean_cpue, 9) AS mean_cpue, n_sites, round(sd, 6) AS stdev, round(ci, 6) AS ci_95,
  round(CASE WHEN lo3 < 0 THEN 0 ELSE lo3 END, 9) AS ci_low, round(hi3, 9) AS ci_high FROM d""")
def _(t):
    digits = {"mean_cpue": 9, "stdev": 6, "ci_95": 6, "ci_low": 9, "ci_high": 9}
    return _report(t).cpue.withColumns({c: F.round(c, n) for c, n in digits.items()})


_LOCATED = f"""{SQL_FISH}, located AS (SELECT f.*, s.DATASHEET_SAMPLE_ID, s.START_RM, strptime(s.START_DATETIME, '%m/%d/%Y %H:%M:%S') AS START_DATETIME, s.SAMPLE_TYPE
  FROM fish f LEFT JOIN report_samples s ON f.ACCESS_SAMPLE_ID = s.ACCESS_SAMPLE_ID WHERE SPECIES_CODE IS DISTINCT FROM 'NFC')"""


@query("specimen_with_sample", f"""WITH {_LOCATED} SELECT ACCESS_FISH_ID, SPECIES_CODE, DATASHEET_SAMPLE_ID, START_RM, START_DATETIME,
  cast(START_DATETIME AS date) AS START_DATE, SAMPLE_TYPE FROM located""")
def _(t):
    caught = t.report_fish.filter(text.is_not(F.col("SPECIES_CODE"), "NFC"))
    located = lookups.add_sample_columns(caught, report.with_times(t.report_samples), report.SAMPLE_COLUMNS)
    return located.select("ACCESS_FISH_ID", "SPECIES_CODE", *report.SAMPLE_COLUMNS)


@query("fish_counts", f"WITH {_LOCATED} SELECT SAMPLE_TYPE, SPECIES_CODE, count(*) AS n FROM located GROUP BY 1, 2")
def _(t):
    return _report(t).fish_counts


@query("total_fish", f"WITH {_LOCATED} SELECT count(*) AS total_fish FROM located")
def _(t):
    return _report(t).total_fish


@query("recaps", f"WITH {_LOCATED} SELECT SPECIES_CODE, PITTAG_RECAP, count(*) AS n FROM located GROUP BY 1, 2")
def _(t):
    return _report(t).recaps


@query("length_frequency", f"""WITH {SQL_FISH} SELECT CASE SPECIES_CODE WHEN 'RBT' THEN 'Rainbow Trout' ELSE 'Brown Trout' END AS species,
  cast(ceil((TL - 5) / 10) * 10 AS bigint) AS bin_centre, count(*) AS n FROM fish
  WHERE SPECIES_CODE IN ('RBT', 'BNT') AND TL IS NOT NULL GROUP BY 1, 2""")
def _(t):
    return _report(t).lengths


# Files ---------------------------------------------------------------------------------------

_FILE_COLUMNS = schemas.ELECTROFISHING_EXPORT
_FILE_NAMES = ", ".join(schemas.names(_FILE_COLUMNS))


def _written(df, label, **options):
    """Where `df` was written. An export with all its columns is several times the size of the tables it is made of, so
    it is compressed: each of its files is read by one task all the same."""
    options = {"compression": "lz4", **options}
    path = fresh_path(df.sparkSession, label)
    files.write_delimited(df, path, **options)
    return path


@query("scan_export", f"SELECT {_FILE_NAMES} FROM raw_export")
def _(t):
    path = _written(t.raw_export, "export", missing="NA", sep="\t")
    return files.scan_export(t.spark, path, _FILE_COLUMNS)


@query("scan_trips", """
SELECT S_TRIP_ID AS trip, count(*) AS n_rows, count(DISTINCT SAMPLE_ID) AS n_samples, sum(WEIGHT)::bigint AS total_weight FROM raw_export GROUP BY 1""")
def _(t):
    path = _written(t.raw_export.withColumn("trip", F.col("S_TRIP_ID")), "trips", missing="NA", sep="\t", partition_by=("trip",))
    rows = files.scan_trips(t.spark, f"{path}/trip=*", _FILE_COLUMNS)
    trip_id = F.regexp_extract("TRIP_FILE", "trip=([^/]+)/", 1)
    return rows.groupBy(trip_id.alias("trip")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("SAMPLE_ID").alias("n_samples"),
        F.sum("WEIGHT").cast("bigint").alias("total_weight"))


_CLIPPED = "cast(SAMPLE_ID as bigint) % 13"


def _with_odd_numbers(t):
    """The raw export with whole numbers typed in other ways and weights in fractions of a gram."""
    return t.raw_export.withColumns({
        "S_EF_MINUTES": F.expr(
            f"CASE {_CLIPPED} WHEN 0 THEN '12.5' WHEN 1 THEN 'x1' WHEN 2 THEN concat(cast(S_EF_MINUTES as string), '.0') "
            "ELSE cast(S_EF_MINUTES as string) END"),
        "WEIGHT": F.col("WEIGHT") / 8,
    })


@query("scan_export_decimals", f"""
SELECT ID, WEIGHT / 8 AS WEIGHT, CASE WHEN {_CLIPPED} IN (0, 1) THEN NULL ELSE S_EF_MINUTES END AS S_EF_MINUTES FROM raw_export""")
def _(t):
    path = _written(_with_odd_numbers(t), "export", missing="NA", sep="\t")
    return files.scan_export(t.spark, path, _FILE_COLUMNS).select("ID", "WEIGHT", "S_EF_MINUTES")


@query("scan_rejects", f"""
SELECT 'S_EF_MINUTES' AS "column", CASE {_CLIPPED} WHEN 0 THEN '12.5' ELSE 'x1' END AS value, count(*) AS n
FROM raw_export WHERE {_CLIPPED} IN (0, 1) GROUP BY 2""")
def _(t):
    path = _written(_with_odd_numbers(t), "export", missing="NA", sep="\t")
    return files.scan_rejects(t.spark, path, _FILE_COLUMNS)


_READR = ", ".join(f"nullif({n}, '') AS {n}" if k == "string" else n for n, k in _FILE_COLUMNS)


@query("scan_export_readr", f"SELECT {_READR} FROM raw_export")
def _(t):
    path = _written(t.raw_export, "export", missing="", sep="\t")
    return files.scan_export_readr(t.spark, path, _FILE_COLUMNS)


@query("scan_sites", "SELECT S_SITE_ID, start_rm, RiverSide, reach, site_seq FROM sites")
def _(t):
    raw = t.sites.select("SiteID", F.col("start_rm").alias("RiverMile_100ths"), "RiverSide", "reach",
                         F.col("site_seq").alias("id"))
    return files.scan_river_sites(t.spark, _written(raw, "sites"))


@query("scan_water", "SELECT START_DATE, TURBIDITY_NTU, WATER_TEMP FROM water")
def _(t):
    other = {new: old for old, new in schemas.WATER_ALIASES.items()}
    return files.scan_water(t.spark, _written(t.water.withColumnsRenamed(other), "water"))


@query("report_inputs", """
SELECT ACCESS_SAMPLE_ID, DATASHEET_SAMPLE_ID, START_RM, strptime(START_DATETIME, '%m/%d/%Y %H:%M:%S') AS START_DATETIME, SAMPLE_TYPE, EF_TOTAL_SECONDS,
  cast(strptime(START_DATETIME, '%m/%d/%Y %H:%M:%S') AS date) AS START_DATE,
  CASE WHEN START_RM > -15.31 AND START_RM <= -10.8 THEN '(-15.3,-10.8]'
  WHEN START_RM > -10.8 AND START_RM <= -4.0 THEN '(-10.8,-4]' WHEN START_RM > -4.0 AND START_RM <= -0.3 THEN '(-4,-0.3]' END AS reach FROM report_samples""")
def _(t):
    kinds = dict(t.report_samples.dtypes)
    path = _written(t.report_samples, "report")
    scanned = files.scan_export(t.spark, path, [(n, kinds[n]) for n in REPORT_SAMPLES], sep=",")
    return report.with_times(scanned)


@query("report_fish_inputs", "SELECT * FROM report_fish")
def _(t):
    kinds = {**dict(schemas.SPECIMEN), "ACCESS_FISH_ID": "string"}
    path = _written(t.report_fish, "report", missing="NA")
    return files.scan_export(t.spark, path, [(n, kinds[n]) for n in t.report_fish.columns], sep=",")


_SINK = ["ID", "SAMPLE_ID", "SPECIES", "SEX_COND", "SPECIMEN_NOTES", "FISH_TAG", "TOTAL_LENGTH", "S_RM_START"]
_SINK_SCHEMA = [(n, {"TOTAL_LENGTH": "double", "S_RM_START": "double"}.get(n, "string")) for n in _SINK]
_SINK_BLANK = ", ".join(f"coalesce({n}, '') AS {n}" if k == "string" else n for n, k in _SINK_SCHEMA)


@query("sink_roundtrip", f"SELECT {_SINK_BLANK} FROM export")
def _(t):
    path = _written(t.export.select(*_SINK), "sink", missing="")
    return files.scan_export(t.spark, path, _SINK_SCHEMA, sep=",")


@query("sink_roundtrip_na", f"SELECT {', '.join(_SINK)} FROM export")
def _(t):
    path = _written(t.export.select(*_SINK), "sink", missing="NA")
    return files.scan_export(t.spark, path, _SINK_SCHEMA, sep=",")


@query("sink_roundtrip_tsv", f"SELECT {', '.join(_SINK)} FROM export")
def _(t):
    path = _written(t.export.select(*_SINK), "sink", missing="NA", sep="\t")
    return files.scan_export(t.spark, path, _SINK_SCHEMA)


@query("sink_roundtrip_multiline", """
SELECT ID, concat('line one', chr(10), 'line "two"', chr(9), ID, chr(10)) AS SPECIMEN_NOTES, TOTAL_LENGTH FROM export""")
def _(t):
    note = F.concat(F.lit('line one\nline "two"\t'), F.col("ID"), F.lit("\n"))
    path = _written(t.export.select("ID", note.alias("SPECIMEN_NOTES"), "TOTAL_LENGTH"), "sink", missing="NA", sep="\t")
    columns = [("ID", "string"), ("SPECIMEN_NOTES", "string"), ("TOTAL_LENGTH", "double")]
    return files.scan_export(t.spark, path, columns)


@query("cleaned_export", f"""WITH fix AS (SELECT key_value, "column" AS col, min(new_value) AS v, round FROM corrections GROUP BY ALL),
listed AS (SELECT S_SITE_ID, start_rm, lead(start_rm) OVER (PARTITION BY RiverSide ORDER BY site_seq) AS end_rm, RiverSide
  FROM sites WHERE RiverSide IN ('L', 'R')),
x AS (SELECT e.ID, coalesce(s.v, upper(e.S_SITE_ID)) AS S_SITE_ID, upper(e.FISH_TAG) AS FISH_TAG, e.SPECIES,
    CASE WHEN tl.key_value IS NOT NULL THEN try_cast(tl.v AS double) ELSE e.TOTAL_LENGTH END AS TOTAL_LENGTH,
    CASE WHEN w.key_value IS NOT NULL THEN try_cast(w.v AS double) ELSE e.WEIGHT END AS WEIGHT,
    coalesce(n.v, e.S_SAMPLE_NOTES) AS S_SAMPLE_NOTES, S_EF_MINUTES * 60 + S_EF_SECONDS AS EF_TOTAL_SECONDS,
    {_SEX_COND} AS SEX_COND, {_TAG.format(other='')} AS PITTAG_RECAP
  FROM export e LEFT JOIN fix s ON s.col = 'S_SITE_ID' AND s.key_value = e.SAMPLE_ID
  LEFT JOIN fix n ON n.col = 'S_SAMPLE_NOTES' AND n.key_value = e.SAMPLE_ID
  LEFT JOIN fix tl ON tl.col = 'TOTAL_LENGTH' AND tl.key_value = e.ID LEFT JOIN fix w ON w.col = 'WEIGHT' AND w.key_value = e.ID)
SELECT x.ID, x.S_SITE_ID, coalesce(FISH_TAG, '') AS FISH_TAG, coalesce(SPECIES, '') AS SPECIES, TOTAL_LENGTH, WEIGHT,
  coalesce(S_SAMPLE_NOTES, '') AS S_SAMPLE_NOTES, EF_TOTAL_SECONDS, coalesce(SEX_COND, '') AS SEX_COND, coalesce(PITTAG_RECAP, '') AS PITTAG_RECAP,
  l.start_rm AS S_RM_START, l.end_rm AS S_RM_END FROM x LEFT JOIN listed l ON x.S_SITE_ID = l.S_SITE_ID""")
def _(t):
    cleaned = trip.clean_electrofishing(
        t.export, _sites(t), _CFG, lambda d: apply_corrections(d, t.corrections, CORRECTIONS_LAYOUT))
    shown = [("ID", "string"), ("S_SITE_ID", "string"), ("FISH_TAG", "string"), ("SPECIES", "string"),
             ("TOTAL_LENGTH", "double"), ("WEIGHT", "double"), ("S_SAMPLE_NOTES", "string"), ("EF_TOTAL_SECONDS", "int"),
             ("SEX_COND", "string"), ("PITTAG_RECAP", "string"), ("S_RM_START", "double"), ("S_RM_END", "double")]
    path = _written(cleaned, "cleaned", missing="")
    return files.scan_export(t.spark, path, shown, sep=",")
