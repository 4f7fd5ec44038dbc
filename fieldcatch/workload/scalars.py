"""Scalar functions, recodes and corrections over every specimen."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions import codes, measures, text, times
from fieldcatch.operators import columns, corrections
from fieldcatch.plans import field, report, trip
from fieldcatch.workload.adapter import CORRECTIONS_LAYOUT
from fieldcatch.workload.registry import query

START, END, SITE = "S_START_DATE_TIME", "S_END_DATE_TIME", "S_SITE_ID"
CUTOFF = datetime(1998, 3, 8, 22, 15)
FIRST_NIGHT = date(1995, 1, 1)

_HOURS = "date_diff('second', S_START_DATE_TIME, S_END_DATE_TIME) / 3600.0"
_NIGHT = """CASE WHEN hour({ts}) > 6 THEN date_diff('day', DATE '1995-01-01', cast({ts} AS date)) + 1
                WHEN hour({ts}) < 6 THEN date_diff('day', DATE '1995-01-01', cast({ts} AS date)) END"""


@query("clean_site_id", "SELECT site_seq, replace(SiteID, '_', '') AS S_SITE_ID, start_rm, RiverSide, reach FROM sites")
def _(t):
    return t.sites.select(
        "site_seq", text.without(F.col("SiteID"), "_").alias("S_SITE_ID"), "start_rm", "RiverSide", "reach")


@query("extract_side", "SELECT ID, upper(S_SITE_ID) AS S_SITE_ID, nullif(regexp_extract(upper(S_SITE_ID), '[A-Z]+'), '') AS S_SIDE FROM export")
def _(t):
    out = text.upper_columns(t.export, ["S_SITE_ID"])
    return out.select("ID", "S_SITE_ID", text.first_capitals(F.col(SITE)).alias("S_SIDE"))


@query("site_visit_key", """
SELECT ID, concat(coalesce(S_SITE_ID, 'NA'), ' ', coalesce(strftime(S_START_DATE_TIME, '%Y-%m-%d %H:%M:%S'), 'NA')) AS S_SITE_ID_2,
       concat(coalesce(SPECIES, 'NA'), coalesce(SEX_COND, 'NA')) AS label FROM export""")
def _(t):
    return t.export.select(
        "ID", trip.visit_key().alias("S_SITE_ID_2"),
        text.paste(F.col("SPECIES"), F.col("SEX_COND"), sep="").alias("label"))


@query("split_datetime", """
SELECT ID, strftime(S_START_DATE_TIME, '%Y-%m-%d') AS START_DATE, strftime(S_START_DATE_TIME, '%H:%M') AS START_TIME,
       strftime(S_END_DATE_TIME, '%Y-%m-%d') AS END_DATE, strftime(S_END_DATE_TIME, '%H:%M') AS END_TIME FROM export""")
def _(t):
    return t.export.select(
        "ID", times.iso_date(F.col(START)).alias("START_DATE"), times.clock(F.col(START)).alias("START_TIME"),
        times.iso_date(F.col(END)).alias("END_DATE"), times.clock(F.col(END)).alias("END_TIME"))


@query("cast_measurements", """
SELECT ID, try_cast(S_RIVER_MILE AS double) AS S_RIVER_MILE, try_cast(FISH_TAG_READER_NUM AS integer) AS reader,
       try_cast(RECAP_YES_NO AS double) AS not_a_number, cast(WEIGHT AS varchar) AS weight_text, cast(WEIGHT AS double) AS WEIGHT
FROM raw_export""")
def _(t):
    return t.raw_export.select(
        "ID", F.col("S_RIVER_MILE").try_cast("double").alias("S_RIVER_MILE"),
        F.col("FISH_TAG_READER_NUM").try_cast("int").alias("reader"),
        F.col("RECAP_YES_NO").try_cast("double").alias("not_a_number"),
        F.col("WEIGHT").cast("string").alias("weight_text"), F.col("WEIGHT").cast("double").alias("WEIGHT"))


@query("recap_decode", """
SELECT ID, CASE WHEN RECAP_YES_NO IN ('BY', 'PY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'FY') THEN 'N' END AS PITTAG_RECAP,
       CASE WHEN RECAP_YES_NO IN ('BY', 'FY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'PY') THEN 'N' END AS FINCLIP1_RECAP FROM export""")
def _(t):
    code = F.col("RECAP_YES_NO")
    return t.export.select(
        "ID", codes.tag_recap(code).alias("PITTAG_RECAP"), codes.clip_recap(code).alias("FINCLIP1_RECAP"))


@query("recap_decode_passthrough", """
SELECT ID, CASE WHEN RECAP_YES_NO IN ('BY', 'PY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'FY') THEN 'N' ELSE RECAP_YES_NO END AS PITTAG_RECAP,
       CASE WHEN RECAP_YES_NO IN ('BY', 'FY') THEN 'Y' WHEN RECAP_YES_NO IN ('BN', 'PY') THEN 'N' ELSE RECAP_YES_NO END AS FINCLIP1_RECAP,
       coalesce(FINCLIP1, '') AS FINCLIP1 FROM export""")
def _(t):
    code = F.col("RECAP_YES_NO")
    return t.export.select(
        "ID", codes.tag_recap_or_code(code).alias("PITTAG_RECAP"),
        codes.clip_recap_or_code(code).alias("FINCLIP1_RECAP"),
        F.coalesce("FINCLIP1", F.lit("")).alias("FINCLIP1"))


@query("fill_blank", """
SELECT ID, coalesce(SEX_COND, '') AS SEX_COND, coalesce(SEX_CHAR, '') AS SEX_CHAR, coalesce(FISH_TAG, '') AS FISH_TAG,
       TOTAL_LENGTH FROM export""")
def _(t):
    cols = ["SEX_COND", "SEX_CHAR", "FISH_TAG"]
    return text.fill_blank(t.export.select("ID", *cols, "TOTAL_LENGTH"), cols)


@query("parse_datetime", r"""
SELECT ID, try_strptime(regexp_extract(S_START_DATE_TIME, '^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}'), '%m/%d/%Y %H:%M') AS started,
       try_strptime(regexp_extract(FISH_TAG_READER_TIME, '^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}'), '%m/%d/%Y %H:%M:%S') AS tag_read
FROM raw_export""")
def _(t):
    return t.raw_export.select(
        "ID", times.parse_minute(F.col(START)).alias("started"),
        times.parse_second(F.col("FISH_TAG_READER_TIME")).alias("tag_read"))


@query("us_date_format", """
SELECT ID, strftime(S_START_DATE_TIME, '%m/%d/%Y') AS START_DATE, strftime(S_START_DATE_TIME, '%m/%d/%Y %H:%M:%S') AS START_DATETIME FROM export""")
def _(t):
    return t.export.select(
        "ID", times.us_date(F.col(START)).alias("START_DATE"), times.us_datetime(F.col(START)).alias("START_DATETIME"))


@query("effort_hours", f"SELECT ID, round({_HOURS}, 6) AS EFFORT_HOURS FROM export")
def _(t):
    return t.export.select("ID", F.round(times.hours_between(F.col(START), F.col(END)), 6).alias("EFFORT_HOURS"))


@query("end_datetime", """
SELECT ID, S_START_DATE_TIME + (S_EF_MINUTES * 60 + S_EF_SECONDS) * INTERVAL '1' SECOND AS END_DATETIME FROM export""")
def _(t):
    seconds = times.effort_seconds(F.col("S_EF_MINUTES"), F.col("S_EF_SECONDS"))
    return t.export.select("ID", times.plus_seconds(F.col(START), seconds).alias("END_DATETIME"))


@query("ef_total_seconds", "SELECT ID, S_EF_MINUTES * 60 + S_EF_SECONDS AS EF_TOTAL_SECONDS FROM export")
def _(t):
    seconds = times.effort_seconds(F.col("S_EF_MINUTES"), F.col("S_EF_SECONDS"))
    return t.export.select("ID", seconds.alias("EF_TOTAL_SECONDS"))


@query("mmss_to_seconds", r"""
SELECT ID, S_SET_NUM, CASE WHEN cast(split_part(S_SET_NUM, ':', 1) AS integer) <= 59
  THEN cast(split_part(S_SET_NUM, ':', 1) AS integer) * 60 + cast(split_part(S_SET_NUM, ':', 2) AS integer) END AS EF_TOTAL_SECONDS
FROM export""")
def _(t):
    return t.export.select(
        "ID", "S_SET_NUM", times.mmss_seconds(F.col("S_SET_NUM")).alias("EF_TOTAL_SECONDS"))


@query("sampling_night", f"""
SELECT ID, cast({_NIGHT.format(ts='S_START_DATE_TIME')} AS integer) AS S_night,
       try_cast(concat(substr(S_TRIP_ID, 3, 4), '-', substr(S_TRIP_ID, 7, 2), '-', substr(S_TRIP_ID, 9, 2)) AS date) AS trip_start
FROM export""")
def _(t):
    return t.export.select(
        "ID", times.sampling_night(F.col(START), F.lit(FIRST_NIGHT)).alias("S_night"),
        times.trip_date(F.col("S_TRIP_ID")).alias("trip_start"))


@query("sample_type_cutoff", """
SELECT ID, CASE WHEN S_START_DATE_TIME < TIMESTAMP '1998-03-08 22:15:00' THEN 97
                WHEN S_START_DATE_TIME > TIMESTAMP '1998-03-08 22:15:00' THEN 96 END AS S_SAMPLE_TYPE FROM export""")
def _(t):
    return t.export.select("ID", times.type_by_cutoff(
        F.col(START), CUTOFF, config.SUPPLEMENTAL, config.MONITORING).alias("S_SAMPLE_TYPE"))


@query("year_repair", """
SELECT ID, CASE WHEN S_START_DATE_TIME < TIMESTAMP '1996-01-01 01:01:01' THEN S_START_DATE_TIME + INTERVAL '366' DAY
                ELSE S_START_DATE_TIME END AS S_START_DATE_TIME FROM export""")
def _(t):
    return t.export.select("ID", times.repair_year(
        F.col(START), datetime(1996, 1, 1, 1, 1, 1)).alias("S_START_DATE_TIME"))


@query("round_half_even", f"""
SELECT ID, round_even(TOTAL_LENGTH / 2.0, 0) AS half_length, round_even(WEIGHT / 8.0, 2) AS eighth_weight,
       round_even({_HOURS}, 2) AS TOTAL_HOURS FROM export""")
def _(t):
    return t.export.select(
        "ID", measures.round_half_even(F.col("TOTAL_LENGTH") / 2.0).alias("half_length"),
        measures.round_half_even(F.col("WEIGHT") / 8.0, 2).alias("eighth_weight"),
        measures.round_half_even(times.hours_between(F.col(START), F.col(END)), 2).alias("TOTAL_HOURS"))


@query("signif3", """
WITH r AS (SELECT ID, WEIGHT / cast(FORK_LENGTH AS double) AS ratio, cast(WEIGHT * 37 AS double) AS large, -WEIGHT / cast(100000 AS double) AS small FROM export),
e AS (SELECT *, 2 - floor(log10(abs(ratio))) AS er, 2 - floor(log10(abs(large))) AS el, 2 - floor(log10(abs(small))) AS es FROM r)
SELECT ID, round_even(ratio * pow(10, er), 0) / pow(10, er) AS ratio3,
       CASE WHEN el >= 0 THEN round_even(large * pow(10, el), 0) / pow(10, el) ELSE round_even(large / pow(10, -el), 0) * pow(10, -el) END AS large3,
       round_even(small * pow(10, es), 0) / pow(10, es) AS small3 FROM e""")
def _(t):
    w = F.col("WEIGHT").cast("double")
    return t.export.select(
        "ID", measures.significant(w / F.col("FORK_LENGTH")).alias("ratio3"),
        measures.significant(w * 37).alias("large3"), measures.significant(-w / 100000.0).alias("small3"))


SQL_TL = """CASE WHEN TOTAL_LENGTH IS NOT NULL THEN cast(TOTAL_LENGTH AS double)
  WHEN SPECIES_CODE = 'BNT' THEN round_even(cast(8.211 AS double) + cast(1.024 AS double) * FORK_LENGTH, 0)
  WHEN SPECIES_CODE = 'RBT' THEN round_even(cast(1.9557129 AS double) + cast(1.0643074 AS double) * FORK_LENGTH, 0)
  WHEN SPECIES_CODE = 'CRP' THEN round_even(cast(6.266 AS double) + cast(1.1 AS double) * FORK_LENGTH, 0) END"""
SQL_CLASS = """CASE WHEN SPECIES_CODE = 'BNT' THEN CASE WHEN TL > 0 AND TL <= 200 THEN '<200' WHEN TL > 200 AND TL <= 350 THEN '200-350' WHEN TL > 350 THEN '>350' END
  WHEN SPECIES_CODE = 'RBT' THEN CASE WHEN TL > 0 AND TL <= 151 THEN '<152' WHEN TL > 151 AND TL <= 305 THEN '152-305' WHEN TL > 305 AND TL <= 405 THEN '306-405' WHEN TL > 405 THEN '>405' END END"""
SQL_FISH = f"""fish AS (SELECT *, concat(SPECIES_CODE, coalesce(size_class, 'NA')) AS grp FROM
  (SELECT *, {SQL_CLASS} AS size_class FROM (SELECT *, {SQL_TL} AS TL FROM report_fish)))"""


@query("impute_total_length", f"WITH {SQL_FISH} SELECT ACCESS_FISH_ID, SPECIES_CODE, TL FROM fish")
def _(t):
    return report.with_measures(t.report_fish).select("ACCESS_FISH_ID", "SPECIES_CODE", "TL")


@query("condition_factor", f"""
WITH {SQL_FISH} SELECT ACCESS_FISH_ID, round(CASE WHEN SPECIES_CODE = 'RBT' AND TL > 0 THEN
  WEIGHT / pow(10, cast(-4.6023 AS double) + cast(2.8193 AS double) * log10(TL)) END, 6) AS kn FROM fish""")
def _(t):
    fish = report.with_measures(t.report_fish)
    return fish.select("ACCESS_FISH_ID", F.round("kn", 6).alias("kn"))


@query("size_class", f"WITH {SQL_FISH} SELECT ACCESS_FISH_ID, SPECIES_CODE, TL, size_class FROM fish")
def _(t):
    return report.with_measures(t.report_fish).select("ACCESS_FISH_ID", "SPECIES_CODE", "TL", "size_class")


@query("reach_bins", """
SELECT ACCESS_SAMPLE_ID, START_RM, CASE WHEN START_RM > -15.31 AND START_RM <= -10.8 THEN '(-15.3,-10.8]'
  WHEN START_RM > -10.8 AND START_RM <= -4.0 THEN '(-10.8,-4]' WHEN START_RM > -4.0 AND START_RM <= -0.3 THEN '(-4,-0.3]' END AS reach
FROM report_samples""")
def _(t):
    return t.report_samples.select(
        "ACCESS_SAMPLE_ID", "START_RM", measures.reach(F.col("START_RM")).alias("reach"))


# Corrections ---------------------------------------------------------------------------------

@query("recode_values", """
SELECT ID, CASE WHEN upper(S_CREW) = 'AN,CH,JB' THEN 'AN, CH' ELSE upper(S_CREW) END AS S_CREW,
       CASE WHEN SPECIES = '' THEN 'FMS' ELSE SPECIES END AS SPECIES FROM export""")
def _(t):
    out = text.upper_columns(t.export.select("ID", "S_CREW", "SPECIES"), ["S_CREW"])
    out = corrections.recode(out, "S_CREW", {"AN,CH,JB": "AN, CH"})
    return corrections.recode(out, "SPECIES", {"": config.UNKNOWN_SPECIES_FILL})


@query("point_corrections", """
WITH fix AS (SELECT key_value, "column" AS col, min(new_value) AS v, round, key_column FROM corrections GROUP BY ALL),
one AS (
  SELECT e.ID, e.SAMPLE_ID, e.FORK_LENGTH, e.SEX,
    coalesce(s.v, e.S_SITE_ID) AS S_SITE_ID, coalesce(n.v, e.S_SAMPLE_NOTES) AS S_SAMPLE_NOTES, e.S_GPS_ID,
    CASE WHEN tl.key_value IS NOT NULL THEN try_cast(tl.v AS double) ELSE e.TOTAL_LENGTH END AS TOTAL_LENGTH,
    CASE WHEN w.key_value IS NOT NULL THEN try_cast(w.v AS double) ELSE e.WEIGHT END AS WEIGHT
  FROM export e
  LEFT JOIN fix s ON s.col = 'S_SITE_ID' AND s.round = 1 AND s.key_value = e.SAMPLE_ID
  LEFT JOIN fix n ON n.col = 'S_SAMPLE_NOTES' AND n.round = 1 AND n.key_value = e.SAMPLE_ID
  LEFT JOIN fix tl ON tl.col = 'TOTAL_LENGTH' AND tl.key_value = e.ID
  LEFT JOIN fix w ON w.col = 'WEIGHT' AND w.key_value = e.ID)
SELECT one.ID, one.SAMPLE_ID, one.S_SITE_ID, one.S_SAMPLE_NOTES, coalesce(g.v, one.S_GPS_ID) AS S_GPS_ID, one.TOTAL_LENGTH, one.WEIGHT,
  one.FORK_LENGTH, one.SEX
FROM one LEFT JOIN fix g ON g.round = 2 AND g.col = 'S_GPS_ID' AND g.key_value = one.S_SITE_ID""")
def _(t):
    rows = t.export.select(
        "ID", "SAMPLE_ID", "S_SITE_ID", "S_SAMPLE_NOTES", "S_GPS_ID", "TOTAL_LENGTH", "WEIGHT",
        "FORK_LENGTH", "SEX")
    return corrections.apply_corrections(rows, t.corrections, CORRECTIONS_LAYOUT)


@query("corrections_rejected", """
SELECT round, "column", key_column, key_value, new_value FROM corrections WHERE "column" = 'FORK_LENGTH'""")
def _(t):
    return corrections.rejected(t.export, t.corrections)


@query("corrections_conflicts", """
SELECT round, "column", key_column, key_value, count(DISTINCT new_value) AS n_values FROM corrections
GROUP BY round, "column", key_column, key_value HAVING count(DISTINCT new_value) > 1""")
def _(t):
    return corrections.conflicts(t.corrections)


@query("split_sample_id", """
SELECT ID, CASE WHEN S_SITE_ID LIKE '%3R' THEN concat(SAMPLE_ID, 'a') WHEN S_SAMPLE_TYPE = 120 THEN concat(SAMPLE_ID, S_SITE_ID)
  ELSE SAMPLE_ID END AS SAMPLE_ID FROM export""")
def _(t):
    own = F.col("SAMPLE_ID")
    second = text.append_where(own, F.col("S_SAMPLE_TYPE") == config.NON_NATIVE, F.col(SITE))
    wanted = F.col(SITE).endswith("3R")
    split = F.when(wanted, text.append_where(own, wanted, F.lit("a"))).otherwise(second)
    return t.export.select("ID", split.alias("SAMPLE_ID"))


@query("sex_cond_rule", """
SELECT ID, SEX, CASE WHEN SEX = 'U' AND SEX_COND IN ('R', 'G') THEN 'N' ELSE SEX_COND END AS SEX_COND FROM export""")
def _(t):
    return t.export.select(
        "ID", "SEX", codes.sex_condition(F.col("SEX"), F.col("SEX_COND")).alias("SEX_COND"))


@query("backfill_site", """
WITH listed AS (SELECT DISTINCT S_SITE_ID, side, rm_start, rm_end FROM sites WHERE type = 'monitoring'),
d AS (SELECT e.*, upper(e.S_SITE_ID) AS site, side, rm_start, rm_end FROM export e LEFT JOIN listed l ON upper(e.S_SITE_ID) = l.S_SITE_ID)
SELECT ID, site AS S_SITE_ID, coalesce(S_RM_START, rm_start, CASE WHEN contains(site, 'SLOUGH') THEN cast(-12.15 AS double) END) AS S_RM_START,
  coalesce(S_RM_END, rm_end, CASE WHEN contains(site, 'SLOUGH') THEN cast(-12.15 AS double) END) AS S_RM_END,
  CASE WHEN S_SIDE IS NOT NULL AND S_SIDE <> '' THEN S_SIDE WHEN side IS NOT NULL AND side <> '' THEN side
       WHEN S_SIDE IS NULL AND contains(site, 'SLOUGH') THEN 'L' END AS S_SIDE FROM d""")
def _(t):
    listed = t.sites.filter("type = 'monitoring'").select("S_SITE_ID", "side", "rm_start", "rm_end").distinct()
    rows = text.upper_columns(t.export, ["S_SITE_ID"]).join(listed, "S_SITE_ID", "left")
    return rows.select(
        "ID", "S_SITE_ID",
        codes.backfill_mile(F.col("S_RM_START"), F.col("rm_start"), F.col(SITE)).alias("S_RM_START"),
        codes.backfill_mile(F.col("S_RM_END"), F.col("rm_end"), F.col(SITE)).alias("S_RM_END"),
        codes.backfill_side(F.col("S_SIDE"), F.col("side"), F.col(SITE)).alias("S_SIDE"))


@query("note_backfill", """
SELECT ID, CASE WHEN S_START_DATE_TIME < TIMESTAMP '1998-03-08 22:15:00' AND S_SAMPLE_NOTES = '' THEN 'rate set too low'
  ELSE S_SAMPLE_NOTES END AS S_SAMPLE_NOTES FROM export""")
def _(t):
    return t.export.select("ID", codes.backfill_note(
        F.col("S_SAMPLE_NOTES"), F.col(START), CUTOFF, "rate set too low").alias("S_SAMPLE_NOTES"))


@query("reclass_sample_type", """
SELECT ID, CASE WHEN upper(S_SITE_ID) IN ('SLOUGH 1A', 'SLOUGH 1B', 'SLOUGH 1C') THEN 120 ELSE S_SAMPLE_TYPE END AS S_SAMPLE_TYPE FROM export""")
def _(t):
    return t.export.select("ID", codes.reclass_sites(
        F.col("S_SAMPLE_TYPE"), F.upper("S_SITE_ID"), config.SLOUGH_SITES, config.NON_NATIVE).alias("S_SAMPLE_TYPE"))


LATE_SITES = ("11.2L", "11.3R", "90.1R", "7.4L")


@query("shift_then_night", f"""
WITH d AS (SELECT ID, CASE WHEN S_SITE_ID IN ('11.2L', '11.3R', '90.1R', '7.4L') THEN S_START_DATE_TIME + INTERVAL '1' DAY
  ELSE S_START_DATE_TIME END AS ts FROM export)
SELECT ID, ts AS S_START_DATE_TIME, cast({_NIGHT.format(ts='ts')} AS integer) AS S_night FROM d""")
def _(t):
    out = field.with_night(field.shift_sites(t.export, LATE_SITES), F.lit(FIRST_NIGHT))
    return out.select("ID", "S_START_DATE_TIME", "S_night")


# Projections and filters ---------------------------------------------------------------------

@query("project_columns", "SELECT S_START_DATE_TIME, S_SITE_ID, SPECIES, TOTAL_LENGTH, ID, SAMPLE_ID FROM export")
def _(t):
    return t.export.select("S_START_DATE_TIME", "S_SITE_ID", "SPECIES", "TOTAL_LENGTH", "ID", "SAMPLE_ID")


_FEW = ["ID", "SAMPLE_ID", "S_CREW", "S_SET_NUM", "SPECIES", "WEIGHT"]


@query("drop_columns", "SELECT ID, SAMPLE_ID, SPECIES, WEIGHT FROM export")
def _(t):
    return t.export.select(*_FEW).drop("S_CREW", "S_SET_NUM", "NOT_THERE")


@query("select_by_pattern", "SELECT DISTINCT S_CREW, S_SET_NUM FROM export")
def _(t):
    named = t.export.select(*_FEW, F.col("DISPOSITION").alias("S_COVER_desc"))
    coded = columns.select_by_name(named, suffix="_DESC", keep=False)
    return columns.select_by_name(coded, prefix="s_").distinct()


@query("drop_all_null_columns", "SELECT ID, WEIGHT, TOTAL_LENGTH FROM export")
def _(t):
    none = F.lit(None).cast("double").alias("EMPTY")
    never = F.when(F.col("WEIGHT") < 0, F.col("SPECIES")).alias("NEVER")
    return columns.drop_all_missing(t.export.select("ID", "WEIGHT", none, never, "TOTAL_LENGTH"))


@query("rename_columns", "SELECT ID AS ACCESS_FISH_ID, FISH_TAG AS PITTAG, SPECIES AS SPECIES_CODE, WEIGHT FROM export")
def _(t):
    rows = t.export.select("ID", "FISH_TAG", "SPECIES", "WEIGHT").withColumnRenamed("ID", "SPECIMEN_ID")
    return rows.toDF("ACCESS_FISH_ID", "PITTAG", "SPECIES_CODE", "WEIGHT")


@query("add_columns", """
SELECT ID, S_EF_MINUTES * 60 + S_EF_SECONDS AS EF_TOTAL_SECONDS, (S_EF_MINUTES * 60 + S_EF_SECONDS) / cast(60 AS double) AS effort_minutes,
       'GC20210403' AS S_TRIP_ID FROM export""")
def _(t):
    steps = {
        "EF_TOTAL_SECONDS": times.effort_seconds(F.col("S_EF_MINUTES"), F.col("S_EF_SECONDS")),
        "effort_minutes": F.col("EF_TOTAL_SECONDS") / 60.0,
        "S_TRIP_ID": F.lit("GC20210403"),
    }
    return columns.add_in_turn(t.export, steps).select("ID", *steps)


@query("mutate_at", r"""
SELECT ID, upper(S_TRIP_ID) AS S_TRIP_ID, upper(S_SITE_ID) AS S_SITE_ID, upper(FISH_TAG) AS FISH_TAG,
  try_strptime(regexp_extract(S_START_DATE_TIME, '^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}'), '%m/%d/%Y %H:%M') AS S_START_DATE_TIME,
  try_strptime(regexp_extract(S_END_DATE_TIME, '^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}'), '%m/%d/%Y %H:%M') AS S_END_DATE_TIME FROM raw_export""")
def _(t):
    rows = t.raw_export.select("ID", "S_TRIP_ID", "S_SITE_ID", "FISH_TAG", "S_START_DATE_TIME", "S_END_DATE_TIME")
    out = columns.mutate_at(rows, ["S_TRIP_ID", "S_SITE_ID", "FISH_TAG"], F.upper)
    return columns.mutate_ending(out, "DATE_TIME", times.parse_minute)


@query("filter_eq", "SELECT ID, SAMPLE_ID, S_SAMPLE_TYPE FROM export WHERE S_SAMPLE_TYPE = 96")
def _(t):
    return t.export.filter(F.col("S_SAMPLE_TYPE") == config.MONITORING).select("ID", "SAMPLE_ID", "S_SAMPLE_TYPE")


@query("filter_exclude", """
SELECT ID, S_SAMPLE_NOTES, SPECIES FROM export WHERE S_SAMPLE_NOTES IS DISTINCT FROM 'test' AND SPECIES IS DISTINCT FROM 'NFC'""")
def _(t):
    kept = t.export.filter(text.is_not(F.col("S_SAMPLE_NOTES"), "test"))
    return kept.filter(text.is_not(F.col("SPECIES"), config.NO_FISH)).select("ID", "S_SAMPLE_NOTES", "SPECIES")


@query("filter_in", "SELECT ID, SPECIES FROM export WHERE NOT coalesce(SPECIES IN ('RBT', 'BNT', 'NFC'), false)")
def _(t):
    return t.export.filter(~text.is_in(F.col("SPECIES"), ("RBT", "BNT", "NFC"))).select("ID", "SPECIES")


@query("filter_not_blank", "SELECT ID, FISH_TAG FROM export WHERE FISH_TAG IS NOT NULL AND FISH_TAG <> ''")
def _(t):
    return t.export.filter(text.not_blank(F.col("FISH_TAG"))).select("ID", "FISH_TAG")


@query("filter_contains", "SELECT ID, upper(S_SITE_ID) AS S_SITE_ID FROM export WHERE contains(upper(S_SITE_ID), 'SLOUGH')")
def _(t):
    rows = text.upper_columns(t.export.select("ID", "S_SITE_ID"), ["S_SITE_ID"])
    return rows.filter(F.col(SITE).contains(config.SLOUGH_MARK))
