"""Joins, groupings and order-dependent operators over the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcatch.config import TripConfig
from fieldcatch.functions import times
from fieldcatch.operators import catch, columns, corrections, lookups, ordering, quality, summary
from fieldcatch.plans import field, trip
from fieldcatch.workload.registry import query
from fieldcatch.workload.scalars import LATE_SITES

_HOURS = "date_diff('second', S_START_DATE_TIME, S_END_DATE_TIME) / 3600.0"
_VISIT = "concat(coalesce(S_SITE_ID, 'NA'), ' ', coalesce(strftime(S_START_DATE_TIME, '%Y-%m-%d %H:%M:%S'), 'NA'))"
_BOAT = """concat(coalesce(strftime(S_START_DATE_TIME, '%Y-%m-%d'), 'NA'), ' ', coalesce(S_CLIPBOARD, 'NA'), ' ',
  coalesce(strftime(S_END_DATE_TIME, '%Y-%m-%d %H:%M:%S'), 'NA'))"""
_CAUGHT = "cast(sum(CASE WHEN SPECIES = 'NFC' THEN 0 ELSE 1 END) AS bigint)"


# Joins ---------------------------------------------------------------------------------------

@query("join_sites", """
SELECT e.ID, e.S_SITE_ID, s.start_rm, s.RiverSide, s.reach FROM export e LEFT JOIN sites s ON e.S_SITE_ID = s.S_SITE_ID""")
def _(t):
    return lookups.join_sites(t.export.select("ID", "S_SITE_ID"), t.sites, ["start_rm", "RiverSide", "reach"])


@query("join_sites_fanout", """
SELECT e.ID, count(*) AS listings, min(s.rm_end) AS first_end, max(s.rm_end) AS last_end
FROM export e LEFT JOIN (SELECT DISTINCT S_SITE_ID, side, rm_start, rm_end FROM sites WHERE type = 'monitoring') s
  ON e.S_SITE_ID = s.S_SITE_ID GROUP BY e.ID""")
def _(t):
    listed = t.sites.filter("type = 'monitoring'").select("S_SITE_ID", "side", "rm_start", "rm_end").distinct()
    joined = lookups.join_sites(t.export.select("ID", "S_SITE_ID"), listed, ["rm_end"])
    return joined.groupBy("ID").agg(
        F.count(F.lit(1)).alias("listings"), F.min("rm_end").alias("first_end"), F.max("rm_end").alias("last_end"))


@query("join_sites_first", """
WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY S_SITE_ID ORDER BY site_seq) AS k FROM sites) WHERE k = 1)
SELECT e.ID, e.S_SITE_ID, o.rm_end, o.RiverSide FROM export e LEFT JOIN one o ON e.S_SITE_ID = o.S_SITE_ID""")
def _(t):
    rows = t.export.select("ID", "S_SITE_ID")
    return lookups.join_sites(rows, t.sites, ["rm_end", "RiverSide"], on_duplicate="first")


@query("repeated_sites", "SELECT S_SITE_ID, count(*) AS n FROM sites GROUP BY 1 HAVING count(*) > 1")
def _(t):
    return lookups.repeated_sites(t.sites)


@query("rejoin_after_fix", """
WITH fix AS (SELECT key_value, min(new_value) AS v FROM corrections WHERE "column" = 'S_SITE_ID' GROUP BY 1),
d AS (SELECT e.ID, coalesce(f.v, e.S_SITE_ID) AS S_SITE_ID FROM export e LEFT JOIN fix f ON f.key_value = e.SAMPLE_ID)
SELECT d.ID, d.S_SITE_ID, s.RiverSide FROM d LEFT JOIN sites s ON d.S_SITE_ID = s.S_SITE_ID""")
def _(t):
    rows = t.export.select("ID", "SAMPLE_ID", "S_SITE_ID")
    fixes = t.corrections.filter(F.col("column") == "S_SITE_ID")
    fixed = corrections.apply_corrections(rows, fixes, [(1, "SAMPLE_ID", "S_SITE_ID")])
    return lookups.join_sites(fixed.select("ID", "S_SITE_ID"), t.sites, ["RiverSide"])


@query("unmatched_sites", """
SELECT e.ID, e.S_SITE_ID FROM export e WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE s.S_SITE_ID = e.S_SITE_ID)""")
def _(t):
    return lookups.unmatched_sites(t.export.select("ID", "S_SITE_ID"), t.sites)


@query("join_water", """
WITH d AS (SELECT DISTINCT SAMPLE_ID, strftime(S_START_DATE_TIME, '%Y-%m-%d') AS START_DATE FROM export)
SELECT d.*, w.TURBIDITY_NTU, w.WATER_TEMP FROM d LEFT JOIN water w ON d.START_DATE = w.START_DATE""")
def _(t):
    day = times.iso_date(F.col("S_START_DATE_TIME")).alias("START_DATE")
    return lookups.join_water(t.export.select("SAMPLE_ID", day).distinct(), t.water)


@query("attach_total_catch", f"""
WITH c AS (SELECT S_SITE_ID, {_CAUGHT} AS TOTAL_CATCH FROM export GROUP BY 1)
SELECT e.ID, e.S_SITE_ID, e.SPECIES, c.TOTAL_CATCH FROM export e JOIN c ON e.S_SITE_ID IS NOT DISTINCT FROM c.S_SITE_ID""")
def _(t):
    return catch.attach_total_catch(t.export.select("ID", "S_SITE_ID", "SPECIES"), ["S_SITE_ID"])


@query("join_effort", """
WITH c AS (SELECT ACCESS_SAMPLE_ID, SPECIES_CODE, count(*) AS n FROM report_fish GROUP BY 1, 2)
SELECT c.*, s.EF_TOTAL_SECONDS / cast(60 AS double) AS effort_minutes FROM c LEFT JOIN report_samples s ON c.ACCESS_SAMPLE_ID = s.ACCESS_SAMPLE_ID""")
def _(t):
    counts = catch.counts_per_sample(t.report_fish, "SPECIES_CODE")
    return counts.join(catch.effort_minutes(t.report_samples), "ACCESS_SAMPLE_ID", "left")


# Groupings -----------------------------------------------------------------------------------

@query("species_counts", "SELECT SPECIES, count(*) AS n FROM export GROUP BY 1")
def _(t):
    return summary.counts_descending(t.export, "SPECIES")


@query("counts_by_type_species", "SELECT S_SAMPLE_TYPE, SPECIES, count(*) AS n FROM export GROUP BY 1, 2")
def _(t):
    return summary.counts(t.export, "S_SAMPLE_TYPE", "SPECIES")


_FIELD_COLUMNS = ["S_SITE_ID", "S_SAMPLE_TYPE", "S_START_DATE_TIME", "S_SAMPLE_NOTES", "S_CLIPBOARD", "S_CREW",
                  "SPECIES", "ID"]
_FIELD_SQL = """
WITH a AS (SELECT upper(S_SITE_ID) AS S_SITE_ID, S_SAMPLE_TYPE AS raw_type, S_START_DATE_TIME AS raw_start, S_SAMPLE_NOTES AS raw_notes,
    S_CLIPBOARD, S_CREW, SPECIES, ID FROM export),
b AS (SELECT S_SITE_ID, S_CLIPBOARD, S_CREW, SPECIES, ID,
    CASE WHEN S_SITE_ID IN ('SLOUGH 1A', 'SLOUGH 1B', 'SLOUGH 1C') THEN 120 ELSE raw_type END AS S_SAMPLE_TYPE,
    CASE WHEN S_SITE_ID IN ('11.2L', '11.3R', '90.1R', '7.4L') THEN raw_start + INTERVAL '1' DAY ELSE raw_start END AS S_START_DATE_TIME,
    CASE WHEN S_SITE_ID = '4.4L' THEN '1 BEAVER' ELSE raw_notes END AS S_SAMPLE_NOTES FROM a),
f AS (SELECT *, cast(S_START_DATE_TIME AS date) AS S_date, cast(CASE
    WHEN hour(S_START_DATE_TIME) > 6 THEN date_diff('day', DATE '1995-01-01', cast(S_START_DATE_TIME AS date)) + 1
    WHEN hour(S_START_DATE_TIME) < 6 THEN date_diff('day', DATE '1995-01-01', cast(S_START_DATE_TIME AS date)) END AS integer) AS S_night FROM b)
"""


def _field(t):
    return field.field_summary(
        t.export.select(*_FIELD_COLUMNS), TripConfig("LF19950101"), LATE_SITES, {"4.4L": "1 BEAVER"})


@query("sites_per_night", _FIELD_SQL + """SELECT S_night, S_SAMPLE_TYPE, count(*) AS n FROM (SELECT DISTINCT S_SITE_ID, S_SAMPLE_TYPE,
  S_START_DATE_TIME, S_SAMPLE_NOTES, S_CLIPBOARD, S_CREW, S_date, S_night FROM f) GROUP BY 1, 2""")
def _(t):
    return _field(t).sites_per_night


@query("species_by_night", _FIELD_SQL + "SELECT SPECIES, S_night, count(*) AS n FROM f GROUP BY 1, 2")
def _(t):
    return _field(t).species_by_night


@query("field_export", _FIELD_SQL + "SELECT * FROM f")
def _(t):
    return _field(t).export


@query("total_catch_visit", f"""
WITH d AS (SELECT {_VISIT} AS S_SITE_ID_2, SPECIES FROM export) SELECT S_SITE_ID_2, {_CAUGHT} AS TOTAL_CATCH FROM d GROUP BY 1""")
def _(t):
    return catch.total_catch(t.export.withColumn("S_SITE_ID_2", trip.visit_key()), ["S_SITE_ID_2"])


@query("total_catch_site", f"SELECT S_SITE_ID, {_CAUGHT} AS TOTAL_CATCH FROM export GROUP BY 1")
def _(t):
    return catch.total_catch(t.export, ["S_SITE_ID"])


@query("sites_per_sample", "SELECT SAMPLE_ID, count(DISTINCT S_SITE_ID) + max(CASE WHEN S_SITE_ID IS NULL THEN 1 ELSE 0 END) AS n_sites FROM export GROUP BY 1")
def _(t):
    return summary.distinct_per_group(t.export, "SAMPLE_ID", "S_SITE_ID", "n_sites")


@query("samples_per_site", """
SELECT S_SITE_ID, count(DISTINCT SAMPLE_ID) + max(CASE WHEN SAMPLE_ID IS NULL THEN 1 ELSE 0 END) AS n_samples FROM export GROUP BY 1""")
def _(t):
    return summary.distinct_per_group(t.export, "S_SITE_ID", "SAMPLE_ID", "n_samples")


@query("site_sample_parity", """
WITH c AS (SELECT count(DISTINCT S_SITE_ID) AS n_left, count(DISTINCT SAMPLE_ID) AS n_right FROM export) SELECT *, n_left = n_right AS matches FROM c""")
def _(t):
    return summary.parity(t.export, "S_SITE_ID", "SAMPLE_ID")


@query("distinct_samples", "SELECT DISTINCT S_SITE_ID, S_START_DATE_TIME FROM export")
def _(t):
    return t.export.select("S_SITE_ID", "S_START_DATE_TIME").distinct()


@query("distinct_values", "SELECT DISTINCT S_CREW FROM export")
def _(t):
    return t.export.select("S_CREW").distinct()


@query("species_list", "SELECT DISTINCT SPECIES_CODE FROM report_fish WHERE SPECIES_CODE <> '' AND SPECIES_CODE <> 'NFC'")
def _(t):
    return summary.species_list(t.report_fish, "SPECIES_CODE")


# Order ---------------------------------------------------------------------------------------

@query("site_end_mile", """
SELECT S_SITE_ID, site_seq, RiverSide, start_rm, lead(start_rm) OVER (PARTITION BY RiverSide ORDER BY site_seq) AS end_rm
FROM sites WHERE RiverSide IN ('L', 'R')""")
def _(t):
    return trip.end_miles(t.sites.select("S_SITE_ID", "site_seq", "RiverSide", "start_rm"))


@query("union_sides", "SELECT S_SITE_ID, RiverSide, start_rm FROM sites WHERE RiverSide IN ('L', 'R')")
def _(t):
    rows = t.sites.select("S_SITE_ID", "RiverSide", "start_rm")
    return columns.stack_sides(rows.filter("RiverSide = 'L'"), rows.filter("RiverSide = 'R'"))


@query("sample_key_visit", f"""
WITH d AS (SELECT DISTINCT {_VISIT} AS S_SITE_ID_2 FROM export)
SELECT S_SITE_ID_2, dense_rank() OVER (ORDER BY S_SITE_ID_2) + 175 AS ACCESS_SAMPLE_ID FROM d""")
def _(t):
    keyed = t.export.select(trip.visit_key().alias("S_SITE_ID_2"))
    return ordering.dense_keys(keyed, ["S_SITE_ID_2"], "ACCESS_SAMPLE_ID", 175)


@query("sample_key_boat", f"""
WITH d AS (SELECT ID, {_BOAT} AS net FROM export) SELECT ID, net, dense_rank() OVER (ORDER BY net) + 267 AS ACCESS_SAMPLE_ID FROM d""")
def _(t):
    keyed = t.export.select("ID", trip.boat_key().alias("net"))
    return lookups.attach(keyed, ordering.dense_keys(keyed, ["net"], "ACCESS_SAMPLE_ID", 267), ["net"])


@query("specimen_key", """
SELECT ID, SAMPLE_ID, S_START_DATE_TIME, row_number() OVER (ORDER BY SAMPLE_ID, S_START_DATE_TIME, ID) + 1536 AS ACCESS_FISH_ID FROM export""")
def _(t):
    rows = t.export.select("ID", "SAMPLE_ID", "S_START_DATE_TIME")
    return ordering.number_rows(rows, ["SAMPLE_ID", "S_START_DATE_TIME", "ID"], "ACCESS_FISH_ID", 1536)


@query("key_high_water", f"""
WITH d AS (SELECT row_number() OVER (ORDER BY SAMPLE_ID, S_START_DATE_TIME, ID) + 1536 AS f, dense_rank() OVER (ORDER BY {_VISIT}) + 175 AS s FROM export)
SELECT max(f) AS "max_ACCESS_FISH_ID", max(s) AS "max_ACCESS_SAMPLE_ID" FROM d""")
def _(t):
    rows = t.export.select("ID", "SAMPLE_ID", "S_START_DATE_TIME", trip.visit_key().alias("visit"))
    numbered = ordering.number_rows(rows, ["SAMPLE_ID", "S_START_DATE_TIME", "ID"], "ACCESS_FISH_ID", 1536)
    visits = ordering.dense_keys(numbered, ["visit"], "ACCESS_SAMPLE_ID", 175)
    return summary.high_water(lookups.attach(numbered, visits, ["visit"]), "ACCESS_FISH_ID", "ACCESS_SAMPLE_ID")


@query("next_load_keys", f"""
SELECT visit, dense_rank() OVER (ORDER BY visit) + (SELECT max(o_orderkey) FROM orders) AS ACCESS_SAMPLE_ID
FROM (SELECT DISTINCT {_VISIT} AS visit FROM export)""")
def _(t):
    cfg = trip.next_load(TripConfig("GC20210403"), t.report_samples)
    visits = t.export.select(trip.visit_key().alias("visit"))
    return ordering.dense_keys(visits, ["visit"], "ACCESS_SAMPLE_ID", cfg.samples_before)


@query("trips_total_catch", """
SELECT upper(S_TRIP_ID) AS S_TRIP_ID, upper(S_SITE_ID) AS S_SITE_ID, cast(sum(CASE WHEN SPECIES = 'NFC' THEN 0 ELSE 1 END) AS bigint) AS TOTAL_CATCH
FROM export GROUP BY 1, 2""")
def _(t):
    rows = trip.normalise(t.export.select("S_TRIP_ID", "S_SITE_ID", "SPECIES"), None, ["S_TRIP_ID", "S_SITE_ID"])
    return catch.total_catch(rows, ["S_TRIP_ID", "S_SITE_ID"])


@query("trips_sample_keys", f"""
WITH v AS (SELECT DISTINCT S_TRIP_ID, {_VISIT} AS visit FROM export)
SELECT S_TRIP_ID, visit, row_number() OVER (PARTITION BY S_TRIP_ID ORDER BY visit)
  + cast(substr(S_TRIP_ID, 3, 4) AS bigint) AS ACCESS_SAMPLE_ID FROM v""")
def _(t):
    visits = t.export.select("S_TRIP_ID", trip.visit_key().alias("visit")).distinct()
    settings = t.export.select("S_TRIP_ID").distinct().withColumn("before", F.substring("S_TRIP_ID", 3, 4).cast("bigint"))
    return ordering.number_within(visits, "S_TRIP_ID", ["visit"], "ACCESS_SAMPLE_ID", settings)


@query("duplicate_tags", """
WITH d AS (SELECT ID, FISH_TAG, S_START_DATE_TIME, row_number() OVER (PARTITION BY FISH_TAG ORDER BY S_START_DATE_TIME, ID) AS k
  FROM export WHERE FISH_TAG IS NOT NULL AND FISH_TAG <> '') SELECT ID, FISH_TAG, S_START_DATE_TIME FROM d WHERE k > 1""")
def _(t):
    return quality.duplicate_tags(t.export.select("ID", "FISH_TAG", "S_START_DATE_TIME"))


@query("duplicate_site_rows", """
WITH s AS (SELECT DISTINCT S_SITE_ID, S_START_DATE_TIME, SAMPLE_ID, S_GEAR FROM export),
k AS (SELECT *, row_number() OVER (PARTITION BY S_SITE_ID ORDER BY S_START_DATE_TIME, SAMPLE_ID, S_GEAR) AS k FROM s)
SELECT S_SITE_ID, S_START_DATE_TIME, SAMPLE_ID, S_GEAR FROM k WHERE k > 1""")
def _(t):
    rows = t.export.select("S_SITE_ID", "S_START_DATE_TIME", "SAMPLE_ID", "S_GEAR").distinct()
    return quality.later_occurrences(rows, "S_SITE_ID", ["S_START_DATE_TIME", "SAMPLE_ID", "S_GEAR"])


@query("progression_check", """
WITH s AS (SELECT DISTINCT S_TRIP_ID, S_CLIPBOARD, S_START_DATE_TIME, SAMPLE_ID, S_RIVER_MILE FROM export),
p AS (SELECT *, lag(S_RIVER_MILE) OVER w AS prev_mile, lag(S_START_DATE_TIME) OVER w AS prev_time FROM s
  WINDOW w AS (PARTITION BY S_TRIP_ID, S_CLIPBOARD ORDER BY S_START_DATE_TIME, SAMPLE_ID, S_RIVER_MILE))
SELECT *, coalesce(S_RIVER_MILE < prev_mile, false) AS upstream_move FROM p""")
def _(t):
    return quality.progression(
        t.export.select("S_TRIP_ID", "S_CLIPBOARD", "S_START_DATE_TIME", "SAMPLE_ID", "S_RIVER_MILE").distinct())


@query("sort_export", "SELECT SAMPLE_ID, S_START_DATE_TIME, FISH_TAG, ID FROM export")
def _(t):
    order = [F.col(c).asc_nulls_last() for c in ("SAMPLE_ID", "S_START_DATE_TIME", "FISH_TAG", "ID")]
    return t.export.select("SAMPLE_ID", "S_START_DATE_TIME", "FISH_TAG", "ID").orderBy(*order)


@query("sample_type_review", """
SELECT DISTINCT S_CLIPBOARD, S_SAMPLE_TYPE, S_SITE_ID, S_START_DATE_TIME, SAMPLE_ID, S_SAMPLE_NOTES FROM export""")
def _(t):
    shown = ["S_CLIPBOARD", "S_SAMPLE_TYPE", "S_SITE_ID", "S_START_DATE_TIME", "SAMPLE_ID", "S_SAMPLE_NOTES"]
    # the sample id keeps rows of one boat and minute from having to share a task
    order = ("S_CLIPBOARD", "S_START_DATE_TIME", "SAMPLE_ID")
    return t.export.select(*shown).distinct().orderBy(*[F.col(c).asc_nulls_last() for c in order])


# Quality -------------------------------------------------------------------------------------

@query("rm_discrepancy", """
WITH d AS (SELECT ID, S_SITE_ID, S_RIVER_MILE, S_RIVER_MILE - try_cast(regexp_replace(S_SITE_ID, '[A-Za-z]', '', 'g') AS double) AS diff FROM export)
SELECT *, coalesce(abs(diff) > 0.20, false) AS mile_error FROM d""")
def _(t):
    return quality.mile_discrepancy(t.export.select("ID", "S_SITE_ID", "S_RIVER_MILE"))


@query("length_outliers", """
SELECT ID, TOTAL_LENGTH - FORK_LENGTH AS total_minus_fork, CASE WHEN TOTAL_LENGTH - FORK_LENGTH >= 40 THEN 'error' ELSE 'ok' END AS error FROM export""")
def _(t):
    return quality.length_outliers(t.export).select("ID", "total_minus_fork", "error")


@query("length_outliers_abs", """
WITH d AS (SELECT ID, TOTAL_LENGTH, FORK_LENGTH + WEIGHT % 90 AS FORK_LENGTH FROM export)
SELECT ID, TOTAL_LENGTH - FORK_LENGTH AS total_minus_fork, CASE WHEN abs(TOTAL_LENGTH - FORK_LENGTH) >= 40 THEN 'error' ELSE 'ok' END AS error FROM d""")
def _(t):
    rows = t.export.select("ID", "TOTAL_LENGTH", (F.col("FORK_LENGTH") + F.col("WEIGHT") % 90).alias("FORK_LENGTH"))
    return quality.length_outliers(rows, absolute=True).select("ID", "total_minus_fork", "error")


@query("effort_anomalies", f"""
SELECT ID, round({_HOURS}, 6) AS EFFORT_HOURS FROM export WHERE {_HOURS} < 0 OR {_HOURS} > 24""")
def _(t):
    return quality.effort_anomalies(t.export).select("ID", F.round("EFFORT_HOURS", 6).alias("EFFORT_HOURS"))


@query("effort_summary", f"""
WITH h AS (SELECT {_HOURS} AS h FROM export WHERE S_GEAR IN ('MHB', 'HB'))
SELECT round(min(h), 6) AS min_hours, round(quantile_cont(h, 0.25), 6) AS q1_hours, round(quantile_cont(h, 0.5), 6) AS median_hours,
  round(avg(h), 6) AS mean_hours, round(quantile_cont(h, 0.75), 6) AS q3_hours, round(max(h), 6) AS max_hours,
  count(*) - count(h) AS n_missing FROM h""")
def _(t):
    out = quality.effort_summary(t.export)
    hours = [c for c in out.columns if c.endswith("_hours")]
    return out.select(*[F.round(c, 6).alias(c) for c in hours], "n_missing")


@query("bad_side", """
WITH d AS (SELECT ID, S_SITE_ID, nullif(regexp_extract(S_SITE_ID, '[A-Z]+'), '') AS S_SIDE FROM export)
SELECT * FROM d WHERE S_SIDE IS NULL OR S_SIDE NOT IN ('L', 'R')""")
def _(t):
    return quality.bad_side(t.export.select("ID", "S_SITE_ID"))


@query("measurement_outliers", """
WITH r AS (SELECT ID, SPECIES, round(TOTAL_LENGTH / cast(nullif(FORK_LENGTH, 0) AS double), 6) AS length_ratio,
    round(WEIGHT * cast(1000000 AS double) / nullif(cast(TOTAL_LENGTH AS double) * TOTAL_LENGTH * TOTAL_LENGTH, 0), 6) AS weight_ratio,
    round(WEIGHT * cast(1000000 AS double) / nullif(cast(FORK_LENGTH AS double) * FORK_LENGTH * FORK_LENGTH, 0), 6) AS fork_weight_ratio FROM export),
q AS (SELECT SPECIES, quantile_cont(length_ratio, 0.25) AS l1, quantile_cont(length_ratio, 0.75) AS l3,
    quantile_cont(weight_ratio, 0.25) AS w1, quantile_cont(weight_ratio, 0.75) AS w3,
    quantile_cont(fork_weight_ratio, 0.25) AS f1, quantile_cont(fork_weight_ratio, 0.75) AS f3 FROM r GROUP BY 1),
f AS (SELECT r.*, coalesce(length_ratio < round(l1 - 1.5 * (l3 - l1), 6) OR length_ratio > round(l3 + 1.5 * (l3 - l1), 6), false) AS length_ratio_outlier,
    coalesce(weight_ratio < round(w1 - 1.5 * (w3 - w1), 6) OR weight_ratio > round(w3 + 1.5 * (w3 - w1), 6), false) AS weight_ratio_outlier,
    coalesce(fork_weight_ratio < round(f1 - 1.5 * (f3 - f1), 6) OR fork_weight_ratio > round(f3 + 1.5 * (f3 - f1), 6), false) AS fork_weight_ratio_outlier
  FROM r JOIN q ON r.SPECIES IS NOT DISTINCT FROM q.SPECIES)
SELECT * FROM f WHERE length_ratio_outlier OR weight_ratio_outlier OR fork_weight_ratio_outlier""")
def _(t):
    rows = t.export.select("ID", "SPECIES", "TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT")
    return quality.measurement_outliers(rows).drop("TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT")


@query("species_plausible", """
SELECT ID, SPECIES, NOT coalesce(SPECIES = 'FHM' AND (coalesce(TOTAL_LENGTH > 70, false) OR coalesce(FISH_TAG <> '', false)), false) AS SPECIES_CORRECT
FROM export""")
def _(t):
    return quality.species_plausible(t.export).select("ID", "SPECIES", "SPECIES_CORRECT")
