"""Many trips in one job, the register of loads, and the record of corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcatch.operators import corrections
from fieldcatch.plans import loads, trip, trips
from fieldcatch.config import TripConfig
from fieldcatch.runtime import materialise
from fieldcatch.workload import jobs
from fieldcatch.workload.adapter import CORRECTIONS_LAYOUT
from fieldcatch.workload.registry import query

TRIP = trip.TRIP
# The settings of a trip, told from the year and month in its id; the same text in both engines.
_YEAR, _MONTH = f"cast(substr({TRIP}, 3, 4) AS bigint)", f"cast(substr({TRIP}, 7, 2) AS int)"
_SETTINGS = {
    "samples_before": _YEAR, "specimens_before": f"{_YEAR} * 10",
    "earliest": f"CASE WHEN {_MONTH} % 2 = 1 THEN cast('1996-01-01 01:01:01' AS {{ts}}) END",
    "key_by_site": f"{_MONTH} % 2 = 0", "with_hours": f"{_MONTH} % 3 <> 0", "keep_codes": f"{_MONTH} % 4 = 0",
}


def _settings(t):
    """A row per trip of the generated orders."""
    ids = t.export.select(F.upper(TRIP).alias(TRIP)).distinct()
    told = ids.selectExpr(TRIP, *[f"{e.format(ts='timestamp_ntz')} AS {n}" for n, e in _SETTINGS.items()])
    upper = F.array(*map(F.lit, trip.UPPER_ELECTROFISHING))
    return materialise(told.withColumns({
        "cutoff": F.lit(None).cast("timestamp_ntz"), "early_note": F.lit(None).cast("string"),
        "upper": F.when(F.expr(f"{_MONTH} % 5 = 0"), upper).otherwise(F.array_append(upper, "S_GPS_ID")),
    }), "settings")


def _rows(t):
    """The export as a scan of all trips' files gives it."""
    return t.export.withColumn(TRIP, F.upper(TRIP))


_EF = jobs._EF.replace("'GC20210403' AS S_TRIP_ID", f"upper({TRIP}) AS {TRIP}").replace(
    "v AS (SELECT visit, dense_rank() OVER (ORDER BY visit) + 175 AS ACCESS_SAMPLE_ID",
    f"v AS (SELECT {TRIP}, visit, dense_rank() OVER (PARTITION BY {TRIP} ORDER BY visit) + {_YEAR} AS ACCESS_SAMPLE_ID",
).replace("FROM d GROUP BY visit", f"FROM d GROUP BY {TRIP}, visit")


def _electrofishing(t, only):
    settings = _settings(t)
    out = trip.ElectrofishingTables(
        trips.clean_many_electrofishing(_rows(t), settings, jobs._sites(t)), TripConfig(""), "RiverSide", t.water, many=True,
        only=only)
    out.before = settings.select(TRIP, "samples_before", "specimens_before")
    return out


@query("trips_sample_table", f"""WITH {_EF}
SELECT s.*, TRIP_ID AS trip FROM ({jobs._sample_sql('RiverSide', True).replace('USING (visit)', f'USING ({TRIP}, visit)')}) s""")
def _(t):
    return _electrofishing(t, "sample").sample


@query("trips_specimen_table", f"""WITH {_EF} {jobs._SPECIMEN.replace('USING (visit)', f'USING ({TRIP}, visit)').replace(
    'row_number() OVER (ORDER BY', f'row_number() OVER (PARTITION BY {TRIP} ORDER BY').replace('+ 1536', f'+ {_YEAR} * 10').replace(
    'FROM d JOIN', f', {TRIP} AS trip FROM d JOIN')}""")
def _(t):
    return _electrofishing(t, "specimen").specimen


# Hoop nets whose trips differ in year repair, keys, hours and codes.
_HOOP = f"""
u AS (SELECT e.* EXCLUDE (S_SITE_ID, S_CLIPBOARD, S_CREW, FISH_TAG, S_GPS_ID, S_START_DATE_TIME, {TRIP}), upper({TRIP}) AS {TRIP},
    upper(S_SITE_ID) AS S_SITE_ID, upper(S_CLIPBOARD) AS S_CLIPBOARD, upper(S_CREW) AS S_CREW, upper(FISH_TAG) AS FISH_TAG,
    CASE WHEN {_MONTH} % 5 = 0 THEN S_GPS_ID ELSE upper(S_GPS_ID) END AS S_GPS_ID,
    CASE WHEN S_START_DATE_TIME < {_SETTINGS['earliest'].format(ts='timestamp')} THEN S_START_DATE_TIME + INTERVAL '366' DAY
      ELSE S_START_DATE_TIME END AS S_START_DATE_TIME FROM export e),
d AS (SELECT u.*, strftime(S_START_DATE_TIME, '%Y-%m-%d') AS day, CASE WHEN {_SETTINGS['key_by_site']} THEN S_SITE_ID
    ELSE concat(strftime(S_START_DATE_TIME, '%Y-%m-%d'), ' ', S_CLIPBOARD, ' ', strftime(S_END_DATE_TIME, '%Y-%m-%d %H:%M:%S')) END AS net FROM u),
v AS (SELECT {TRIP}, net, dense_rank() OVER (PARTITION BY {TRIP} ORDER BY net) + {_YEAR} AS ACCESS_SAMPLE_ID FROM d GROUP BY {TRIP}, net),
c AS (SELECT {TRIP}, S_SITE_ID, {jobs._CAUGHT} AS TOTAL_CATCH FROM d GROUP BY {TRIP}, S_SITE_ID)
"""


def _hoop(t, only):
    settings = _settings(t)
    out = trips.many_hoop_tables(trips.clean_many_hoop(_rows(t), settings), t.water, only=only)
    out.before = settings.select(TRIP, "samples_before", "specimens_before")
    return out


@query("trips_sample_table_hoop", f"""WITH {_HOOP}
SELECT DISTINCT v.ACCESS_SAMPLE_ID, S_SITE_ID AS DATASHEET_SAMPLE_ID, {TRIP} AS TRIP_ID, S_SAMPLE_TYPE AS SAMPLE_TYPE,
  strftime(S_START_DATE_TIME, '%m/%d/%Y') AS START_DATE, strftime(S_START_DATE_TIME, '%H:%M') AS START_TIME,
  strftime(S_END_DATE_TIME, '%m/%d/%Y') AS END_DATE, CASE WHEN S_GEAR = 'MHB' THEN strftime(S_END_DATE_TIME, '%H:%M') WHEN S_GEAR = 'EL' THEN '' END AS END_TIME,
  S_START_DATE_TIME AS START_DATETIME, S_END_DATE_TIME AS END_DATETIME,
  CASE WHEN {_SETTINGS['with_hours']} THEN round_even(date_diff('second', S_START_DATE_TIME, S_END_DATE_TIME) / 3600.0, 2) END AS TOTAL_HOURS,
  'COR' AS RIVER_CODE, nullif(regexp_extract(S_SITE_ID, '[A-Z]+'), '') AS SIDE_CODE, S_RIVER_MILE AS START_RM, S_GPS_ID AS STATION_ID,
  S_CREW AS CREW, S_CLIPBOARD AS CLIPBOARD, S_GEAR AS GEAR_CODE, TOTAL_CATCH, S_HABITAT AS HABITAT_CODE, S_HYDRAULIC AS HYDRAULIC_CODE,
  S_SUBSTRATE AS SUBSTRATE_CODE, S_COVER AS COVER_CODE, S_SAMPLE_NOTES AS SAMPLE_NOTES, w.TURBIDITY_NTU, w.WATER_TEMP, {TRIP} AS trip
FROM d JOIN v USING ({TRIP}, net) JOIN c USING ({TRIP}, S_SITE_ID) LEFT JOIN water w ON w.START_DATE = day""")
def _(t):
    return _hoop(t, "sample").sample


def _kept(template: str) -> str:
    """A recapture code, passed through where the trip's settings say so."""
    other = f"ELSE CASE WHEN {_SETTINGS['keep_codes']} THEN RECAP_YES_NO END"
    return template.format(other=other)


@query("trips_specimen_table_hoop", f"""WITH {_HOOP}
SELECT row_number() OVER (PARTITION BY {TRIP} ORDER BY CASE WHEN {_SETTINGS['key_by_site']} THEN SAMPLE_ID ELSE day END,
    CASE WHEN NOT {_SETTINGS['key_by_site']} THEN S_CLIPBOARD END, S_END_DATE_TIME, ID) + {_YEAR} * 10 AS ACCESS_FISH_ID,
  v.ACCESS_SAMPLE_ID, SPECIES AS SPECIES_CODE, cast(TOTAL_LENGTH AS double) AS TOTAL_LENGTH, cast(FORK_LENGTH AS double) AS FORK_LENGTH,
  cast(WEIGHT AS double) AS WEIGHT, SEX AS SEX_CODE, SEX_COND AS SEX_COND_CODE, SEX_CHAR AS SEX_CHAR_CODE,
  {_kept(jobs._CLIP)} AS FINCLIP1_RECAP, CASE WHEN {_SETTINGS['keep_codes']} THEN coalesce(FINCLIP1, '') ELSE FINCLIP1 END AS FINCLIP1,
  {_kept(jobs._TAG)} AS PITTAG_RECAP, FISH_TAG AS PITTAG, DISPOSITION AS DISPOSITION_CODE, SPECIMEN_NOTES, {TRIP} AS trip
FROM d JOIN v USING ({TRIP}, net)""")
def _(t):
    return _hoop(t, "specimen").specimen


# Trips of 1997 are held with room to spare and keep their keys; the others are new.
_HELD = 1_000_000_000


@query("trips_key_ranges", f"""WITH n AS (
  SELECT upper({TRIP}) AS trip, count(DISTINCT concat(upper(S_SITE_ID), ' ', strftime(S_START_DATE_TIME, '%Y-%m-%d %H:%M:%S'))) AS n_samples,
    count(*) AS n_specimens FROM export GROUP BY 1),
k AS (SELECT *, substr(trip, 3, 4) = '1997' AS held FROM n),
s AS (SELECT *, sum(CASE WHEN held THEN 0 ELSE n_samples END) OVER w AS a, sum(CASE WHEN held THEN 0 ELSE n_specimens END) OVER w AS b FROM k
  WINDOW w AS (ORDER BY trip ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT trip, 'electrofishing' AS gear, CASE WHEN held THEN 7 ELSE {_HELD + 7} + coalesce(a, 0) END::bigint AS samples_before,
  CASE WHEN held THEN {_HELD} ELSE n_samples END::bigint AS n_samples, CASE WHEN held THEN 7 ELSE {_HELD + 7} + coalesce(b, 0) END::bigint AS specimens_before,
  CASE WHEN held THEN {_HELD} ELSE n_specimens END::bigint AS n_specimens FROM s""")
def _(t):
    rows = _rows(t).select(TRIP, F.upper("S_SITE_ID").alias("S_SITE_ID"), "S_START_DATE_TIME")
    wanted = trips.sizes(rows.withColumn(trip.VISIT, trip.visit_key()), trip.VISIT, "electrofishing")
    held = wanted.filter("substr(trip, 3, 4) = '1997'").select(
        "trip", "gear", *[F.lit(v).cast("bigint").alias(c) for c, v in (
            ("samples_before", 7), ("n_samples", _HELD), ("specimens_before", 7), ("n_specimens", _HELD))])
    return loads.allocate(wanted, held)


# Corrections ---------------------------------------------------------------------------------

_CORRECTED = ["ID", "SAMPLE_ID", "S_SITE_ID", "S_SAMPLE_NOTES", "S_GPS_ID", "TOTAL_LENGTH", "WEIGHT", "FORK_LENGTH", "SEX"]


@query("corrections_log", """
WITH fix AS (SELECT key_value, "column" AS col, min(new_value) AS v, round, key_column FROM corrections
  WHERE "column" NOT IN ('FORK_LENGTH', 'SEX') GROUP BY ALL),
one AS (SELECT e.*, coalesce(s.v, e.S_SITE_ID) AS moved FROM export e LEFT JOIN fix s ON s.col = 'S_SITE_ID' AND s.key_value = e.SAMPLE_ID),
log AS (
  SELECT ID, f.*, CASE col WHEN 'S_SITE_ID' THEN S_SITE_ID WHEN 'S_SAMPLE_NOTES' THEN S_SAMPLE_NOTES END AS before, v AS after
  FROM export JOIN fix f ON f.key_column = 'SAMPLE_ID' AND f.key_value = SAMPLE_ID
  UNION ALL SELECT ID, f.*, concat(cast(cast(CASE col WHEN 'WEIGHT' THEN WEIGHT ELSE TOTAL_LENGTH END AS bigint) AS varchar), '.0'), concat(v, '.0')
  FROM export JOIN fix f ON f.key_column = 'ID' AND f.key_value = ID
  UNION ALL SELECT ID, f.*, S_GPS_ID, v FROM one JOIN fix f ON f.round = 2 AND f.key_value = moved)
SELECT ID, round, col AS "column", nullif(before, '.0') AS before, CASE WHEN v IS NOT NULL THEN after END AS after, key_column, key_value FROM log""")
def _(t):
    _, log = corrections.apply_logged(t.export.select(*_CORRECTED), t.corrections, "ID", CORRECTIONS_LAYOUT)
    return log.drop("overruled")


# The same field fixed by sample and by specimen: the specimen's column comes first in the alphabet.
_CLASHING = """
SELECT 1 AS round, 'SEX' AS "column", 'SAMPLE_ID' AS key_column, cast(o_orderkey AS string) AS key_value, 'U' AS new_value FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT DISTINCT 1, 'SEX', 'ID', {id}, 'X' FROM lineitem WHERE l_extendedprice > 98000"""


@query("corrections_overruled", f"""
WITH c AS ({_CLASHING.format(id=jobs.SPECIMEN_ID)})
SELECT e.ID, e.SEX AS before, coalesce(i.new_value, s.new_value) AS after, CASE WHEN i.key_value IS NOT NULL THEN 'ID' ELSE 'SAMPLE_ID' END AS key_column,
  CASE WHEN i.key_value IS NOT NULL AND s.key_value IS NOT NULL THEN 'SAMPLE_ID' ELSE '' END AS overruled
FROM export e LEFT JOIN c s ON s.key_column = 'SAMPLE_ID' AND s.key_value = e.SAMPLE_ID LEFT JOIN c i ON i.key_column = 'ID' AND i.key_value = e.ID
WHERE i.key_value IS NOT NULL OR s.key_value IS NOT NULL""")
def _(t):
    text = _CLASHING.replace('"column"', "column").replace("FROM orders", "FROM {orders}").replace("FROM lineitem", "FROM {lineitem}")
    fixes = t.spark.sql(text.replace("{id}", jobs.SPECIMEN_ID), orders=t.table("orders"), lineitem=t.table("lineitem"))
    _, log = corrections.apply_logged(t.export.select("ID", "SAMPLE_ID", "SEX"), fixes, "ID", [(1, "ID", "SEX"), (1, "SAMPLE_ID", "SEX")])
    return log.select("ID", "before", "after", "key_column", F.array_join("overruled", ",").alias("overruled"))


@query("corrections_unmatched", """
SELECT round, "column", key_column, key_value, new_value FROM corrections c
WHERE (key_column = 'SAMPLE_ID' AND key_value NOT IN (SELECT SAMPLE_ID FROM export))
   OR (key_column = 'ID' AND key_value NOT IN (SELECT ID FROM export))
   OR (key_column = 'S_SITE_ID' AND key_value NOT IN (SELECT S_SITE_ID FROM export WHERE S_SITE_ID IS NOT NULL))""")
def _(t):
    return corrections.unmatched(t.export.select(*_CORRECTED), t.corrections)
