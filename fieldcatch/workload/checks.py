"""Files read in splits and with their rejects, and checks driven by tables of rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldcatch.operators import quality
from fieldcatch.sources import files
from fieldcatch.workload import jobs
from fieldcatch.workload.registry import query

_NOTE = "concat('line one', chr(10), 'line \"two\"', chr(9), ID, chr(10))"


#: A file of so many rows of `scan_split` has several splits.
ROWS_PER_FILE = 8_000_000


def _in_large_files(rows, count):
    """Where `rows`, at most `count`, were written: one file as long as a task can write it, as few as that after. The
    rows are dealt out to the files, so that what computes them is not drawn into the tasks that write."""
    dealt = rows.repartition(max(1, -(-count // ROWS_PER_FILE)))
    return jobs._written(dealt, "large", missing="NA", sep="\t", compression=None)


@query("scan_split", f"""
SELECT ID, {_NOTE} AS SPECIMEN_NOTES, TOTAL_LENGTH FROM export""")
def _(t):
    """Files with line breaks in quotes, each read by many tasks."""
    note = F.concat(F.lit('line one\nline "two"\t'), F.col("ID"), F.lit("\n"))
    rows = t.export.select("ID", note.alias("SPECIMEN_NOTES"), "TOTAL_LENGTH")
    path = _in_large_files(rows, t.table("lineitem").count())
    columns = [("ID", "string"), ("SPECIMEN_NOTES", "string"), ("TOTAL_LENGTH", "double")]
    return files.scan_export(t.spark, path, columns, multiline="split")


@query("scan_with_rejects", """
WITH e AS (SELECT *, CASE WHEN l % 13 = 0 THEN 'n/a' WHEN l % 17 = 0 THEN 'about 5' END AS odd
  FROM (SELECT *, cast(TOTAL_LENGTH AS bigint) AS l FROM export))
SELECT 'rows' AS part, coalesce(SPECIES, 'none') AS name, count(*) AS n, count(CASE WHEN odd IS NULL THEN TOTAL_LENGTH END) AS n_numbers FROM e GROUP BY 2
UNION ALL SELECT 'rejects', odd, count(*), 0 FROM e WHERE odd IS NOT NULL GROUP BY 2""")
def _(t):
    length = F.col("TOTAL_LENGTH").cast("bigint")
    odd = F.when(length % 13 == 0, "n/a").when(length % 17 == 0, "about 5").otherwise(F.col("TOTAL_LENGTH").cast("string"))
    typed = t.export.select("ID", F.coalesce("SPECIES", F.lit("none")).alias("SPECIES"), odd.alias("TOTAL_LENGTH"))
    path = jobs._written(typed, "odd", missing="NA", sep="\t")
    rows, rejects = files.scan_with_rejects(
        t.spark, path, [("ID", "string"), ("SPECIES", "string"), ("TOTAL_LENGTH", "double")])
    kept = rows.groupBy("SPECIES").agg(F.count(F.lit(1)).alias("n"), F.count("TOTAL_LENGTH").alias("n_numbers"))
    return kept.select(F.lit("rows").alias("part"), F.col("SPECIES").alias("name"), "n", "n_numbers").unionByName(
        rejects.select(F.lit("rejects").alias("part"), F.col("value").alias("name"), "n", F.lit(0).cast("bigint").alias("n_numbers")))


# Limits that speak against some of the generated fish of each rule; a missing limit forbids nothing.
_RULES = [("FHM", 70.0, None, False, None), ("RBT", 400.0, 900.0, None, None), ("BNT", None, 950.0, True, False), ("HBC", None, None, None, True)]


@query("species_rules", """
WITH b AS (SELECT ID, SPECIES,
  coalesce(CASE SPECIES WHEN 'FHM' THEN TOTAL_LENGTH > 70 WHEN 'RBT' THEN TOTAL_LENGTH > 400 END, false) AS len,
  coalesce(CASE SPECIES WHEN 'RBT' THEN WEIGHT > 900 WHEN 'BNT' THEN WEIGHT > 950 END, false) AS weight,
  coalesce(SPECIES = 'FHM' AND FISH_TAG <> '', false) AS tag, coalesce(SPECIES = 'BNT' AND FINCLIP1 <> '', false) AS clip FROM export)
SELECT ID, SPECIES, concat_ws(',', CASE WHEN len THEN 'length' END, CASE WHEN weight THEN 'weight' END, CASE WHEN tag THEN 'tag' END,
  CASE WHEN clip THEN 'clip' END) AS broken, NOT (len OR weight OR tag OR clip) AS SPECIES_CORRECT FROM b""")
def _(t):
    rules = t.spark.createDataFrame(_RULES, quality.RULES)
    rows = t.export.select("ID", "SPECIES", "TOTAL_LENGTH", "WEIGHT", "FISH_TAG", "FINCLIP1")
    out = quality.species_plausible(rows, rules)
    return out.select("ID", "SPECIES", F.array_join("RULES_BROKEN", ",").alias("broken"), "SPECIES_CORRECT")


@query("table_conformance", f"""WITH {jobs._EF}, s AS ({jobs._SPECIMEN})
SELECT * FROM (
  SELECT 'SPECIES_CODE' AS "column", 'codes' AS rule, count(*) AS n_rows, max(SPECIES_CODE) AS example FROM s WHERE SPECIES_CODE NOT IN ('RBT', 'BNT', 'NFC')
  UNION ALL SELECT 'SPECIES_CODE', 'required', count(*), max(SPECIES_CODE) FROM s WHERE SPECIES_CODE IS NULL OR SPECIES_CODE = ''
  UNION ALL SELECT 'PITTAG', 'width', count(*), max(PITTAG) FROM s WHERE length(PITTAG) > 6
  UNION ALL SELECT 'TOTAL_LENGTH', 'type', count(*), NULL FROM s
  UNION ALL SELECT 'SCALES', 'present', count(*), NULL FROM s) WHERE n_rows > 0""")
def _(t):
    rules = t.spark.createDataFrame([
        ("ACCESS_FISH_ID", "bigint", None, 20, True), ("SPECIES_CODE", "string", ["RBT", "BNT", "NFC"], None, True),
        ("PITTAG", "string", None, 6, False), ("TOTAL_LENGTH", "int", None, None, False), ("SCALES", "string", None, None, False),
    ], "column string, kind string, codes array<string>, width int, required boolean")
    return quality.conformance(jobs._electrofishing(t, "specimen").specimen, rules)
