"""Delimited text in and out.

Files are read as text under an explicit schema and then typed, so one odd value never changes
the type of a column and never loses a row; `scan_rejects` lists the values that could not be typed.
A path may be a glob or a folder: many trips are read in one scan.

`multiline` lets quoted fields hold line breaks, as notes do. A file is then read by one task, which suits
exports of a trip each; as "split" large files are read by many tasks all the same (`quoted`), and a quote must
not stand alone in a field. Without it Spark splits large files at line ends, and `scan_malformed` returns
the lines that do not fit the header.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcatch import schemas
from fieldcatch.functions.text import blanks_missing, keep_blanks, without
from fieldcatch.operators.columns import clean_header
from fieldcatch.runtime import materialise
from fieldcatch.sources import quoted


_LINE = "_malformed"
_FILE = "_file"


def _reader(spark: SparkSession, sep: str, multiline: bool):
    reader = spark.read.option("sep", sep).option("header", True).option("escape", '"')
    return reader.option("multiLine", multiline)


def _read_text(spark: SparkSession, path, sep: str, multiline: bool | str = True) -> DataFrame:
    if multiline == "split":
        return clean_header(quoted.read_text(spark, path, sep, _FILE))
    reader = _reader(spark, sep, multiline)
    header = reader.csv(path).columns
    # A stated schema makes Spark compare the header of every file with it.
    named = reader.option("enforceSchema", False).schema(schemas.as_text([(c,) for c in header]))
    return clean_header(named.csv(path).withColumn(_FILE, F.input_file_name()))


def _read_columns(spark: SparkSession, path, columns, sep: str, multiline: bool | str = True) -> DataFrame:
    return _pick(_read_text(spark, path, sep, multiline), columns, path)


def scan_malformed(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """(first_field, line): lines with too few or too many fields, read without `multiline`."""
    reader = _reader(spark, sep, False)
    names = [*reader.csv(path).columns, _LINE]
    # all fields must be parsed, or lines that lack some are not noticed
    reader = reader.option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False)
    full = reader.schema(schemas.as_text([(c,) for c in names])).csv(path)
    odd = full.filter(F.col(_LINE).isNotNull())
    return odd.select(F.col(f"`{names[0]}`").alias("first_field"), F.col(_LINE).alias("line"))


def _pick(raw: DataFrame, columns, path) -> DataFrame:
    """The named columns, whatever their order and case in the header."""
    have = {c.lower(): c for c in raw.columns}
    missing = [c[0] for c in columns if c[0].lower() not in have]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    return raw.select(*[F.col(f"`{have[c[0].lower()]}`").alias(c[0]) for c in columns], _FILE)


def _number(c: Column, kind: str) -> Column:
    """Text as a number. Whole numbers may be written with a decimal point; others are no integers."""
    if kind not in ("int", "bigint"):
        return F.trim(c).try_cast(kind)
    wide = F.trim(c).try_cast("double")
    return F.coalesce(F.trim(c).try_cast(kind), F.when(wide == F.floor(wide), wide.try_cast(kind)))


def _typed(raw: DataFrame, columns, text_rule: Callable[[Column], Column], extra: list[str] = ()) -> DataFrame:
    return raw.select(*[
        (text_rule(F.col(name)) if kind == "string" else _number(F.col(name), kind)).alias(name)
        for name, kind in columns
    ], *extra)


def _rejected(columns) -> Column:
    """What stands in columns of numbers of a row and is neither one nor missing: an array of (column, value)."""
    numeric = [(name, kind) for name, kind in columns if kind != "string"]
    return F.array_compact(F.array(*[
        F.when(_number(F.col(n), k).isNull() & ~F.trim(F.coalesce(F.col(n), F.lit(""))).isin("", "NA"),
               F.struct(F.lit(n).alias("column"), F.col(n).alias("value")))
        for n, k in numeric
    ]))


def _counted(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("r.column", "r.value").agg(F.count(F.lit(1)).alias("n"))


def scan_rejects(spark: SparkSession, path, columns, sep: str = "\t", multiline: bool | str = True) -> DataFrame:
    """(column, value, n): what stands in a column of numbers and is neither one nor missing."""
    raw = _read_columns(spark, path, columns, sep, multiline)
    return _counted(raw.select(F.explode(_rejected(columns)).alias("r")))


def scan_with_rejects(
    spark: SparkSession, path, columns, sep: str = "\t", multiline: bool | str = True
) -> tuple[DataFrame, DataFrame]:
    """`scan_export` and `scan_rejects` of one reading, both cut from a stored table; the rejects also tell one
    of the files they stand in: (column, value, n, file)."""
    raw = _read_columns(spark, path, columns, sep, multiline).withColumn("_rejects", _rejected(columns))
    typed = _typed(raw, columns, keep_blanks, ["_rejects", _FILE])
    stored = materialise(typed, "scanned")
    odd = stored.filter(F.size("_rejects") > 0).select(F.explode("_rejects").alias("r"), _FILE)
    rejects = odd.groupBy("r.column", "r.value").agg(F.count(F.lit(1)).alias("n"), F.min(_FILE).alias("file"))
    return stored.drop("_rejects", _FILE), rejects


def scan_export(spark: SparkSession, path, columns, sep: str = "\t", multiline: bool | str = True) -> DataFrame:
    """Export where a blank text field is blank and the text NA is missing."""
    return _typed(_read_columns(spark, path, columns, sep, multiline), columns, keep_blanks)


def scan_export_readr(
    spark: SparkSession, path, columns, sep: str = "\t", multiline: bool | str = True
) -> DataFrame:
    """Export where blank fields are missing and outer spaces are dropped."""
    return _typed(_read_columns(spark, path, columns, sep, multiline), columns, blanks_missing)


def scan_legacy(spark: SparkSession, path) -> DataFrame:
    """The 2019 export. Its first column is the specimen id, whatever the header calls it."""
    raw = _read_text(spark, path, "\t")
    raw = raw.withColumnRenamed(raw.columns[0], "SPECIMEN_ID")
    columns = [(source, kind) for source, _, kind in schemas.LEGACY_EXPORT]
    return _typed(_pick(raw, columns, path), columns, keep_blanks)


def scan_any(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """Every column of an export whose columns are not known beforehand, as text."""
    raw = _read_text(spark, path, sep)
    return raw.select(*[blanks_missing(F.col(f"`{c}`")).alias(c) for c in raw.columns if c != _FILE])


def scan_trips(spark: SparkSession, path, columns, sep: str = "\t", multiline: bool | str = True) -> DataFrame:
    """Many trips at once; TRIP_FILE tells the rows of the files apart."""
    raw = _read_columns(spark, path, columns, sep, multiline)
    return _typed(raw, columns, keep_blanks, [_FILE]).withColumnRenamed(_FILE, "TRIP_FILE")


def scan_sites(spark: SparkSession, path, columns=schemas.SITE_LIST) -> DataFrame:
    """Site list. Its `id` becomes `site_seq`, as the export has an `ID` of its own."""
    sites = _typed(_read_columns(spark, path, columns, ","), columns, blanks_missing)
    return sites.withColumnRenamed("id", "site_seq")


def scan_river_sites(spark: SparkSession, path) -> DataFrame:
    return tidy_river_sites(scan_sites(spark, path, schemas.RIVER_SITE_LIST))


def tidy_river_sites(sites: DataFrame) -> DataFrame:
    """Site ids without underscores, the columns named as the export's join needs them."""
    return sites.select(
        without(F.col("SiteID"), "_").alias("S_SITE_ID"),
        F.col("RiverMile_100ths").alias("start_rm"), "RiverSide", "reach", "site_seq",
    )


def scan_water(spark: SparkSession, path) -> DataFrame:
    """Daily turbidity and temperature under either of the two headers in use."""
    return _typed(canonical_water(_read_text(spark, path, ",")), schemas.WATER, blanks_missing)


def canonical_water(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(schemas.WATER_ALIASES).select(*schemas.names(schemas.WATER))


def write_delimited(
    df: DataFrame, path: str, missing: str = "", sep: str = ",", one_file: bool = False,
    partition_by: tuple[str, ...] = (), replace: bool = False, compression: str | None = None,
) -> None:
    """Write with a header; missing values as `missing` and blank text as quoted blank.

    `replace` overwrites what is there: with `partition_by` only the partitions that `df` has rows of.

    `compression` names a codec of Spark's text files, such as gzip; a compressed file is read by one task.

    `one_file` is for the hand-off of a single trip; leave it out at scale and partition by trip.
    Rows are then gathered by partition before the write, which keeps the number of files
    down; adaptive execution splits a partition that is too large for one task.
    """
    out = df.coalesce(1) if one_file else df
    if partition_by:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.option("header", True).option("sep", sep).option("nullValue", missing)
    writer = writer.option("emptyValue", '""').option("escape", '"')
    writer = writer.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic" if partition_by else "static")
    writer.csv(path)
