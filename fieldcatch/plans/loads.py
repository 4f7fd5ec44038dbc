"""The register of loaded trips: which keys each of them holds.

A load of a trip takes `n` keys behind its offset, for samples and for specimens. A trip that is loaded again
keeps its offsets as long as it fits into the keys it holds; if it has outgrown them, or is new, it gets keys
behind all that were ever given out, in order of trip and gear. Keys are never given out twice.

The register is a table with one row per load, (trip, gear, samples_before, n_samples, specimens_before,
n_specimens), in a folder of its own, partitioned by trip and gear: writing a load replaces its row alone.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldcatch.operators.lookups import attach
from fieldcatch.runtime import materialise

LOADS = ("samples_before bigint, n_samples bigint, specimens_before bigint, n_specimens bigint, "
         "trip string, gear string")
_KEY = ["trip", "gear"]


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """The register below `path`; empty before the first load."""
    try:
        return spark.read.schema(LOADS).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], LOADS)


def write_loads(loads: DataFrame, path: str) -> None:
    """Replace the rows of these loads; the others stay."""
    writer = loads.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*_KEY).parquet(path)


def allocate(wanted: DataFrame, held: DataFrame) -> DataFrame:
    """Offsets for (trip, gear, n_samples, n_specimens), given the register so far.

    One row per load: the running totals are over the loads of one job, not over their rows.
    """
    held = held.select(*_KEY, *[F.col(c).alias(f"_{c}") for c in (
        "samples_before", "n_samples", "specimens_before", "n_specimens")])
    most = held.agg(
        F.coalesce(F.max(F.col("_samples_before") + F.col("_n_samples")), F.lit(0)).alias("_samples"),
        F.coalesce(F.max(F.col("_specimens_before") + F.col("_n_specimens")), F.lit(0)).alias("_specimens"),
    )
    rows = attach(wanted, held, _KEY).withColumns({c: most.select(c).scalar() for c in most.columns})
    fits = F.coalesce(
        (F.col("n_samples") <= F.col("_n_samples")) & (F.col("n_specimens") <= F.col("_n_specimens")), F.lit(False)
    )
    rows = rows.withColumn("_fits", fits)
    before = Window.orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, -1)

    def placed(n: str, start: str, high: str):
        new = F.col(high) + F.coalesce(F.sum(F.when(~F.col("_fits"), F.col(n)).otherwise(F.lit(0))).over(before), F.lit(0))
        return F.when(F.col("_fits"), F.col(f"_{start}")).otherwise(new).cast("bigint").alias(start)

    def size(n: str):
        return F.when(F.col("_fits"), F.col(f"_{n}")).otherwise(F.col(n)).cast("bigint").alias(n)

    return rows.select(
        placed("n_samples", "samples_before", "_samples"), size("n_samples"),
        placed("n_specimens", "specimens_before", "_specimens"), size("n_specimens"), *_KEY,
    )


def register(wanted: DataFrame, path: str) -> DataFrame:
    """`allocate` against the register at `path`, fixed so that all tables of the job see the same offsets."""
    return materialise(allocate(wanted, read_loads(wanted.sparkSession, path)), "loads")
