"""Catch totals, crosstabs and catch per unit effort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions.codes import caught
from fieldcatch.functions.measures import significant
from fieldcatch.operators.lookups import attach


#: A crosstab has at most so many columns; its values are looked up in a first, bounded pass.
MOST_COLUMNS = 500


def total_catch(export: DataFrame, keys: list[str]) -> DataFrame:
    """Fish per visit; the row that says none were caught counts zero."""
    return export.groupBy(*keys).agg(F.sum(caught(F.col("SPECIES"))).alias("TOTAL_CATCH"))


def attach_total_catch(export: DataFrame, keys: list[str]) -> DataFrame:
    return attach(export, total_catch(export, keys), keys)


def group_label(species: Column, size_class: Column) -> Column:
    return F.concat(species, F.coalesce(size_class, F.lit("NA")))


def counts_per_sample(fish: DataFrame, column: str) -> DataFrame:
    """Fish per sample and species (or group), long form."""
    return fish.groupBy("ACCESS_SAMPLE_ID", column).agg(F.count(F.lit(1)).alias("n"))


def crosstab(fish: DataFrame, column: str, values: list[str] | None = None) -> DataFrame:
    """One row per sample, one column per value, zero where there is none.

    `values` fixes the columns, and leaving a value out drops its column; without it the
    values present are used, but for the one that says no fish was caught. The column of the
    blank value is called `blank`. More than `MOST_COLUMNS` different values are refused.
    """
    if values is None:
        found = fish.select(column).distinct().limit(MOST_COLUMNS + 1).collect()
        if len(found) > MOST_COLUMNS:
            raise ValueError(f"{column} has more than {MOST_COLUMNS} values")
        none = (None, config.NO_FISH, config.NO_FISH + "NA")
        values = sorted(r[0] for r in found if r[0] not in none)
    wide = fish.groupBy("ACCESS_SAMPLE_ID").pivot(column, values).count().na.fill(0)
    return wide.toDF("ACCESS_SAMPLE_ID", *[v or "blank" for v in values])


def effort_minutes(samples: DataFrame) -> DataFrame:
    return samples.select(
        "ACCESS_SAMPLE_ID", (F.col("EF_TOTAL_SECONDS") / F.lit(60.0)).alias("effort_minutes")
    )


def per_minute(counts: DataFrame, columns: list[str], prefix: str = "CPUE_") -> DataFrame:
    """Counts divided by `effort_minutes`; missing where the effort is zero or missing."""
    rates = [
        F.try_divide(F.col(f"`{c}`").cast("double"), F.col("effort_minutes")).alias(prefix + c)
        for c in columns
    ]
    return counts.select("ACCESS_SAMPLE_ID", *rates)


def longer(wide: DataFrame, ids: list[str], columns: list[str], name: str, value: str,
           strip: str = "") -> DataFrame:
    """Columns to rows; `strip` is removed from the names."""
    long = wide.unpivot(ids, [F.col(f"`{c}`") for c in columns], name, value)
    return long.withColumn(name, F.replace(F.col(name), F.lit(strip), F.lit(""))) if strip else long


def cpue_summary(cpue: DataFrame) -> DataFrame:
    """Mean catch rate per species with its 95 % confidence interval.

    The interval is put around the rounded mean. `n_sites` counts missing rates too, mean
    and deviation do not.
    """
    base = cpue.groupBy("SPECIES_CODE").agg(
        significant(F.avg("CPUE")).alias("mean_cpue"),
        F.count(F.lit(1)).alias("n_sites"),
        F.stddev_samp("CPUE").alias("stdev"),
    )
    half = F.lit(config.NORMAL_975) * F.col("stdev") / F.sqrt(F.col("n_sites"))
    low = significant(F.col("mean_cpue") - F.col("ci_95"))
    return (
        base.withColumn("ci_95", half)
        .withColumn("ci_low", F.when(low < 0, F.lit(0.0)).otherwise(low))
        .withColumn("ci_high", significant(F.col("mean_cpue") + F.col("ci_95")))
    )
