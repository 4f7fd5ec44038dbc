"""Counts and distinct counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions.measures import length_bin
from fieldcatch.functions.text import not_blank


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def counts_descending(df: DataFrame, *keys: str) -> DataFrame:
    return counts(df, *keys).orderBy(F.desc("n"), *[F.col(k).asc_nulls_last() for k in keys])


def n_unique(c: Column) -> Column:
    """Distinct values, a missing value being one of them."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))


def distinct_per_group(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Distinct values per group, largest first. Pairs are made distinct before the groups
    are formed, so no task holds all values of a group."""
    return (
        df.groupBy(key).agg(n_unique(F.col(value)).cast("bigint").alias(out))
        .orderBy(F.desc(out), F.col(key).asc_nulls_last())
    )


def parity(df: DataFrame, left: str, right: str) -> DataFrame:
    """Do two columns hold equally many different values?"""
    both = df.agg(
        n_unique(F.col(left)).cast("bigint").alias("n_left"),
        n_unique(F.col(right)).cast("bigint").alias("n_right"),
    )
    return both.withColumn("matches", F.col("n_left") == F.col("n_right"))


def species_list(fish: DataFrame, column: str) -> DataFrame:
    code = F.col(column)
    return fish.select(column).distinct().filter(not_blank(code) & (code != config.NO_FISH))


def high_water(df: DataFrame, *keys: str) -> DataFrame:
    """Largest key in use: the offset of the next load."""
    return df.agg(*[F.max(k).cast("bigint").alias(f"max_{k}") for k in keys])


def length_frequency(fish: DataFrame, species: str, length: str, width: int = 10) -> DataFrame:
    """Length histogram of the species that have a display name."""
    name = F.lit(None).cast("string")
    for code, shown in config.SPECIES_NAMES.items():
        name = F.when(F.col(species) == code, shown).otherwise(name)
    return (
        fish.filter(F.col(species).isin(*config.SPECIES_NAMES) & F.col(length).isNotNull())
        .groupBy(name.alias("species"), length_bin(F.col(length), width).alias("bin_centre"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
