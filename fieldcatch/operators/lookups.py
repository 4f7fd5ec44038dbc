"""Joins: site list, daily water table, sample attributes, totals back to rows.

No join carries a broadcast hint. Spark compares the measured size of the smaller side with
its broadcast threshold, and sorts and merges when it is larger. A merge join in which one key holds
a large part of the rows is then split by adaptive execution, for which both sides must come
straight from a shuffle of their own: see `attach`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, per_key: DataFrame, keys: list[str]) -> DataFrame:
    """Left-join `per_key` to the rows; missing keys match each other.

    The null-safe comparison is hashed on other expressions than a grouping by the same
    keys, so even where `per_key` is such a grouping it is shuffled anew (it is the small side)
    and an oversized key on the side of the rows can be split over many tasks.
    """
    renamed, on = _beside(per_key, keys)
    return rows.join(renamed, on, "left").drop(*[f"_key_{k}" for k in keys])


def _beside(per_key: DataFrame, keys: list[str]):
    """`per_key` with its keys renamed, and the null-safe condition that meets them."""
    renamed = per_key.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    return renamed, reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    )


def first_per_key(dim: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the row with the lowest `order` of each key."""
    rest = [c for c in dim.columns if c != key]
    best = F.min_by(F.struct(*rest), F.col(order)).alias("_best")
    return dim.groupBy(key).agg(best).select(key, *[f"_best.{c}" for c in rest])


def join_sites(
    export: DataFrame, sites: DataFrame, columns: list[str], on_duplicate: str = "all"
) -> DataFrame:
    """Add site columns by site id.

    A site id listed twice yields two rows per specimen, as the listed rows differ; with
    `on_duplicate="first"` only the row of the lowest site number is used.
    """
    if on_duplicate == "first":
        one = first_per_key(sites.select("S_SITE_ID", "site_seq", *columns), "S_SITE_ID", "site_seq")
        return attach(export, one.drop(*({"site_seq"} - set(columns))), ["S_SITE_ID"])
    return attach(export, sites.select("S_SITE_ID", *columns), ["S_SITE_ID"])


def repeated_sites(sites: DataFrame) -> DataFrame:
    """Site ids listed more than once, with the number of listings."""
    return sites.groupBy("S_SITE_ID").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unmatched_sites(export: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows whose site id is not on the list."""
    listed, on = _beside(sites.select("S_SITE_ID").distinct(), ["S_SITE_ID"])
    return export.join(listed, on, "left_anti")


def join_water(samples: DataFrame, water: DataFrame) -> DataFrame:
    """Add the day's turbidity and temperature by ISO start date."""
    return attach(
        samples, water.select("START_DATE", "TURBIDITY_NTU", "WATER_TEMP"), ["START_DATE"]
    )


def add_sample_columns(specimens: DataFrame, samples: DataFrame, columns: list[str]) -> DataFrame:
    """Add attributes of the sample each specimen came from."""
    return attach(specimens, samples.select("ACCESS_SAMPLE_ID", *columns), ["ACCESS_SAMPLE_ID"])
