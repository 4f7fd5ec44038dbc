"""Choosing, renaming and replacing columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_by_name(df: DataFrame, prefix: str = "", suffix: str = "", keep: bool = True) -> DataFrame:
    """Keep (or drop) the columns whose name starts and ends so; case does not matter."""
    def hit(name: str) -> bool:
        low = name.lower()
        return low.startswith(prefix.lower()) and low.endswith(suffix.lower())

    return df.select(*[c for c in df.columns if hit(c) == keep])


def drop_all_missing(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all; one pass, one row to the driver."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def mutate_at(df: DataFrame, names: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({n: fn(F.col(n)) for n in names})


def mutate_ending(df: DataFrame, suffix: str, fn: Callable[[Column], Column]) -> DataFrame:
    low = suffix.lower()
    return mutate_at(df, [c for c in df.columns if c.lower().endswith(low)], fn)


def add_in_turn(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Add columns one after another, so that each may use those before it."""
    for name, value in steps.items():
        df = df.withColumn(name, value)
    return df


def clean_header(df: DataFrame) -> DataFrame:
    """Strip a byte-order mark, however it was decoded, from the first column name."""
    first = df.columns[0]
    for mark in ("﻿", "ï»¿", "ï.."):
        if first.startswith(mark):
            return df.withColumnRenamed(first, first[len(mark):])
    return df


def stack_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)
