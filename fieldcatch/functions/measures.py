"""Numeric rules: rounding, lengths, condition, classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcatch import config


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c.cast("double"), digits)


def significant(c: Column, digits: int = 3) -> Column:
    """Round to significant digits.

    The scaled value is divided by a whole power of ten, never multiplied by a fraction of one,
    so the result is the double nearest to the decimal that is meant.
    """
    x = c.cast("double")
    shift = F.lit(float(digits - 1)) - F.floor(F.log10(F.abs(x))).cast("double")
    up = F.pow(F.lit(10.0), shift)
    down = F.pow(F.lit(10.0), -shift)
    return (
        F.when(x == 0, F.lit(0.0))
        .when(shift >= 0, F.bround(x * up, 0) / up)
        .otherwise(F.bround(x / down, 0) * down)
    )


def right_closed(c: Column, bins) -> Column:
    """Label of the bin (low, high] that holds the value; missing outside all bins."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(bins):
        inside = c > F.lit(low)
        if high is not None:
            inside = inside & (c <= F.lit(high))
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def total_length(species: Column, total: Column, fork: Column) -> Column:
    """Measured total length, else the species' estimate from fork length."""
    estimate = F.lit(None).cast("double")
    for code, (intercept, slope) in config.LENGTH_COEFFICIENTS.items():
        estimate = F.when(
            species == code, round_half_even(F.lit(intercept) + F.lit(slope) * fork)
        ).otherwise(estimate)
    return F.coalesce(total.cast("double"), estimate)


def condition_factor(species: Column, weight: Column, length: Column) -> Column:
    """Relative condition of the one species it is defined for; missing without a length."""
    expected = F.pow(
        F.lit(10.0),
        F.lit(config.CONDITION_INTERCEPT) + F.lit(config.CONDITION_SLOPE) * F.log10(length),
    )
    return F.when((species == config.CONDITION_SPECIES) & (length > 0), weight / expected)


def size_class(species: Column, length: Column) -> Column:
    label = F.lit(None).cast("string")
    for code, bins in config.SIZE_CLASSES.items():
        label = F.when(species == code, right_closed(length, bins)).otherwise(label)
    return label


def reach(start_mile: Column) -> Column:
    return right_closed(start_mile, config.REACHES)


def length_gap(total: Column, fork: Column) -> Column:
    return total - fork


def gap_flag(gap: Column, absolute: bool = False) -> Column:
    """`error` when total length exceeds fork length by the limit or more; missing is `ok`."""
    size = F.abs(gap) if absolute else gap
    return F.when(size >= config.LENGTH_GAP_LIMIT, "error").otherwise("ok")


def length_bin(length: Column, width: int = 10) -> Column:
    """Centre of the histogram bin (centre - width/2, centre + width/2]."""
    return (F.ceil((length - width / 2) / width) * width).cast("bigint")
