"""Operators that need one order over all rows, without putting all rows in one task.

Rows are range-partitioned by the order, sorted inside each range and written out together with
their place in it. The only thing that is ever put side by side is one row per range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcatch.operators.lookups import attach
from fieldcatch.runtime import materialise

_SLOT, _RANGE, _PLACE, _BEFORE = "_slot", "_range", "_place", "_before"
_PLACE_BITS = 33


def _place(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with the number of its range and its place within the range.

    The result is read back from a written table. The range bounds come from a sample, so
    computing them twice could cut the rows differently; once written they are fixed.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialise(ranged.withColumn(_SLOT, F.monotonically_increasing_id()), "ordered")
    return stored.withColumns({
        _RANGE: F.shiftright(_SLOT, _PLACE_BITS),
        _PLACE: F.col(_SLOT).bitwiseAND((1 << _PLACE_BITS) - 1),
    }).drop(_SLOT)


def _start_of_ranges(sizes: DataFrame) -> DataFrame:
    """Running total of `_size` before each range.

    One row per range, so never more rows than shuffle partitions: small enough for one task
    and for a broadcast, whatever the data.
    """
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        sizes.select(_RANGE, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias(_BEFORE))
    )


def number_rows(df: DataFrame, order: list[str], out: str, offset: int = 0) -> DataFrame:
    """Number rows 1, 2, 3 ... in the given order (missing values last), plus `offset`.

    End the order with a unique column: rows that compare equal share a range, and so a task.
    """
    placed = _place(df, order)
    sizes = placed.groupBy(_RANGE).agg((F.max(_PLACE) + 1).alias("_size"))
    number = (F.col(_BEFORE) + F.col(_PLACE) + 1 + offset).cast("bigint").alias(out)
    return placed.join(_start_of_ranges(sizes), _RANGE).select(*df.columns, number)


def number_within(df: DataFrame, group: str, order: list[str], out: str, before: DataFrame) -> DataFrame:
    """Number the rows of each group 1, 2, 3 ... in order, plus the group's own offset.

    `before` holds one row per group, (group, before); a group without one starts at 1. Groups lie one after
    the other in one range layout, so a group of any size spreads over many tasks. What its rows in earlier
    ranges come to is summed over one row per range and group and met by both, which no group can make a hot key.
    """
    placed = _place(df, [group, *order])
    parts = placed.groupBy(_RANGE, group).agg(F.min(_PLACE).alias("_from"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    done = parts.withColumn("_done", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    starts = materialise(attach(done, before.select(group, "before"), [group]).select(
        _RANGE, group, (F.col("_done") + F.coalesce("before", F.lit(0)) - F.col("_from") + 1).alias("_add")
    ), "starts")
    return attach(placed, starts, [_RANGE, group]).select(
        *df.columns, (F.col(_PLACE) + F.col("_add")).cast("bigint").alias(out)
    )


def dense_keys(df: DataFrame, keys: list[str], out: str, offset: int = 0) -> DataFrame:
    """One row per distinct key with its dense rank in key order, plus `offset`."""
    return number_rows(df.select(*keys).distinct(), keys, out, offset)


def neighbour(
    df: DataFrame, groups: list[str], order: list[str], values: dict[str, str], step: int
) -> DataFrame:
    """Add values of the next row of the group (`step=1`) or of the one before (`step=-1`).

    `values` maps source column to new column. The window looks along one range at a time, so
    a group of any size spreads over many tasks; the row at the far side of a range's edge comes
    from a table of one row per range.
    """
    placed = _place(df, groups + order)
    entry = F.struct(*[F.col(g).alias(f"_g_{g}") for g in groups], *[F.col(v) for v in values])
    shift, edge = (F.lead, F.min_by) if step == 1 else (F.lag, F.max_by)
    inside = Window.partitionBy(_RANGE).orderBy(_PLACE)
    edges = placed.groupBy(_RANGE).agg(edge(entry, F.col(_PLACE)).alias("_edge"))
    # one row per range, as in _start_of_ranges
    across = edges.select(_RANGE, shift("_edge").over(Window.orderBy(_RANGE)).alias("_across"))
    seen = placed.withColumn("_within", shift(entry).over(inside)).join(
        F.broadcast(across), _RANGE
    ).withColumn("_other", F.coalesce("_within", "_across"))
    same_group = reduce(
        lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"_other._g_{g}")) for g in groups], F.lit(True)
    ) & F.col("_other").isNotNull()
    return seen.select(*df.columns, *[
        F.when(same_group, F.col(f"_other.{src}")).alias(new) for src, new in values.items()
    ])


#: Groups of fewer values are ordered whole; larger ones only near the wanted positions. The sketch that tells
#: what is near is wrong by at most one part in so many.
ACCURACY = 10_000


def quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, interpolated linearly between neighbouring values.

    A mergeable sketch, reduced before the shuffle, brackets each wanted position by values four errors away on
    either side, so the position and the next one are certain to lie inside. Values below a bracket are only counted; the
    few inside are counted by value and put in order. Values are stored once and read twice.
    """
    values = materialise(df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_v")), "values")
    names, step = list(probs), 4 / ACCURACY
    edges = [min(max(p + side * step, 0.0), 1.0) for p in probs.values() for side in (-1, 1)]
    sketch = values.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("_total"), F.percentile_approx("_v", edges, ACCURACY).alias("_edges"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
    )
    whole = F.col("_total") < ACCURACY
    brackets = materialise(sketch.select(*groups, "_total", *[
        # at the ends the sketch may miss the outermost value
        F.when(whole | F.lit(edges[2 * i + k] in (0.0, 1.0)), F.col(end)).otherwise(F.col("_edges")[2 * i + k]).alias(f"_{side}_{i}")
        for i in range(len(names)) for k, (side, end) in enumerate((("lo", "_min"), ("hi", "_max")))
    ]), "brackets")
    seen = attach(values, brackets, groups) if groups else values.withColumns(
        {c: brackets.select(c).scalar() for c in brackets.columns}
    )
    # a value counts once for each position it lies below, and goes on for each it is near
    near = F.array_compact(F.array(*[
        F.when(F.col("_v") <= F.col(f"_hi_{i}"), F.struct(
            F.lit(i).alias("i"), F.when(F.col("_v") >= F.col(f"_lo_{i}"), F.col("_v")).alias("near"))) for i in range(len(names))
    ]))
    counted = seen.select(*groups, "_total", F.explode(near).alias("_c")).groupBy(*groups, "_c").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_total").alias("_total")
    ).select(*groups, "_c.i", F.col("_c.near").alias("_near"), "_n", "_total")
    # what lies below a bracket is one row of value null, which comes first
    along = Window.partitionBy(*groups, "i").orderBy(F.col("_near").asc_nulls_first())
    running = counted.withColumn("_upto", F.sum("_n").over(along)).withColumn("_from", F.col("_upto") - F.col("_n"))
    picks, results = [], []
    for i, (name, p) in enumerate(probs.items()):
        at = (F.col("_total") - 1) * F.lit(p)
        low = F.floor(at)
        for side, index in (("lo", low), ("hi", F.least(low + 1, F.col("_total") - 1))):
            holds = (F.col("i") == i) & (F.col("_from") <= index) & (index < F.col("_upto"))
            picks.append(F.max(F.when(holds, F.col("_near").cast("double"))).alias(f"_{side}_{name}"))
        picks.append(F.max(at - low).alias(f"_w_{name}"))
        lo, hi, w = (F.col(f"_{part}_{name}") for part in ("lo", "hi", "w"))
        results.append((lo + (hi - lo) * w).alias(name))
    return running.groupBy(*groups).agg(*picks).select(*groups, *results)


#: Bits of the filter that tells keys that may repeat, and of one row of it.
FILTER_BITS, ROW_BITS = 1 << 26, 1 << 15


def maybe_repeated(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key stands in two rows or more, and a few others.

    Hashes of keys are counted first, reduced before the shuffle; those met twice set a bit of a filter of fixed size
    (at most 2048 rows of 4 kB), which is sent to every task. So no row of a unique key is shuffled.
    """
    twice = rows.groupBy(F.xxhash64(key).alias("_h")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _look_up(rows, key, twice, "inner").filter("_on").select(*rows.columns)


def may_be_listed(rows: DataFrame, key: str, listed: DataFrame, flag: str) -> DataFrame:
    """`rows` with a flag that is true where the key stands in `listed`, a frame of one column of the same type, and
    for a few others. No row is shuffled: the filter is that of `maybe_repeated`."""
    hashes = listed.select(F.xxhash64(listed.columns[0]).alias("_h"))
    return _look_up(rows, key, hashes, "left").select(*rows.columns, F.coalesce("_on", F.lit(False)).alias(flag))


def _look_up(rows: DataFrame, key: str, hashes: DataFrame, how: str) -> DataFrame:
    """Whether the bit of each row's key is set in the filter of `hashes`."""
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    bits = hashes.select(F.pmod("_h", F.lit(FILTER_BITS)).alias("_p")).groupBy(F.floor(F.col("_p") / ROW_BITS).alias("_row")).agg(
        F.bitmap_construct_agg(F.col("_p") % ROW_BITS).alias("_bits")
    )
    placed = rows.withColumns({"_row": F.floor(place / ROW_BITS), "_bit": place % ROW_BITS})
    byte = F.ascii(F.decode(F.substring("_bits", (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    on = byte.bitwiseAND(F.expr("shiftleft(1, cast(_bit % 8 AS int))")) > 0
    return placed.join(F.broadcast(bits), "_row", how).withColumn("_on", on)
