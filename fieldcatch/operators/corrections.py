"""Corrections held as data.

A correction row is (round, column, key_column, key_value, new_value), all text but the round:
where `key_column` equals `key_value`, `column` becomes `new_value`, which may be missing.
Rounds apply in order, so a later one may key on what an earlier one changed. Within a round every
key is compared, as a value of its column's type, with the values the round started from; should
two key columns both fix one field, the one named first in the alphabet wins. Corrections may belong to a
trip each: `by` names columns that must agree as well.

A correction whose key or new value is not of its column's type is left out, and so are all
corrections of one field that disagree: the old value stays. `rejected` and `conflicts` return them,
`unmatched` those that no row answers. `apply_logged` also returns what was changed, by what, and what else
had been asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcatch.operators.lookups import attach
from fieldcatch.operators.ordering import may_be_listed
from fieldcatch.runtime import materialise

#: Of more corrections of one key column, which no longer fit a broadcast, rows without any pass by the join.
FEW = 500_000
SCHEMA = "round int, column string, key_column string, key_value string, new_value string"


def layout(corrections: DataFrame) -> list[tuple[int, str, str]]:
    """The (round, key column, column) combinations in use: at most a few per column."""
    rows = corrections.select("round", "key_column", "column").distinct().collect()
    return sorted((r["round"], r["key_column"], r["column"]) for r in rows)


def _typed_as(value: str, column: str, types: dict[str, str]):
    """Whether the text `value` fits the type of the column whose name stands in `column`."""
    fits = F.lit(False)
    for name, kind in types.items():
        fits = F.when(F.col(column) == name, F.col(value).try_cast(kind).isNotNull()).otherwise(fits)
    return fits


def rejected(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrections of `df` that name no column or hold text that is not of the column's type."""
    types = dict(df.dtypes)
    known = F.col("column").isin(*types) & F.col("key_column").isin(*types)
    key_fits = _typed_as("key_value", "key_column", types)
    value_fits = F.col("new_value").isNull() | _typed_as("new_value", "column", types)
    return corrections.filter(~(known & key_fits & value_fits))


def _key_text(types: dict[str, str] | None):
    """The key as a value of its column's type, as text again, so that 7 and 07 are one number."""
    text = F.col("key_value")
    for name, kind in (types or {}).items():
        if kind != "string":
            number = F.col("key_value").try_cast(kind).cast("string")
            text = F.when(F.col("key_column") == name, F.coalesce(number, F.col("key_value"))).otherwise(text)
    return text.alias("key_value")


def conflicts(corrections: DataFrame, df: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Fields that one round gives several values: (round, column, key_column, key_value, n_values).

    Keys are compared as values of `df`'s columns, as `apply_corrections` does; without `df` as text.
    """
    field = [*by, "round", "column", "key_column", "key_value"]
    typed = corrections.withColumn("key_value", _key_text(dict(df.dtypes) if df is not None else None))
    distinct = typed.select(*field, "new_value").distinct()
    several = distinct.groupBy(*field).agg(F.count(F.lit(1)).alias("n_values"))
    return several.filter("n_values > 1")


def unmatched(df: DataFrame, corrections: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Corrections whose key stands in no row of `df` as it is before the first round.

    Keys that an earlier round makes are not in `df` yet; ask again with the rows that round returns.
    """
    types, out = dict(df.dtypes), None
    for key in sorted({r[0] for r in corrections.select("key_column").distinct().collect()} & set(types)):
        asked = corrections.filter(F.col("key_column") == key).withColumn("_value", F.col("key_value").try_cast(types[key]))
        held = df.select(*by, F.col(key).alias("_value")).distinct()
        lost = asked.join(held, [*by, "_value"], "left_anti").select(*corrections.columns)
        out = lost if out is None else out.unionByName(lost)
    return out if out is not None else corrections.limit(0)


def apply_corrections(
    df: DataFrame, corrections: DataFrame, used: list[tuple[int, str, str]] | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """Apply all rounds; `used` saves looking up the layout when it is known."""
    return _apply(df, corrections, used, by, None).select(*df.columns)


def apply_logged(
    df: DataFrame, corrections: DataFrame, row: str = "ID", used: list[tuple[int, str, str]] | None = None,
    by: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """The corrected rows, and the log: (row, round, column, before, after, key_column, key_value, overruled).

    Values are text. `overruled` lists the key columns whose correction of the same field gave way. A correction
    that leaves a value as it is is logged too. Rows and log are cut from one stored table.
    """
    stored = materialise(_apply(df, corrections, used, by, F.array().cast(_LOG)), "corrected")
    log = stored.select(*by, row, F.explode("_log").alias("_l")).select(*by, row, "_l.*")
    return stored.select(*df.columns), log


_LOG = ("array<struct<round:int,column:string,before:string,after:string,key_column:string,key_value:string,"
        "overruled:array<string>>>")


def _apply(df: DataFrame, corrections: DataFrame, used, by: tuple[str, ...], log) -> DataFrame:
    types = dict(df.dtypes)
    used = [u for u in sorted(used if used is not None else layout(corrections)) if {u[1], u[2]} <= set(types)]
    out = df if log is None else df.withColumn("_log", log)
    kept = out.columns
    for number in sorted({r for r, _, _ in used}):
        this_round = corrections.filter(F.col("round") == number)
        fixes: dict[str, list[str]] = {}
        asked: dict[str, DataFrame] = {}
        for key_column in sorted({k for r, k, _ in used if r == number}):
            columns = [c for r, k, c in used if r == number and k == key_column]
            per_key = (
                this_round.filter(F.col("key_column") == key_column)
                .groupBy(*by, F.col("key_value").try_cast(types[key_column]).alias("_value"))
                .agg(*[_agreed(c, types[c]).alias(f"_{key_column}_{c}") for c in columns])
                .filter(F.col("_value").isNotNull())
            )
            asked[key_column] = materialise(per_key, "fixes")  # read again, and of known size
            for c in columns:
                fixes.setdefault(c, []).append(key_column)
        out = _with_fixes(out, asked, by)
        replaced, entries = {}, []
        for c, found in fixes.items():
            value = entry = None
            for k in reversed(found):
                fix = F.col(f"_{k}_{c}")
                new = fix["new_value"].try_cast(types[c])
                value = F.when(fix.isNotNull(), new).otherwise(F.col(c) if value is None else value)
                others = F.array_compact(F.array(*[
                    F.when(F.col(f"_{o}_{c}").isNotNull(), F.lit(o)) for o in found if o > k
                ])) if found[-1] > k else F.array().cast("array<string>")
                told = F.struct(
                    F.lit(number).alias("round"), F.lit(c).alias("column"), F.col(c).cast("string").alias("before"),
                    new.cast("string").alias("after"), F.lit(k).alias("key_column"),
                    F.col(k).cast("string").alias("key_value"), others.alias("overruled"),
                )
                entry = F.when(fix.isNotNull(), told) if entry is None else F.when(fix.isNotNull(), told).otherwise(entry)
            replaced[c] = value
            entries.append(entry)
        if log is not None and entries:
            replaced["_log"] = F.concat("_log", F.array_compact(F.array(*entries)))
        out = out.withColumns(replaced).select(*kept)
    return out


def _with_fixes(rows: DataFrame, asked: dict[str, DataFrame], by: tuple[str, ...]) -> DataFrame:
    """`rows` with the fixes of their keys. `asked` holds a frame (*by, _value, fixes) for each key column.

    Few corrections are small enough for Spark to broadcast. Of many, a filter of fixed size tells which rows
    may have one; only those meet the corrections in a shuffle, all others pass by. The rows are stored for it, as
    they are read twice.
    """
    many = [k for k, fixes in asked.items() if fixes.count() > FEW]
    if many:
        told = rows
        for k in many:
            told = may_be_listed(told, k, asked[k].select("_value"), f"_may_{k}")
        may = reduce(lambda a, b: a | b, [F.col(f"_may_{k}") for k in many])
        told, may = materialise(told.select(*rows.columns, may.alias("_may")), "told"), F.col("_may")
        none = told.filter(~may).select(*rows.columns, *[
            F.lit(None).cast(f.dataType).alias(f.name) for k in many for f in asked[k].schema if f.name not in ("_value", *by)
        ])
        rows = told.filter(may).select(*rows.columns)
        for k in many:
            rows = _attached(rows, asked[k], k, by)
        rows = none.unionByName(rows)
    for k in asked:
        if k not in many:
            rows = _attached(rows, asked[k], k, by)
    return rows


def _attached(rows: DataFrame, fixes: DataFrame, key: str, by: tuple[str, ...]) -> DataFrame:
    return attach(rows.withColumn("_value", F.col(key)), fixes, [*by, "_value"]).drop("_value")


def _agreed(column: str, kind: str):
    """The one new value all usable corrections of `column` agree on, in a struct; else null."""
    value = F.col("new_value")
    usable = (F.col("column") == column) & (value.isNull() | value.try_cast(kind).isNotNull())
    new = F.when(usable, F.struct("new_value"))
    return F.when(F.min(new).eqNullSafe(F.max(new)), F.min(new))


def recode(df: DataFrame, column: str, mapping: dict[str, str | None]) -> DataFrame:
    """Replace listed values of one column; for the short typo maps of a script."""
    value = F.col(column)
    fixed = value
    for old, new in mapping.items():
        fixed = F.when(value == old, F.lit(new)).otherwise(fixed)
    return df.withColumn(column, fixed)
