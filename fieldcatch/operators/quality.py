"""Checks that the scripts left to the eye, as tables of flagged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions.measures import gap_flag, length_gap
from fieldcatch.functions.text import first_capitals, is_in, not_blank, number_in
from fieldcatch.functions.times import hours_between
from fieldcatch.operators.lookups import attach
from fieldcatch.operators.ordering import maybe_repeated, neighbour, quantiles
from fieldcatch.runtime import materialise


def later_occurrences(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows that repeat a key seen earlier in the given order (missing values last).

    Only rows of keys that repeat are looked at. Every one but the first is later, so each key needs only
    the place of its first row: a minimum, which is reduced before the shuffle.
    """
    place = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    marked = materialise(maybe_repeated(rows, key), "repeated").withColumn("_place", place)
    first = (
        marked.groupBy(key)
        .agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1").drop("_n")
    )
    return attach(marked, first, [key]).filter("_place > _first").drop("_place", "_first")


def duplicate_tags(export: DataFrame) -> DataFrame:
    """Later records of a tag; a fish may be caught twice, so these want a look."""
    tagged = export.filter(not_blank(F.col("FISH_TAG")))
    return later_occurrences(tagged, "FISH_TAG", ["S_START_DATE_TIME", "ID"])


def mile_discrepancy(export: DataFrame) -> DataFrame:
    """Difference between the recorded mile and the mile in the site id, and its flag."""
    diff = F.col("S_RIVER_MILE") - number_in(F.col("S_SITE_ID"))
    return export.withColumn("diff", diff).withColumn(
        "mile_error", F.coalesce(F.abs("diff") > config.MILE_TOLERANCE, F.lit(False))
    )


def length_outliers(export: DataFrame, absolute: bool = False) -> DataFrame:
    gap = length_gap(F.col("TOTAL_LENGTH"), F.col("FORK_LENGTH"))
    return export.withColumn("total_minus_fork", gap).withColumn(
        "error", gap_flag(F.col("total_minus_fork"), absolute)
    )


def effort_anomalies(export: DataFrame) -> DataFrame:
    """Sets that end before they start or last more than a day."""
    hours = hours_between(F.col("S_START_DATE_TIME"), F.col("S_END_DATE_TIME"))
    return export.withColumn("EFFORT_HOURS", hours).filter(
        (F.col("EFFORT_HOURS") < 0) | (F.col("EFFORT_HOURS") > config.MAX_SET_HOURS)
    )


def effort_summary(export: DataFrame) -> DataFrame:
    """Minimum, quartiles, mean, maximum and missing count of hoop-net hours; the export is read once."""
    hours = hours_between(F.col("S_START_DATE_TIME"), F.col("S_END_DATE_TIME"))
    nets = materialise(export.filter(F.col("S_GEAR").isin(*config.HOOP_GEARS)).select(hours.alias("h")), "hours")
    plain = nets.agg(
        F.min("h").alias("min_hours"), F.avg("h").alias("mean_hours"),
        F.max("h").alias("max_hours"), F.count_if(F.col("h").isNull()).alias("n_missing"),
    )
    quarts = quantiles(nets, [], "h", {"q1_hours": 0.25, "median_hours": 0.5, "q3_hours": 0.75})
    return plain.select("*", *[quarts.select(c).scalar().alias(c) for c in quarts.columns])


def bad_side(export: DataFrame) -> DataFrame:
    """Rows whose site id does not yield left or right."""
    side = first_capitals(F.col("S_SITE_ID"))
    return export.withColumn("S_SIDE", side).filter(~is_in(F.col("S_SIDE"), ("L", "R")))


def progression(samples: DataFrame) -> DataFrame:
    """Does each boat move downstream as time passes?

    `samples` needs S_CLIPBOARD, S_START_DATE_TIME, SAMPLE_ID and S_RIVER_MILE; trips are told
    apart by S_TRIP_ID where there is one.
    """
    groups = [c for c in ("S_TRIP_ID", "S_CLIPBOARD") if c in samples.columns]
    before = {"S_RIVER_MILE": "prev_mile", "S_START_DATE_TIME": "prev_time"}
    with_prev = neighbour(
        samples, groups, ["S_START_DATE_TIME", "SAMPLE_ID", "S_RIVER_MILE"], before, step=-1
    )
    return with_prev.withColumn(
        "upstream_move", F.coalesce(F.col("S_RIVER_MILE") < F.col("prev_mile"), F.lit(False))
    )


def measurement_outliers(export: DataFrame, digits: int = 6) -> DataFrame:
    """Rows outside the species' quartile fences of TL / FL, W / TL^3 or W / FL^3.

    Ratios and fences are rounded, so that equal measurements compare equal.
    """
    tl, fl, w = (F.col(c).cast("double") for c in ("TOTAL_LENGTH", "FORK_LENGTH", "WEIGHT"))
    ratios = materialise(export.withColumns({
        "length_ratio": F.round(F.try_divide(tl, fl), digits),
        "weight_ratio": F.round(F.try_divide(w * 1e6, tl * tl * tl), digits),
        "fork_weight_ratio": F.round(F.try_divide(w * 1e6, fl * fl * fl), digits),
    }), "ratios")
    # All ratios go through one pass, told apart by name; only their sketches and the few values near the
    # quartiles are shuffled.
    names = ("length_ratio", "weight_ratio", "fork_weight_ratio")
    long = ratios.select("SPECIES", *names).unpivot("SPECIES", list(names), "_ratio", "_value")
    q = quantiles(long, ["SPECIES", "_ratio"], "_value", {"_q1": 0.25, "_q3": 0.75})
    reach = 1.5 * (F.col("_q3") - F.col("_q1"))

    def fence(name: str, edge) -> Column:
        return F.max(F.when(F.col("_ratio") == name, F.round(edge, digits)))

    fences = materialise(q.groupBy("SPECIES").agg(*[
        fence(n, edge).alias(f"_{side}_{n}")
        for n in names for side, edge in (("low", F.col("_q1") - reach), ("high", F.col("_q3") + reach))
    ]), "fences")
    flags = {
        f"{n}_outlier": F.coalesce((F.col(n) < F.col(f"_low_{n}")) | (F.col(n) > F.col(f"_high_{n}")), F.lit(False))
        for n in names
    }
    out = attach(ratios, fences, ["SPECIES"]).withColumns(flags)
    return out.select(*ratios.columns, *flags).filter(" OR ".join(flags))


RULES = "SPECIES string, max_length double, max_weight double, tag_allowed boolean, clip_allowed boolean"


def plausibility_rules(spark, rules=config.PLAUSIBLE) -> DataFrame:
    """The fixed rules as a table. A missing limit or permission forbids nothing."""
    return spark.createDataFrame([(s, float(length), None, tag, None) for s, length, tag in rules], RULES)


def species_plausible(export: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """Do length, weight, tag and fin clip make sense for the species?

    `rules` is a table with a row per species, (SPECIES, max_length, max_weight, tag_allowed, clip_allowed); it is
    joined, so there may be any number. RULES_BROKEN names what speaks against a row, SPECIES_CORRECT is true
    where nothing does, as for species without a rule.
    """
    given = rules if rules is not None else plausibility_rules(export.sparkSession)
    # stored, so that Spark knows how small it is and does not deal all rows out by their few species first
    named_rule = materialise(given.select("SPECIES", F.struct(*[c for c in given.columns if c != "SPECIES"]).alias("_rule")), "rules")
    told = attach(export, named_rule, ["SPECIES"])
    rule = F.col("_rule")

    def text(column: str) -> Column:
        return not_blank(F.col(column)) if column in export.columns else F.lit(False)

    def above(column: str, limit: str) -> Column:
        return F.col(column) > rule[limit] if column in export.columns else F.lit(False)

    broken = {
        "length": above("TOTAL_LENGTH", "max_length"), "weight": above("WEIGHT", "max_weight"),
        "tag": ~rule["tag_allowed"] & text("FISH_TAG"), "clip": ~rule["clip_allowed"] & text("FINCLIP1"),
    }
    named = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in broken.items()]))
    return told.withColumn("RULES_BROKEN", named).withColumn("SPECIES_CORRECT", F.size("RULES_BROKEN") == 0).drop("_rule")


def conformance(table: DataFrame, rules: DataFrame) -> DataFrame:
    """(column, rule, n_rows, example): how a table breaks the rules of its target, one row per broken rule.

    `rules` has (column, kind, codes, width, required): the type's name, the values allowed, the longest text,
    whether a value must be there; a null asks for nothing. A column that is missing or of another type breaks
    `present` or `type` on every row. All rules are checked in one aggregate over the table.
    """
    have, checks = dict(table.dtypes), []
    fixed = [F.count(F.lit(1)).alias("_all")]
    for r in rules.collect():  # as many as the target has columns
        name, c = r["column"], F.col(f"`{r['column']}`") if r["column"] in have else None
        if c is None or (r["kind"] and have[name] != r["kind"]):
            checks.append((name, "present" if c is None else "type", None))
            continue
        text = c.cast("string")
        if r["codes"] is not None:
            checks.append((name, "codes", ~text.isin(*r["codes"])))
        if r["width"] is not None:
            checks.append((name, "width", F.length(text) > r["width"]))
        if r["required"]:
            checks.append((name, "required", c.isNull() | (text == "")))
    for i, (name, _, wrong) in enumerate(checks):
        if wrong is not None:
            fixed += [F.count_if(wrong).alias(f"_n{i}"), F.max(F.when(wrong, F.col(f"`{name}`").cast("string"))).alias(f"_e{i}")]
    seen = table.agg(*fixed)
    found = F.array(*[F.struct(
        F.lit(name).alias("column"), F.lit(rule).alias("rule"),
        (F.col("_all") if wrong is None else F.col(f"_n{i}")).alias("n_rows"),
        (F.lit(None).cast("string") if wrong is None else F.col(f"_e{i}")).alias("example"),
    ) for i, (name, rule, wrong) in enumerate(checks)])
    empty = F.array().cast("array<struct<column:string,rule:string,n_rows:bigint,example:string>>")
    return seen.select(F.explode(found if checks else empty).alias("_r")).select("_r.*").filter("n_rows > 0")
