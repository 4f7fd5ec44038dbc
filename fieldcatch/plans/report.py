"""Trip report: catch rates with confidence limits, counts, recaptures, length histogram."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions import measures, text, times
from fieldcatch.operators import catch, lookups, summary

REPORT_SPECIES = ["BNT", "RBT"]
# Names of the tables and the report.
REPORT_GROUPS = [
    "BNT<200", "BNT>350", "BNT200-350", "RBT<152", "RBT152-305", "RBT306-405", "RBT>405",
]
# How the report names the group columns.
GROUP_NAMES = {
    "BNT<200": "BNT.200", "BNT>350": "BNT.350", "BNT200-350": "BNT200.350",
    "RBT<152": "RBT.152", "RBT152-305": "RBT152.305", "RBT306-405": "RBT306.405",
    "RBT>405": "RBT.405",
}
# Names of the tables and the report.
SUMMARY_COLUMNS = ["RBT", "RBT.152", "RBT152.305", "RBT306.405", "RBT.405", "BNT"]
# Names of the tables and the report.
SAMPLE_COLUMNS = ["DATASHEET_SAMPLE_ID", "START_RM", "START_DATETIME", "START_DATE", "SAMPLE_TYPE"]


def with_measures(fish: DataFrame) -> DataFrame:
    """Add total length, condition, size class and the species-and-class group."""
    code = F.col("SPECIES_CODE")
    out = fish.withColumn(
        "TL", measures.total_length(code, F.col("TOTAL_LENGTH"), F.col("FORK_LENGTH")))
    return out.withColumns({
        "kn": measures.condition_factor(code, F.col("WEIGHT"), F.col("TL")),
        "size_class": measures.size_class(code, F.col("TL")),
    }).withColumn("group", catch.group_label(code, F.col("size_class")))


def with_times(samples: DataFrame) -> DataFrame:
    start = times.parse_report_datetime(F.col("START_DATETIME"))
    return samples.withColumn("START_DATETIME", start).withColumns({
        "START_DATE": F.col("START_DATETIME").cast("date"),
        "reach": measures.reach(F.col("START_RM")),
    })


def rates(fish: DataFrame, effort: DataFrame, column: str, values: list[str],
          names: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Counts and catch per minute per sample, one column per value."""
    counts = catch.crosstab(fish, column, values).withColumnsRenamed(names or {})
    shown = [(names or {}).get(v, v) for v in values]
    with_effort = counts.join(effort, "ACCESS_SAMPLE_ID", "left")
    return counts, catch.per_minute(with_effort, shown)


def counts_and_rates(fish: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples that have specimens, with counts and rates by species and by size class.

    One grouping of the specimens gives all counts; the rates are computed beside them.
    """
    wanted = {v: F.col("SPECIES_CODE") == v for v in REPORT_SPECIES}
    wanted |= {GROUP_NAMES[v]: F.col("group") == v for v in REPORT_GROUPS}
    counts = fish.groupBy("ACCESS_SAMPLE_ID").agg(
        *[F.count_if(rule).alias(name) for name, rule in wanted.items()])
    minutes = F.col("EF_TOTAL_SECONDS") / F.lit(60.0)
    joined = samples.join(counts, "ACCESS_SAMPLE_ID")
    return joined.select("*", *[
        F.try_divide(F.col(f"`{name}`").cast("double"), minutes).alias(f"CPUE_{name}")
        for name in wanted
    ])


@dataclass(frozen=True)
class TripReport:
    samples: DataFrame
    cpue: DataFrame
    sample_sizes: DataFrame
    fish_counts: DataFrame
    total_fish: DataFrame
    recaps: DataFrame
    lengths: DataFrame


def trip_report(samples: DataFrame, specimens: DataFrame) -> TripReport:
    """All tables of the report from the two stage-one tables."""
    fish = with_measures(specimens)
    timed = with_times(samples)
    wide = counts_and_rates(fish, timed)
    monitoring = wide.filter(F.col("SAMPLE_TYPE") == config.MONITORING)
    cpue = catch.longer(
        monitoring, ["ACCESS_SAMPLE_ID"], [f"CPUE_{c}" for c in SUMMARY_COLUMNS],
        "SPECIES_CODE", "CPUE", strip="CPUE_")
    sizes = catch.longer(monitoring, ["ACCESS_SAMPLE_ID"], SUMMARY_COLUMNS, "SPECIES_CODE", "n")
    caught = fish.filter(text.is_not(F.col("SPECIES_CODE"), config.NO_FISH))
    located = lookups.add_sample_columns(caught, timed, SAMPLE_COLUMNS)
    fish_counts = summary.counts(located, "SAMPLE_TYPE", "SPECIES_CODE")
    return TripReport(
        samples=wide,
        cpue=catch.cpue_summary(cpue),
        sample_sizes=sizes,
        fish_counts=fish_counts,
        total_fish=fish_counts.agg(F.sum("n").alias("total_fish")),
        recaps=summary.counts(located, "SPECIES_CODE", "PITTAG_RECAP"),
        lengths=summary.length_frequency(caught, "SPECIES_CODE", "TL"),
    )
