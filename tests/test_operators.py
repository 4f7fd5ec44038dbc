"""Operators against brute force, and the shape of their plans."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldcatch.operators import catch, columns, corrections, lookups, ordering, quality, summary
from fieldcatch.runtime import materialise, shared_dir


@pytest.fixture(scope="module")
def shuffled(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "b", "b", "b", None]), rng.choice([None, 1.5, 2.5, 3.5]), rng.random()) for i in range(3000)]
    pdf = pd.DataFrame(rows, columns=["id", "g", "v", "x"])
    schema = "id bigint, g string, v double, x double"
    return spark.createDataFrame(rows, schema).repartition(7), pdf


def test_number_rows_is_the_global_order(spark, shuffled):
    df, _ = shuffled
    got = ordering.number_rows(df, ["g", "v", "id"], "n", offset=100).collect()
    want = sorted(got, key=lambda r: (r.g is None, r.g or "", r.v is None, r.v or 0, r.id))
    assert [r.n for r in want] == list(range(101, 3101))


def test_dense_keys(spark, shuffled):
    df, _ = shuffled
    got = {(r.g, r.v): r.k for r in ordering.dense_keys(df, ["g", "v"], "k", 5).collect()}
    order = sorted(got, key=lambda k: (k[0] is None, k[0] or "", k[1] is None, k[1] or 0))
    assert [got[k] for k in order] == list(range(6, 6 + len(got))) and len(got) == 12


def test_neighbour_both_ways(spark, shuffled):
    df, pdf = shuffled
    back = {r.id: r.p for r in ordering.neighbour(df, ["g"], ["x", "id"], {"id": "p"}, -1).collect()}
    ahead = {r.id: r.p for r in ordering.neighbour(df, ["g"], ["x", "id"], {"id": "p"}, 1).collect()}
    for _, part in pdf.sort_values(["x", "id"]).groupby(pdf["g"].fillna("-")):
        ids = list(part["id"])
        assert [back[i] for i in ids] == [None, *ids[:-1]]
        assert [ahead[i] for i in ids] == [*ids[1:], None]


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_quantiles(spark, shuffled, groups):
    df, pdf = shuffled
    df = df.withColumn("x", F.round("x", 2))
    probs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q9": 0.93, "q10": 1.0}
    got = ordering.quantiles(df, groups, "x", probs).collect()
    parts = [(None, pdf)] if not groups else [
        (None if k == "-" else k, part) for k, part in pdf.groupby(pdf["g"].fillna("-"))]
    assert len(got) == len(parts)
    for key, part in parts:
        row = next(r for r in got if not groups or r.g == key)
        want = np.quantile(part["x"].round(2), list(probs.values()))
        assert [row[p] for p in probs] == pytest.approx(list(want))


def test_quantiles_of_one_and_missing(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), ("b", None)], "g string, v double")
    assert [tuple(r) for r in ordering.quantiles(df, ["g"], "v", {"q": 0.25}).collect()] == [("a", 3.0)]


def test_later_occurrences_with_a_hot_key(spark):
    start = datetime(2020, 1, 1)
    rows = [("hot" if i % 3 == 0 else f"t{i % 40}", None if i % 50 == 0 else start + timedelta(minutes=i % 11), f"id{i:04d}") for i in range(900)]
    df = spark.createDataFrame(rows, "tag string, at timestamp_ntz, ID string").repartition(5)
    got = {r.ID for r in quality.later_occurrences(df, "tag", ["at", "ID"]).collect()}
    first = {}
    for tag, at, i in rows:
        place = (at is None, at or start, i)
        first[tag] = min(first.get(tag, place), place)
    assert got == {i for tag, at, i in rows if (at is None, at or start, i) > first[tag]}


def test_attach_matches_missing_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "b")], "id int, k string")
    got = {r.id: r.n for r in lookups.attach(df, summary.counts(df, "k"), ["k"]).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1}


def test_hot_key_is_split_when_attached(spark):
    """With a third of the rows under one key the merge join must be split, not one long task."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000))
        rows = spark.range(0, 300000, 1, 8).select(
            "id", key.alias("K"), F.when(F.col("id") % 5 == 0, "NFC").otherwise("RBT").alias("SPECIES"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        out = catch.attach_total_catch(rows, ["K"])
        total = {r.K: r.TOTAL_CATCH for r in out.select("K", "TOTAL_CATCH").distinct().collect()}
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan
    assert total["hot"] == sum(1 for i in range(0, 300000, 3) if i % 5)


SITES = [("1.0L", 1, 1.0, 1.1, "L"), ("1.0L", 2, 1.0, 1.2, "L"), ("2.0R", 3, 2.0, 2.1, "R")]


def test_join_sites_fan_out_or_first(spark):
    sites = spark.createDataFrame(SITES, "S_SITE_ID string, site_seq int, rm_start double, rm_end double, side string")
    export = spark.createDataFrame([("f1", "1.0L"), ("f2", "2.0R"), ("f3", "9.9L")], "ID string, S_SITE_ID string")
    every = lookups.join_sites(export, sites, ["rm_end"]).collect()
    assert sorted((r.ID, r.rm_end) for r in every if r.rm_end) == [("f1", 1.1), ("f1", 1.2), ("f2", 2.1)] and len(every) == 4
    first = lookups.join_sites(export, sites, ["rm_end"], on_duplicate="first").collect()
    assert {r.ID: r.rm_end for r in first} == {"f1": 1.1, "f2": 2.1, "f3": None} and len(first) == 3
    assert [r.ID for r in lookups.unmatched_sites(export, sites).collect()] == ["f3"]
    assert [tuple(r) for r in lookups.repeated_sites(sites).collect()] == [("1.0L", 2)]


def test_corrections_rounds_missing_targets_and_snapshot(spark):
    export = spark.createDataFrame(
        [("i1", "s1", "AN,CH", 300, 50), ("i2", "s1", "AN,CH", 310, 60), ("i3", "s2", "XX", None, 70)],
        "ID string, SAMPLE_ID string, S_CREW string, TOTAL_LENGTH int, WEIGHT int")
    fixes = spark.createDataFrame([
        (1, "S_CREW", "S_CREW", "AN,CH", "AN, CH"),
        (1, "TOTAL_LENGTH", "ID", "i1", "370"),
        (1, "WEIGHT", "ID", "i2", None),
        (1, "SAMPLE_ID", "ID", "i2", "s9"),
        (2, "S_CREW", "SAMPLE_ID", "s9", "late"),
        (2, "WEIGHT", "SAMPLE_ID", "s2", "not a number"),
    ], corrections.SCHEMA)
    got = {r.ID: tuple(r)[1:] for r in corrections.apply_corrections(export, fixes).collect()}
    assert got == {"i1": ("s1", "AN, CH", 370, 50), "i2": ("s9", "late", 310, None), "i3": ("s2", "XX", None, 70)}
    refused = corrections.rejected(export, fixes).collect()
    assert [(r["column"], r["new_value"]) for r in refused] == [("WEIGHT", "not a number")]


def test_corrections_that_disagree_keep_the_old_value(spark):
    rows = spark.createDataFrame([("i1", 300.0), ("i2", 310.0)], "ID string, TOTAL_LENGTH double")
    fixes = spark.createDataFrame([
        (1, "TOTAL_LENGTH", "ID", "i1", "12.5"), (1, "TOTAL_LENGTH", "ID", "i2", "1"), (1, "TOTAL_LENGTH", "ID", "i2", None),
        (1, "NO_COLUMN", "ID", "i1", "1"),
    ], corrections.SCHEMA)
    got = {r.ID: r.TOTAL_LENGTH for r in corrections.apply_corrections(rows, fixes).collect()}
    assert got == {"i1": 12.5, "i2": 310.0}
    assert [(r["key_value"], r["n_values"]) for r in corrections.conflicts(fixes).collect()] == [("i2", 2)]
    assert [r["column"] for r in corrections.rejected(rows, fixes).collect()] == ["NO_COLUMN"]


def test_recode_keeps_other_and_missing(spark):
    df = spark.createDataFrame([("",), ("RBT",), (None,)], "SPECIES string")
    assert [r[0] for r in corrections.recode(df, "SPECIES", {"": "FMS"}).collect()] == ["FMS", "RBT", None]


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "x")], "S_A int, b_DESC string, s_c string")
    assert columns.select_by_name(df, suffix="_desc", keep=False).columns == ["S_A", "s_c"]
    assert columns.select_by_name(df, prefix="s_").columns == ["S_A", "s_c"]
    assert columns.drop_all_missing(df).columns == ["S_A", "s_c"]
    marked = spark.createDataFrame([(1,)], ["ï..ID"])
    assert columns.clean_header(marked).columns == ["ID"]
    stacked = columns.stack_sides(df.select("S_A"), df.select("S_A", "s_c"))
    assert stacked.columns == ["S_A", "s_c"] and stacked.count() == 2
    turn = columns.add_in_turn(df, {"p": F.col("S_A") + 1, "q": F.col("p") * 10}).first()
    assert (turn.p, turn.q) == (2, 20)


def test_counts_distinct_missing_and_parity(spark):
    df = spark.createDataFrame([("s1", "a"), ("s1", None), ("s2", "a"), (None, "a")], "k string, v string")
    got = [tuple(r) for r in summary.distinct_per_group(df, "k", "v", "n").collect()]
    assert got == [("s1", 2), ("s2", 1), (None, 1)]
    assert tuple(summary.parity(df, "k", "v").first()) == (3, 2, False)


FISH = [(1, "RBT"), (1, "RBT"), (1, "BNT"), (2, "NFC"), (3, None), (4, "BNT")]


def test_crosstab_keeps_samples_without_listed_species(spark):
    fish = spark.createDataFrame(FISH, "ACCESS_SAMPLE_ID int, SPECIES_CODE string")
    fixed = {r[0]: tuple(r)[1:] for r in catch.crosstab(fish, "SPECIES_CODE", ["BNT", "RBT"]).collect()}
    assert fixed == {1: (1, 2), 2: (0, 0), 3: (0, 0), 4: (1, 0)}
    found = catch.crosstab(fish, "SPECIES_CODE")
    assert found.columns == ["ACCESS_SAMPLE_ID", "BNT", "RBT"]
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == fixed


def test_rates_with_zero_effort(spark):
    counts = spark.createDataFrame([(1, 3, 2.0), (2, 3, 0.0), (3, 3, None)], "ACCESS_SAMPLE_ID int, RBT int, effort_minutes double")
    assert [r.CPUE_RBT for r in catch.per_minute(counts, ["RBT"]).orderBy("ACCESS_SAMPLE_ID").collect()] == [1.5, None, None]


def test_cpue_summary(spark):
    rows = [("RBT", 1.0), ("RBT", 2.0), ("RBT", None), ("BNT", 0.1), ("CRP", 0.0), ("CRP", 0.3)]
    got = {r.SPECIES_CODE: r for r in catch.cpue_summary(spark.createDataFrame(rows, "SPECIES_CODE string, CPUE double")).collect()}
    rbt = got["RBT"]
    assert (rbt.mean_cpue, rbt.n_sites) == (1.5, 3) and rbt.stdev == pytest.approx(0.7071067811865476)
    assert rbt.ci_95 == pytest.approx(1.959963984540054 * 0.7071067811865476 / 3 ** 0.5)
    assert (rbt.ci_low, rbt.ci_high) == (0.7, 2.3)
    assert got["BNT"].stdev is None and got["BNT"].ci_low is None
    assert got["CRP"].ci_low == 0.0


def test_quality_flags(spark):
    rows = [("a", "10.0L", 10.2), ("b", "10.0L", 10.0), ("c", "x", 10.0), ("d", "10.0", 11.0)]
    df = spark.createDataFrame(rows, "ID string, S_SITE_ID string, S_RIVER_MILE double")
    assert {r.ID: r.mile_error for r in quality.mile_discrepancy(df).collect()} == {
        "a": (10.2 - 10.0) > 0.20, "b": False, "c": False, "d": True}
    assert {r.ID for r in quality.bad_side(df).collect()} == {"c", "d"}
    fish = spark.createDataFrame([("a", "FHM", 71, None), ("b", "FHM", 60, "tag"), ("c", "FHM", 60, ""), ("d", "RBT", 400, "tag"), ("e", None, None, None)],
                                 "ID string, SPECIES string, TOTAL_LENGTH int, FISH_TAG string")
    assert {r.ID for r in quality.species_plausible(fish).filter("NOT SPECIES_CORRECT").collect()} == {"a", "b"}


def test_stored_tables_can_be_dropped(spark):
    from fieldcatch.runtime import drop_stored

    stored = materialise(spark.range(3), "test")
    path = stored.inputFiles()[0]
    assert path.startswith("file:") and drop_stored(spark) >= 1
    assert not os.path.exists(path.removeprefix("file://"))
    assert drop_stored(spark) == 0


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named


# quantiles, repeated keys, rules

def test_quantiles_of_large_and_small_groups(spark, monkeypatch):
    """Groups above and below the sketch's accuracy, ties, one value, missing values."""
    import numpy as np

    monkeypatch.setattr(ordering, "ACCURACY", 50)
    rng = np.random.default_rng(1)
    data = {"big": rng.normal(size=3000).round(3), "ties": rng.integers(0, 4, 2000).astype(float), "small": rng.random(20),
            "one": np.array([4.0]), None: rng.random(300), "edge": rng.random(50)}
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("big", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"a": 0.0, "q": 0.25, "m": 0.5, "t": 0.9, "z": 1.0}
    got = {r["g"]: r for r in ordering.quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), abs=1e-12), (g, name)
    whole = ordering.quantiles(df, [], "v", {"m": 0.5}).collect()
    assert whole[0]["m"] == pytest.approx(np.median([v for _, v in rows if v is not None]))
    assert ordering.quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0


def test_rows_of_unique_keys_are_left_out(spark):
    rows = [(f"k{i}", i) for i in range(5000)] + [("k7", -1), ("k9", -2), ("k9", -3), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = ordering.maybe_repeated(df, "k").collect()
    assert {(r["k"], r["v"]) for r in got} >= {("k7", 7), ("k7", -1), ("k9", 9), ("k9", -2), ("k9", -3), (None, 1), (None, 2)}
    assert len(got) < 20
    assert ordering.maybe_repeated(df.limit(0), "k").count() == 0


def test_rules_as_a_table(spark):
    from fieldcatch.operators import quality

    df = spark.createDataFrame([
        ("FHM", 71.0, 5.0, "", None), ("FHM", None, 5.0, "tag", "AD"), ("FHM", 70.0, None, None, ""), ("RBT", 900.0, 9.0, "t", "AD"), (None, 900.0, 9.0, "t", None),
        ("BNT", 1.0, 9.5, None, "AD"),
    ], "SPECIES string, TOTAL_LENGTH double, WEIGHT double, FISH_TAG string, FINCLIP1 string")
    rules = spark.createDataFrame([("FHM", 70.0, None, False, None), ("BNT", None, 9.0, None, False)], quality.RULES)
    out = quality.species_plausible(df, rules).collect()
    assert [(r["SPECIES"], r["RULES_BROKEN"], r["SPECIES_CORRECT"]) for r in sorted(out, key=str)] == sorted([
        ("FHM", ["length"], False), ("FHM", ["tag"], False), ("FHM", [], True), ("RBT", [], True), (None, [], True),
        ("BNT", ["weight", "clip"], False)], key=lambda x: str([r for r in out if (r["SPECIES"], r["RULES_BROKEN"]) == x[:2]][0]))


def test_conformance(spark):
    from fieldcatch.operators import quality

    rules = spark.createDataFrame([("a", "string", ["x", "y"], 1, True), ("b", "int", None, None, False), ("c", None, None, None, False)],
                                  "column string, kind string, codes array<string>, width int, required boolean")
    df = spark.createDataFrame([("x", 1), ("zz", 2), (None, 3), ("", 4)], "a string, b bigint")
    assert {tuple(r) for r in quality.conformance(df, rules).collect()} == {
        ("a", "codes", 2, "zz"), ("a", "width", 1, "zz"), ("a", "required", 2, ""), ("b", "type", 4, None), ("c", "present", 4, None)}
    good = spark.createDataFrame([("x", 1)], "a string, b int").selectExpr("a", "b", "1 AS c")
    assert quality.conformance(good, rules).count() == 0


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def test_small_sides_are_known_to_be_small_before_rows_are_dealt_out(spark):
    fish = spark.range(200).selectExpr(
        "cast(id AS string) AS ID", "CASE WHEN id % 9 = 0 THEN 'FHM' ELSE 'RBT' END AS SPECIES", "cast(50 + id AS double) AS TOTAL_LENGTH",
        "cast(45 + id AS double) AS FORK_LENGTH", "cast(9 + id * id AS double) AS WEIGHT", "'' AS FISH_TAG", "'' AS FINCLIP1")
    for df in (quality.species_plausible(fish), quality.measurement_outliers(fish)):
        plan = _planned(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    before = spark.createDataFrame([("FHM", 10), ("RBT", 20)], "SPECIES string, before bigint")
    numbered = ordering.number_within(fish, "SPECIES", ["ID"], "k", before)
    assert "SortMergeJoin" not in _planned(numbered)
    assert {(r[0], r[1]) for r in numbered.groupBy("SPECIES").agg(F.min("k"), F.max("k")).select("SPECIES", "max(k)").collect()} == {
        ("FHM", 33), ("RBT", 197)}


def test_stored_tables_are_compressed_well(spark):
    path = materialise(spark.range(1000), "test").inputFiles()[0]
    assert path.endswith(".zstd.parquet")


@pytest.mark.parametrize("few", [corrections.FEW, 0])
def test_rows_without_a_correction_pass_by_many(spark, monkeypatch, few):
    monkeypatch.setattr(corrections, "FEW", few)
    export = spark.createDataFrame(
        [(f"i{i % 50}" if i % 7 else None, f"s{i % 20}", float(i), "x" if i % 3 else None) for i in range(100)],
        "ID string, SAMPLE_ID string, WEIGHT double, SITE string")
    fixes = spark.createDataFrame([
        (1, "WEIGHT", "ID", "i3", "7.5"), (1, "WEIGHT", "ID", "i4", None), (1, "WEIGHT", "SAMPLE_ID", "s3", "9"),
        (1, "SITE", "SAMPLE_ID", "s5", "moved"), (2, "WEIGHT", "SITE", "moved", "1"), (1, "SITE", "WEIGHT", "-0.0", "zero"),
    ], corrections.SCHEMA)
    fixed, log = corrections.apply_logged(export, fixes)
    want, told = [], 0
    for r in export.collect():
        site, weight = r.SITE, r.WEIGHT
        told += (r.ID in ("i3", "i4") or r.SAMPLE_ID == "s3") + (r.SAMPLE_ID == "s5" or r.WEIGHT == 0)
        if r.SAMPLE_ID == "s3":
            weight = 9.0
        if r.ID in ("i3", "i4"):
            weight = {"i3": 7.5, "i4": None}[r.ID]
        site = "moved" if r.SAMPLE_ID == "s5" else "zero" if r.WEIGHT == 0 else site
        told += site == "moved"
        want.append((r.ID, r.SAMPLE_ID, 1.0 if site == "moved" else weight, site))
    assert sorted(map(tuple, fixed.collect()), key=str) == sorted(want, key=str) and log.count() == told
    plan = _planned(corrections.apply_corrections(export, fixes))
    assert ("Union" in plan) == (few == 0) and "SortMergeJoin" not in plan
