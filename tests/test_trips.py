"""Many trips from files to files in one job, loads that are repeated, and the record of corrections."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest

from fieldcatch import schemas
from fieldcatch.config import TripConfig
from fieldcatch.operators import corrections, ordering
from fieldcatch.plans import loads, presets, run, trips
from fieldcatch.plans.presets import Preset
from tests.test_plans import ef_row, hoop_row, river_sites, table, water  # noqa: F401

OCT, APR = presets.PRESETS["GC20191024_hoop"], presets.PRESETS["GC20210403_hoop"]


@pytest.fixture
def hoop_files(tmp_path):
    (tmp_path / "in").mkdir()
    table(tmp_path / "in" / "GC20191024_hoop.txt", schemas.HOOP_EXPORT, [
        hoop_row("i1", "s1", "1r", "10/24/2019 09:00", "10/25/2019 09:00", "HBC", S_TRIP_ID="typo", S_GPS_ID="al1", RECAP_YES_NO="ZZ")])
    table(tmp_path / "in" / "GC20210403_hoop.txt", schemas.HOOP_EXPORT, [
        hoop_row("ID_20210414_1032_11_524_b8e3f7cf", "s1", "1R", "04/04/2021 09:00", "04/05/2021 09:00", "", S_GPS_ID="al1", RECAP_YES_NO="ZZ"),
        hoop_row("i2", "0404_0906_46", "2R", "04/04/2021 09:00", "04/05/2021 10:00", "NFC", S_GPS_ID="br052")])
    return str(tmp_path / "in" / "GC*_hoop.txt")


def test_two_hoop_trips_stay_apart(spark, tmp_path, hoop_files):
    run.run_trip(spark, [OCT, APR], str(tmp_path / "out"), hoop_files)
    read = lambda name: spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "out" / "hoop" / name))
    samples = {(r["trip"], r["DATASHEET_SAMPLE_ID"]): r for r in read("sample").collect()}
    assert sorted(samples) == [("GC20191024", "1R"), ("GC20210403", "103.6R"), ("GC20210403", "1R")]
    first, second = samples["GC20191024", "1R"], samples["GC20210403", "1R"]
    assert (first["TRIP_ID"], first["TOTAL_CATCH"], first["ACCESS_SAMPLE_ID"], first["TOTAL_HOURS"], first["STATION_ID"]) == ("GC20191024", 1, 1, None, "al1")
    assert (second["TRIP_ID"], second["TOTAL_CATCH"], second["ACCESS_SAMPLE_ID"], second["TOTAL_HOURS"], second["STATION_ID"]) == ("GC20210403", 1, 218, 24.0, "AL1")
    assert samples["GC20210403", "103.6R"]["START_RM"] == 9.79
    fish = {(r["trip"], r["ACCESS_FISH_ID"]): r for r in read("specimen").collect()}
    assert sorted(fish) == [("GC20191024", 1), ("GC20210403", 1738), ("GC20210403", 1739)]
    # corrections and code rules of the one trip leave the other alone
    assert (fish["GC20191024", 1]["SPECIES_CODE"], fish["GC20191024", 1]["PITTAG_RECAP"]) == ("HBC", None)
    assert (fish["GC20210403", 1738]["SPECIES_CODE"], fish["GC20210403", 1738]["PITTAG_RECAP"]) == ("HBC", "ZZ")
    # only the script of the later trip writes the corrected export
    assert {r["trip"] for r in read("errorchecked").collect()} == {"GC20210403"}


def test_one_trip_refuses_the_files_of_another(spark, hoop_files):
    with pytest.raises(ValueError, match="GC20191024"):
        run.trip_tables(spark, APR, hoop_files)
    with pytest.raises(ValueError, match="no known trip"):
        trips.tables_of(spark, [APR], hoop_files)
    with pytest.raises(ValueError, match="one gear"):
        trips.tables_of(spark, [APR, replace(APR, gear="backfilled")], hoop_files)


def test_a_trip_loaded_again_keeps_its_keys(spark, tmp_path, hoop_files):
    out = str(tmp_path / "out")
    keys = lambda: {(r["trip"], r["ACCESS_SAMPLE_ID"]) for r in spark.read.option("header", True).csv(os.path.join(out, "hoop", "sample")).collect()}
    alone = hoop_files.replace("GC*", "GC20210403")
    trips.run_trips(spark, [APR], out, alone, continue_keys=True)
    assert keys() == {("GC20210403", "1"), ("GC20210403", "2")}
    trips.run_trips(spark, [OCT, APR], out, hoop_files, continue_keys=True)
    assert keys() == {("GC20210403", "1"), ("GC20210403", "2"), ("GC20191024", "3")}
    trips.run_trips(spark, [OCT], out, hoop_files.replace("GC*", "GC20191024"), continue_keys=True)
    assert keys() == {("GC20210403", "1"), ("GC20210403", "2"), ("GC20191024", "3")}
    held = {r["trip"]: tuple(r[:4]) for r in loads.read_loads(spark, os.path.join(out, "_loads")).collect()}
    assert held == {"GC20210403": (0, 2, 0, 2), "GC20191024": (2, 1, 2, 1)}


def test_a_trip_that_outgrew_its_keys_moves_behind_all(spark):
    held = spark.createDataFrame([(0, 2, 0, 9, "A", "hoop"), (2, 5, 9, 5, "B", "hoop"), (7, 1, 14, 1, "A", "ef")], loads.LOADS)
    wanted = spark.createDataFrame([("A", "hoop", 3, 9), ("B", "hoop", 4, 5), ("C", "hoop", 2, 2), ("D", "hoop", 1, 1)],
                                   "trip string, gear string, n_samples bigint, n_specimens bigint")
    got = {r["trip"]: tuple(r[:4]) for r in loads.allocate(wanted, held).collect()}
    assert got == {"A": (8, 3, 15, 9), "B": (2, 5, 9, 5), "C": (11, 2, 24, 2), "D": (13, 1, 26, 1)}
    assert loads.allocate(wanted, held.limit(0)).orderBy("trip").first()["samples_before"] == 0


def test_electrofishing_trips_together(spark, tmp_path, river_sites, water):  # noqa: F811
    for name, rows in (
        ("GC20210403", [ef_row("i1", "s1", "10.0l", "04/03/2021 20:15", "RBT"), ef_row("i2", "s1", "10.0L", "04/03/2021 20:15", "BNT")]),
        ("GC20220403", [ef_row("i3", "s1", "9.9L", "04/03/2021 20:15", "RBT"), ef_row("i4", "s2", "10.0L", "04/03/2021 20:15", "NFC")]),
    ):
        table(tmp_path / f"{name}_ef.txt", schemas.ELECTROFISHING_EXPORT, rows)
    one = Preset(TripConfig("GC20210403", samples_before=10, specimens_before=20), "electrofishing")
    two = Preset(TripConfig("GC20220403"), "electrofishing", rounds=([("S_SITE_ID", "S_SITE_ID", [("9.9L", "11.0L")])],),
                 splits=((1, "S_SITE_ID", "10.0L", "x"),))
    out = trips.tables_of(spark, [one, two], str(tmp_path / "*_ef.txt"), river_sites, water)
    assert {(r["trip"], r["ACCESS_SAMPLE_ID"], r["DATASHEET_SAMPLE_ID"], r["TOTAL_CATCH"], r["WATER_TEMP"]) for r in out.sample.collect()} == {
        ("GC20210403", 11, "10.0L", 2, 11.5), ("GC20220403", 1, "10.0L", 0, 11.5), ("GC20220403", 2, "11.0L", 1, 11.5)}
    assert {(r["trip"], r["ACCESS_FISH_ID"], r["ACCESS_SAMPLE_ID"]) for r in out.specimen.collect()} == {
        ("GC20210403", 21, 11), ("GC20210403", 22, 11), ("GC20220403", 1, 2), ("GC20220403", 2, 1)}
    assert {r["SAMPLE_ID"] for r in out.cleaned.collect()} == {"s1", "s2x"}


def test_backfilled_trips_have_cutoffs_of_their_own(spark, tmp_path):
    sites = table(tmp_path / "lf.csv", schemas.SITE_LIST, [
        {"id": 1, "rm_start": -12.55, "rm_end": -12.4, "side": "L", "S_SITE_ID": "-12.55L", "type": "monitoring"}], ",")
    for name in ("LF20210308", "LF20220308"):
        table(tmp_path / f"{name}.txt", schemas.ELECTROFISHING_EXPORT, [ef_row("i1", "s1", "-12.55L", "03/08/2021 22:14", "RBT")])
    early = presets.PRESETS["LF20210308_electrofishing"]
    plain = Preset(TripConfig("LF20220308"), "backfilled")
    out = trips.tables_of(spark, [early, plain], str(tmp_path / "LF*.txt"), sites)
    got = {r["trip"]: (r["SAMPLE_TYPE"], r["SAMPLE_NOTES"][:8], r["START_RM"]) for r in out.sample.collect()}
    assert got == {"LF20210308": (97, "rate set", -12.55), "LF20220308": (96, "", -12.55)}


def test_numbers_within_groups_that_span_ranges(spark):
    rows = [(g, i) for g, n in (("a", 1), ("b", 500), (None, 3), ("c", 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(8)
    before = spark.createDataFrame([("b", 100), (None, 7)], "g string, before bigint")
    got = ordering.number_within(df, "g", ["i"], "k", before).collect()
    assert {(r["g"], r["i"], r["k"]) for r in got} == {(g, i, i + 1 + {"b": 100, None: 7}.get(g, 0)) for g, i in rows}
    assert dict(ordering.number_within(df, "g", ["i"], "k", before).dtypes)["k"] == "bigint"


def test_a_table_job_reads_its_export_once(spark, tmp_path, river_sites):  # noqa: F811
    """Counted by an accumulator in the reading of the export."""
    from fieldcatch.plans import trip
    from fieldcatch.sources import files

    seen = spark.sparkContext.accumulator(0)
    export = table(tmp_path / "export.txt", schemas.ELECTROFISHING_EXPORT,
                   [ef_row(f"i{i}", f"s{i % 4}", "10.0L", "04/03/2021 20:15", "RBT") for i in range(40)])
    rows = trip.parse_export_times(files.scan_export(spark, export, schemas.ELECTROFISHING_EXPORT))

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    counted = rows.mapInPandas(count, rows.schema)
    sites = trip.end_miles(files.scan_river_sites(spark, river_sites))
    out = trip.ElectrofishingTables(trip.clean_electrofishing(counted, sites), TripConfig("GC20210403"), "RiverSide")
    assert out.sample.count() == 1 and out.specimen.count() == 40 and out.keyed.count() == 40
    assert seen.value == 40


# corrections

ROWS = [("a", 7.0, "x", None), ("b", 7.5, "y", "n"), ("c", None, "y", "n")]
SCHEMA = "ID string, mile double, site string, note string"


def test_keys_are_compared_as_values(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fixes = spark.createDataFrame([
        (1, "site", "mile", "7", "p"), (1, "site", "mile", "07.0", "q"), (1, "note", "mile", "7.50", "m"), (1, "note", "mile", "far", "z"),
    ], corrections.SCHEMA)
    assert {(r["key_value"], r["n_values"]) for r in corrections.conflicts(fixes, df).collect()} == {("7.0", 2)}
    assert corrections.conflicts(fixes).count() == 0
    assert {r["ID"]: (r["site"], r["note"]) for r in corrections.apply_corrections(df, fixes).collect()} == {
        "a": ("x", None), "b": ("y", "m"), "c": ("y", "n")}
    assert [r["key_value"] for r in corrections.unmatched(df, fixes).collect()] == ["far"]
    assert corrections.unmatched(df, fixes.limit(0)).count() == 0


def test_the_log_tells_what_was_done(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    fixes = spark.createDataFrame([
        (1, "note", "ID", "a", "first"), (1, "note", "site", "x", "gave way"), (1, "mile", "ID", "b", None),
        (2, "site", "note", "first", "z"), (2, "site", "ID", "none", "q"),
    ], corrections.SCHEMA)
    fixed, log = corrections.apply_logged(df, fixes)
    assert {tuple(r) for r in fixed.collect()} == {("a", 7.0, "z", "first"), ("b", None, "y", "n"), ("c", None, "y", "n")}
    assert {(*r[:7], tuple(r["overruled"])) for r in log.collect()} == {
        ("a", 1, "note", None, "first", "ID", "a", ("site",)), ("b", 1, "mile", "7.5", None, "ID", "b", ()),
        ("a", 2, "site", "x", "z", "note", "first", ())}
    assert fixed.columns == df.columns
    same, none = corrections.apply_logged(df, fixes.limit(0))
    assert same.count() == 3 and none.count() == 0


def test_corrections_of_one_trip_leave_others_alone(spark):
    df = spark.createDataFrame([("T1", "a", "x"), ("T2", "a", "x")], "trip string, ID string, site string")
    fixes = spark.createDataFrame([("T1", 1, "site", "ID", "a", "y")], "trip string, " + corrections.SCHEMA)
    assert {tuple(r) for r in corrections.apply_corrections(df, fixes, by=("trip",)).collect()} == {("T1", "a", "y"), ("T2", "a", "x")}
    assert corrections.unmatched(df, fixes, by=("trip",)).count() == 0
