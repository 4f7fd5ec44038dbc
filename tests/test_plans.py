"""Small hand-written trips through whole jobs, from files to files."""

from __future__ import annotations

import glob
from dataclasses import replace
from datetime import datetime

import pytest

from fieldcatch import schemas
from fieldcatch.config import TripConfig
from fieldcatch.plans import presets, report, run, trip
from fieldcatch.runtime import stored_paths
from fieldcatch.sources import files


def table(path, columns, rows, sep="\t"):
    """Write rows given as dicts; a column left out is blank."""
    names = [c[0] for c in columns] if isinstance(columns, tuple) else columns
    lines = [sep.join(names)] + [sep.join(str(r.get(n, "")) for n in names) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8-sig")
    return str(path)


def by(df, key):
    return {r[key]: r for r in df.collect()}


@pytest.fixture
def river_sites(tmp_path):
    rows = [(1, "10.0_L", 10.0, "L"), (2, "10.5_R", 10.5, "R"), (3, "11.0_L", 11.0, "L"), (4, "12.0_L", 12.0, "L"), (5, "9.0_C", 9.0, "C")]
    return table(tmp_path / "sites.csv", schemas.RIVER_SITE_LIST,
                 [{"id": i, "SiteID": s, "RiverMile_100ths": m, "RiverSide": b, "reach": "x"} for i, s, m, b in rows], ",")


@pytest.fixture
def water(tmp_path):
    return table(tmp_path / "water.csv", ["date", "temperature", "TurbidityNTU"],
                 [{"date": "2021-04-03", "temperature": 11.5, "TurbidityNTU": 3}], ",")


def ef_row(i, sample, site, start, species, **more):
    return {"ID": i, "SAMPLE_ID": sample, "S_SITE_ID": site, "S_START_DATE_TIME": start, "SPECIES": species, "S_SAMPLE_TYPE": 96,
            "S_EF_MINUTES": 10, "S_EF_SECONDS": 5, "S_CREW": "an,ch", "S_CLIPBOARD": "b1", "S_TRIP_ID": "typo", **more}


EF_ROWS = [
    ef_row("i3", "s1", "10.0l", "04/03/2021 20:15", "RBT", FISH_TAG="3dd.1", RECAP_YES_NO="PY", SEX="U", SEX_COND="R", TOTAL_LENGTH=300),
    ef_row("i1", "s1", "10.0l", "04/03/2021 20:15", "BNT", RECAP_YES_NO="FY", SEX="F", SEX_COND="R"),
    ef_row("i2", "s1", "10.0l", "04/03/2021 20:15", "NFC", SEX="NA"),
    ef_row("i4", "s2", "10.0L", "04/04/2021 00:05", "NFC"),
    ef_row("i5", "s3", "11.0R", "04/03/2021 23:59", "", RECAP_YES_NO="ZZ", S_SAMPLE_NOTES="NA"),
    ef_row("i6", "s4", "99.9L", "junk", "RBT", S_EF_MINUTES="NA"),
]


def test_electrofishing_trip(spark, tmp_path, river_sites, water):
    export = table(tmp_path / "export.txt", schemas.ELECTROFISHING_EXPORT, EF_ROWS)
    preset = presets.Preset(
        TripConfig("GC20210403", samples_before=100, specimens_before=1000), "electrofishing",
        rounds=([("S_SITE_ID", "S_SITE_ID", [("11.0R", "11.0L")])],))
    out = run.trip_tables(spark, preset, export, river_sites, water)

    assert schemas.conforms(out.sample.select(*schemas.names(schemas.SAMPLE_ELECTROFISHING)), schemas.SAMPLE_ELECTROFISHING) == []
    assert schemas.conforms(out.specimen, schemas.SPECIMEN) == []
    sample = by(out.sample, "ACCESS_SAMPLE_ID")
    # Keys follow the text of site and start: 10.0L on two nights, 11.0L, 99.9L without a time.
    assert sorted(sample) == [101, 102, 103, 104]
    first, second, third, last = (sample[k] for k in sorted(sample))
    assert (first.DATASHEET_SAMPLE_ID, first.START_DATE, first.START_TIME, first.END_TIME) == ("10.0L", "04/03/2021", "20:15", "20:25")
    assert (first.END_DATETIME, first.EF_TOTAL_SECONDS, first.TOTAL_CATCH) == ("04/03/2021 20:25:05", 605, 2)
    assert (first.START_RM, first.END_RM, first.SIDE_CODE, first.CREW, first.TRIP_ID) == (10.0, 11.0, "L", "AN,CH", "GC20210403")
    assert (first.STATION_ID, first.GEAR_CODE, first.RIVER_CODE, first.TURBIDITY_NTU, first.WATER_TEMP) == ("S10.0L", "EL", "COR", 3.0, 11.5)
    assert (second.TOTAL_CATCH, second.START_DATE, second.TURBIDITY_NTU) == (0, "04/04/2021", None)
    assert (third.TOTAL_CATCH, third.END_DATE, third.END_TIME, third.SAMPLE_NOTES, third.END_RM) == (1, "04/04/2021", "00:09", "", 12.0)
    assert (last.DATASHEET_SAMPLE_ID, last.START_DATE, last.START_RM, last.EF_TOTAL_SECONDS, last.TOTAL_CATCH) == ("99.9L", None, None, None, 1)

    fish = by(out.specimen, "ACCESS_FISH_ID")
    assert [(k, fish[k].ACCESS_SAMPLE_ID, fish[k].SPECIES_CODE) for k in sorted(fish)] == [
        (1001, 101, "BNT"), (1002, 101, "NFC"), (1003, 101, "RBT"), (1004, 102, "NFC"), (1005, 103, ""), (1006, 104, "RBT")]
    rbt = fish[1003]
    assert (rbt.SEX_COND_CODE, rbt.PITTAG, rbt.PITTAG_RECAP, rbt.FINCLIP1_RECAP, rbt.TOTAL_LENGTH) == ("N", "3DD.1", "Y", "N", 300)
    assert (fish[1001].SEX_COND_CODE, fish[1001].PITTAG_RECAP, fish[1001].FINCLIP1_RECAP) == ("R", "N", "Y")
    assert (fish[1002].SEX_CODE, fish[1005].PITTAG_RECAP) == ("", "")


def test_written_trip_reads_back_and_feeds_the_report(spark, tmp_path, river_sites, water):
    export = table(tmp_path / "export.txt", schemas.ELECTROFISHING_EXPORT, EF_ROWS)
    preset = presets.Preset(TripConfig("GC20210403"), "electrofishing")
    before = stored_paths(spark)
    run.run_trip(spark, preset, str(tmp_path / "out"), export, river_sites, water, one_file=True)
    assert stored_paths(spark) == before
    made = {p.rsplit("/", 1)[1] for p in glob.glob(str(tmp_path / "out" / "*"))}
    assert made == {"GC20210403_sample.csv", "GC20210403_specimen.csv", "GC20210403_errorchecked.csv"}
    cfg = replace(preset.config, output_dir=str(tmp_path / "out"))
    samples, fish = run.report_tables(spark, cfg.output_path("_sample.csv"), cfg.output_path("_specimen.csv"))
    out = report.trip_report(samples, fish)
    assert by(out.samples, "ACCESS_SAMPLE_ID")[1].START_DATETIME == datetime(2021, 4, 3, 20, 15)
    assert by(out.samples, "ACCESS_SAMPLE_ID")[1].CPUE_RBT == pytest.approx(60 / 605)
    assert out.total_fish.first()[0] == 4
    assert {r.SPECIES_CODE for r in out.cpue.collect()} == set(report.SUMMARY_COLUMNS)


def test_trip_totals_agree(spark, tmp_path, river_sites):
    """Specimens = export rows times listings; catches add up to the rows that are fish; keys are dense."""
    twice = table(tmp_path / "twice.csv", schemas.RIVER_SITE_LIST, [
        {"id": 1, "SiteID": "10.0L", "RiverMile_100ths": 10.0, "RiverSide": "L", "reach": "x"},
        {"id": 2, "SiteID": "10.0L", "RiverMile_100ths": 10.1, "RiverSide": "L", "reach": "x"}], ",")
    export = table(tmp_path / "export.txt", schemas.ELECTROFISHING_EXPORT, EF_ROWS)
    preset = presets.Preset(TripConfig("GC20210403"), "electrofishing")
    out = run.trip_tables(spark, preset, export, twice)
    fish = out.specimen.collect()
    assert len(fish) == 6 + 4
    assert sorted(r.ACCESS_FISH_ID for r in fish) == list(range(1, 11))
    visits = {r.ACCESS_SAMPLE_ID: r.TOTAL_CATCH for r in out.sample.collect()}
    assert sorted(visits) == [1, 2, 3, 4]
    assert sum(visits.values()) == sum(r.SPECIES_CODE != "NFC" for r in fish) == 6


def test_backfilled_trip(spark, tmp_path):
    sites = table(tmp_path / "lf.csv", schemas.SITE_LIST, [
        {"id": 1, "rm_start": -12.55, "rm_end": -12.4, "side": "L", "S_SITE_ID": "-12.55L", "type": "monitoring"},
        {"id": 2, "rm_start": -9.0, "rm_end": -8.9, "side": "R", "S_SITE_ID": "-9R", "type": "nonnative"}], ",")
    export = table(tmp_path / "export.txt", schemas.ELECTROFISHING_EXPORT, [
        ef_row("i1", "s1", "--12.55l", "03/08/2021 22:14", "RBT"),
        ef_row("i2", "s2", "-12.55L", "03/08/2021 22:15", "RBT"),
        ef_row("i3", "s3", "slough 1a", "03/09/2021 01:00", "GSF", S_SIDE="NA"),
        ef_row("i4", "s4", "-9R", "03/09/2021 02:00", "RBT", S_SIDE="R", S_RM_START=-9),
        ef_row("i5", "s5", "slough 1b", "03/09/2021 03:00", "RBT")])
    preset = presets.PRESETS["LF20210308_electrofishing"]
    out = run.trip_tables(spark, preset, export, sites)
    got = {r.DATASHEET_SAMPLE_ID + r.START_TIME: r for r in out.sample.collect()}
    early, tie = got["-12.55L22:14"], got["-12.55L22:15"]
    assert (early.SAMPLE_TYPE, tie.SAMPLE_TYPE, got["-9R02:00"].SAMPLE_TYPE) == (97, None, 96)
    assert early.SAMPLE_NOTES.startswith("rate set incorrectly") and tie.SAMPLE_NOTES == ""
    assert (early.START_RM, early.END_RM, early.SIDE_CODE) == (-12.55, -12.4, "L")
    slough, blank = got["SLOUGH 1A01:00"], got["SLOUGH 1B03:00"]
    assert (slough.START_RM, slough.END_RM, slough.SIDE_CODE) == (-12.15, -12.15, "L")
    assert (blank.START_RM, blank.SIDE_CODE) == (-12.15, None)
    assert (got["-9R02:00"].START_RM, got["-9R02:00"].SIDE_CODE) == (None, "R")


def hoop_row(i, sample, site, start, end, species, **more):
    return {"ID": i, "SAMPLE_ID": sample, "S_SITE_ID": site, "S_START_DATE_TIME": start, "S_END_DATE_TIME": end, "SPECIES": species,
            "S_GEAR": "MHB", "S_CLIPBOARD": "b", "S_GPS_ID": "al1", "S_RIVER_MILE": "96", "S_SAMPLE_TYPE": 99, **more}


def test_hoop_trip_with_its_corrections(spark, tmp_path, water):
    export = table(tmp_path / "export.txt", schemas.HOOP_EXPORT, [
        hoop_row("i1", "s1", "34.59", "06/25/2020 16:00", "06/26/2020 08:30", "HBC", TOTAL_LENGTH="200"),
        hoop_row("i2", "s1", "34.59", "06/25/2020 16:00", "06/26/2020 08:30", "NFC"),
        hoop_row("i3", "0703_0932_16", "201.79LC", "07/01/2020 10:00", "07/03/2020 09:00", "", S_GPS_ID="x"),
        hoop_row("i4", "s4", "91.13R", "06/25/2019 16:00", "06/25/2020 09:00", "BHS", S_RIVER_MILE="96.20", S_GEAR="EL"),
        hoop_row("i5", "s5", "81.68R", "06/25/2020 16:10", "06/26/2020 09:00", "FMS", S_GPS_ID="bl053", S_GEAR="HB"),
        hoop_row("i6", "s6", "253.73R", "06/25/2020 17:10", "06/26/2020 09:10", "FMS"),
        hoop_row("ID_20200630_0844_03_986_2315cb95", "s6", "34.59R", "06/25/2020 16:00", "06/26/2020 08:31", "HBC", FORK_LENGTH="9", WEIGHT="1"),
    ])
    out = run.trip_tables(spark, presets.PRESETS["GC20200621_hoop"], export, None, water)
    rows = {r.ID: r for r in out.keyed.collect()}
    assert {i: r.S_SITE_ID for i, r in rows.items() if len(i) == 2} == {
        "i1": "34.59R", "i2": "34.59R", "i3": "202.24L", "i4": "91.16L", "i5": "81.68L", "i6": "253.73R"}
    moved = rows["i3"]
    assert (moved.S_GPS_ID, moved.S_RIVER_MILE, moved.S_START_DATE_TIME, moved.SPECIES) == ("AL125", 202.27, datetime(2020, 7, 2, 16, 23), "FMS")
    assert (rows["i4"].S_GPS_ID, rows["i4"].S_START_DATE_TIME) == ("AL0602", datetime(2020, 6, 25, 16, 0))
    assert rows["i6"].SAMPLE_ID == "s6a"
    fixed = rows["ID_20200630_0844_03_986_2315cb95"]
    assert (fixed.FORK_LENGTH, fixed.WEIGHT) == (273.0, 179.0)
    sample = {(r.DATASHEET_SAMPLE_ID, r.END_DATETIME): r for r in out.sample.collect()}
    # catch is per site: both lifts of 34.59R share three records, one of them without fish
    two = [r for (site, _), r in sample.items() if site == "34.59R"]
    assert [r.TOTAL_CATCH for r in two] == [2, 2] and len({r.ACCESS_SAMPLE_ID for r in two}) == 2
    first = sample["34.59R", datetime(2020, 6, 26, 8, 30)]
    assert (first.TOTAL_HOURS, first.END_TIME, first.SIDE_CODE, first.START_DATE) == (16.5, "08:30", "R", "06/25/2020")
    assert {r.GEAR_CODE: r.END_TIME for r in sample.values()}["EL"] == "" and {r.GEAR_CODE: r.END_TIME for r in sample.values()}["HB"] is None
    assert min(r.ACCESS_SAMPLE_ID for r in sample.values()) == 268
    assert sorted(r.ACCESS_FISH_ID for r in rows.values()) == list(range(2687, 2694))


def test_hoop_template_numbers_sites(spark, tmp_path, river_sites):
    export = table(tmp_path / "export.txt", schemas.HOOP_EXPORT, [
        hoop_row("i1", "s2", "10.5R", "10/24/2019 09:00", "10/25/2019 09:00", "FMS"),
        hoop_row("i2", "s1", "10.0l", "10/24/2019 09:10", "10/25/2019 09:10", "NFC"),
        hoop_row("i3", "s3", "10.5R", "10/26/2019 09:00", "10/27/2019 09:00", "", S_RIVER_MILE="no")])
    out = run.trip_tables(spark, presets.PRESETS["GC20191024_hoop"], export, river_sites)
    assert "TOTAL_HOURS" not in out.sample.columns
    assert {(r.ACCESS_SAMPLE_ID, r.DATASHEET_SAMPLE_ID, r.TOTAL_CATCH, r.START_RM) for r in out.sample.collect()} == {
        (1, "10.0L", 0, 96.0), (2, "10.5R", 2, 96.0), (2, "10.5R", 2, None)}
    assert {(r.ACCESS_FISH_ID, r.ACCESS_SAMPLE_ID, r.SPECIES_CODE) for r in out.specimen.collect()} == {
        (1, 1, "NFC"), (2, 2, "FMS"), (3, 2, "")}


def test_late_fixes_come_after_the_catch(spark, tmp_path):
    from fieldcatch.operators.corrections import SCHEMA
    export = table(tmp_path / "export.txt", schemas.HOOP_EXPORT, [
        hoop_row("i1", "s1", "1R", "10/24/2019 09:00", "10/25/2019 09:00", "FMS", S_GPS_ID="g")])
    rows = trip.parse_export_times(files.scan_export(spark, export, schemas.HOOP_EXPORT))
    late = spark.createDataFrame([(1, "SPECIES", "S_GPS_ID", "G", "NFC")], SCHEMA)
    out = trip.HoopTables(trip.clean_hoop(rows), TripConfig("GC20191024"), late_fixes=late)
    assert out.specimen.first().SPECIES_CODE == "NFC" and out.sample.first().TOTAL_CATCH == 1


def test_hoop_split_of_a_merged_sample(spark, tmp_path):
    export = table(tmp_path / "export.txt", schemas.HOOP_EXPORT, [
        hoop_row("i1", "1026_0930_42", "238.19R", "10/26/2020 09:00", "10/27/2020 09:00", "FMS", S_SAMPLE_TYPE=115, S_SAMPLE_NOTES="carried"),
        hoop_row("i2", "1026_0930_42", "238.30R", "10/26/2020 09:10", "10/27/2020 09:10", "FMS", S_SAMPLE_TYPE=115, S_SAMPLE_NOTES="Float is out of the water"),
        hoop_row("ID_20201027_1019_05_171_e0873e75", "x", "254.66R", "10/26/2020 09:20", "10/27/2020 09:20", "FMS")])
    out = run.trip_tables(spark, presets.PRESETS["GC20201025_hoop"], export, store=False)
    rows = {r.ID: r for r in out.cleaned.collect()}
    assert (rows["i1"].SAMPLE_ID, rows["i1"].S_SAMPLE_TYPE, rows["i1"].S_SAMPLE_NOTES) == ("1026_0930_42238.19R", 99, "")
    assert (rows["i2"].SAMPLE_ID, rows["i2"].S_SAMPLE_TYPE, rows["i2"].S_SAMPLE_NOTES) == ("1026_0930_42238.30R", 115, "Throat is out of the water")
    third = rows["ID_20201027_1019_05_171_e0873e75"]
    assert (third.SAMPLE_ID, third.S_RIVER_MILE) == ("1027_0954_15", 254.8)


def test_legacy_format(spark, tmp_path):
    names = ["X.ID"] + [c[0] for c in schemas.LEGACY_EXPORT[1:]]
    base = {"S_SITE_ID": "-4.5l", "S_RIVER_MILE": -4.456, "S_START_DATE_TIME": "03/11/2019 20:00:00", "S_SET_NUM": "5:30", "RECAP_YES_NO": "BN"}
    export = table(tmp_path / "export.txt", names, [
        {**base, "X.ID": "i1", "SPECIES": "RBT"}, {**base, "X.ID": "i2", "SPECIES": "BNT"},
        {**base, "X.ID": "i3", "S_SAMPLE_NOTES": "test"}, {**base, "X.ID": "i4", "S_SET_NUM": "61:00", "S_SAMPLE_NOTES": "ok"}])
    out = run.legacy_tables(spark, export)
    assert {r.ACCESS_FISH_ID for r in out.specimen.collect()} == {"i1", "i2", "i4"}
    got = {r.SAMPLE_NOTES: r for r in out.sample.collect()}
    assert len(got) == 2 and (got[""].EF_TOTAL_SECONDS, got["ok"].EF_TOTAL_SECONDS) == (330, None)
    assert (got[""].DATASHEET_SAMPLE_ID, got[""].START_RM, got[""].START_DATETIME) == ("-4.5L", -4.46, datetime(2019, 3, 11, 20, 0))
    assert "SAMPLE_NOTES" not in out.specimen.columns and "PITTAG_RECAP" in out.specimen.columns
    run.run_legacy(spark, export, str(tmp_path / "out"))
    site = files.scan_export(spark, str(tmp_path / "out" / "site.csv"), [("SAMPLE_NOTES", "string"), ("EF_TOTAL_SECONDS", "int"), ("WATER_TEMP", "double")], sep=",")
    assert sorted(map(tuple, site.collect())) == [("", 330, None), ("ok", None, None)]


def test_field_summary(spark, tmp_path):
    names = ["ID", "SPECIES", "SPECIES_DESC", "S_SITE_ID", "S_SAMPLE_TYPE", "S_START_DATE_TIME", "S_END_DATE_TIME", "S_SAMPLE_NOTES", "RECMOD", "UNUSED"]
    def row(i, species, site, start, kind=96):
        return {"ID": i, "SPECIES": species, "SPECIES_DESC": "d", "S_SITE_ID": site, "S_SAMPLE_TYPE": kind,
                "S_START_DATE_TIME": start, "S_END_DATE_TIME": "01/01/2018 00:01", "RECMOD": "1"}
    export = table(tmp_path / "export.txt", names, [
        row("i1", "RBT", "-4.76l", "07/15/2020 20:00"), row("i2", "BNT", "-4.76L", "07/15/2020 20:00"),
        row("i3", "RBT", "-11.72L", "07/16/2020 01:00"), row("i4", "RBT", "slough 1a", "07/16/2020 06:30"),
        row("i5", "RBT", "-1L", "07/16/2020 02:00")])
    out = run.field_tables(spark, presets.PRESETS["LF20200715_field"], export)
    assert "UNUSED" not in out.export.columns and "SPECIES_DESC" not in out.export.columns and "RECMOD" not in out.export.columns
    rows = by(out.export, "ID")
    assert {i: r.S_night for i, r in rows.items()} == {"i1": 1, "i2": 1, "i3": 2, "i4": None, "i5": 1}
    assert (rows["i4"].S_SAMPLE_TYPE, rows["i1"].S_SAMPLE_NOTES, rows["i3"].S_START_DATE_TIME) == (120, "1 BEAVER", datetime(2020, 7, 17, 1, 0))
    assert {tuple(r) for r in out.sites_per_night.collect()} == {(1, 96, 2), (2, 96, 1), (None, 120, 1)}
    assert {tuple(r) for r in out.species.collect()} == {("RBT", 4), ("BNT", 1)}
    run.write_field_export(out, str(tmp_path / "edited"))
    assert files.scan_any(spark, str(tmp_path / "edited")).count() == 5


def test_presets_are_consistent():
    for name, preset in presets.PRESETS.items():
        rows = presets.correction_rows(preset)
        assert len({r[:4] for r in rows}) == len(rows), name
        assert preset.config.year >= 2019


def test_end_miles(spark):
    rows = [("a", 1, 1.0, "L"), ("b", 2, 2.0, "R"), ("c", 3, 3.0, "L"), ("d", 4, 4.0, "C"), ("e", 5, 5.0, "R")]
    df = spark.createDataFrame(rows, "S_SITE_ID string, site_seq int, start_rm double, RiverSide string")
    assert {r.S_SITE_ID: r.end_rm for r in trip.end_miles(df).collect()} == {"a": 3.0, "b": 5.0, "c": None, "e": None}


def test_trips_loaded_together_are_kept_apart(spark):
    from fieldcatch.operators import catch, ordering, quality

    rows = spark.createDataFrame(
        [("T1", "1R", "RBT"), ("T2", "1R", "RBT"), ("T2", "2R", "NFC")], "S_TRIP_ID string, S_SITE_ID string, SPECIES string")
    got = {(r["S_TRIP_ID"], r["S_SITE_ID"]): r["TOTAL_CATCH"] for r in catch.total_catch(rows, ["S_TRIP_ID", "S_SITE_ID"]).collect()}
    assert got == {("T1", "1R"): 1, ("T2", "1R"): 1, ("T2", "2R"): 0}
    before = spark.createDataFrame([("T2", 100)], "S_TRIP_ID string, before bigint")
    keys = ordering.number_within(rows.select("S_TRIP_ID", "S_SITE_ID"), "S_TRIP_ID", ["S_SITE_ID"], "k", before)
    assert {(r[0], r[1]): r[2] for r in keys.collect()} == {("T1", "1R"): 1, ("T2", "1R"): 101, ("T2", "2R"): 102}
    from datetime import datetime
    moves = spark.createDataFrame(
        [("T1", "b", datetime(2020, 1, 1), "s1", 5.0), ("T2", "b", datetime(2020, 2, 1), "s2", 1.0)],
        "S_TRIP_ID string, S_CLIPBOARD string, S_START_DATE_TIME timestamp_ntz, SAMPLE_ID string, S_RIVER_MILE double")
    assert [r["prev_mile"] for r in quality.progression(moves).collect()] == [None, None]


def test_next_load_starts_behind_the_tables(spark):
    from fieldcatch.config import TripConfig
    from fieldcatch.plans import trip

    held = spark.createDataFrame([(7,), (9,)], "ACCESS_SAMPLE_ID bigint")
    cfg = trip.next_load(TripConfig("GC20210403", specimens_before=3), held)
    assert (cfg.samples_before, cfg.specimens_before) == (9, 3)
    assert trip.next_load(cfg, held.limit(0)).samples_before == 0
