"""Edge rows of every column function."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldcatch import config
from fieldcatch.functions import codes, measures, text, times


def values(spark, rows, schema, *exprs):
    out = spark.createDataFrame(rows, schema).select(*exprs).collect()
    return [tuple(r) if len(exprs) > 1 else r[0] for r in out]


def test_blank_and_missing_text(spark):
    rows = [("",), ("NA",), (None,), (" a ",)]
    assert values(spark, rows, "c string", text.keep_blanks(F.col("c"))) == ["", None, "", " a "]
    assert values(spark, rows, "c string", text.blanks_missing(F.col("c"))) == [None, None, None, "a"]


def test_site_id_parts(spark):
    rows = [("218.17L",), ("-12.15L",), ("34.59",), ("SLOUGH 1A",), ("x",), (None,)]
    got = values(spark, rows, "c string", text.number_in(F.col("c")), text.first_capitals(F.col("c")))
    assert got == [(218.17, "L"), (-12.15, "L"), (34.59, None), (1.0, "SLOUGH"), (None, None), (None, None)]


def test_paste_writes_missing_as_text(spark):
    rows = [("a", None), (None, None), ("", "b")]
    got = values(spark, rows, "a string, b string", text.paste(F.col("a"), F.col("b")))
    assert got == ["a NA", "NA NA", " b"]


def test_membership_and_exclusion_with_missing(spark):
    rows = [("a",), ("b",), (None,)]
    got = values(spark, rows, "c string", text.is_in(F.col("c"), ("a",)), text.is_not(F.col("c"), "a"))
    assert got == [(True, False), (False, True), (False, True)]


def test_parse_times(spark):
    rows = [("3/8/2021 7:05",), ("03/08/2021 07:05:30",), ("03/08/2021 07:05 late",), ("13/01/2021 07:05",),
            ("02/30/2021 07:05",), ("",), (None,)]
    minute, second = datetime(2021, 3, 8, 7, 5), datetime(2021, 3, 8, 7, 5, 30)
    got = values(spark, rows, "c string", times.parse_minute(F.col("c")), times.parse_second(F.col("c")))
    assert got == [(minute, None), (minute, second), (minute, None), (None, None), (None, None), (None, None), (None, None)]


def test_wall_clock_survives_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on this day
        at = times.parse_minute(F.col("c"))
        got = values(spark, [("03/14/2021 02:30",)], "c string", at, times.clock(at), times.us_datetime(at),
                     times.hours_between(at, times.plus_days(at, 1)), times.iso_text(at))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(datetime(2021, 3, 14, 2, 30), "02:30", "03/14/2021 02:30:00", 24.0, "2021-03-14 02:30:00")]


def test_report_datetime_forms(spark):
    rows = [("03/08/2021 22:15:00",), ("2021-03-08 22:15:00",), ("junk",)]
    at = datetime(2021, 3, 8, 22, 15)
    assert values(spark, rows, "c string", times.parse_report_datetime(F.col("c"))) == [at, at, None]


def test_trip_date(spark):
    rows = [("LF20200715",), ("LF2020",), ("LF20201301",)]
    assert values(spark, rows, "c string", times.trip_date(F.col("c"))) == [date(2020, 7, 15), None, None]


@pytest.mark.parametrize("hour, night", [(5, 1), (6, None), (7, 2), (23, 2), (0, 1)])
def test_sampling_night(spark, hour, night):
    rows = [(datetime(2020, 7, 16, hour, 30),)]
    first = F.lit(date(2020, 7, 15))
    assert values(spark, rows, "t timestamp_ntz", times.sampling_night(F.col("t"), first)) == [night]


def test_cutoff_and_year_repair(spark):
    cut = datetime(2021, 3, 8, 22, 15)
    rows = [(datetime(2021, 3, 8, 22, 14),), (cut,), (datetime(2021, 3, 8, 22, 16),), (None,)]
    got = values(spark, rows, "t timestamp_ntz", times.type_by_cutoff(F.col("t"), cut, 97, 96))
    assert got == [97, None, 96, None]
    rows = [(datetime(2019, 6, 25, 8, 0),), (datetime(2020, 6, 25, 8, 0),), (None,)]
    got = values(spark, rows, "t timestamp_ntz", times.repair_year(F.col("t"), datetime(2020, 1, 1, 1, 1, 1)))
    assert got == [datetime(2020, 6, 25, 8, 0), datetime(2020, 6, 25, 8, 0), None]


def test_elapsed_and_added_time(spark):
    rows = [(datetime(2020, 1, 1, 10, 0), datetime(2020, 1, 1, 8, 30))]
    got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", times.hours_between(F.col("a"), F.col("b")),
                 times.plus_seconds(F.col("a"), F.lit(90)), times.clock(times.plus_days(F.col("a"), 1)))
    assert got == [(-1.5, datetime(2020, 1, 1, 10, 1, 30), "10:00")]


def test_mmss(spark):
    rows = [("5:30",), ("59:59",), ("60:00",), ("junk",), (None,)]
    assert values(spark, rows, "c string", times.mmss_seconds(F.col("c"))) == [330, 3599, None, None, None]


def test_effort_seconds_needs_both(spark):
    rows = [(2, 5), (None, 5), (2, None)]
    assert values(spark, rows, "m int, s int", times.effort_seconds(F.col("m"), F.col("s"))) == [125, None, None]


def test_midnight_keeps_its_clock(spark):
    rows = [(datetime(2020, 1, 2),)]
    got = values(spark, rows, "t timestamp_ntz", times.clock(F.col("t")), times.us_date(F.col("t")), times.us_datetime(F.col("t")))
    assert got == [("00:00", "01/02/2020", "01/02/2020 00:00:00")]


def test_rounding(spark):
    rows = [(0.5,), (1.5,), (2.5,), (-2.5,), (None,)]
    assert values(spark, rows, "x double", measures.round_half_even(F.col("x"))) == [0.0, 2.0, 2.0, -2.0, None]
    rows = [(0.0,), (1.125,), (123456.0,), (0.00123456,), (-7.8912,), (999.9,), (None,)]
    got = values(spark, rows, "x double", measures.significant(F.col("x")))
    assert got == [0.0, 1.12, 123000.0, 0.00123, -7.89, 1000.0, None]


def test_size_class_edges(spark):
    rows = [("RBT", x) for x in (0.0, 1.0, 151.0, 152.0, 305.0, 306.0, 405.0, 406.0)]
    rows += [("BNT", x) for x in (200.0, 201.0, 350.0, 351.0)] + [("CRP", 100.0), ("RBT", None), (None, 100.0)]
    got = values(spark, rows, "s string, l double", measures.size_class(F.col("s"), F.col("l")))
    assert got == [None, "<152", "<152", "152-305", "152-305", "306-405", "306-405", ">405",
                   "<200", "200-350", "200-350", ">350", None, None, None]


def test_reach_edges(spark):
    rows = [(x,) for x in (-15.31, -15.3, -10.8, -10.79, -4.0, -0.3, -0.29)]
    a, b, c = (r[2] for r in config.REACHES)
    assert values(spark, rows, "x double", measures.reach(F.col("x"))) == [None, a, a, b, b, c, None]


def test_total_length_and_condition(spark):
    rows = [("BNT", None, 200), ("RBT", None, 200), ("CRP", None, 200), ("HBC", None, 200), ("RBT", 321, 200), ("BNT", None, None)]
    got = values(spark, rows, "s string, t int, f int", measures.total_length(F.col("s"), F.col("t"), F.col("f")))
    assert got == [213.0, 215.0, 226.0, None, 321.0, None]
    rows = [("RBT", 500, 350.0), ("BNT", 500, 350.0), ("RBT", 500, 0.0), ("RBT", None, 350.0)]
    got = values(spark, rows, "s string, w int, l double", measures.condition_factor(F.col("s"), F.col("w"), F.col("l")))
    assert got[0] == pytest.approx(500 / 10 ** (-4.6023 + 2.8193 * 2.544068044350276)) and got[1:] == [None, None, None]


def test_length_gap_and_bins(spark):
    rows = [(140, 100), (139, 100), (60, 100), (None, 100)]
    gap = measures.length_gap(F.col("t"), F.col("f"))
    got = values(spark, rows, "t int, f int", measures.gap_flag(gap), measures.gap_flag(gap, absolute=True))
    assert got == [("error", "error"), ("ok", "ok"), ("ok", "error"), ("ok", "ok")]
    rows = [(95.0,), (95.1,), (105.0,), (106.0,)]
    assert values(spark, rows, "l double", measures.length_bin(F.col("l"))) == [90, 100, 100, 110]


def test_recapture_codes(spark):
    rows = [(c,) for c in ("PY", "BY", "FY", "BN", "", "ZZ", None)]
    c = F.col("c")
    got = values(spark, rows, "c string", codes.tag_recap(c), codes.clip_recap(c))
    assert got == [("Y", "N"), ("Y", "Y"), ("N", "Y"), ("N", "N"), (None, None), (None, None), (None, None)]
    got = values(spark, rows, "c string", codes.tag_recap_or_code(c), codes.clip_recap_or_code(c))
    assert got[4:] == [("", ""), ("ZZ", "ZZ"), (None, None)]


def test_sex_condition(spark):
    rows = [("U", "R"), ("U", "G"), ("M", "R"), ("U", None), (None, "R")]
    got = values(spark, rows, "s string, c string", codes.sex_condition(F.col("s"), F.col("c")))
    assert got == ["N", "N", "R", None, "R"]


def test_backfills(spark):
    rows = [(1.0, 2.0, "X"), (None, 2.0, "X"), (None, None, "SLOUGH 1A"), (None, None, "X")]
    got = values(spark, rows, "a double, b double, s string", codes.backfill_mile(F.col("a"), F.col("b"), F.col("s")))
    assert got == [1.0, 2.0, -12.15, None]
    rows = [("R", "L", "X"), ("", "L", "X"), (None, None, "SLOUGH 1A"), ("", None, "SLOUGH 1A")]
    got = values(spark, rows, "a string, b string, s string", codes.backfill_side(F.col("a"), F.col("b"), F.col("s")))
    assert got == ["R", "L", "L", None]


def test_hoop_end_clock_and_caught(spark):
    rows = [("MHB",), ("EL",), ("HB",), (None,)]
    assert values(spark, rows, "g string", codes.hoop_end_clock(F.col("g"), F.lit("09:30"))) == ["09:30", "", None, None]
    rows = [("NFC",), ("RBT",), ("",), (None,)]
    assert values(spark, rows, "s string", codes.caught(F.col("s"))) == [0, 1, 1, 1]
