"""Settings and corrections of the known trips, held as data.

Each trip lists its corrections in rounds of (column, key_column, [(key_value, new_value), ...]).
A round reads the values the round before left. A split gives part of a sample an id of its own, by
adding a suffix or, where the suffix is None, the site id; it comes before the round it names.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcatch.config import TripConfig
from fieldcatch.functions.text import append_where
from fieldcatch.operators.corrections import SCHEMA, apply_corrections


@dataclass(frozen=True)
class Preset:
    config: TripConfig
    gear: str
    rounds: tuple = ()
    splits: tuple = ()  # (before round, key column, key value, suffix or None)
    options: dict = field(default_factory=dict)
    late: tuple = ()  # rounds that come after the catch has been counted
    missing: str = ""  # how the tables print missing values
    export_missing: str | None = ""  # how the corrected export prints them; None: none is written


# Key offsets, typing errors and record corrections of past trips.
PRESETS = {
    "GC20191024_hoop": Preset(
        TripConfig("GC20191024"), "hoop", options={
            "key_by_site": True, "with_hours": False,
            "upper": ["S_TRIP_ID", "S_SITE_ID", "S_CLIPBOARD", "S_CREW", "FISH_TAG"]}, export_missing=None),

    "GC20200621_hoop": Preset(
        TripConfig("GC20200621", samples_before=267, specimens_before=2686), "hoop",
        rounds=(
            [("S_SITE_ID", "S_SITE_ID", [
                ("225.13LC", "225.13L"), ("34.59", "34.59R"), ("35.73", "35.73R"),
                ("173.06", "173.06R"), ("173.0696", "173.06R"), ("201.79LC", "201.79L"),
                ("252.25", "252.25R"), ("253.32", "253.32R")])],
            [("S_SITE_ID", "SAMPLE_ID", [
                ("0629_0738_39", "140.55L"), ("0703_0932_16", "202.24L"),
                ("0704_0820_17", "225L"), ("0705_1029_56", "253.32L")]),
             ("S_START_DATE_TIME", "SAMPLE_ID", [("0703_0932_16", "2020-07-02 16:23:00")])],
            # the waypoint and the mile of a net go before its sample id, so they come later
            [("S_SITE_ID", "S_GPS_ID", [("BL053", "81.68L")]),
             ("S_SITE_ID", "S_RIVER_MILE", [("96.2", "91.16L")]),
             ("S_GPS_ID", "SAMPLE_ID", [("0703_0932_16", "AL125"), ("0704_0820_17", "BL131")])],
            [("S_GPS_ID", "S_RIVER_MILE", [("96.2", "AL0602")])],
            [("S_RIVER_MILE", "SAMPLE_ID", [
                ("0703_0932_16", "202.27"), ("0704_0820_17", "225.08"),
                ("0703_0810_15", "201.98")]),
             ("S_SITE_ID", "SAMPLE_ID", [
                ("0624_0905_41", "53.98R"), ("0627_0744_32", "96.16L"),
                ("0630_0803_00", "154.77L"), ("0626_0551_46", "79.8L"),
                ("0625_0741_50", "66.24R")])],
            [("S_SITE_ID", "SAMPLE_ID", [("0706_0649_28", "275.23L"), ("0627_0734_42", "96.13R")]),
             ("SPECIES", "SPECIES", [("", "FMS")]),
             ("TOTAL_LENGTH", "ID", [
                ("ID_20200701_0906_25_233_03f0923b", "370"), ("ID_20200704_0831_34_460_42705a79", "98"),
                ("ID_20200630_0821_57_118_ec0371bc", "437"), ("ID_20200701_0948_00_900_950ff17c", "363"),
                ("ID_20200630_0926_09_331_0eb453ca", "227"), ("ID_20200701_0912_15_674_439a78f7", "226"),
                ("ID_20200630_0836_42_797_5d05ab61", "226"), ("ID_20200705_0905_15_325_400d6e7c", "177")]),
             ("FORK_LENGTH", "ID", [
                ("ID_20200705_0916_07_019_ef04a42c", None), ("ID_20200630_0942_45_355_ef149d9b", "371"),
                ("ID_20200702_0932_26_049_d1c6ef6e", "386"), ("ID_20200630_0844_03_986_2315cb95", "273"),
                ("ID_20200703_0903_40_590_11f61c3a", None), ("ID_20200705_1040_16_197_717ed25d", None),
                ("ID_20200701_0959_37_820_d25ffc0c", None), ("ID_20200704_0833_52_497_128e8b7f", "231"),
                ("ID_20200701_0920_36_625_88741647", "406"), ("ID_20200627_0805_57_165_8c641cd0", None)]),
             ("WEIGHT", "ID", [
                ("ID_20200630_0844_03_986_2315cb95", "179"), ("ID_20200629_0834_58_852_93d93a24", None)])],
        ),
        splits=((2, "S_SITE_ID", "253.73R", "a"),),
        options={"earliest": datetime(2020, 1, 1, 1, 1, 1)}, export_missing=None),

    "GC20201025_hoop": Preset(
        TripConfig("GC20201025", samples_before=126, specimens_before=895), "hoop",
        rounds=(
            [("SAMPLE_ID", "ID", [("ID_20201027_1019_05_171_e0873e75", "1027_0954_15")])],
            [("S_SITE_ID", "SAMPLE_ID", [
                ("1027_1006_50", "255.37R"), ("1028_0842_30", "260.86R"),
                ("1029_0841_05", "279.49L"), ("1029_0957_19", "281.26L"),
                ("1026_1144_45", "240.11L")]),
             ("S_RIVER_MILE", "SAMPLE_ID", [("1027_0954_15", "254.8"), ("1026_0946_48", "237.29")]),
             ("S_SAMPLE_TYPE", "SAMPLE_ID", [("1026_0930_42238.19R", "99")]),
             ("S_SAMPLE_NOTES", "SAMPLE_ID", [("1026_0930_42238.19R", "")])],
            [("S_SAMPLE_NOTES", "S_SAMPLE_NOTES", [
                ("Mouth of hoopnet out of water but still submerged2",
                 "Mouth of hoopnet out of water but still submerged"),
                ("Float is out of the water, net partially submerged",
                 "Throat is out of the water, net partially submerged"),
                ("Float is out of the water", "Throat is out of the water")]),
             ("SPECIES", "ID", [
                ("ID_20201026_1301_00_676_b574e4d2", "FMS"), ("ID_20201027_1026_47_051_6d46085e", "FMS"),
                ("ID_20201026_1223_24_571_9fc95052", "FMS")]),
             ("FORK_LENGTH", "ID", [
                ("ID_20201026_0944_18_121_c5d33d12", None), ("ID_20201026_1007_22_978_a42e7e00", None)]),
             ("TOTAL_LENGTH", "ID", [("ID_20201028_1004_58_543_4aaf6c5c", "334")])],
        ),
        splits=((1, "SAMPLE_ID", "1026_0930_42", None),), export_missing=None),

    "GC20210403_hoop": Preset(
        TripConfig("GC20210403", samples_before=217, specimens_before=1737), "hoop",
        rounds=(
            [("S_SITE_ID", "S_GPS_ID", [("BR052", "103.6R"), ("AL082", "172.98L")])],
            [("S_SITE_ID", "SAMPLE_ID", [
                ("0414_1134_54", "250.08R"), ("0409_0843_31", "144.82R"),
                ("0414_0959_06", "246.3R"), ("0415_1028_34", "262.53R")]),
             ("S_RIVER_MILE", "SAMPLE_ID", [
                ("0412_0940_35", "207.28"), ("0404_0906_46", "9.79"), ("0415_0947_05", "260.28")])],
        ),
        late=(
            [("SPECIES", "ID", [
                ("ID_20210414_1032_11_524_b8e3f7cf", "HBC"), ("ID_20210411_0910_44_718_cacb6cbc", "FMS"),
                ("ID_20210416_0859_59_516_fec9fa37", "RBT"), ("ID_20210416_0847_15_807_e6ed789a", "HBC")]),
             ("FORK_LENGTH", "ID", [
                ("ID_20210414_1044_45_372_fdcf07cb", "189"), ("ID_20210408_0935_36_504_934e6db8", "487"),
                ("ID_20210411_0911_19_742_768680c2", "448"), ("ID_20210411_0922_12_345_aa62201c", "461"),
                ("ID_20210408_1003_23_044_5d343350", "347")]),
             ("WEIGHT", "ID", [
                ("ID_20210411_0929_13_745_f0cfeae4", None), ("ID_20210411_0945_10_160_3dbdb60b", None),
                ("ID_20210416_0823_07_289_b97c5bb7", "151"), ("ID_20210414_1214_55_428_08198733", None)])],
            [("SPECIES", "SPECIES", [("", "FMS")])],
        ),
        options={"keep_codes": True}, export_missing="NA"),

    "GC20210403_electrofishing": Preset(
        TripConfig("GC20210403", samples_before=175, specimens_before=1536), "electrofishing",
        rounds=(
            [("S_SITE_ID", "S_SITE_ID", [
                ("218.17R", "218.17L"), ("218.80L", "218.8L"), ("275.8L", "275.80L"),
                ("277.8L", "277.80L"), ("279.6R", "279.60R")]),
             ("S_CREW", "S_CREW", [("AN,CH,JB,SW", "AN, CH")])],
        ), missing="NA", export_missing="NA"),

    "LF20210308_electrofishing": Preset(
        TripConfig("LF20210308"), "backfilled",
        rounds=(
            [("S_SITE_ID", "S_SITE_ID", [("--12.55L", "-12.55L"), ("-12.05", "-12.05L")]),
             ("SPECIES", "ID", [
                ("ID_20210310_0054_31_122_a25595fe", "RBT"), ("ID_20210309_2247_07_992_1fc77982", "BNT")]),
             ("TOTAL_LENGTH", "ID", [("ID_20210310_2156_42_290_213c68ed", "252")]),
             ("WEIGHT", "ID", [("ID_20210309_1933_31_541_f853c7c0", None)])],
        ),
        options={
            "cutoff": datetime(2021, 3, 8, 22, 15),
            "early_note": "rate set incorrectly on CPS, 24 instead of 240, did not shock effectively"}),

    "LF20200715_field": Preset(
        TripConfig("LF20200715"), "field",
        options={"late_sites": ("-11.72L", "-11.02R", "-10.92L", "-10.8L"), "notes": {"-4.76L": "1 BEAVER"}}),
}


def correction_rows(preset: Preset, late: bool = False) -> list[tuple]:
    return [
        (number, column, key_column, value, new)
        for number, entries in enumerate(preset.late if late else preset.rounds, start=1)
        for column, key_column, pairs in entries
        for value, new in pairs
    ]


def corrections_frame(spark: SparkSession, preset: Preset, late: bool = False) -> DataFrame:
    return spark.createDataFrame(correction_rows(preset, late), SCHEMA)


def apply_preset(df: DataFrame, preset: Preset) -> DataFrame:
    """Run the trip's splits and corrections over its normalised export, in order."""
    rows = correction_rows(preset)
    fixes = corrections_frame(df.sparkSession, preset)
    out = df
    for number in range(1, len(preset.rounds) + 1):
        for before, key_column, value, suffix in preset.splits:
            if before == number:
                added = F.col("S_SITE_ID") if suffix is None else F.lit(suffix)
                out = out.withColumn(
                    "SAMPLE_ID", append_where(F.col("SAMPLE_ID"), F.col(key_column) == value, added))
        used = sorted({(n, k, c) for n, c, k, _, _ in rows if n == number})
        out = apply_corrections(out, fixes, used)
    return out
