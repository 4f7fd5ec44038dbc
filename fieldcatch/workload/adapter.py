"""The generated star-schema tables seen as catch data.

A line item is a specimen, its order the sample, the order's customer the site and the order date
the day of the water table. The expressions below are plain SQL that means the same in both
engines; the Spark frames and the SQL twins are both built from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SITE_TEXT = "concat(cast(cast(floor({k} / 10) as bigint) as string), '.', cast({k} % 10 as string))"
_SIDE = "CASE WHEN {k} % 2 = 0 THEN 'L' ELSE 'R' END"


def _us(c: str, clock: str) -> str:
    day = f"substr(cast({c} as string), 6, 2), '/', substr(cast({c} as string), 9, 2), '/', substr(cast({c} as string), 1, 4)"
    return f"concat({day}, ' ', {clock})"


_START = "o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE"

# Columns that depend on the sample alone.
SAMPLE_SIDE = {
    "SAMPLE_ID": "cast(o_orderkey as string)",
    "S_TRIP_ID": "concat('gc', substr(cast(o_orderdate as string), 1, 4), substr(cast(o_orderdate as string), 6, 2), '01')",
    "S_START_DATE_TIME": _START,
    "S_END_DATE_TIME": "o_orderdate + (o_orderkey % 1440 + CASE WHEN o_orderkey % 97 = 0 THEN -100 "
                       "ELSE 600 + o_orderkey % 900 END) * INTERVAL '1' MINUTE",
    "S_SAMPLE_TYPE": "CASE o_orderstatus WHEN 'F' THEN 96 WHEN 'O' THEN 97 ELSE 120 END",
    "S_GEAR": "CASE WHEN o_custkey % 3 = 0 THEN 'EL' WHEN o_custkey % 3 = 1 THEN 'MHB' ELSE 'HB' END",
    "S_CREW": "CASE WHEN o_orderkey % 9 = 0 THEN 'an,ch,jb' ELSE 'an, ch' END",
    "S_CLIPBOARD": "concat('b', substr(o_orderpriority, 1, 1))",
    "S_SITE_ID": "CASE WHEN o_orderkey % 59 = 0 THEN 'slough 1a' WHEN o_orderkey % 41 = 0 THEN "
                 f"{_SITE_TEXT.format(k='o_custkey')} ELSE concat({_SITE_TEXT.format(k='o_custkey')}, "
                 f"{_SIDE.format(k='o_custkey')}) END",
    "S_RIVER_MILE": "o_custkey / cast(10 as double) + CASE WHEN o_orderkey % 17 = 0 THEN cast(0.5 as double) "
                    "WHEN o_orderkey % 17 = 1 THEN cast(0.2 as double) ELSE cast(0 as double) END",
    "S_RM_START": "CASE WHEN o_orderkey % 5 = 0 THEN o_custkey / cast(10 as double) ELSE cast(NULL as double) END",
    "S_RM_END": "CASE WHEN o_orderkey % 5 = 0 THEN (o_custkey + 1) / cast(10 as double) ELSE cast(NULL as double) END",
    "S_SIDE": "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN cast(NULL as string) "
              f"ELSE {_SIDE.format(k='o_custkey')} END",
    "S_GPS_ID": "concat('g', cast(o_custkey as string))",
    "S_SET_NUM": "concat(cast(o_orderkey % 65 as string), ':', substr(cast(100 + o_orderkey % 60 as string), 2, 2))",
    "S_EF_MINUTES": "cast(o_orderkey % 30 as int)",
    "S_EF_SECONDS": "cast(o_orderkey % 60 as int)",
    "S_EF_VOLTS": "cast(o_custkey % 7 * 50 as double)",
    "S_EF_AMPS": "(o_custkey % 9) / cast(4 as double)",
    "S_HABITAT": "substr(o_orderpriority, 3, 3)",
    "S_COVER": "o_orderstatus",
    "S_SUBSTRATE": "CASE WHEN o_custkey % 6 = 0 THEN cast(NULL as string) ELSE concat('S', cast(o_custkey % 6 as string)) END",
    "S_HYDRAULIC": "CASE WHEN o_custkey % 4 = 0 THEN '' ELSE concat('H', cast(o_custkey % 4 as string)) END",
    "S_SAMPLE_NOTES": "CASE WHEN o_orderkey % 11 = 0 THEN 'test' WHEN o_orderkey % 11 = 1 THEN cast(NULL as string) ELSE '' END",
    "S_TEMPERATURE": "cast(o_orderkey % 20 as double)",
    "S_TURBIDITY_NTU": "cast(o_orderkey % 50 as double)",
    "S_TURBIDITY": "CASE WHEN o_orderkey % 8 = 0 THEN 'H' ELSE 'L' END",
}

# Columns of the single specimen.
SPECIMEN_SIDE = {
    "ID": "concat('ID_', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', "
          "cast(l_partkey as string), '_', cast(l_suppkey as string), '_', cast(cast(floor(l_quantity) as int) as string))",
    "SPECIES": "CASE WHEN l_partkey % 23 = 0 THEN cast(NULL as string) WHEN l_partkey % 29 = 0 THEN '' "
               "WHEN l_partkey % 31 = 0 THEN 'FHM' WHEN l_partkey % 10 < 5 THEN 'RBT' WHEN l_partkey % 10 < 7 THEN 'BNT' "
               "WHEN l_partkey % 10 = 7 THEN 'CRP' WHEN l_partkey % 10 = 8 THEN 'HBC' ELSE 'NFC' END",
    "TOTAL_LENGTH": "CASE WHEN l_linenumber = 7 THEN cast(NULL as double) ELSE cast(floor(50 + l_quantity * 9) as double) END",
    "FORK_LENGTH": "cast(floor(45 + l_quantity * 8) as double)",
    "WEIGHT": "cast(floor(1 + l_extendedprice / 100) as double)",
    "SEX": "CASE l_suppkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'M' ELSE 'F' END",
    "SEX_COND": "CASE l_suppkey % 4 WHEN 0 THEN 'R' WHEN 1 THEN 'G' WHEN 2 THEN 'N' ELSE cast(NULL as string) END",
    "SEX_CHAR": "CASE WHEN l_suppkey % 5 = 0 THEN cast(NULL as string) ELSE l_linestatus END",
    "RECAP_YES_NO": "CASE l_linenumber WHEN 1 THEN 'PY' WHEN 2 THEN 'BY' WHEN 3 THEN 'FY' WHEN 4 THEN 'BN' WHEN 5 THEN '' "
                    "WHEN 6 THEN 'ZZ' ELSE cast(NULL as string) END",
    "FINCLIP1": "CASE l_linenumber WHEN 3 THEN 'AD' WHEN 4 THEN cast(NULL as string) ELSE '' END",
    "FISH_TAG": "CASE WHEN l_partkey % 4 = 0 THEN '' WHEN l_partkey % 4 = 1 THEN cast(NULL as string) "
                "ELSE concat('3dd.', cast(l_partkey as string)) END",
    "FISH_TAG_READER_TIME": _us("l_shipdate", "'08:', substr(cast(100 + l_suppkey % 60 as string), 2, 2), "
                                "CASE WHEN l_linenumber % 2 = 0 THEN ':30' ELSE '' END"),
    "DISPOSITION": "l_returnflag",
    "SPECIMEN_NOTES": "CASE WHEN l_tax = 0 THEN cast(NULL as string) WHEN l_tax < 0.03 THEN 'say \"ok\", twice' ELSE '' END",
    "FISH_TAG_READER_NUM": "cast(l_suppkey % 5 as string)",
}

EXPORT = {**SAMPLE_SIDE, **SPECIMEN_SIDE}

# The start time as typed into the export, now and then with seconds.
START_TEXT = _us(
    f"({_START})",
    f"substr(cast({_START} as string), 12, 5), CASE WHEN o_orderkey % 5 = 0 THEN ':30' ELSE '' END",
)
END_TEXT = _us(
    f"({SAMPLE_SIDE['S_END_DATE_TIME']})",
    f"substr(cast({SAMPLE_SIDE['S_END_DATE_TIME']} as string), 12, 5), ':00'",
)
RAW_EXPORT = {**EXPORT, "S_START_DATE_TIME": START_TEXT, "S_END_DATE_TIME": END_TEXT,
              "S_RIVER_MILE": "cast(cast(o_custkey as int) as string)"}

# One row per customer; every fortieth shares the id of the site two before it.
_LISTED = "(c_custkey - CASE WHEN c_custkey % 40 = 39 THEN 2 ELSE 0 END)"
_LISTED_TEXT = _SITE_TEXT.format(k=_LISTED)
_LISTED_SIDE = _SIDE.format(k="c_custkey")
SITES = {
    "S_SITE_ID": f"concat({_LISTED_TEXT}, {_LISTED_SIDE})",
    "SiteID": f"concat({_LISTED_TEXT}, '_', {_LISTED_SIDE})",
    "site_seq": "cast(c_custkey as int)",
    "start_rm": f"{_LISTED} / cast(10 as double)",
    "rm_start": f"{_LISTED} / cast(10 as double)",
    "rm_end": "(c_custkey + 1) / cast(10 as double)",
    "RiverSide": "CASE WHEN c_nationkey = 3 THEN 'C' ELSE " + _LISTED_SIDE + " END",
    "side": _LISTED_SIDE,
    "reach": "c_mktsegment",
    "type": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'nonnative' ELSE 'monitoring' END",
}
SITES_FROM = "customer"

# Every seventh day of a month is a dry one: its water row stands under a date no sample has.
_DAY = "substr(cast(o_orderdate as string), 1, 10)"
WATER_SQL = f"""
SELECT CASE WHEN substr({_DAY}, 9, 2) IN ('07', '14', '21', '28') THEN concat('18', substr({_DAY}, 3, 8)) ELSE {_DAY} END AS START_DATE,
       max(cast(floor(o_totalprice / 1000) as double)) AS TURBIDITY_NTU,
       min(cast(o_orderkey % 20 as double)) AS WATER_TEMP
FROM orders GROUP BY {_DAY}"""

# Stage-one tables as the report reads them.
REPORT_SAMPLES = {
    "ACCESS_SAMPLE_ID": "o_orderkey",
    "DATASHEET_SAMPLE_ID": f"concat({_SITE_TEXT.format(k='o_custkey')}, {_SIDE.format(k='o_custkey')})",
    "START_RM": "-(o_custkey % 160) / cast(10 as double)",
    "START_DATETIME": _us(f"({_START})", f"substr(cast({_START} as string), 12, 8)"),
    "SAMPLE_TYPE": SAMPLE_SIDE["S_SAMPLE_TYPE"],
    "EF_TOTAL_SECONDS": "cast(o_orderkey % 30 * 60 + o_orderkey % 60 as int)",
}
REPORT_FISH = {
    "ACCESS_FISH_ID": SPECIMEN_SIDE["ID"],
    "ACCESS_SAMPLE_ID": "l_orderkey",
    "SPECIES_CODE": SPECIMEN_SIDE["SPECIES"],
    "TOTAL_LENGTH": SPECIMEN_SIDE["TOTAL_LENGTH"],
    "FORK_LENGTH": SPECIMEN_SIDE["FORK_LENGTH"],
    "WEIGHT": SPECIMEN_SIDE["WEIGHT"],
    "PITTAG_RECAP": "CASE WHEN l_linenumber IN (1, 2) THEN 'Y' WHEN l_linenumber IN (3, 4) THEN 'N' END",
}

# Corrections, as data: what the office wrote down about samples, specimens and crews.
CORRECTIONS_SQL = """
SELECT 1 AS round, 'S_SITE_ID' AS column, 'SAMPLE_ID' AS key_column, cast(o_orderkey as string) AS key_value,
       concat(cast(cast(floor(o_custkey / 10) as bigint) as string), '.', cast(o_custkey % 10 as string), 'R') AS new_value
FROM orders WHERE o_totalprice > 480000
UNION ALL
SELECT 1, 'S_SAMPLE_NOTES', 'SAMPLE_ID', cast(o_orderkey as string), 'checked' FROM orders WHERE o_totalprice > 490000
UNION ALL
SELECT DISTINCT 1, 'TOTAL_LENGTH', 'ID', {id}, cast(cast(floor(l_quantity) as int) as string)
FROM lineitem WHERE l_extendedprice > 102000
UNION ALL
SELECT DISTINCT 1, 'WEIGHT', 'ID', {id}, cast(NULL as string) FROM lineitem WHERE l_extendedprice > 103000
UNION ALL
SELECT DISTINCT 2, 'S_GPS_ID', 'S_SITE_ID',
       concat(cast(cast(floor(o_custkey / 10) as bigint) as string), '.', cast(o_custkey % 10 as string), 'R'), 'moved'
FROM orders WHERE o_totalprice > 480000
UNION ALL
SELECT DISTINCT 1, 'FORK_LENGTH', 'ID', {id}, '37O' FROM lineitem WHERE l_extendedprice > 102500
UNION ALL
SELECT DISTINCT 1, 'SEX', 'ID', {id}, 'M' FROM lineitem WHERE l_extendedprice > 102500
UNION ALL
SELECT DISTINCT 1, 'SEX', 'ID', {id}, 'F' FROM lineitem WHERE l_extendedprice > 102500""".format(id=SPECIMEN_SIDE["ID"])
CORRECTIONS_LAYOUT = [
    (1, "SAMPLE_ID", "S_SITE_ID"), (1, "SAMPLE_ID", "S_SAMPLE_NOTES"),
    (1, "ID", "TOTAL_LENGTH"), (1, "ID", "WEIGHT"), (1, "ID", "FORK_LENGTH"), (1, "ID", "SEX"), (2, "S_SITE_ID", "S_GPS_ID"),
]


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


# The same relations as named subqueries for the SQL twins.
SQL_VIEWS = {
    "export": f"SELECT {_select(EXPORT)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "raw_export": f"SELECT {_select(RAW_EXPORT)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "sites": f"SELECT {_select(SITES)} FROM {SITES_FROM}",
    "water": WATER_SQL,
    "corrections": CORRECTIONS_SQL.replace("AS column,", 'AS "column",'),
    "report_samples": f"SELECT {_select(REPORT_SAMPLES)} FROM orders",
    "report_fish": f"SELECT {_select(REPORT_FISH)} FROM lineitem",
}


class Tables:
    """The adapter's frames over one folder of generated tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _specimens(self, columns: dict[str, str]) -> DataFrame:
        """Specimens with their sample. Each side is projected before the join: sample columns
        are computed once per sample, and neither projection outgrows the code generator. Both are dealt out
        by the key of the join first, so the shuffle moves the tables' own short columns, and the texts made
        of them are computed in as many tasks as the shuffle has, however few files there are."""
        orders = self._project(self.table("orders").repartition("o_orderkey"), {
            "o_orderkey": "o_orderkey", **{n: e for n, e in columns.items() if n in SAMPLE_SIDE}})
        items = self._project(self.table("lineitem").repartition("l_orderkey"), {
            "l_orderkey": "l_orderkey", **{n: e for n, e in columns.items() if n in SPECIMEN_SIDE}})
        return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select(*columns)

    @staticmethod
    def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])

    @property
    def export(self) -> DataFrame:
        return self._specimens(EXPORT)

    @property
    def raw_export(self) -> DataFrame:
        return self._specimens(RAW_EXPORT)

    @property
    def sites(self) -> DataFrame:
        return self._project(self.table("customer"), SITES)

    @property
    def water(self) -> DataFrame:
        return self.spark.sql(WATER_SQL.replace("FROM orders", "FROM {orders}"), orders=self.table("orders"))

    @property
    def corrections(self) -> DataFrame:
        text = CORRECTIONS_SQL.replace("FROM orders", "FROM {orders}").replace("FROM lineitem", "FROM {lineitem}")
        return self.spark.sql(text, orders=self.table("orders"), lineitem=self.table("lineitem"))

    @property
    def report_samples(self) -> DataFrame:
        return self._project(self.table("orders"), REPORT_SAMPLES)

    @property
    def report_fish(self) -> DataFrame:
        return self._project(self.table("lineitem"), REPORT_FISH)
