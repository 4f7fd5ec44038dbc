"""Readers and writers on small files."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from fieldcatch import schemas
from fieldcatch.sources import files, quoted
from fieldcatch.workload import checks, jobs

COLUMNS = (("ID", "string"), ("NOTE", "string"), ("N", "int"))


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_export_blank_rule_and_odd_numbers(spark, tmp_path):
    path = write(tmp_path / "a.txt", 'ID\tNOTE\tEXTRA\tN\na\t\tx\t1\nb\tNA\tx\tNA\nc\t"say ""ok"""\tx\tjunk\nd\t""\tx\t\n')
    got = rows(files.scan_export(spark, path, COLUMNS))
    assert got == [("a", "", 1), ("b", None, None), ("c", 'say "ok"', None), ("d", "", None)]


def test_readr_rule(spark, tmp_path):
    path = write(tmp_path / "a.txt", "ID\tNOTE\tN\na\t\t 1 \nb\t  x \t2\n")
    assert rows(files.scan_export_readr(spark, path, COLUMNS)) == [("a", None, 1), ("b", "x", 2)]


def test_byte_order_mark_order_and_case_of_header(spark, tmp_path):
    path = write(tmp_path / "a.txt", "ID\tn\tNOTE\na\t1\tx\n", encoding="utf-8-sig")
    assert rows(files.scan_export(spark, path, COLUMNS)) == [("a", "x", 1)]


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "a.txt", "ID\tN\na\t1\n")
    with pytest.raises(ValueError, match="NOTE"):
        files.scan_export(spark, path, COLUMNS)


def test_many_trips_by_glob(spark, tmp_path):
    for trip in ("GC1", "GC2"):
        write(tmp_path / f"{trip}_Export.txt", f"ID\tNOTE\tN\n{trip}\t\t1\n")
    got = files.scan_trips(spark, str(tmp_path / "*_Export.txt"), COLUMNS).collect()
    assert {(r.ID, os.path.basename(r.TRIP_FILE)) for r in got} == {("GC1", "GC1_Export.txt"), ("GC2", "GC2_Export.txt")}


def test_files_with_another_column_order_are_refused(spark, tmp_path):
    write(tmp_path / "a.txt", "ID\tNOTE\tN\na\tx\t1\n")
    write(tmp_path / "b.txt", "ID\tN\tNOTE\na\t1\tx\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_export(spark, str(tmp_path), COLUMNS).collect()


def test_water_under_either_header(spark, tmp_path):
    one = write(tmp_path / "a.csv", "START_DATE,TURBIDITY_NTU,WATER_TEMP\n2021-04-03,5.5,11\n")
    two = write(tmp_path / "b.csv", "date,temperature,TurbidityNTU\n2021-04-03,11,5.5\n")
    want = [("2021-04-03", 5.5, 11.0)]
    assert rows(files.scan_water(spark, one)) == rows(files.scan_water(spark, two)) == want


def test_site_lists(spark, tmp_path):
    river = write(tmp_path / "g.csv", "SiteID,RiverMile_100ths,RiverSide,reach,id\n218_.17L,218.17,L,west,1\n")
    assert rows(files.scan_river_sites(spark, river)) == [("218.17L", 218.17, "L", "west", 1)]
    head = ",".join(schemas.names(schemas.SITE_LIST))
    listed = write(tmp_path / "l.csv", head + "\n1,-15.79,-15.71,L,-15.79L,-15.71L,,,upper,N,1L,2L,monitoring,,\n")
    row = files.scan_sites(spark, listed).first()
    assert (row.site_seq, row.S_SITE_ID, row.rm_end, row.latitude, row.comments) == (1, "-15.79L", -15.71, None, None)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "", 1), ("b", None, None), ("c", 'x "y", z', 3)], "ID string, NOTE string, N int")
    files.write_delimited(df, str(tmp_path / "blank"), one_file=True)
    text = open(glob.glob(str(tmp_path / "blank" / "part-*"))[0]).read()
    assert text == 'ID,NOTE,N\na,"",1\nb,,\nc,"x ""y"", z",3\n'
    files.write_delimited(df, str(tmp_path / "na"), missing="NA", sep="\t")
    assert rows(files.scan_export(spark, str(tmp_path / "na"), COLUMNS)) == [("a", "", 1), ("b", None, None), ("c", 'x "y", z', 3)]
    files.write_delimited(df, str(tmp_path / "parts"), partition_by=("ID",))
    assert sorted(os.path.basename(p) for p in glob.glob(str(tmp_path / "parts" / "ID=*"))) == ["ID=a", "ID=b", "ID=c"]


def test_conformance_report():
    class Frame:
        dtypes = [("a", "int"), ("b", "string"), ("c", "int")]

    assert schemas.conforms(Frame, (("a", "int"), ("b", "string"), ("c", "int"))) == []
    assert len(schemas.conforms(Frame, (("a", "int"), ("b", "int")))) == 2


def test_decimals_line_breaks_and_rejects(spark, tmp_path):
    columns = (("ID", "string"), ("NOTE", "string"), ("N", "int"), ("W", "double"))
    rows = [("a", 'one\ntwo\t"three"', "5", "12.5"), ("b", "", "370.0", "1e2"), ("c", None, "37O", "x"), ("d", "n", "12.5", None)]
    df = spark.createDataFrame(rows, "ID string, NOTE string, N string, W string")
    path = str(tmp_path / "odd")
    files.write_delimited(df, path, missing="NA", sep="\t")
    got = {r["ID"]: tuple(r)[1:] for r in files.scan_export(spark, path, columns).collect()}
    assert got == {"a": ('one\ntwo\t"three"', 5, 12.5), "b": ("", 370, 100.0), "c": (None, None, None), "d": ("n", None, None)}
    odd = {(r["column"], r["value"], r["n"]) for r in files.scan_rejects(spark, path, columns).collect()}
    assert odd == {("N", "37O", 1), ("N", "12.5", 1), ("W", "x", 1)}
    split = files.scan_malformed(spark, path).collect()
    assert any(r["line"].endswith("one") for r in split)
    assert files.scan_export(spark, path, columns, multiline=False).count() == 5


def quoted_file(path, rows=400, seed=3):
    """A file with line breaks, quotes, tabs, blank lines and Windows line ends inside and between fields."""
    import random

    rng = random.Random(seed)
    notes = ["plain", "", "NA", 'say ""ok""', "two\nlines", "three\r\nlong\n\nlines", "tab\there", "\n", '""', "é" * 30]
    out = ["ID\tNOTE\tN"]
    for i in range(rows):
        note = rng.choice(notes)
        out.append(f'i{i}\t"{note}"\t{rng.choice([str(i), "x", "NA", ""])}' if rng.random() < .8 else f"i{i}\tbare\t{i}")
        if rng.random() < .1:
            out.append("")
    ends = rng.choice(["\n", "\r\n"])
    path.write_bytes(("﻿" if seed % 2 else "").encode() + ends.join(out).encode() + (ends if seed % 3 else "").encode())
    return str(path)


QUOTED = [("ID", "string"), ("NOTE", "string"), ("N", "int")]


@pytest.mark.parametrize("seed,size", [(1, 64), (2, 97), (3, 1000), (4, 10_000_000)])
def test_split_files_read_as_by_one_task(spark, tmp_path, seed, size):
    for k in range(2):
        quoted_file(tmp_path / f"q{k}.txt", seed=seed + 4 * k)
    kept = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    whole = sorted(map(str, files.scan_export(spark, str(tmp_path / "q*.txt"), QUOTED).collect()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        split = files.scan_export(spark, str(tmp_path / "q*.txt"), QUOTED, multiline="split")
        tasks = quoted._lines(spark, str(tmp_path / "q0.txt")).rdd.getNumPartitions()
        got = sorted(map(str, split.collect()))
        trips = files.scan_trips(spark, str(tmp_path / "q*.txt"), QUOTED, multiline="split")
        assert {r[0].rsplit("/", 1)[1] for r in trips.select("TRIP_FILE").distinct().collect()} == {"q0.txt", "q1.txt"}
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert got == whole and len(got) == 800
    assert tasks > 1 or size > 1000


def test_split_reading_refuses_another_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("ID\tNOTE\n1\tx\n")
    (tmp_path / "b.txt").write_text("ID\tOTHER\n1\tx\n")
    with pytest.raises(Exception, match="another header"):
        files.scan_export(spark, str(tmp_path / "*.txt"), [("ID", "string")], multiline="split").collect()


def test_a_file_that_ends_inside_quotes(spark, tmp_path):
    (tmp_path / "a.txt").write_text('ID\tNOTE\n1\t"x\ny')
    rows = files.scan_export(spark, str(tmp_path / "a.txt"), [("ID", "string"), ("NOTE", "string")], multiline="split").collect()
    assert [r["ID"] for r in rows] == ["1"] and rows[0]["NOTE"].endswith("x\ny")


@pytest.mark.parametrize("multiline", [True, "split"])
def test_rejects_come_with_the_scan(spark, tmp_path, multiline):
    path = quoted_file(tmp_path / "q.txt", seed=2)
    rows, rejects = files.scan_with_rejects(spark, path, QUOTED, multiline=multiline)
    assert sorted(map(str, rows.collect())) == sorted(map(str, files.scan_export(spark, path, QUOTED).collect()))
    assert {tuple(r)[:3] for r in rejects.collect()} == {tuple(r) for r in files.scan_rejects(spark, path, QUOTED).collect()}
    assert rows.columns == ["ID", "NOTE", "N"] and rejects.first()["file"].endswith("q.txt")


def test_exports_on_the_way_to_a_scan_are_compressed(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"a{i}", 'say "ok",\ntwice' if i % 2 else "", None if i % 3 else 1.5) for i in range(2000)],
        "ID string, SPECIMEN_NOTES string, TOTAL_LENGTH double")
    columns = [("ID", "string"), ("SPECIMEN_NOTES", "string"), ("TOTAL_LENGTH", "double")]
    path = jobs._written(rows, "export", missing="NA", sep="\t")
    assert sorted(files.scan_export(spark, path, columns).collect()) == sorted(rows.collect())
    files.write_delimited(rows, str(tmp_path / "plain"), missing="NA", sep="\t")

    def size(folder):
        return sum(os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.startswith("part-"))

    assert size(path) < size(tmp_path / "plain") / 2


def test_rows_for_large_files_are_computed_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(checks, "ROWS_PER_FILE", 400)
    rows = spark.range(0, 1000, numPartitions=8).select(
        F.col("id").cast("string").alias("ID"), F.concat(F.lit("one\n"), "id").alias("NOTE"), F.spark_partition_id().alias("N"))
    for count, parts in ((1000, 3), (400, 1)):
        path = checks._in_large_files(rows, count)
        assert len(glob.glob(os.path.join(path, "part-*"))) == parts
        got = files.scan_export(spark, path, COLUMNS, multiline="split").collect()
        assert sorted(got) == sorted(rows.collect())
        assert {r.N for r in got} == set(range(8))  # the rows come from eight tasks, whatever the number of files
