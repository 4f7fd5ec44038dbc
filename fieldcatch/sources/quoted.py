"""Large delimited files whose quoted fields hold line breaks, read by many tasks.

A file is split at any line end, wherever that stands. Whether a line begins inside a quoted field depends on
the number of quotes before it: quotes are counted per split first, and the parity of their running total, one row
per split, tells each split how it begins. Then every task puts the lines of its records together by itself;
only the piece of a record that reaches over the edge of a split is shuffled. Quotes inside a quoted field
are doubled, which leaves the parity as it is.

Records come as in the reading by one task: line breaks inside quotes are kept, as line feeds in files whose lines
mostly end in a carriage return and a line feed, blank lines between records are none. A file that ends inside quotes ends its last
record there. A quote that stands alone in an unquoted field is not told from the beginning of a quoted one.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SPLIT = ["_file", "_block"]
_NAMES = ["_file", "_block", "_at", "_open", "_record"]
_PIECES = "_file string, _block bigint, _at bigint, _open boolean, _record string"
_MARK = "\ufeff"


def _lines(spark: SparkSession, path) -> DataFrame:
    """Lines with the file and the first byte of the split they stand in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value"
    )


def _begins(lines: DataFrame) -> DataFrame:
    """Whether each split begins inside quotes, and whether its file has carriage returns; one row per split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    found = lines.groupBy(*_SPLIT).agg(
        (F.sum(quotes) % 2).alias("_n"), F.count_if(F.endswith("value", F.lit("\r"))).alias("_returns"),
        F.count(F.lit(1)).alias("_lines"),
    )
    file = Window.partitionBy("_file")
    before = file.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(
        *_SPLIT, (F.coalesce(F.sum("_n").over(before), F.lit(0)) % 2 == 1).alias("_inside"),
        (2 * F.sum("_returns").over(file) > F.sum("_lines").over(file)).alias("_crlf"),
    )


def join_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records of each split, numbered from 1.

    What a split that begins inside quotes begins with has number 0 and ends a record of an earlier split; a
    last record that goes on in the next split is marked open.
    """
    split, at, parts, inside = None, 0, [], False
    for batch in batches:
        out = []
        for file, block, begins, crlf, text in zip(
            batch["_file"], batch["_block"], batch["_inside"], batch["_crlf"], batch["value"]
        ):
            if (file, block) != split:
                if parts:
                    out.append((*split, at, True, "\n".join(parts)))
                split, parts, inside = (file, block), [], bool(begins)
                at = 0 if inside else 1
            parts.append(text.removesuffix("\r") if crlf else text)
            inside ^= text.count('"') % 2 == 1
            if not inside:
                out.append((*split, at, False, "\n".join(parts)))
                at, parts = at + 1, []
        yield pd.DataFrame(out, columns=_NAMES)
    if parts:
        yield pd.DataFrame([(*split, at, True, "\n".join(parts))], columns=_NAMES)


def records(spark: SparkSession, path) -> DataFrame:
    """(_file, _block, _at, _record): the records of all files, the split they begin in and their number there."""
    lines = _lines(spark, path)
    # one row per split of the input, a fixed small share of it; the lines must stay where they were read
    told = lines.join(F.broadcast(_begins(lines)), _SPLIT)
    pieces = told.select("_file", "_block", "_inside", "_crlf", "value").mapInPandas(join_lines, _PIECES)
    whole = pieces.filter("_at > 0 AND NOT _open").select(*_SPLIT, "_at", "_record")
    # the pieces of a record that reaches over edges of splits are put behind the one that begins it
    edges = pieces.filter("_at = 0 OR _open")
    along = Window.partitionBy("_file").orderBy("_block", "_at")
    named = edges.withColumn("_first", F.max(F.when(F.col("_at") > 0, F.struct("_block", "_at"))).over(along))
    joined = named.groupBy("_file", "_first").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_block", "_at", "_record")))["_record"], "\n").alias("_record")
    ).select("_file", F.col("_first._block").alias("_block"), F.col("_first._at").alias("_at"), "_record")
    return whole.unionByName(joined).filter("_record <> ''")


def _unmarked(text: Column) -> Column:
    return F.when(F.startswith(text, F.lit(_MARK)), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def read_text(spark: SparkSession, path, sep: str = "\t", file_column: str | None = None) -> DataFrame:
    """Every column as text, named by the header, which all files must share; like a reading with `multiLine`.

    `file_column` adds the path of the file a record stands in.
    """
    shown = spark.read.option("lineSep", "\n").text(path).first()
    head = shown[0].rstrip("\r").removeprefix(_MARK) if shown else ""
    names = next(csv.reader([head], delimiter=sep), [])
    is_head = (F.col("_block") == 0) & (F.col("_at") == 1)
    other = F.raise_error(F.concat(F.lit("another header than that of the first file: "), "_file")).cast("boolean")
    body = records(spark, path).filter(
        F.when(is_head & (_unmarked(F.col("_record")) != F.lit(head)), other).otherwise(~is_head)
    )
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    options = {"sep": sep, "escape": '"', "maxCharsPerColumn": "-1"}
    kept = [F.col("_file").alias(file_column)] if file_column else []
    return body.select(F.from_csv("_record", schema, options).alias("_r"), *kept).select("_r.*", *([file_column] if file_column else []))
