"""Spelling variants by permuterm rotations.

A word and a terminator behind it are written in every rotation. In the sorted list of rotations, those that agree
up to their last character are a range; the last character is where the word is edited. The
words of a range therefore differ by one replaced character, and the word whose whole rotation is that prefix
lacks the character the others have. A range is a group of words that are all neighbours, with at most one
word per character of the alphabet, so the scan of a group is bounded. The list is dealt out by prefix
and sorted inside, which keeps every range in one task.

Each pair of neighbours lies in one range only: a replaced character has one place, and of a run of equal
characters only the first is taken as the deleted one. So counts need no removal of repeats.

Null texts have no words; a row without an id hashes as one with an empty id; repeated rows count as often as
they stand. Ties of a word's form go to the smallest word in code-point order.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.runtime import materialise

RUN = r"[A-Za-zÀ-ÿ]+"
END = "\u0000"
#: Words have at least so many characters and occurrences; one run in so many loses a character; a form is
#: so many times as frequent as the word.
LEAST_CHARS, LEAST_COUNT, MISPRINTS, RATIO = 6, 5, 199, 5


def lower_ascii(column: Column) -> Column:
    return F.when(
        column.rlike("[A-Z]"), F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    ).otherwise(column)


def misprinted(run: Column, key: Column, every: int = MISPRINTS) -> Column:
    """`run` without one of its characters where `every` divides the crc32 of `key:run`."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT,
          every: int = MISPRINTS) -> DataFrame:
    """(word, n): the frequent words of whole texts and how often they occur."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("_run")).filter(
        F.length("_run") >= least_chars
    ).select("doc_id", lower_ascii(F.col("_run")).alias("_run"))
    found = runs.select(misprinted(F.col("_run"), F.col("doc_id"), every).alias("word"))
    return found.filter(F.length("word") >= least_chars).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    ).filter(F.col("n") >= least_count)


def rotations(vocabulary: DataFrame) -> DataFrame:
    """(prefix, edited, word, n): each rotation of each word whole, and without its last character.

    The last character is the one that may be replaced or inserted; the terminator is not.
    """
    size = F.length("word")

    def rotation(i: Column) -> Column:
        return F.concat(F.substring(F.col("word"), i + 1, size), F.lit(END), F.substring(F.col("word"), F.lit(1), i))

    rows = vocabulary.select("word", "n", F.explode(F.transform(F.sequence(F.lit(0), size), rotation)).alias("_rotation"))
    whole = F.struct(F.col("_rotation").alias("prefix"), F.lit("").alias("edited"))
    cut = F.struct(
        F.substring(F.col("_rotation"), F.lit(1), F.length("_rotation") - 1).alias("prefix"),
        F.substring(F.col("_rotation"), -1, 1).alias("edited"),
    )
    return rows.select("word", "n", F.explode(F.array(whole, cut)).alias("_e")).select(
        "_e.prefix", "_e.edited", "word", "n"
    ).filter(F.col("edited") != END)


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words that differ by one inserted, deleted or replaced
    character, both ways round."""
    groups = rotations(vocabulary).groupBy("prefix").agg(
        F.sort_array(F.collect_list(F.struct("edited", "word", "n"))).alias("_group")
    ).filter(F.size("_group") > 1)
    seen = groups.select("prefix", "_group", F.explode("_group").alias("_x"))

    def meets(y: Column) -> Column:
        replaced = (F.col("_x.edited") != "") & (y["edited"] != "")
        first = F.greatest(F.col("_x.edited"), y["edited"]) != F.substring(F.col("prefix"), -1, 1)
        return (y["word"] != F.col("_x.word")) & (replaced | first)

    return seen.select(
        F.col("_x.word").alias("word"), F.col("_x.n").alias("n"), F.explode(F.filter("_group", meets)).alias("_y")
    ).select("word", "n", F.col("_y.word").alias("near"), F.col("_y.n").alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Every round doubles how far forms are followed."""
    ends = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ends = materialise(ends.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
        ), "roots")
        if not ends.filter("_moved").limit(1).count():
            return ends.select("word", "root")
        ends = ends.select("word", "root")


def variants(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of (word, n) without repeated words."""
    kept = materialise(vocabulary.select("word", "n"), "words")
    best = neighbours(kept).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("_best")
    )
    formed = materialise(kept.join(best, "word", "left").withColumn(
        "_strong", -F.col("_best.less") >= ratio * F.col("n")
    ).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(F.col("_strong"), F.col("_best.near")).alias("form"),
        F.when(F.col("_strong"), -F.col("_best.less")).alias("form_n"),
    ), "forms")
    roots = _roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
