"""Quality rules as a short-circuit cascade.

A first pass turns each text into a few counts. The rules are conditions on those counts; a sample
tells how many rows each rule rejects and how long it takes, and the rules then run in order of
rejections per second inside one CASE expression, which stops at the first rule that rejects.
The order changes the cost and the `rejected_by` label, never the verdict.

Null and empty texts have no words. Input columns keep their names; the counts are added, and a
column of the same name is replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.runtime import materialise

#: Characters of words, white space other than one blank, and symbols.
WORD = r"[^\x20\x09-\x0D]"
UNEVEN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows the cost and selectivity of the rules are estimated on, at most about this many.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """Rejects the rows for which `fails` holds; `fails` sees the columns of `measure`."""

    name: str
    fails: Callable[[], Column]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all bigint).

    `_flat` (words parted by one blank) and `_solid` (no white space) stay for rules that read text.

    n_dup_lines counts lines with a word that equal an earlier line; n_repeat_words counts the
    words inside windows of eight words that occur twice or more, their first occurrence included.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    plain = docs.withColumn("_body", body).withColumn(
        "_flat", F.trim(F.regexp_replace("_body", UNEVEN, " "))
    ).withColumns({"_solid": F.replace("_flat", F.lit(" "), F.lit("")), "_words": F.split("_flat", " ")})
    counted = plain.withColumns({
        "word_chars": F.length("_solid").cast("bigint"),
        "n_words": F.when(F.col("_flat") == "", 0).otherwise(F.size("_words")).cast("bigint"),
        "n_symbols": (F.length("_solid") - F.length(reduce(
            lambda x, c: F.replace(x, F.lit(c), F.lit("")), SYMBOLS, F.col("_solid")
        ))).cast("bigint"),
        "_lines": F.filter(F.split("_body", "\n"), lambda x: x.rlike(WORD)),
    })
    counted = _with_prints(counted).withColumn("_placed", F.when(
        F.size("_prints") > F.size(F.array_distinct("_prints")),
        F.sort_array(F.transform(
            F.sequence(F.lit(1), F.size("_words") - WINDOW + 1),
            lambda i: F.struct(F.array_join(F.slice("_words", i, WINDOW), " ").alias("w"), i.alias("i")),
        )),
    ))
    return counted.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.coalesce(_covered(F.col("_placed")), F.lit(0)).cast("bigint"),
    }).drop("_body", "_words", "_lines", "_prints", "_placed")


def _with_prints(df: DataFrame) -> DataFrame:
    """Add `_prints`: a hash of every run of eight words, doubled up from one word to two, four, eight.

    Only tells whether a run may occur twice; the runs themselves are compared then. Each doubling
    is a column of its own: within one expression Spark would evaluate the one below again and again.
    """
    df = df.withColumn("_prints", F.when(
        F.size("_words") >= WINDOW, F.transform("_words", lambda w: F.xxhash64(w))
    ))
    for step in (1, 2, 4):
        df = df.withColumn("_prints", F.zip_with(
            "_prints", F.slice("_prints", F.lit(1 + step), F.size("_words")),
            lambda x, y: F.xxhash64(x, y),
        ))
    return df.withColumn(
        "_prints", F.slice("_prints", F.lit(1), F.greatest(F.size("_words") - WINDOW + 1, F.lit(0)))
    )


def _covered(placed: Column) -> Column:
    """Number of words inside runs that occur more than once; `placed` are the sorted runs."""
    twice = F.transform(placed, lambda own, k: F.when(
        (own.w == F.get(placed, k - 1).w) | (own.w == F.get(placed, k + 1).w), own.i
    ))
    starts = F.array_sort(F.filter(twice, lambda i: i.isNotNull()))
    swept = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, at: F.struct(
            (acc.n + F.least(F.lit(WINDOW), at - acc.last)).alias("n"), at.alias("last")
        ),
    )
    return swept.n


def _only(kept: str) -> Column:
    """Number of characters of the text that are in the class `kept`."""
    return F.length(F.regexp_replace("_solid", f"[^{kept}]+", ""))


#: The method's own rules; the thresholds leave ordinary prose alone in languages that part words by white
#: space. long_words rejects Chinese, Japanese or Thai prose, parted only by sentences. The last ones read the text again, which the cascade spares the rows an earlier rule has rejected.
RULES = (
    Rule("symbols", lambda: F.col("n_symbols") * 4 > F.col("n_words")),
    Rule("dup_lines", lambda: F.col("n_dup_lines") * 10 > F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < F.col("n_words") * 2),
    Rule("long_words", lambda: F.col("word_chars") > F.col("n_words") * 20),
    Rule("digits", lambda: _only("0-9") * 2 > F.col("word_chars")),
    Rule("stutter", lambda: F.regexp_count(
        "_flat", F.lit(r"(?<![^ ])([^ ]++)(?= \1(?![^ ]))")) * 3 > F.col("n_words")),
    Rule("shouting", lambda: _only("A-Z") * 2 > F.col("word_chars")),
)


def base_fails() -> Column:
    """What rejects a text before the cascade."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rank_rules(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Seconds and rejected share of each rule on a sample, most rejections per second first.

    The sample is a fraction of the rows that gives about `sample_rows` at any size; it is measured
    and written to the shared folder once, so that each rule is timed alone.
    """
    total = docs.count()
    if not total:
        return [{"rule": r, "seconds": 0.0, "rejected": 0.0} for r in rules]
    rows = docs.select(text).sample(fraction=min(1.0, sample_rows / total), seed=7)
    sample = materialise(measure(rows, text), "rules")
    n = sample.count()
    figures = []
    for rule in rules:
        began = time.perf_counter()
        bad = sample.filter(rule.fails()).count()
        figures.append({
            "rule": rule, "seconds": time.perf_counter() - began, "rejected": bad / max(n, 1),
        })
    return sorted(figures, key=lambda f: -f["rejected"] / max(f["seconds"], 1e-6))


def cascade(measured: DataFrame, rules) -> DataFrame:
    """Add `rejected_by`: the first rule, in the given order, that rejects the row; null if none."""
    first = F.lit(None).cast("string")
    for rule in reversed(list(rules)):
        first = F.when(rule.fails(), F.lit(rule.name)).otherwise(first)
    return measured.withColumn("rejected_by", first)


def judge(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts of every text, `base_failed`, `kept`, and the rule that rejected it (`rejected_by`).

    The base rules come first for every row; the ranked cascade decides about those that pass.
    """
    ranked = [f["rule"] for f in rank_rules(docs, rules, text, sample_rows)]
    judged = cascade(measure(docs, text), [Rule("base", base_fails), *ranked])
    return judged.withColumns({
        "base_failed": base_fails(), "kept": F.col("rejected_by").isNull(),
    }).drop("_flat", "_solid")
