"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query: alternatives, each a set of trigrams
every match must contain. Postings (trigram, text) are made for the trigrams some rule asks for,
intersected per alternative, and only texts that answer a rule's query are searched with its
expression. Rules whose expression guarantees no trigram scan every text.

Null text counts as empty. Spans are in code points, end exclusive. Rows that repeat a document are
scanned once and each get the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.runtime import local_table

try:
    from re import _parser as _sre  # Python 3.11 and later
except ImportError:
    import sre_parse as _sre  # type: ignore[no-redef]


@dataclass(frozen=True)
class Rule:
    """`pattern` finds candidates left to right; those whose `group` is shorter than `least` fall away."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


#: The base kinds in their order.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
)
#: Kinds the method adds; listed after the base kinds.
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"ghp_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xoxb-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("stripe", r"sk_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + ADDED_RULES
#: An expression with more alternatives than this, or trigrams per alternative beyond the second
#: number, is not expanded further: a query may be weaker than the rule, never stronger.
MOST_BRANCHES, MOST_GRAMS = 32, 3


def _runs(parsed) -> list[list[str]] | None:
    """For each alternative the runs of literal characters every match contains; None if too many."""
    found: list[list[str]] = [[""]]
    for op, value in parsed:
        name = str(op)
        if name == "LITERAL":
            found = [[*runs[:-1], runs[-1] + chr(value).lower()] for runs in found]
            continue
        if name == "SUBPATTERN":
            inner = _runs(value[3])
        elif name == "BRANCH":
            parts = [_runs(branch) for branch in value[1]]
            inner = None if None in parts else [runs for part in parts for runs in part]
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, body = value
            once = _runs(body)
            if least == 0 and most == 1:
                inner = None if once is None else [[""], *once]
            elif least == 0 or once is None:
                inner = [["", ""]]
            else:  # at least one copy; what follows it is not known to touch it
                inner = [[*runs, ""] for runs in ([[""], *once][1:] if least == most == 1 else
                                                  [["", *runs] for runs in once])]
        else:
            inner = [["", ""]]  # a class, an anchor: breaks the run
        if inner is None or len(found) * len(inner) > MOST_BRANCHES:
            return None
        found = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in found for b in inner]
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams, one of which all occur (lower-cased) in any text that matches.

    None if the expression promises no trigram. At most `MOST_GRAMS` are kept of an alternative,
    spread over it.
    """
    branches = _runs(_sre.parse(pattern))
    if branches is None:
        return None
    query = []
    for runs in branches:
        grams = list(dict.fromkeys(run[i:i + 3] for run in runs for i in range(len(run) - 2)))
        if not grams:
            return None
        step = max(1, (len(grams) - 1) // max(1, MOST_GRAMS - 1))
        query.append(frozenset(grams[::step][:MOST_GRAMS]))
    return list(dict.fromkeys(query))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(body, F.length(body)).alias("_print"), body.alias("_body"),
    )


def postings(docs: DataFrame, grams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(gram, _id, _print): which text contains which of the trigrams, letters in either case."""
    low = _keyed(docs, doc_id, text).withColumn("_body", F.lower("_body"))
    present = F.array_compact(F.array(*[
        F.when(F.contains(F.col("_body"), F.lit(g)), F.lit(g)) for g in grams
    ]))
    return low.select("_id", "_print", F.explode(present).alias("gram"))


def candidates(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _print, kinds): the rules with a trigram query that the text answers."""
    spark = docs.sparkSession
    rows = [
        (gram, rule.kind, branch, len(grams))
        for rule in rules for branch, grams in enumerate(trigram_query(rule.pattern) or [])
        for gram in sorted(grams)
    ]
    wanted = local_table(spark, rows, "gram string, kind string, branch int, need int")
    listed = postings(docs, sorted({r[0] for r in rows}), doc_id, text)
    # the query table is as small as the rules are few
    met = listed.join(F.broadcast(wanted), "gram").groupBy("_id", "_print", "kind", "branch", "need").agg(
        F.count_distinct("gram").alias("have")
    ).filter("have = need")
    return met.groupBy("_id", "_print").agg(F.collect_set("kind").alias("kinds"))


def spans_of(body: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, kind, end) of the rule's matches: match lengths and gaps, added up."""
    hits = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(0))
    values = F.regexp_extract_all(body, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.split(body, rule.pattern)
    steps = F.zip_with(F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("g"), h.alias("h"))), values,
                       lambda x, v: F.struct(F.length(x.g).alias("gap"), F.length(x.h).alias("len"),
                                             F.length(v).alias("val")))
    kind = "array<struct<start:int,rank:int,kind:string,end:int>>"
    walked = F.aggregate(
        F.filter(steps, lambda x: x.len.isNotNull()),
        F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found")),
        lambda acc, x: F.struct(
            (acc.at + x.gap + x.len).alias("at"),
            F.when(x.val < rule.least, acc.found).otherwise(F.concat(acc.found, F.array(F.struct(
                (acc.at + x.gap).alias("start"), F.lit(order).alias("rank"),
                F.lit(rule.kind).alias("kind"), (acc.at + x.gap + x.len).alias("end"),
            )))).alias("found"),
        ),
    )
    return F.when(body.rlike(rule.pattern), walked.found).otherwise(F.array().cast(kind))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def find_secrets(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` plus `secret_spans` (array of start, rank, kind, end, in text order).

    Only texts that answer a query are shuffled to their candidates, and only narrow rows after that.
    """
    ranks = {rule.kind: i for i, rule in enumerate(rules)}
    queried = [r for r in rules if trigram_query(r.pattern) is not None]
    scanned = [r for r in rules if trigram_query(r.pattern) is None]
    keyed = _keyed(docs, doc_id, text)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    checked = keyed.join(candidates(docs, queried, doc_id, text), ["_id", "_print"]).select(
        "_id", "_print", F.concat(*[
            F.when(F.array_contains("kinds", r.kind), spans_of(F.col("_body"), r, ranks[r.kind])).otherwise(none)
            for r in queried
        ]).alias("_verified"),
    ).groupBy("_id", "_print").agg(F.any_value("_verified").alias("_verified"))
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.withColumns({
        "_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")),
        "_print": F.xxhash64(body, F.length(body)),
        "_scanned": F.concat(none, *[spans_of(body, r, ranks[r.kind]) for r in scanned]),
    })
    return own.join(checked, ["_id", "_print"], "left").withColumn(
        "secret_spans",
        F.array_sort(F.concat("_scanned", F.coalesce("_verified", none))),
    ).drop("_id", "_print", "_scanned", "_verified")


def digest(found: DataFrame, rules=RULES) -> DataFrame:
    """Counts and digests of `secret_spans`, one row per row of `find_secrets`."""
    base = {rule.kind for rule in rules if rule.base}
    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s.kind == kind)).cast("bigint")

    return found.withColumns({
        "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
        "base_sha256": F.sha2(_joined(F.filter("secret_spans", lambda s: s.kind.isin(*sorted(base)))), 256),
        "spans": _joined(F.col("secret_spans")),
    })


def mask(found: DataFrame, text: str = "text", marker: str = "<SECRET>") -> Column:
    """The text with every span replaced by `marker`; overlapping spans fall together."""
    body = F.col(text)
    walked = F.aggregate(
        "secret_spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s.end <= acc.at, acc).otherwise(F.struct(
            F.when(s.start < acc.at, acc.out).otherwise(F.concat(
                acc.out, F.substr(body, acc.at + 1, s.start - acc.at), F.lit(marker)
            )).alias("out"),
            s.end.alias("at"),
        )),
    )
    rest = F.substr(body, walked.at + 1, F.length(body))
    return F.when(F.size("secret_spans") > 0, F.concat(walked.out, rest)).otherwise(body)
