"""Merkle manifest of a table of documents, with a proof of every row.

A leaf is the digest of a row. The leaves of a source, in order of their ids, are hashed three by three until
one node is left, the source's subroot; the subroots, in order of their sources, likewise give the root.
Leaves are numbered through a range partitioning, so a source of any size spreads over many tasks, and
hashed in blocks of 3^6 that rise six levels at a time.

Proofs come by pointer jumping: a node holds the siblings on its way to an ancestor, at first its parent.
A self-join on that ancestor doubles the distance and joins the two segments, until every leaf reaches
the root; the joins grow with the logarithm of the depth. After a round only levels that later rounds
ask for are kept. As an ancestor far up is asked for by thousands of leaves, both sides of the join also
carry the stretch of leaves they belong to, which bounds the rows of a key.

Every row is a leaf, rows without an id or text included; null ids come last, rows with equal ids follow
the order of their digests, rows equal in all fields have equal leaves and places next to each other. A null
source is a source of its own, before all others. Other columns are not hashed. An empty table
gives an empty manifest.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.operators.ordering import number_rows
from fieldcatch.runtime import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
#: Levels a block of nodes rises in one task.
RISE = 6
#: Leaves that share a key of the joins; stretches a source's rows are dealt to when its facts are looked up.
STRETCH, DEAL = FAN ** 9, 32

_NODES = "tree bigint, n bigint, level int, idx bigint, node binary, left binary, right binary"


def digest(*fields: Column) -> Column:
    """SHA-256 of the fields, each `-` if null, else its bytes' number, a colon and its text; as hex text."""
    parts = []
    for field in fields:
        words = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(words).cast("string"), F.lit(":"), words), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def depth(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FAN), levels + 1
    return levels


def fold(nodes: list[bytes], whole: bool, rise: int = RISE) -> list[list[bytes]]:
    """The levels above and with `nodes`: up to one node if these are a whole tree's, else `rise` levels."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= rise:
        below = [n.hex() for n in levels[-1]]
        levels.append([
            hashlib.sha256("".join(below[i:i + FAN]).encode()).digest() for i in range(0, len(below), FAN)
        ])
    return levels


def _fold_blocks(base: int, rise: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, n, many, block, nodes in zip(
                batch["tree"], batch["n"], batch["many"], batch["block"], batch["nodes"]
            ):
                levels = fold(list(nodes), many <= FAN ** rise, rise)
                for k, level in enumerate(levels):
                    first = block * FAN ** (rise - k)
                    for i, node in enumerate(level):
                        a = i - i % FAN
                        last = k == len(levels) - 1
                        left = None if last else b"".join(level[a:i])
                        right = None if last else b"".join(level[i + 1:a + FAN])
                        out.append((tree, n, base + k, first + i, node, left, right))
            yield pd.DataFrame(out, columns=["tree", "n", "level", "idx", "node", "left", "right"])

    return run


def grow(leaves: DataFrame, rise: int = RISE) -> tuple[DataFrame, DataFrame, int]:
    """Nodes below the roots, roots (tree, root), and the depth of the deepest tree.

    `leaves` has tree, idx (from 0), n (leaves of the tree) and node, the digest.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    span = FAN ** rise
    current, base, many = leaves.withColumn("many", F.col("n")), 0, largest
    below, roots = [], []
    while True:
        blocks = current.groupBy("tree", F.floor(F.col("idx") / span).alias("block")).agg(
            F.max("n").alias("n"), F.max("many").alias("many"),
            F.sort_array(F.collect_list(F.struct("idx", "node")))["node"].alias("nodes"),
        )
        made = materialise(blocks.mapInPandas(_fold_blocks(base, rise), _NODES), "nodes")
        below.append(made.filter("left IS NOT NULL"))
        tops = made.filter("left IS NULL").withColumn(
            "many", F.ceil(F.col("n") / FAN ** (base + rise)).cast("bigint")
        )
        done = (F.col("level") < base + rise) | (F.col("many") == 1)
        roots.append(tops.filter(done).select("tree", F.col("node").alias("root")))
        if many <= span:
            break
        current = tops.filter(~done).select("tree", "idx", "n", "node", "many")
        base, many = base + rise, -(-many // span)
    nodes, ends = below[0], roots[0]
    for more, end in zip(below[1:], roots[1:]):
        nodes, ends = nodes.unionByName(more), ends.unionByName(end)
    return nodes, ends, depth(largest)


def _leaves_below(level: Column) -> Column:
    return F.pow(F.lit(float(FAN)), level).cast("bigint")


def _jump(low: DataFrame, up: DataFrame, reach: int, stretch: int) -> DataFrame:
    """Segments of `low`, `reach` levels long, with those of the ancestors they end at behind them."""
    first, size = F.col("idx") * _leaves_below(F.col("level")), _leaves_below(F.col("level"))
    to = F.floor(F.col("idx") / FAN ** reach)
    asks = low.withColumns({
        "_level": F.col("level") + reach, "_at": to, "_stretch": F.floor(first / stretch),
    })
    last = F.least(first + size, F.col("n")) - 1
    gives = up.select(
        "tree", F.col("level").alias("_level"), F.col("idx").alias("_at"), F.col("steps").alias("_more"),
        F.explode(F.sequence(F.floor(first / stretch), F.floor(last / stretch))).alias("_stretch"),
    )
    return asks.join(gives, ["tree", "_stretch", "_level", "_at"], "left").withColumn(
        "steps", F.when(F.col("_more").isNull(), F.col("steps")).otherwise(F.concat("steps", "_more"))
    ).select(*low.columns)


def paths(nodes: DataFrame, levels: int, stretch: int = STRETCH) -> DataFrame:
    """(tree, idx, steps) of each leaf that has siblings or parents: what stands left and right of its way
    to the root of its tree, level by level."""
    held = nodes.select("tree", "level", "idx", "n", F.array(F.struct("left", "right")).alias("steps"))
    leaves, inner, reach = held.filter("level = 0"), held.filter("level > 0"), 1
    while reach < levels:
        turn = F.col("level") % (2 * reach)
        up = inner.filter(turn == reach)
        leaves = _jump(leaves, up, reach, stretch)
        inner = materialise(_jump(inner.filter(turn == 0), up, reach, stretch), "segments")
        reach *= 2
    return leaves.select("tree", "idx", "steps")


def _hex(column: Column | str) -> Column:
    return F.lower(F.hex(column))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf, as hex text, and the siblings on its way give."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])), 256))


def manifest(docs: DataFrame, altered: Column | None = None, fields: tuple[str, ...] = FIELDS,
             group: str = "source", order: str = "doc_id", rise: int = RISE, stretch: int = STRETCH) -> DataFrame:
    """One row per document: `order`, leaf, subroot, root, steps (the siblings left and right of its way, as
    bytes, level by level), and changed, the leaf of the row with the text `altered` gives, if that is another.
    """
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))  # null comes first
    leaf = digest(*map(F.col, fields))
    other = leaf if altered is None else digest(*[altered if f == "text" else F.col(f) for f in fields])
    hashed = docs.select(
        F.col(order).alias("_id"), name.alias("_group"), F.unhex(leaf).alias("node"),
        F.unhex(F.when(other != leaf, other)).alias("_changed"),
    )
    numbered = number_rows(materialise(hashed, "leaves"), ["_group", "_id", "node", "_changed"], "_number")
    groups = number_rows(
        numbered.groupBy("_group").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("n")),
        ["_group"], "tree",
    )

    def dealt(facts: DataFrame) -> DataFrame:
        return facts.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))))

    places = materialise(
        numbered.withColumn("_deal", F.pmod("_number", F.lit(DEAL)).cast("int")).join(dealt(groups), ["_group", "_deal"])
        .select("tree", (F.col("_number") - F.col("_first")).alias("idx"), "n", "node", "_id", "_changed"), "places",
    )
    nodes, subroots, levels = grow(places.select("tree", "idx", "n", "node"), rise)
    count = subroots.count()
    top, root, above = grow(subroots.select(
        F.lit(0).cast("bigint").alias("tree"), (F.col("tree") - 1).alias("idx"),
        F.lit(count).cast("bigint").alias("n"), F.col("root").alias("node"),
    ), rise)
    end = root.select("root").first()
    nothing = F.lit(None).cast("array<struct<left:binary,right:binary>>")
    upper = paths(top, above, stretch).select((F.col("idx") + 1).alias("tree"), F.col("steps").alias("_upper"))
    facts = subroots.withColumnRenamed("root", "_subroot").join(upper, "tree", "left") if above else (
        subroots.withColumnRenamed("root", "_subroot").withColumn("_upper", nothing)
    )
    ways = places.join(paths(nodes, levels, stretch), ["tree", "idx"], "left") if levels else (
        places.withColumn("steps", nothing)
    )
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    return ways.withColumn("_deal", F.pmod("idx", F.lit(DEAL)).cast("int")).join(dealt(facts), ["tree", "_deal"]).select(
        F.col("_id").alias(order), _hex("node").alias("leaf"), _hex("_subroot").alias("subroot"),
        F.lit(bytes(end[0]).hex() if end else None).cast("string").alias("root"),
        F.concat(F.coalesce("steps", none), F.coalesce("_upper", none)).alias("steps"),
        _hex("_changed").alias("changed"),
    )


def verify(proofs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, and folded_root and verified of the changed leaf, if there is
    one, else of the leaf itself."""
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")
    seen = proofs.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("steps")))
    return seen.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def tampered(text: Column, key: Column) -> Column:
    """`text` without its line feeds where 2 divides the crc32 of the decimal key, else as it is."""
    hit = F.coalesce(F.crc32(key.cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
