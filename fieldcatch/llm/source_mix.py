"""Mixing sources to target weights.

The words of each source, document after document, are packed into blocks of fixed length and numbered.
Output shards draw how many blocks they take from each source from a multinomial; the draws of a
source, counted over the shards, are slots, and a pseudorandom permutation of the source's block
numbers (a new one for each pass over the source) says which block a slot takes. Draws beyond a
source's quota are left out and what it lacks goes to one last shard, so every source meets its
target to within a block.

A null text has no words; a null source is a source of its own, the last one. Repeated rows are documents of
their own. Everything is a function of the rows and the seed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcatch.runtime import local_table, materialise

#: White space between words; the weights of the sources, in turn.
WHITE = r"[\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: Words in a block, and blocks drawn for an output shard.
BLOCK_WORDS, SHARD_SLOTS = 128, 4096
#: Documents whose places in their source are summed up in one group.
GROUP_ROWS = 8192
#: The mix has one row per source, which the driver and every task hold; more sources are refused.
MOST_SOURCES = 100_000


@dataclass(frozen=True)
class Share:
    """One source of the mix; `quota` counts blocks to take, all passes together."""

    rank: int
    source: str | None
    size: int
    target: float
    quota: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, WHITE), "")), F.lit(0)).cast("bigint")


def fill(sizes: list[int], weights: list[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of `total` by weight; none above `most` times its size, the excess shared again."""
    targets, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = total
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > most * sizes[i]}
        for i in over or open_:
            targets[i] = float(most * sizes[i]) if over else level * weights[i]
        if not over:
            break
        left -= sum(targets[i] for i in over)
        open_ -= over
    return targets


def shares(sized: DataFrame, weights=WEIGHTS, total_share: float = 1.5, most: float = 2.0,
           block_words: int = BLOCK_WORDS) -> list[Share]:
    """Targets and block quotas of all sources, in code point order with null last."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in rows]
    turn = [float(weights[i % len(weights)]) for i in range(len(rows))]
    targets = fill(sizes, turn, total_share * sum(sizes), most)
    found = []
    for i, (row, size, target) in enumerate(zip(rows, sizes, targets)):
        blocks = -(-size // block_words)
        passes, rest = divmod(target, size) if size else (0, 0)
        quota = int(passes) * blocks + (round(rest * blocks / size) if size else 0)
        found.append(Share(i, row["source"], size, target, min(quota, int(most * blocks))))
    return found


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed pseudorandom permutation of range(size) puts each index, element by element.

    Four Feistel rounds on the smallest even number of bits that holds `size`; results outside the range
    are permuted again until they fall inside.
    """
    index, size, key = (np.asarray(a).astype(np.uint64) for a in (index, size, key))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2).astype(float)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(4):
            mixed = (right + np.uint64(turn + 1)) * np.uint64(0x9E3779B97F4A7C15) ^ k
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def slots(spark, mix: list[Share], block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS,
          seed: int = 17) -> DataFrame:
    """(shard, rank, pass, block): every block the mix takes, and the output shard that takes it."""
    quotas = np.array([s.quota for s in mix], dtype=np.int64)
    blocks = np.array([-(-s.size // block_words) for s in mix], dtype=np.int64)
    total = int(quotas.sum())
    shards = -(-total // shard_slots)
    chance = quotas / max(total, 1)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                n = min(shard_slots, total - shard * shard_slots)
                drawn = np.random.Generator(np.random.Philox(key=[seed, shard])).multinomial(n, chance)
                at = np.flatnonzero(drawn)
                yield pd.DataFrame({"shard": shard, "rank": at.astype("int32"), "n": drawn[at]})

    drawn = spark.range(shards).mapInPandas(draw, "shard bigint, rank int, n bigint")
    before = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    limits = F.broadcast(local_table(  # one row per source
        spark, [(s.rank, s.quota) for s in mix], "rank int, quota bigint"
    ))
    begun = drawn.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).join(limits, "rank")
    inside = begun.select("shard", "rank", "begin", F.least(F.col("begin") + F.col("n"), "quota").alias("end"))
    lacking = limits.join(drawn.groupBy("rank").agg(F.sum("n").alias("begin")), "rank", "left").select(
        F.lit(shards).cast("bigint").alias("shard"), "rank", F.coalesce("begin", F.lit(0)).alias("begin"),
        F.col("quota").alias("end"),
    )
    numbered = inside.unionByName(lacking).filter("begin < end").select(
        "shard", "rank", F.explode(F.sequence("begin", F.col("end") - 1)).alias("slot")
    )

    def look(rank: pd.Series, slot: pd.Series) -> pd.DataFrame:
        ranks = rank.to_numpy()
        size = blocks[ranks]
        round_, at = np.divmod(slot.to_numpy(), size)
        key = (ranks.astype(np.uint64) * np.uint64(0x94D049BB133111EB)
               + round_.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
        return pd.DataFrame({"pass": round_.astype("int32"), "block": permuted(at, size, key)})

    # a filter on its result must not run it once more beside itself: that takes another worker for each task
    taken = F.pandas_udf(look, "pass int, block bigint").asNondeterministic()(F.col("rank"), F.col("slot"))
    return numbered.withColumn("_taken", taken).select("shard", "rank", "_taken.pass", "_taken.block")


def sized_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, _tie) of every row, written once; `_tie` tells rows of one id apart."""
    others = [F.col(c).cast("string") for c in sorted(docs.columns) if c != "doc_id"]
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       F.xxhash64(*others).alias("_tie"))


def placed(sized: DataFrame, mix: list[Share]) -> DataFrame:
    """`sized` plus rank, source_size, target and `begin`, the first word's number in its source.

    Sums run inside small groups of documents, and over one row per group and source after that.
    """
    spark = sized.sparkSession
    table = F.broadcast(local_table(  # one row per source
        spark, [(s.source, s.rank, s.size, s.target) for s in mix],
        "_source string, rank int, source_size bigint, target double",
    ))
    groups = max(1, math.ceil(sized.count() / GROUP_ROWS))
    ranked = sized.join(table, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "_tie"), F.lit(groups))
    )
    inside = Window.partitionBy("rank", "_group").orderBy("doc_id", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("rank").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranked.groupBy("rank", "_group").agg(F.sum("size").alias("_n")).select(
        "rank", "_group", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_start")
    )
    return ranked.withColumn("_within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, ["rank", "_group"]
    ).withColumn("begin", F.col("_start") + F.col("_within")).drop("_group", "_start", "_within")


def _parts(rows: DataFrame, block_words: int) -> DataFrame:
    """One row per document and block it reaches into: words [from, to) of the document."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / block_words).cast("bigint")
    first = F.floor(F.col("begin") / block_words).cast("bigint")
    return rows.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last))).withColumns({
        "from": F.greatest(F.col("block") * block_words - F.col("begin"), F.lit(0)),
        "to": F.least((F.col("block") + 1) * block_words - F.col("begin"), "size"),
    })


def mix_counts(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words of the document in the mix)."""
    sized = materialise(sized_documents(docs), "sized")
    mix = shares(sized, block_words=block_words)
    rows = placed(sized, mix)
    times = slots(docs.sparkSession, mix, block_words, seed=seed).groupBy("rank", "block").count()
    keys = ["doc_id", "source", "rank", "begin", "size", "source_size", "target"]
    hit = _parts(rows, block_words).join(times, ["rank", "block"], "left").groupBy(*keys).agg(
        F.sum((F.col("to") - F.col("from")) * F.coalesce("count", F.lit(0))).alias("taken")
    )
    empty = rows.filter("size = 0").select(*keys, F.lit(0).cast("bigint").alias("taken"))
    return hit.unionByName(empty).drop("rank", "begin")


def _cut(text: str, ranges: list[tuple[int, int]]) -> str:
    """The words of the ranges, each range as it stands in the text, ranges parted by a line break."""
    merged: list[list[int]] = []
    for a, b in sorted(ranges):
        if merged and merged[-1][1] == a:
            merged[-1][1] = b
        else:
            merged.append([a, b])
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return "\n".join(text[words[a][0]:words[b - 1][1]] for a, b in merged)


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """The mix as documents: for each document and pass, the words taken; `docs`' columns.

    `n_chars`, where there is one, is the length of the new text. A document taken whole keeps its
    words and the white space between them.
    """
    sized = materialise(sized_documents(docs), "sized")
    mix = shares(sized, block_words=block_words)
    chosen = slots(docs.sparkSession, mix, block_words, seed=seed).select("rank", "block", "pass")
    ranges = _parts(placed(sized, mix), block_words).join(chosen, ["rank", "block"]).groupBy(
        "doc_id", "_tie", "begin", "pass"
    ).agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("_ranges")).groupBy("doc_id", "_tie").agg(
        F.collect_list("_ranges").alias("_copies")
    )
    names = docs.columns
    others = [F.col(c).cast("string") for c in sorted(names) if c != "doc_id"]
    texts = docs.withColumn("_tie", F.xxhash64(*others)).dropDuplicates(["doc_id", "_tie"])

    def cut(text: pd.Series, ranges: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, [(r["from"], r["to"]) for r in rs]) for t, rs in zip(text, ranges)])

    cut_udf = F.pandas_udf(cut, "string")
    copies = texts.withColumnRenamed("doc_id", "_id").join(
        ranges.withColumnRenamed("doc_id", "_rid").withColumnRenamed("_tie", "_rtie"),
        F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_tie") == F.col("_rtie")),
    ).withColumn("_range", F.explode("_copies")).withColumnRenamed("_id", "doc_id")
    out = copies.withColumn("text", cut_udf("text", "_range"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
