"""Exact top-k by inner product with vector-approximation files.

Vectors are kept in blocks. A block's approximation file has, for every vector and dimension, the number of
a cell of equal width; a cell bounds the component and so, for a query, the score. Scanning the small
files gives each query a certain lower limit for its kth score and the vectors whose upper bound
reaches it. Exact vectors are then read in order of the bound: first the best few, whose kth score
raises the limit, then only what still reaches it.

Components are floor(256 x). Vectors that are null or hold null or non-finite components take no part; rows
that repeat an id and vector count once; only vectors of one length are compared. A query never
meets rows of its own id. Of equal vectors only the k + 1 smallest ids can be results, so only those
are kept. Scores must stay below 2^53.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcatch.runtime import materialise

BLOCK_ROWS, QUERY_ROWS = 4096, 512
CELL_BITS = 6


def quantised(column: Column) -> Column:
    """Integer components, or null if the vector takes no part."""
    wide = F.transform(column, lambda x: x.cast("double"))
    sound = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(column.isNotNull() & sound, F.transform(wide, lambda x: F.floor(256 * x).cast("bigint")))


def _vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vec_id, vec, _row, dims) of the vectors that can be results."""
    sound = rows.select("vec_id", quantised(F.col("embedding")).alias("vec")).filter(
        F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
    ).distinct()
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    return sound.withColumn("_n", place).filter(F.col("_n") <= k + 1).select(
        "vec_id", "vec", F.xxhash64("vec_id", "vec").alias("_row"), F.size("vec").alias("dims")
    )


def approximations(vectors: DataFrame, block_rows: int = BLOCK_ROWS, bits: int = CELL_BITS) -> DataFrame:
    """One row per block and vector length: ids and cells, and the first value and width of the cells."""
    blocks = max(1, math.ceil(vectors.count() / block_rows))

    def quantise(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.array(rows["vec"].tolist(), dtype=np.int64).reshape(len(rows), -1)
        low = values.min(axis=0)
        width = (values.max(axis=0) - low) // (1 << bits) + 1
        return pd.DataFrame({
            "dims": [int(rows["dims"].iloc[0])], "ids": [rows["vec_id"].tolist()], "keys": [rows["_row"].tolist()],
            "cells": [((values - low) // width).astype(np.uint8).tobytes()],
            "low": [low.tolist()], "width": [width.tolist()],
        })

    return vectors.withColumn("_block", F.pmod("_row", F.lit(blocks))).groupBy("_block", "dims").applyInPandas(
        quantise, "dims int, ids array<bigint>, keys array<bigint>, cells binary, low array<bigint>, width array<bigint>"
    )


def _query_blocks(queries: DataFrame, n: int) -> DataFrame:
    return queries.withColumn("_group", F.pmod("_row", F.lit(n))).groupBy("_group", "dims").agg(
        F.collect_list(F.struct("vec_id", "_row", "vec")).alias("asked")
    )


def _scan(k: int):
    def scan(pairs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for ids, keys, cells, low, width, asked in zip(
            pairs["ids"], pairs["keys"], pairs["cells"], pairs["low"], pairs["width"], pairs["asked"]
        ):
            ids, keys = np.asarray(ids), np.asarray(keys)
            low, width = np.asarray(low, dtype=float), np.asarray(width, dtype=float)
            cell = np.frombuffer(cells, dtype=np.uint8).reshape(len(ids), -1).astype(float)
            middle = low + cell * width + (width - 1) / 2
            q = np.array([a["vec"] for a in asked], dtype=float).reshape(len(asked), -1)
            score = q @ middle.T
            slack = np.abs(q) @ ((width - 1) / 2)
            own = np.array([a["vec_id"] for a in asked])[:, None] == ids[None, :]
            score[own] = -np.inf
            for a, scores, s in zip(asked, score, slack):
                usable = np.isfinite(scores)
                limit = np.partition(scores[usable], -k)[-k] - s if usable.sum() >= k else -np.inf
                hit = np.flatnonzero(usable & (scores + s >= limit))
                out.append((a["vec_id"], a["_row"], float(limit), keys[hit].tolist(), ids[hit].tolist(),
                            (scores[hit] + s).tolist()))
        return pd.DataFrame(out, columns=["query_id", "_query", "limit", "keys", "ids", "bounds"])

    return scan


def _exact(found: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """Reads the vectors of candidates and scores them."""
    asked = queries.select(F.col("_row").alias("_query"), F.col("vec_id").alias("query_id"), F.col("vec").alias("_asked"))
    held = vectors.select("vec_id", "_row", "vec")
    return found.join(held, ["vec_id", "_row"]).join(asked, ["query_id", "_query"]).select(
        "query_id", "_query", "vec_id", "_row",
        F.aggregate(F.zip_with("vec", "_asked", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda t, x: t + x).alias("score"),
    )


def top_k(rows: DataFrame, queries: Column, k: int = 5, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS, bits: int = CELL_BITS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each row that `queries` selects."""
    sound = rows.select("vec_id", "embedding")
    vectors = materialise(_vectors(sound, k), "vectors")
    asked = materialise(
        sound.filter(queries).select("vec_id", quantised(F.col("embedding")).alias("vec")).filter(
            F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
        ).distinct().select("vec_id", "vec", F.xxhash64("vec_id", "vec").alias("_row"), F.size("vec").alias("dims")),
        "queries",
    )
    groups = max(1, math.ceil(asked.count() / query_rows))
    files = approximations(vectors, block_rows, bits).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )
    # every block of queries meets every approximation file; a pair is a group of its own
    pairs = files.join(_query_blocks(asked, groups), ["_group", "dims"])
    scanned = materialise(
        pairs.withColumn("_pair", F.xxhash64("_group", "cells", "ids")).groupBy("_pair").applyInPandas(
            _scan(k), "query_id bigint, _query bigint, limit double, keys array<bigint>, ids array<bigint>, bounds array<double>"
        ), "scanned",
    )
    limits = scanned.groupBy("query_id", "_query").agg(F.max("limit").alias("_least"))
    reach = scanned.join(limits, ["query_id", "_query"]).select(
        "query_id", "_query",
        F.explode(F.filter(
            F.arrays_zip("keys", "ids", "bounds"), lambda c: c["bounds"] >= F.col("_least")
        )).alias("c"),
    ).select("query_id", "_query", F.col("c.ids").alias("vec_id"), F.col("c.keys").alias("_row"), F.col("c.bounds").alias("bound"))
    order = Window.partitionBy("query_id", "_query").orderBy(F.desc("bound"), "vec_id", "_row")
    reach = materialise(reach.withColumn("_turn", F.row_number().over(order)), "reach")
    first = materialise(_exact(reach.filter(F.col("_turn") <= 2 * k), vectors, asked), "exact")
    best = Window.partitionBy("query_id", "_query").orderBy(F.desc("score"), "vec_id", "_row")
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(
        "query_id", "_query", F.col("score").alias("_kth")
    )
    rest = reach.filter(F.col("_turn") > 2 * k).join(kth, ["query_id", "_query"]).filter("bound >= _kth")
    return first.unionByName(_exact(rest.select("query_id", "_query", "vec_id", "_row"), vectors, asked)).withColumn(
        "rank", F.row_number().over(best)
    ).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
