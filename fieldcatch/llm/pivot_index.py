"""Near duplicates among vectors with a pivot-permutation index.

Pivots are reference vectors. A vector is described by the ordered numbers of its nearest pivots; two similar
vectors share most of them. Inverted lists hold the vectors by pivot: who shares at least `shared` pivots is a
candidate, and candidates are verified by the cosine in double precision. Rare pivots are taken first, and
vectors that share `shared` of `nearest` pivots must share `key` of their first nearest - shared + key ones, so
the lists are kept by those only, by combinations of `key` pivots where single ones would be long.

Equal vectors are one class and are looked up once. Classes are numbered in the order of their permutations,
so blocks of them mostly hold similar vectors. A list gives, for each vector, the blocks it
has candidates in; a vector then meets each such block once. Large lists and the visitors of a block are
split into parts of bounded size; what leaves a task is counts and a spanning set of links, never all pairs.

Links found are exact; the index may miss some, the more the closer the cosine is to the threshold.
Pivots are fitted on a bounded sample (`Index.sample` vectors with the smallest hashes, `Index.numbers` numbers);
of these the most distant are taken. All vectors are indexed; a length that the sample lacks has no
pivots, and its vectors are compared with each other.

Null, empty and zero vectors and those with null or non-finite components link with nothing and are their
own component. Only vectors of one length are compared. Each row counts as a vector, also where ids repeat;
a row without an id links with nothing and has no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.llm.components import components
from fieldcatch.operators.ordering import number_rows
from fieldcatch.runtime import materialise

#: Classes of a block, visitors it meets in one task, vectors of a list compared in one task.
BLOCK, VISITORS, PART = 256, 2048, 2048
#: Parts that the rows of one key are dealt to when facts about it are looked up.
DEAL = 16


@dataclass(frozen=True)
class Index:
    """How vectors are described: `nearest` pivots of at most `pivots`, candidates share `shared` of them."""

    nearest: int = 16
    shared: int = 6
    pivots: int = 8192
    sample: int = 16384
    numbers: int = 1 << 22

    def wanted(self, vectors: int) -> int:
        """Pivots for so many vectors: lists grow with the root of their number."""
        return min(self.pivots, 1 << max(6, math.ceil(math.log2(4 * math.sqrt(max(vectors, 1))))))

    def key(self, vectors: int, pivots: int) -> int:
        """Pivots that name a list: as few as keep the average list within a part."""
        for key in (1, 2):
            if vectors * math.comb(self.nearest - self.shared + key, key) <= PART * math.comb(max(pivots, key), key):
                return key
        return 3


def sound(column: Column) -> Column:
    """Whether a vector can link at all."""
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & F.exists(column, lambda x: x != 0), F.lit(False))


def units(vectors: list) -> np.ndarray:
    """Rows scaled to length one, in double precision; the largest component first, so nothing overflows."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)
    if not len(rows):
        return rows.reshape(0, 0)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def farthest(rows: np.ndarray, count: int) -> np.ndarray:
    """`count` rows, each the farthest from those before it; copies and near copies come last."""
    chosen, nearest = [0], rows @ rows[0]
    while len(chosen) < min(count, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
        nearest[chosen] = np.inf
    return rows[chosen]


def fit(classes: DataFrame, index: Index) -> dict[int, np.ndarray]:
    """Pivots of each vector length that the sample holds."""
    count, longest = classes.agg(F.count(F.lit(1)), F.max("dims")).first()
    if not count:
        return {}
    size = min(index.sample, max(64, index.numbers // longest))
    picked = classes.select("dims", "vec").orderBy(F.xxhash64("vec"), "vec").limit(size).toPandas()
    return {
        int(dims): farthest(units(rows["vec"].tolist()), index.wanted(count)).astype(np.float32)
        for dims, rows in picked.groupby("dims")
    }


def _describe(pivots: dict[int, np.ndarray], nearest: int):
    """Adds the permutation: the nearest pivots' numbers, two bytes each, nearest first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            order = np.full(len(batch), b"", dtype=object)
            for dims, rows in batch.reset_index(drop=True).groupby("dims"):
                held = pivots.get(int(dims))
                if held is None:
                    continue
                far = -(units(rows["vec"].tolist()).astype(np.float32) @ held.T)
                m = min(nearest, len(held))
                near = np.argpartition(far, m - 1, axis=1)[:, :m]
                near = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)
                for at, one in zip(rows.index, near.astype(">u2")):
                    order[at] = one.tobytes()
            yield batch.assign(permutation=order)

    return run


def _numbers(permutations) -> list[np.ndarray]:
    return [np.frombuffer(p, dtype=">u2").astype(np.int32) for p in permutations]


def _lists(ranks: dict[int, np.ndarray], index: Index, key: int):
    """(list, row, permutation) for each list a vector is kept in: combinations of its rarest pivots."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists, rows, orders = [], [], []
            for dims, row, order in zip(batch["dims"], batch["row"], batch["permutation"]):
                near = np.frombuffer(order, dtype=">u2").astype(np.int64)
                if len(near) <= index.shared:  # fewer pivots than must be shared: all meet
                    names = [(int(dims),)]
                else:
                    rare = near[np.lexsort((near, ranks[int(dims)][near]))]
                    first = rare[:len(near) - index.shared + key]
                    names = [(int(dims), *c) for c in combinations(sorted(first.tolist()), key)]
                lists += [xxhash.xxh3_64_intdigest(np.array(n, dtype="<i8").tobytes()) for n in names]
                rows += [row] * len(names)
                orders += [order] * len(names)
            yield pd.DataFrame({
                "list": np.array(lists, dtype=np.uint64).view(np.int64), "row": np.array(rows, dtype=np.int64),
                "permutation": orders,
            })

    return run


def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many pivots each of `a` shares with each of `b`.

    Frequent pivots are counted by a matrix product, the others by their pairs of holders.
    """
    many, others = len(a), len(b)
    names, places = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    owner = np.repeat(np.arange(many + others), [len(x) for x in (*a, *b)])
    mine, theirs = owner < many, owner >= many
    uses = np.bincount(places[mine], minlength=len(names)), np.bincount(places[theirs], minlength=len(names))
    dense = uses[0] * uses[1] > 0.02 * many * others
    hot = np.zeros((many + others, int(dense.sum())), dtype=np.float32)
    at = dense[places]
    hot[owner[at], (np.cumsum(dense) - 1)[places[at]]] = 1
    found = hot[:many] @ hot[many:].T
    theirs &= ~at
    order = np.argsort(places[theirs], kind="stable")
    holders = owner[theirs][order] - many
    begin = np.searchsorted(places[theirs][order], np.arange(len(names)))
    mine &= ~at
    n = uses[1][places[mine]]
    behind = np.repeat(begin[places[mine]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    pairs = np.repeat(owner[mine], n) * others + holders[behind]
    return found + np.bincount(pairs, minlength=many * others).reshape(many, others)


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a sorted stream of rows, one at a time."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        values = held[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(axis=1)])
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a > 1:
                yield held.iloc[a:b]
        held = held.iloc[starts[-1]:]
    if held is not None and len(held) > 1:
        yield held


def _meet(shared: int):
    """(row, block): the blocks in which a vector has candidates that are in the same part of a list."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _groups(batches, ["list", "part", "other"]):
            rows, orders = group["row"].to_numpy(), _numbers(group["permutation"])
            hit = _shared(orders, orders) >= min(shared, min(map(len, orders)))
            a, b = np.nonzero(hit)
            pairs = np.unique(np.stack([rows[a], rows[b] // BLOCK], axis=1), axis=0)
            yield pd.DataFrame(pairs, columns=["row", "block"])

    return run


def visits(classes: DataFrame, ranks: dict[int, np.ndarray], index: Index, key: int) -> DataFrame:
    """(row, block): each block of classes that a class has candidates in."""
    postings = materialise(classes.select("dims", "row", "permutation").mapInPandas(
        _lists(ranks, index, key), "list bigint, row bigint, permutation binary"
    ), "postings")
    long = postings.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / (PART // 2)).alias("_parts")).filter("_parts > 1")
    dealt = postings.withColumn("_deal", F.pmod("row", F.lit(DEAL)).cast("int")).join(
        long.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1)))), ["list", "_deal"], "left"
    ).withColumn("_parts", F.coalesce("_parts", F.lit(1)).cast("bigint"))
    # a part of a list meets every part, each two parts in a task of their own
    own = F.pmod(F.xxhash64("row"), F.col("_parts"))
    tasks = dealt.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    ).select(
        "list", F.least("_own", "_other").alias("part"), F.greatest("_own", "_other").alias("other"), "row", "permutation"
    )
    keys = ["list", "part", "other"]
    return tasks.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        _meet(index.shared), "row bigint, block bigint"
    ).distinct()


def _spanning(hit: np.ndarray, guests: np.ndarray, members: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what `hit`, guests by members, connects: at most one for each row."""
    mine, theirs = guests.copy(), members.copy()
    at = hit.any(axis=1), hit.any(axis=0)
    while True:
        far = np.iinfo(np.int64).max
        new = np.minimum(mine, np.where(hit, theirs[None, :], far).min(axis=1, initial=far))
        back = np.minimum(theirs, np.where(hit, new[:, None], far).min(axis=0, initial=far))
        if (new == mine).all() and (back == theirs).all():
            break
        mine, theirs = new, back
    links = [(int(a), int(b)) for a, b in zip(guests[at[0]], mine[at[0]]) if a != b]
    return links + [(int(a), int(b)) for a, b in zip(members[at[1]], theirs[at[1]]) if a != b]


def _verify(least: float, shared: int):
    """(row, links, other): how many rows a class links with in a block, and links that connect them."""
    def run(members: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
        counts, links = [], []
        for dims, mine in guests.groupby("dims"):
            held = members[members["dims"] == dims]
            if not len(held):
                continue
            a, b = mine["row"].to_numpy(), held["row"].to_numpy()
            hit = (units(mine["vec"].tolist()) @ units(held["vec"].tolist()).T >= least) & (a[:, None] != b[None, :])
            x, y = np.nonzero(hit)
            if not len(x):
                continue
            both = _shared(_numbers(mine["permutation"]), _numbers(held["permutation"]))
            hit &= both >= min(shared, min(len(p) // 2 for p in held["permutation"]))
            n = hit @ held["copies"].to_numpy()
            counts += [(r, c, None) for r, c in zip(a, n) if c]
            links += [(r, None, o) for r, o in _spanning(hit, a, b)]
        return pd.DataFrame(counts + links, columns=["row", "links", "other"]).astype(
            {"row": "int64", "links": "Int64", "other": "Int64"}
        )

    return run


def near_duplicates(rows: DataFrame, least: float = 0.95, index: Index = Index()) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (smallest id reachable) and kept of each row."""
    every = rows.select("vec_id", F.col("embedding").alias("vec"))
    usable = F.col("vec_id").isNotNull() & sound(F.col("vec"))
    classes = materialise(every.filter(usable).groupBy("vec").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first")
    ).withColumn("dims", F.size("vec")), "vectors")
    pivots = fit(classes, index)
    vec = dict(classes.dtypes)["vec"]
    described = classes.withColumn("_hash", F.xxhash64("vec")).mapInPandas(
        _describe(pivots, index.nearest),
        f"vec {vec}, copies bigint, first bigint, dims int, _hash bigint, permutation binary",
    )
    indexed = number_rows(materialise(described, "described"), ["dims", "permutation", "_hash", "first"], "_number")
    indexed = materialise(indexed.withColumn("row", F.col("_number") - 1).drop("_number", "_hash"), "index")

    # how long the single lists are sets which pivots are taken first: one row per pivot
    uses = indexed.select("dims", F.explode(F.sequence(F.lit(1), F.length("permutation"), F.lit(2))).alias("_at"), "permutation").filter(
        "length(permutation) > 0"
    ).groupBy("dims", F.conv(F.hex(F.substring("permutation", F.col("_at"), F.lit(2))), 16, 10).cast("int").alias("pivot")).count().collect()
    ranks = {dims: np.zeros(len(held), dtype=np.int64) for dims, held in pivots.items()}
    for use in uses:
        ranks[use["dims"]][use["pivot"]] = use["count"]
    key = index.key(indexed.count(), max(map(len, pivots.values()), default=0))

    block = F.floor(F.col("row") / BLOCK)
    asks = materialise(visits(indexed, ranks, index, key), "visits")
    parts = asks.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / VISITORS).alias("_parts"))
    facts = indexed.select("row", "dims", "vec", "permutation", "copies")
    members = facts.withColumn("block", block).join(parts, "block").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    ).drop("_parts")
    guests = asks.withColumn("_deal", F.pmod("row", F.lit(DEAL)).cast("int")).join(
        parts.withColumn("_deal", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1)))), ["block", "_deal"]
    ).withColumn("part", F.pmod(F.xxhash64("row"), F.col("_parts"))).select("row", "block", "part").join(
        facts.select("row", *[F.col(c).alias(c) for c in ("dims", "vec", "permutation")]), "row"
    )
    found = materialise(
        members.groupBy("block", "part").cogroup(guests.groupBy("block", "part")).applyInPandas(
            _verify(least, index.shared), "row bigint, links bigint, other bigint"
        ), "links",
    )
    linked = found.filter("links IS NOT NULL").groupBy("row").agg(F.sum("links").alias("_links"))
    labels = components(found.filter("other IS NOT NULL").select(F.col("row").alias("a"), F.col("other").alias("b")))
    group = F.coalesce("label", "row")
    told = indexed.join(linked, "row", "left").join(labels.withColumnRenamed("node", "row"), "row", "left").select(
        "vec", "first", group.alias("_group"), (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n"),
    )
    least_id = told.groupBy("_group").agg(F.min("first").alias("_component"))
    deals = F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1)))
    spread = F.pmod(F.xxhash64("first"), F.lit(DEAL)).cast("int")
    ends = told.withColumn("_deal", spread).join(least_id.withColumn("_deal", deals), ["_group", "_deal"]).select(
        F.xxhash64("vec").alias("_h1"), F.xxhash64(F.lit(1), "vec").alias("_h2"), "_n", "_component"
    )
    linked_rows = every.filter(usable).select(
        "vec_id", F.xxhash64("vec").alias("_h1"), F.xxhash64(F.lit(1), "vec").alias("_h2"),
        F.pmod(F.xxhash64("vec_id"), F.lit(DEAL)).cast("int").alias("_deal"),
    ).join(ends.withColumn("_deal", deals), ["_h1", "_h2", "_deal"]).select("vec_id", "_n", "_component")
    others = every.filter(~usable).select("vec_id", F.lit(0).alias("_n"), F.col("vec_id").alias("_component"))
    return linked_rows.unionByName(others).select(
        "vec_id", F.col("_n").cast("bigint").alias("n_links"), F.col("_component").cast("bigint").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.col("_component")).alias("kept"),
    )
