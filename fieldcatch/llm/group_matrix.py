"""Exact n-gram Jaccard join with a token-group matrix.

A document's tokens are the hashes of its distinct word shingles. Near copies mostly have the same least tokens
in two orders, their band; documents of one band are compared first, and what is linked so is a family.

Two documents that are similar enough must
share a token among their first few in any common order of tokens; here tokens that a sketch of the
whole corpus finds more frequent come later. The documents that have a token so, without a gap in size
between them that no link can bridge, are a run. Runs inside a family have nothing to tell. Two documents of different
families that meet in short runs are candidates if they share so many of these tokens that the rest can make up
the overlap; in a wider run if parity bits of their tokens do not rule the link out; in a long run all are. What
candidates connect is a candidate set, and all links lie inside a set or a family.

Inside a set documents are taken in turn and put into groups of similar ones; the matrix tells in
which groups' token unions a token occurs. A document's overlap with a group's union bounds its overlap with
every member, so only groups whose bound reaches the threshold are opened, and members that are
already connected to the document are passed over. Documents with the same tokens are one class and
take part once.

Null, empty and wordless texts have no tokens and are linked with nothing. Rows without an id are
returned with a null component and take no part; rows that share an id count as one document.
Tokens are 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldcatch.llm.components import components
from fieldcatch.llm.workers import tidy
from fieldcatch.runtime import drop_stored, materialise, stored_paths

#: Counters of the frequency sketch, and counters per row it is written in. The sketch only sets the order
#: of tokens: with any counts the result is the same, with good ones there are fewer candidates.
SKETCH_BITS, CHUNK_BITS = 22, 18
#: Buckets of the filter that picks the texts to read again.
PICK_BITS = 22
#: Documents of a run whose pairs are counted one by one, and of one whose pairs are told by their parity bits.
SHORT, WIDE = 32, 256
#: Documents whose token sets are handed on at once.
SLICE = 256
#: Documents compared in one task; larger candidate sets are split, and each part meets the hubs.
BLOCK, HUBS = 512, 16
#: Classes a task remembers so as not to send the tokens of copies again.
REMEMBERED = 50_000

#: What tokens are multiplied by in the orders whose least ones are a document's bands.
_ORDERS = ((1, 0xC2B2AE3D27D4EB4F), (0x165667B19E3779F9, 0xD6E8FEB86659FD93))

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M = np.uint64


@dataclass(frozen=True)
class Threshold:
    """Linked: `percent` of the union is common. Shingles have `words` words."""

    percent: int = 85
    words: int = 4

    def overlap(self, n: int) -> int:
        """Least number of common tokens of a set of `n` with any it is linked with."""
        return -(-self.percent * n // 100)

    def least_shared(self, n: Column, m: Column) -> Column:
        """Least number of first tokens that linked sets of `n` and `m` tokens share, as far as runs tell.

        Tokens behind the first ones of the larger set can add one less than its `overlap`.
        """
        needed = F.ceil(self.percent * (n + m) / (100 + self.percent))
        return needed - F.ceil(self.percent * F.greatest(n, m) / 100) + 1

    def near_enough(self, apart, n, m):
        """Whether sets of `n` and `m` tokens of which at least `apart` are in one alone can be linked."""
        return (100 + self.percent) * apart <= (100 - self.percent) * (n + m)

    def linked(self, common: int, n: int, m: int) -> bool:
        return 100 * common >= self.percent * (n + m - common)


def tokens(text: str | None, words: int = 4) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text, A-Z in lower case.

    With fewer words than a shingle has, the whole sequence is one shingle.
    """
    parts = text.encode("utf-8", "replace").translate(_LOWER).split() if isinstance(text, str) else []
    if not parts:
        return np.empty(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    mixed = np.full(len(parts) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        mixed = (mixed ^ hashed[k:len(parts) - size + 1 + k]) * _M(0x9E3779B97F4A7C15)
        mixed ^= mixed >> _M(29)
    return np.unique(mixed)


def band(found: np.ndarray, which: int) -> int:
    """The first or second band of a set of tokens: its least tokens in two orders."""
    least = [int((found * _M(k)).min()) if len(found) else 0 for k in _ORDERS[which]]
    return xxhash.xxh3_64_intdigest(b"".join(x.to_bytes(8, "little") for x in least)) - (1 << 63)


def parities(found: np.ndarray) -> bytes:
    """A bit for each remainder of the tokens, set if an odd number has it. Where two differ, so do the sets."""
    many = 1 << max(6, (len(found) - 1).bit_length())
    return np.packbits(np.bincount((found & _M(many - 1)).astype(np.int64), minlength=many) & 1, bitorder="little").tobytes()


def _packed(body: str) -> bytes:
    """A text as it is shuffled: it takes a fraction of its tokens."""
    return zlib.compress(body.encode("utf-8", "replace"), 1)


def _marks(buckets: DataFrame) -> bytes:
    """The numbers in the only column, below 2^PICK_BITS, as a filter of fixed size."""
    marks = np.zeros(1 << PICK_BITS, dtype=bool)
    marks[buckets.toDF("bucket").distinct().toPandas()["bucket"].to_numpy(dtype=int)] = True
    return np.packbits(marks).tobytes()


def _unpacked(marks: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(marks, dtype=np.uint8)).astype(bool)


def _meta(docs: DataFrame, rule: Threshold, text: str) -> DataFrame:
    """One row per document (id, size, 128-bit digest of its tokens, bands, parity bits), and each task's counts of tokens."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
        shift = _M(64 - SKETCH_BITS)
        seen = False
        for batch in batches:
            rows = []
            for key, body in zip(batch["doc_id"], batch["text"]):
                found = tokens(body, rule.words)
                at = found >> shift
                counters[at] += counters[at] < 255
                digest = xxhash.xxh3_128_digest(found.tobytes())
                rows.append((key, len(found), int.from_bytes(digest[:8], "little", signed=True),
                             int.from_bytes(digest[8:], "little", signed=True), band(found, 0), band(found, 1), parities(found)))
            seen = seen or bool(rows)
            frame = pd.DataFrame(rows, columns=["doc_id", "n", "s1", "s2", "band0", "band1", "odd"])
            frame["doc_id"] = frame["doc_id"].astype("object")
            yield frame.assign(chunk=-1, counts=None)
        if seen:
            step = 1 << CHUNK_BITS
            yield pd.DataFrame({
                "doc_id": None, "n": 0, "s1": 0, "s2": 0, "band0": 0, "band1": 0, "odd": None,
                "chunk": range(len(counters) // step),
                "counts": [zlib.compress(counters[i:i + step].tobytes(), 1) for i in range(0, len(counters), step)],
            })

    return docs.select(F.col("doc_id").cast("string"), F.col(text).alias("text")).mapInPandas(
        tidy(read), "doc_id string, n bigint, s1 bigint, s2 bigint, band0 bigint, band1 bigint, odd binary, "
        "chunk int, counts binary"
    )


def _levels(counted: DataFrame) -> bytes:
    """How frequent the tokens of each counter of the summed sketch are: 0 if no more than chance
    explains, else the logarithm of the rest. A byte for each counter, whatever the corpus."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, dtype=np.int64)
        for counts in rows["counts"]:
            total += np.frombuffer(zlib.decompress(counts), dtype=np.uint8)
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "total": [total.astype("<u4").tobytes()]})

    rows = counted.groupBy("chunk").applyInPandas(add, "chunk int, total binary").collect()
    # as many as the sketch has chunks; one at a time, as the driver has little memory to spare
    totals = {row["chunk"]: np.frombuffer(row["total"], dtype="<u4") for row in rows}
    mean = sum(int(total.sum(dtype=np.int64)) for total in totals.values()) / (1 << SKETCH_BITS)
    levels = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for chunk, total in totals.items():
        over = total - mean
        levels[chunk << CHUNK_BITS:(chunk + 1) << CHUNK_BITS] = np.where(
            over > 4 * math.sqrt(mean) + 4, np.log2(np.maximum(over, 1)) + 1, 0
        )
    return levels.tobytes()


def _prefixes(docs: DataFrame, rule: Threshold, levels: bytes, mixed: bytes, text: str) -> DataFrame:
    """(token, s1, band, n): the first tokens of each class, ordered by level and hash.

    Classes of one `band` are of one family; if the filter `mixed` has the band of a class, it gets one of its own.
    Half a digest is enough here: classes that had it in common would only have more candidates.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level = np.frombuffer(levels, dtype=np.uint8)
        shift = _M(64 - SKETCH_BITS)
        several = _unpacked(mixed)
        sent: set[bytes] = set()
        for texts in (batch["text"].iloc[i:i + 4 * SLICE] for batch in batches for i in range(0, len(batch), 4 * SLICE)):
            parts: list[np.ndarray] = []
            keys, families, sizes, lengths = [], [], [], []
            for body in texts:
                found = tokens(body, rule.words)
                n = len(found)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                if not n or digest in sent:
                    continue
                if len(sent) < REMEMBERED:
                    sent.add(digest)
                order = np.argsort(level[found >> shift], kind="stable")  # tokens are sorted by hash
                first = found[order[:n - rule.overlap(n) + 1]]
                parts.append(first)
                keys.append(digest)
                families.append(band(found, 0))
                sizes.append(n)
                lengths.append(len(first))
            if parts:
                pair = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
                family = np.array(families, dtype=np.int64)
                family = np.where(several[family & ((1 << PICK_BITS) - 1)], pair[:, 1], family)
                yield pd.DataFrame({
                    "token": np.concatenate(parts).view(np.int64), "s1": np.repeat(pair[:, 0], lengths),
                    "band": np.repeat(family, lengths), "n": np.repeat(np.array(sizes, dtype=np.int64), lengths),
                })

    return docs.select(F.col(text).alias("text")).mapInPandas(tidy(read), "token bigint, s1 bigint, band bigint, n bigint")


def _again(docs: DataFrame, ids: DataFrame, text: str, dealt: Callable[[int, str], tuple] | None = None) -> DataFrame:
    """(doc_id, body) of the rows that a filter of fixed size takes for rows of the ids: all of them and few others.

    A body is a packed text. `dealt` tells the band and the part of a row, which are then columns too.
    """
    def bucket(key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("bigint")), F.lit(1 << PICK_BITS)).cast("int")

    packed = _marks(ids.select(bucket(F.col("doc_id"))))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marked = _unpacked(packed)
        for batch in batches:
            found = batch.loc[marked[batch["bucket"].to_numpy()] & batch["text"].notna().to_numpy(), ["doc_id", "text"]]
            for i in range(0, len(found), SLICE):
                part = found.iloc[i:i + SLICE]
                made = pd.DataFrame({"doc_id": part["doc_id"], "body": [_packed(t) for t in part["text"]]})
                if dealt:
                    at = [dealt(key, body) for key, body in part.itertuples(index=False)]
                    made["band"], made["part"] = [x for x, _ in at], [x for _, x in at]
                yield made

    return docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"), bucket(F.col("doc_id")).alias("bucket")
    ).mapInPandas(tidy(read), "doc_id bigint, body binary" + ", band bigint, part bigint" * bool(dealt))


def _sets(docs: DataFrame, wanted: DataFrame, text: str) -> DataFrame:
    """(doc_id, body) of the wanted ids, with what else `wanted` has."""
    return _again(docs, wanted.select("doc_id"), text).join(wanted, "doc_id")


def _of_band(docs: DataFrame, known: DataFrame, which: int, rule: Threshold, text: str) -> DataFrame:
    """Links inside each band, between one class of each label that `known` has there.

    The texts tell their band themselves, so they are shuffled once. Bands of many classes are dealt to several tasks.
    """
    some = known.groupBy(F.col(f"band{which}").alias("band"), "label").agg(F.min("head").alias("doc_id"))
    many = some.groupBy("band").agg(F.count(F.lit(1)).alias("_many")).filter("_many > 1")
    large = {r["band"]: -(-r["_many"] // BLOCK) for r in many.filter(F.col("_many") > BLOCK).collect()}

    def dealt(key: int, body: str) -> tuple[int, int]:
        own = band(tokens(body, rule.words), which)
        return own, xxhash.xxh3_64_intdigest(int(key).to_bytes(8, "little", signed=True)) % large.get(own, 1)

    rows = _again(docs, some.join(many, "band", "left_semi").select("doc_id"), text, dealt)
    return _linked(rows.withColumn("task", F.xxhash64("band", "part")), rule)


def _families(docs: DataFrame, classes: DataFrame, rule: Threshold, text: str) -> tuple[DataFrame, DataFrame]:
    """Links inside bands, and the classes with the label of what these links connect."""
    known, links = classes.withColumn("label", F.col("head")), None
    for which in range(len(_ORDERS)):
        found = materialise(_of_band(docs, known, which, rule, text), "copies")
        links = links.unionByName(found) if links else found
        labels = components(links).withColumnRenamed("node", "head")
        known = materialise(classes.join(labels, "head", "left").withColumn("label", F.coalesce("label", "head")), "families")
    return links, known


def _unruled(runs: DataFrame, rule: Threshold) -> DataFrame:
    """(a, b) of the pairs of each run whose sizes, labels and parity bits do not rule a link out."""
    def pairs(rows: pd.DataFrame) -> pd.DataFrame:
        n, label, ids = (rows[c].to_numpy() for c in ("n", "label", "doc_id"))
        bits = [np.frombuffer(b, dtype=np.uint8) for b in rows["odd"]]
        width = np.array([len(b) for b in bits])
        found = []
        for w in np.unique(width):
            wider = np.flatnonzero(width >= w)
            folded = np.stack([np.bitwise_xor.reduce(bits[y].reshape(-1, w), axis=0) for y in wider])
            for x in np.flatnonzero(width == w):
                apart = np.bitwise_count(folded ^ bits[x]).sum(axis=1, dtype=np.int64)
                fits = rule.near_enough(np.maximum(apart, np.abs(n[wider] - n[x])), n[wider], n[x])
                for y in wider[fits & (label[wider] != label[x]) & ((width[wider] > w) | (wider > x))]:
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return runs.groupBy("token", "_run").applyInPandas(pairs, "a bigint, b bigint").distinct()


def link_sets(ids: list[int], sets: list[np.ndarray], rule: Threshold) -> list[tuple[int, int]]:
    """Links (id, other id) that connect what belongs together among the given token sets."""
    many = len(ids)
    if many < 2:
        return []
    root = list(range(many))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = [len(s) for s in sets]
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = np.repeat(np.arange(many), sizes)[order]
    begin = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
    count = np.diff(np.r_[begin, len(flat)])
    # the tokens of each document that another document has too
    twice = np.repeat(count > 1, count)
    by_owner = np.argsort(owner[twice], kind="stable")
    shared = np.repeat(np.arange(len(begin)), count)[twice][by_owner]
    ends = np.cumsum(np.bincount(owner[twice], minlength=many))

    def own(x: int) -> np.ndarray:
        return shared[ends[x - 1] if x else 0:ends[x]]

    def overlaps(x: int) -> np.ndarray:
        """Common tokens of x with every document."""
        found = own(x)
        n = count[found]
        at = np.repeat(begin[found] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=many)

    matrix: dict[int, list[int]] = {}  # token -> groups whose union holds it
    members: list[list[int]] = []
    smallest: list[int] = []
    for x in sorted(range(many), key=sizes.__getitem__):
        n, mine = sizes[x], own(x).tolist()
        bound = Counter(chain.from_iterable(matrix[t] for t in mine if t in matrix))
        common = None
        for g, most in bound.items():
            if most < rule.overlap(max(n, smallest[g])):
                continue
            for y in members[g]:
                if sizes[y] < rule.overlap(n) or find(x) == find(y):
                    continue
                if common is None:
                    common = overlaps(x)
                if rule.linked(int(common[y]), n, sizes[y]):
                    root[find(x)] = find(y)
        best = max(bound, key=lambda g: (bound[g], -g), default=-1)
        if best < 0 or 2 * bound[best] < n:
            best = len(members)
            members.append([])
            smallest.append(n)
        members[best].append(x)
        for t in mine:
            held = matrix.setdefault(t, [])
            if best not in held:
                held.append(best)
    return [(ids[i], ids[find(i)]) for i in range(many) if find(i) != i]


def _linked(tasks: DataFrame, rule: Threshold) -> DataFrame:
    """Links found inside each `task`, a bounded number of token sets."""
    def open_(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["doc_id", "body"]).sort_values("doc_id")
        sets = [tokens(zlib.decompress(b).decode("utf-8", "replace"), rule.words) for b in rows["body"]]
        ids, sets = [i for i, s in zip(rows["doc_id"], sets) if len(s)], [s for s in sets if len(s)]
        return pd.DataFrame(link_sets(ids, sets, rule), columns=["a", "b"], dtype="int64")

    return tasks.select("task", "doc_id", "body").groupBy("task").applyInPandas(open_, "a bigint, b bigint")


def _linked_large(large: DataFrame, near: DataFrame, long: DataFrame, rule: Threshold) -> DataFrame:
    """Links of the candidate sets that are too large for one task.

    Every part of such a set also meets the documents most others were found by, which connects
    nearly all of a group of copies. What is connected then is a group, small components share one; a document
    visits the groups of which some member is its candidate, and no others. `near` are the candidates of short
    and wide runs, (a, b), `long` the long runs, (token, _run, doc_id). Groups and their visitors are split where they are many.
    """
    task = F.xxhash64("set_id", "_block")
    by_degree = Window.partitionBy("set_id").orderBy(F.desc("_degree"), "doc_id")
    parts = large.select("set_id", "_block").distinct()
    hubs = large.withColumn("_turn", F.row_number().over(by_degree)).filter(F.col("_turn") <= HUBS)
    hub_rows = hubs.drop("_block").join(parts, "set_id").withColumn("task", task)
    own = large.withColumn("task", task).select("task", "doc_id", "body")
    first = materialise(_linked(own.unionByName(hub_rows.select("task", "doc_id", "body")), rule), "links")

    known = materialise(large.select("doc_id", "set_id").distinct().join(
        components(first).withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select("doc_id", "set_id", F.coalesce("label", "doc_id").alias("label")), "known")
    counts = known.groupBy("set_id", "label").agg(F.count(F.lit(1)).alias("_n"))
    # a long run all of whose documents are of its set's largest component has no visits to offer
    largest = counts.groupBy("set_id").agg(F.max_by("label", F.struct("_n", "label")).alias("label"))
    others = known.join(largest, ["set_id", "label"], "left_anti").select("doc_id")
    open_runs = long.join(others, "doc_id", "left_semi").select("token", "_run").distinct()
    held = long.join(open_runs, ["token", "_run"], "left_semi")
    grouped = materialise(_grouped(known, counts, held), "groups")
    marks = held.join(grouped, "doc_id")
    groups = marks.select("token", "_run", F.col("group").alias("host")).distinct()
    told = near.join(grouped.withColumnsRenamed({"doc_id": "a", "label": "_la", "group": "_ga"}), "a").join(
        grouped.withColumnsRenamed({"doc_id": "b", "label": "_lb", "group": "_gb"}), "b"
    ).filter("_la <> _lb").select(
        F.when(F.col("_ga") > F.col("_gb"), F.col("a")).otherwise(F.col("b")).alias("doc_id"),
        F.least("_ga", "_gb").alias("host"),
    )
    # components visit smaller ones; those of a packed group also meet each other
    offered = marks.join(groups, ["token", "_run"]).filter("host < group OR (host = group AND host.packed)")
    visits = materialise(offered.select("doc_id", "host").unionByName(told).distinct(), "visits")
    plan = visits.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_asks")).join(
        grouped.groupBy(F.col("group").alias("host")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_parts")), "host"
    )
    pair = F.xxhash64("host", "_part", "_ask")
    home = grouped.select("doc_id", F.col("group").alias("host")).join(plan, "host").select(
        "doc_id", "host", F.pmod(F.xxhash64("doc_id"), F.col("_parts")).alias("_part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_asks") - 1)).alias("_ask"),
    )
    away = visits.join(plan, "host").select(
        "doc_id", "host", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("_asks")).alias("_ask"),
    )
    met = home.unionByName(away).select("doc_id", pair.alias("task")).distinct()
    return first.unionByName(_linked(met.join(large.select("doc_id", "body"), "doc_id"), rule))


def _grouped(known: DataFrame, counts: DataFrame, held: DataFrame) -> DataFrame:
    """(doc_id, label, group): where documents are visited.

    A component above half a `BLOCK` is a group of its own. Smaller ones are packed: each goes with the longest
    run that a document of it is in, and what shares that run is one group, or as many as fill blocks; small ones
    share groups. So a set has few more groups than blocks, however many of its documents are unlinked.
    """
    small = counts.filter(F.col("_n") <= BLOCK // 2)
    longest = held.groupBy("token", "_run").agg(F.count(F.lit(1)).alias("_many"))
    family = held.join(longest, ["token", "_run"]).join(known, "doc_id").join(small, ["set_id", "label"]).groupBy(
        "set_id", "label"
    ).agg(F.max(F.struct("_many", "token", "_run")).alias("_family"), F.max("_n").alias("_n"))
    sizes = family.groupBy("set_id", "_family").agg(F.sum("_n").alias("_of_family"))
    room = family.groupBy("set_id").agg(F.ceil(F.sum("_n") / BLOCK).alias("_packs"))
    pack = F.when(
        F.col("_of_family") >= BLOCK // 2,
        F.xxhash64("_family", F.pmod(F.xxhash64("label"), F.ceil(F.col("_of_family") / BLOCK))),
    ).otherwise(F.xxhash64("set_id", F.pmod(F.xxhash64("_family"), F.col("_packs"))))
    packed = family.join(sizes, ["set_id", "_family"]).join(room, "set_id").select("set_id", "label", pack.alias("_pack"))
    return known.join(packed, ["set_id", "label"], "left").select(
        "doc_id", "label",
        F.struct(F.col("_pack").isNotNull().alias("packed"), F.coalesce("_pack", "label").alias("id")).alias("group"),
    )


def jaccard_join(docs: DataFrame, rule: Threshold = Threshold(), text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row."""
    before = stored_paths(docs.sparkSession)
    meta = materialise(_meta(docs, rule, text), "meta")
    rows = meta.filter("chunk < 0").select(F.col("doc_id").cast("bigint").alias("doc_id"), "n", "s1", "s2")
    classes = materialise(
        meta.filter("chunk < 0 AND n > 0").withColumn("doc_id", F.col("doc_id").cast("bigint")).filter(
            "doc_id IS NOT NULL"
        ).groupBy("s1", "s2").agg(F.min("doc_id").alias("head"), *[F.max(c).alias(c) for c in ("n", "band0", "band1", "odd")]),
        "classes",
    )
    needed = stored_paths(docs.sparkSession)
    copies, known = _families(docs, classes.drop("n", "odd"), rule, text)
    mixed = _marks(known.groupBy("band0").agg(F.min("label").alias("_l"), F.max("label").alias("_h")).filter("_l <> _h").select(
        F.col("band0").bitwiseAND(F.lit((1 << PICK_BITS) - 1))
    ))
    levels = _levels(meta.filter("chunk >= 0").select("chunk", "counts"))
    # along a token's documents, by size: where the next is too large for a link, a new run begins
    by_size = Window.partitionBy("token").orderBy("n", "s1", "band")
    run = Window.partitionBy("token", "_run")
    breaks = (F.lag("n").over(by_size) < F.lit(rule.percent) * F.col("n") / 100).cast("int")
    # a row without an id is in no class and must not begin a run
    named = docs.filter(F.col("doc_id").cast("bigint").isNotNull())
    met = _prefixes(named, rule, levels, mixed, text).repartition("token").select("token", "s1", "band", "n").distinct()
    runs = materialise(met.withColumn("_break", F.coalesce(breaks, F.lit(0))).withColumn(
        "_run", F.sum("_break").over(by_size)
    ).withColumns({
        "_many": F.count(F.lit(1)).over(run), "_low": F.min("band").over(run), "_high": F.max("band").over(run)
    }).filter("_low <> _high").select("token", "_run", "_many", "s1", "n").join(
        known.select("s1", F.col("head").alias("doc_id"), "label"), "s1"
    ).select("token", "_run", "_many", "doc_id", "n", "label"), "runs")
    short = runs.filter(F.col("_many") <= SHORT).groupBy("token", "_run").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "n", "label"))).alias("_met")
    ).select(F.explode("_met").alias("_x"), "_met").select(
        "_x", F.explode(F.filter(
            "_met", lambda y: (y["doc_id"] > F.col("_x.doc_id")) & (y["label"] != F.col("_x.label"))
        )).alias("_y")
    ).groupBy(F.col("_x.doc_id").alias("a"), F.col("_y.doc_id").alias("b")).agg(
        F.count(F.lit(1)).alias("_shared"), F.max("_x.n").alias("_n"), F.max("_y.n").alias("_m")
    )
    bridged = 100 * F.least("_n", "_m") >= rule.percent * F.greatest("_n", "_m")
    counted = short.filter(bridged & (F.col("_shared") >= rule.least_shared(F.col("_n"), F.col("_m")))).select("a", "b")
    wide = runs.filter((F.col("_many") > SHORT) & (F.col("_many") <= WIDE)).join(
        classes.select(F.col("head").alias("doc_id"), "odd"), "doc_id"
    )
    near = materialise(counted.unionByName(_unruled(wide, rule)).distinct(), "near")
    long = runs.filter(F.col("_many") > max(SHORT, WIDE)).select("token", "_run", "doc_id", "n", "label")
    hub = long.groupBy("token", "_run").agg(
        F.min(F.struct("n", "doc_id"))["doc_id"].alias("b"), F.min("label").alias("_low"), F.max("label").alias("_high")
    ).filter("_low <> _high").select("token", "_run", "b")
    stars = long.join(hub, ["token", "_run"]).filter("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    pairs = materialise(near.unionByName(stars), "pairs")
    sets_of = components(pairs).select(F.col("node").alias("doc_id"), F.col("label").alias("set_id"))
    degree = pairs.groupBy(F.col("b").alias("doc_id")).agg(F.count(F.lit(1)).alias("_degree"))
    size = sets_of.groupBy("set_id").agg(F.count(F.lit(1)).alias("_size"))
    wanted = sets_of.join(degree, "doc_id", "left").join(size, "set_id").select(
        "doc_id", "set_id", "_size", F.coalesce("_degree", F.lit(0)).alias("_degree"),
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("_size") / BLOCK)).alias("_block"),
    )
    task = F.xxhash64("set_id", "_block")
    small = _sets(docs, wanted.filter(F.col("_size") <= BLOCK), text)
    links = _linked(small.withColumn("task", task), rule)
    if size.filter(F.col("_size") > BLOCK).limit(1).count():
        large = materialise(_sets(docs, wanted.filter(F.col("_size") > BLOCK), text), "sets")
        links = materialise(links, "links").unionByName(
            _linked_large(large, near, long.join(hub, ["token", "_run"], "left_semi").drop("n", "label"), rule)
        )
    held = stored_paths(docs.sparkSession)
    labels = components(links.unionByName(copies)).withColumnRenamed("node", "head")
    drop_stored(docs.sparkSession, keep=before | needed | (stored_paths(docs.sparkSession) - held))
    return rows.join(classes.select("s1", "s2", "head"), ["s1", "s2"], "left").join(labels, "head", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("label", "head")).otherwise(F.col("doc_id")).alias("component_id"),
    )
