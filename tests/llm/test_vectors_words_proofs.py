"""Near vectors, spelling variants and manifest proofs against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldcatch.llm import merkle_proofs, permuterm, pivot_index

VECTORS = "vec_id bigint, embedding array<double>"


# vectors

def spread(base, cosine, rng):
    """A vector at the given cosine from `base`."""
    side = rng.standard_normal(len(base))
    side -= side @ base * base
    return cosine * base + (1 - cosine ** 2) ** 0.5 * side / np.linalg.norm(side)


def vector_rows(rng, groups=12, size=25, dims=24):
    rows = []
    for _ in range(groups):
        base = rng.standard_normal(dims)
        base /= np.linalg.norm(base)
        rows += [spread(base, rng.uniform(.955, .999), rng) for _ in range(size)]
    rows += list(rng.standard_normal((300, dims)))
    return [(i, (v * rng.uniform(.1, 10)).tolist()) for i, v in enumerate(rng.permutation(rows))]


def brute_links(rows, least=0.95):
    """(n_links, component_id) of each row, by place."""
    good = [v is not None and k is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
            for k, v in rows]
    unit = [np.array(v) / np.abs(v).max() if ok else None for ok, (_, v) in zip(good, rows)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    links = defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least:
                links[i].add(j)
                links[j].add(i)
    label = [k for k, _ in rows]
    while True:
        new = [min([label[i], *[label[j] for j in links[i]]]) if links[i] else label[i] for i in range(len(rows))]
        if new == label:
            return [(len(links[i]), label[i]) for i in range(len(rows))]
        label = new


def found_links(spark, rows, schema=VECTORS, **options):
    out = pivot_index.near_duplicates(spark.createDataFrame(rows, schema), **options).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    return Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in out)


def wanted_links(rows):
    return Counter((k, n, c) for (k, _), (n, c) in zip(rows, brute_links([(r[0], r[1]) for r in rows])))


@pytest.mark.parametrize("sizes", [(256, 2048, 2048), (7, 16, 20)])
def test_near_vectors_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("BLOCK", "VISITORS", "PART"), sizes):
        monkeypatch.setattr(pivot_index, name, value)
    rows = vector_rows(np.random.default_rng(4))
    rows += [(k + 1000, v) for k, v in rows[:40]] + [(2000 + i, rows[3][1]) for i in range(60)]
    assert found_links(spark, rows) == wanted_links(rows)


@pytest.mark.parametrize("key", [2, 3])
def test_lists_of_several_pivots_lose_no_link(spark, monkeypatch, key):
    monkeypatch.setattr(pivot_index.Index, "key", lambda self, vectors, pivots: key)
    rows = vector_rows(np.random.default_rng(5), groups=5, size=12)
    assert found_links(spark, rows) == wanted_links(rows)


def test_recall_at_the_threshold():
    """Vectors at a cosine of 0.95 share enough of their pivots, few strangers do."""
    rng, index = np.random.default_rng(6), pivot_index.Index()
    for count in (64, 256, 2048):
        pivots = {64: pivot_index.farthest(pivot_index.units(list(rng.standard_normal((2 * count, 64)))), count).astype(np.float32)}
        bases = pivot_index.units(list(rng.standard_normal((400, 64))))
        near = [spread(b, .95, rng) for b in bases]
        told = [pivot_index._numbers(next(pivot_index._describe(pivots, index.nearest)(
            iter([pd.DataFrame({"dims": 64, "vec": list(rows)})])))["permutation"]) for rows in (bases, near)]
        shared = pivot_index._shared(*told)
        assert (np.diag(shared) >= index.shared).mean() > .97
        brute = [[len(set(a) & set(b)) for b in told[1][:50]] for a in told[0][:50]]
        assert (shared[:50, :50] == np.array(brute)).all()


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1e200, 1e200]), (8, [1e-200, 1e-200]), (9, [1.0, 1.0]), (9, [-1.0, 2.0]), (10, [1.0, 1.0, 0.0]),
        (10, [1.0, 1.0]), (11, [-1.0, 2.0]), (12, [0.0, 3.0]), (13, [-0.0, 3.0]), (None, [0.0, 3.0]), (None, None),
    ]
    got = found_links(spark, rows)
    assert got == wanted_links(rows)
    assert got[(None, 0, None)] == 2 and got[(7, 3, 7)] == 1 and got[(12, 1, 12)] == 1
    few = [(i, [float(i), 1.0]) for i in range(3)]
    assert found_links(spark, few) == wanted_links(few)
    assert found_links(spark, []) == Counter()
    wide = spark.createDataFrame([(1, [1.0, 0.0], 5, 6), (2, [1.0, 0.0], 7, 8)],
                                 "vec_id bigint, embedding array<float>, n_links int, row int")
    assert {(r["vec_id"], r["n_links"]) for r in pivot_index.near_duplicates(wide).collect()} == {(1, 1), (2, 1)}


def test_pivots_are_spread():
    rng = np.random.default_rng(2)
    hot = rng.standard_normal(16)
    rows = pivot_index.units([*(hot + 0.01 * rng.standard_normal((500, 16))), *rng.standard_normal((40, 16))])
    chosen = pivot_index.farthest(rows, 20)
    assert ((chosen @ rows[0]) > .95).sum() == 1


# words

def brute_words(docs):
    found = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in string.ascii_uppercase else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(vocabulary):
    near = {w: [v for v in vocabulary if one_edit(w, v)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), vocabulary.get(form[w])) for w, n in vocabulary.items()}


def test_variants_against_brute_force(spark):
    rng = random.Random(1)
    vocabulary = {}
    for _ in range(250):
        word = "".join(rng.choices("abcé", k=rng.randint(2, 7)))
        vocabulary[word] = rng.choice([5, 6, 25, 30, 130, 700, 4000])
    vocabulary |= {"aaaaaa": 5, "aaaaa": 25, "aaaa": 125, "aaa": 700, "öäü": 5, "öäüü": 5, "": 9, "q": 1}
    out = permuterm.variants(spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")).collect()
    got = {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}
    assert len(out) == len(vocabulary) and got == brute_variants(vocabulary)


def test_neighbours_are_given_once(spark):
    words = ["aab", "ab", "aaab", "bab", "abb", "xyz", "xyzz", "xyzzz"]
    rows = permuterm.neighbours(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n bigint")).collect()
    pairs = [(r["word"], r["near"]) for r in rows]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}
    assert all(words[r["near_n"]] == r["near"] for r in rows)


def test_words_of_whole_texts(spark):
    rng = random.Random(2)
    stems = ["Ärmelweise", "straßen", "cafétier", "ordinary", "ORDINARY", "×÷×÷×÷", "naïveté", "short"]
    docs = [(i, " ".join(rng.choices(stems, k=400))) for i in range(30)]
    docs += [(None, "ordinary " * 50), (None, None), (3, ""), (4, "x" * 300_000 + " ordinary"), (4, docs[4][1])]
    table = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id bigint, text string, word string, n int")
    got = {r["word"]: r["n"] for r in permuterm.words(table).collect()}
    assert got == brute_words(docs)
    assert permuterm.variants(permuterm.words(table.limit(0))).count() == 0


# proofs

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(level):
    """Levels of a tree from its leaves to its root."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i:i + 3]) for i in range(0, len(level), 3)]
        levels.append(level)
    return levels


def brute_manifest(rows):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf_of(r)))
        trees[s] = climb([leaf_of(r) for r in groups[s]])
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, row in enumerate(groups[s]):
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            node, proof = leaf_of((*row[:4], row[4].replace("\n", "")) if hit else row), ""
            for levels, place in ((trees[s], i), (top, at)):
                for level in levels[:-1]:
                    a = place - place % 3
                    left, right = "".join(level[a:place]), "".join(level[place + 1:a + 3])
                    node, proof, place = h(left, node, right), proof + left + right, place // 3
            out.append((row[0], leaf_of(row), trees[s][-1][0], top[-1][0], h(proof), node, node == top[-1][0]))
    return Counter(out)


FIELDS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def proved(spark, rows, **options):
    docs = spark.createDataFrame(rows, FIELDS)
    made = merkle_proofs.manifest(docs, merkle_proofs.tampered(F.col("text"), F.col("doc_id")), **options)
    return Counter(map(tuple, merkle_proofs.verify(made).collect()))


def document_rows(count=400):
    rng = random.Random(8)
    sources = ["hot"] * 30 + ["a", "b", "c", None, "é", "z", "Z", "", "0"]
    rows = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, i * 7]),
             rng.choice([None, "", "one\ntwo\n", "no break", "é" * 9])) for i in range(count)]
    return rows + [(None, "a", None, None, None), (5, "hot", "en", 5, "again\n"), (5, "hot", "en", 5, "again\n"),
                   (7, "alone", "fr", 1, "x"), (-3, "zz1", None, 0, "\n"), (8, None, None, None, "x" * 200_000 + "\n")]


@pytest.mark.parametrize("rise,stretch", [(6, 3 ** 9), (1, 3), (2, 9)])
def test_manifest_against_brute_force(spark, rise, stretch):
    rows = document_rows()
    got = proved(spark, rows, rise=rise, stretch=stretch)
    assert got == brute_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("rows", [
    [(1, "s", "en", 1, "x\n")], [(i, "s", "en", 1, "x") for i in range(3)], [(i, str(i), None, None, None) for i in range(5)], [],
])
def test_small_manifests(spark, rows):
    assert proved(spark, rows) == brute_manifest(rows)


def test_fold_levels():
    leaves = [bytes([i]) * 32 for i in range(28)]
    want = climb([n.hex() for n in leaves])
    assert [[n.hex() for n in level] for level in merkle_proofs.fold(leaves, True)] == want
    assert [len(level) for level in merkle_proofs.fold(leaves[:2], False, 3)] == [2, 1, 1, 1]
    assert [merkle_proofs.depth(n) for n in (0, 1, 2, 3, 4, 9, 10, 27, 28)] == [0, 0, 1, 1, 2, 2, 3, 3, 4]
