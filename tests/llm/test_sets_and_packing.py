"""Language codes, source mix, top-k search, Jaccard join, page text and packing on small tables."""

from __future__ import annotations

import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldcatch.llm import best_fit, group_matrix, html_density, language_codes, source_mix, va_file, workers
from fieldcatch.llm.components import components

PLAIN = "doc_id bigint, text string"


# language

def test_codewords_differ():
    for n in (2, 3, 4, 7, 12):
        code = language_codes.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= (1 if n == 2 else 2)
        assert (np.abs(code.sum(axis=0)) < n).all()


def test_language_prediction(spark):
    rng = random.Random(3)
    stems = {"aa": "ka lo mi tu".split(), "bb": "schr pft und ig".split(), "cc": "ção nh lh ões".split()}
    data = [(i, " ".join("".join(rng.choices(stems[k], k=3)) for _ in range(30)), k)
            for i, k in enumerate(sorted(stems) * 20)]
    docs = spark.createDataFrame([*data, (900, None, "aa"), (901, "123 !", "bb"), (902, "", None), (903, data[0][1], None)],
                                 "doc_id bigint, text string, lang string")
    model = language_codes.fit(docs.filter(~language_codes.held_out()))
    out = {r["doc_id"]: r for r in language_codes.predict(docs, model).collect()}
    assert all(out[i]["lang_pred"] == k for i, _, k in data)
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (900, 901, 902))
    assert out[903]["lang_pred"] == "aa" and 0 <= out[903]["score"] <= 1
    assert {r["doc_id"]: r["h"] for r in docs.select("doc_id", language_codes.held_out().alias("h")).collect()} == {
        i: zlib.crc32(str(i).encode()) % 5 == 0 for i in out}
    nothing = language_codes.fit(docs.filter("lang = 'none'"))
    assert {r["lang_pred"] for r in language_codes.predict(docs, nothing).collect()} == {"und"}
    assert language_codes.predict(docs.limit(0), model).count() == 0
    assert not any(out[i]["ambiguous"] for i in out)


def _speech(rng: random.Random, stems: str, words: int) -> str:
    return " ".join("".join(rng.choices(stems.split(), k=3)) for _ in range(words))


def test_texts_of_two_languages_are_ambiguous(spark):
    rng = random.Random(5)
    stems = {"aa": "ka lo mi tu re", "bb": "schr pft und ig ung", "cc": "ção nh lh ões ar"}
    known = spark.createDataFrame([(_speech(rng, stems[k], 40), k) for k in sorted(stems) * 30], "text string, lang string")
    model = language_codes.fit(known)
    rows = []
    for a, b in (("aa", "bb"), ("aa", "cc"), ("bb", "cc")):
        for words in (20, 2000):
            rows += [(f"{_speech(rng, stems[a], words)} {_speech(rng, stems[b], words)}", True),
                     (f"{_speech(rng, stems[a], 9 * words)} {_speech(rng, stems[b], words)}", False),
                     (_speech(rng, stems[a], words), False)]
    rows.append(("Η γλώσσα είναι ένα σύστημα επικοινωνίας " * 30, True))
    docs = spark.createDataFrame([(i, text, flag) for i, (text, flag) in enumerate(rows)],
                                 "doc_id bigint, text string, ambiguous boolean")  # a clashing name is replaced
    told = {r["doc_id"]: r for r in language_codes.predict(docs, model).collect()}
    assert [told[i]["ambiguous"] for i in range(len(rows))] == [flag for _, flag in rows]
    assert all(0 <= r["score"] <= 1 for r in told.values())


def test_decoding_against_loops():
    rng = np.random.default_rng(2)
    codes = language_codes.codewords(5)
    trust = rng.random(codes.shape) + 0.1
    model = language_codes.Model(list("abcde"), codes, np.zeros((1, codes.shape[1])), trust, np.ones(codes.shape))
    for margins in (*rng.normal(0, 3, (50, codes.shape[1])), np.zeros(codes.shape[1])):
        losses = [sum(t * np.log1p(np.exp(-c * m)) for t, c, m in zip(trust[k], codes[k], margins)) for k in range(5)]
        best, score = language_codes.decode(margins, 10, model)
        assert losses[best] == pytest.approx(min(losses)) and 0 <= score <= 1
    assert language_codes.decode(codes[3] * 50, 100, model)[0] == 3
    assert language_codes.decode(codes[3] * 0, 100, model)[1] == 0


# mix

def test_fill_shares_the_excess():
    assert source_mix.fill([10, 100], [3, 1], 80) == [20.0, 60.0]
    assert source_mix.fill([0, 0], [1, 1], 0) == [0.0, 0.0]
    assert source_mix.fill([], [], 0) == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation(n):
    got = source_mix.permuted(np.arange(n), np.full(n, n), np.full(n, 99))
    assert sorted(got) == list(range(n))


def mix_docs(spark):
    rng = random.Random(5)
    data = [(i, " ".join(f"w{i}_{j}" for j in range(rng.randint(0, 400))), rng.choice(["a", "b", "c", None, "hot", "hot"]))
            for i in range(300)]
    data += [(907, None, "a"), (907, None, "a"), (8, data[8][1], data[8][2])]
    return spark.createDataFrame(data, "doc_id bigint, text string, source string")


def test_mix_meets_targets(spark):
    out = source_mix.mix_counts(mix_docs(spark), block_words=16).collect()
    assert len(out) == 303
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 16 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    again = source_mix.mix_counts(mix_docs(spark).repartition(3), block_words=16).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))


def test_mixed_texts_hold_the_taken_words(spark):
    docs = mix_docs(spark)
    counts = defaultdict(int)
    for r in source_mix.mix_counts(docs, block_words=16).collect():
        counts[r["doc_id"]] += r["taken"]
    words = defaultdict(int)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    mixed = source_mix.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert set(r["text"].split()) <= set(texts[r["doc_id"]].split())
    assert {k: v for k, v in counts.items() if v} == dict(words)
    empty = docs.limit(0)
    assert source_mix.mix_counts(empty).count() == 0 and source_mix.mixed_documents(empty).count() == 0


# top k

def test_top_k_is_exact(spark):
    rng = np.random.default_rng(1)
    data = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    data += [(1000 + i, data[3][1]) for i in range(30)]  # ties
    data += [(2000, None), (2001, [float("nan")] * 8), (2002, [1.0, None] * 4), (2003, [1.0, 2.0]), (5, data[5][1]), (None, [1.0] * 8)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in va_file.top_k(
        df, F.col("vec_id") % 50 == 0, block_rows=64, query_rows=4, bits=3).collect()}
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in data
             if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q in whole:
        if q % 50 == 0:
            best = sorted((-int(whole[q] @ v), c) for c, v in whole.items() if c != q)[:5]
            want |= {(q, k + 1): (c, -s) for k, (s, c) in enumerate(best)}
    assert got == want
    assert va_file.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    few = va_file.top_k(df.filter("vec_id IN (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]


# join

def brute_join(data, words, percent):
    sets = {}
    for i, text in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    label = {i: i for i in sets}
    changed = True
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and
             100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and sets[j]]
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("block", [512, 8])
def test_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(group_matrix, "BLOCK", block)
    monkeypatch.setattr(group_matrix, "HUBS", 2)
    rng = random.Random(block)
    passage = [f"p{i}" for i in range(40)]
    data = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "One TWO"), (5, "one two three")]
    for base in range(8):
        words = [f"b{base}_{i}" for i in range(60)]
        for _ in range(10):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(60)] = f"x{rng.random()}"
            data.append((len(data), " ".join(copy + (passage if base % 2 else []))))
    data.append((len(data), " ".join(f"w{i}" for i in range(20_000))))
    want = brute_join(data, 4, 85)
    df = spark.createDataFrame(data, PLAIN).withColumns({"n": F.lit("x"), "label": F.lit(1)})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_join(df).collect()}
    assert got == want
    assert sum(a != i for i, (_, a) in want.items()) > 10


def test_join_of_variants_that_share_a_core_but_are_mostly_unlinked(spark, monkeypatch):
    monkeypatch.setattr(group_matrix, "BLOCK", 8)
    monkeypatch.setattr(group_matrix, "HUBS", 1)
    monkeypatch.setattr(group_matrix, "SHORT", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    data = []
    for i in range(90):
        copy = list(words)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 6, 7])):
            copy[rng.randrange(120)] = f"x{rng.random()}"
        data.append((i, " ".join(copy)))
    for i in range(6):  # pairs that are linked with each other and hardly with the rest
        copy = words[:100] + [f"pair{i}_{k}" for k in range(20)]
        data += [(len(data), " ".join(copy)), (len(data) + 1, " ".join(["start", *copy]))]
    want = brute_join(data, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_join(
        spark.createDataFrame(data, PLAIN)).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) > 20


def stored_rows(monkeypatch):
    """Rows of the tables that the join stores, by label."""
    rows_ = defaultdict(int)

    def stored(df, label, real=group_matrix.materialise):
        made = real(df, label)
        rows_[label] += made.count()
        return made

    monkeypatch.setattr(group_matrix, "materialise", stored)
    return rows_


def test_near_copies_are_no_candidates_of_each_other(spark, monkeypatch):
    rows_ = stored_rows(monkeypatch)
    rng = random.Random(11)
    data = []
    for base in range(6):
        words = [f"b{base}_{i}" for i in range(400)]
        for k in range(12):
            copy = list(words)
            copy[rng.randrange(400)] = f"x{base}_{k}"
            data.append((len(data), " ".join(copy)))
    df = spark.createDataFrame(data, PLAIN)
    got = {r["doc_id"]: r["component_id"] for r in group_matrix.jaccard_join(df).collect()}
    assert got == {i: i // 12 * 12 for i in range(72)}
    assert rows_["copies"] >= 60 and rows_["near"] < 6 * 66 // 4


def test_a_passage_of_many_does_not_make_them_candidates(spark, monkeypatch):
    monkeypatch.setattr(group_matrix, "SHORT", 4)
    rows_ = stored_rows(monkeypatch)
    passage = [f"p{i}" for i in range(30)]
    data = [(i, " ".join(passage + [f"w{i}_{k}" for k in range(60 + i % 7)])) for i in range(40)]
    data += [(40 + i, text + " end") for i, (_, text) in enumerate(data[:3])]
    want = brute_join(data, 4, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_join(
        spark.createDataFrame(data, PLAIN)).collect()}
    assert got == want and got[42][1] == 2
    assert rows_["pairs"] <= 3


@pytest.mark.parametrize("wide", [2, 256])
def test_join_of_wide_and_long_runs(spark, monkeypatch, wide):
    monkeypatch.setattr(group_matrix, "SHORT", 2)
    monkeypatch.setattr(group_matrix, "WIDE", wide)
    monkeypatch.setattr(group_matrix, "_families", lambda docs, classes, *_: (
        spark.createDataFrame([], "a bigint, b bigint"), classes.withColumn("label", F.col("head"))))
    rng = random.Random(wide)
    words = [f"w{i}" for i in range(90)]
    data = []
    for i in range(50):
        copy = list(words) + [f"z{k}" for k in range(rng.randrange(20))]
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5])):
            copy[rng.randrange(90)] = f"x{rng.random()}"
        data.append((i, " ".join(copy)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in group_matrix.jaccard_join(
        spark.createDataFrame(data, PLAIN)).collect()}
    assert got == brute_join(data, 4, 85)


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(4)
    rule = group_matrix.Threshold()
    for n, own in ((40, 2), (500, 30), (510, 20), (3000, 200)):
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        a, b = (np.unique(np.r_[common, rng.integers(0, 1 << 63, k, dtype=np.uint64)]) for k in (own, own + 9))
        x, y = (np.frombuffer(group_matrix.parities(s), dtype=np.uint8) for s in (a, b))
        y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
        apart = int(np.bitwise_count(x ^ y).sum())
        assert apart <= len(np.setxor1d(a, b))
        assert rule.near_enough(apart, len(a), len(b)) or not rule.linked(n, len(a), len(b))


def test_levels_take_little_of_the_driver(spark):
    import tracemalloc

    size = 1 << group_matrix.CHUNK_BITS
    counts = np.random.default_rng(3).integers(0, 3, size=size).astype(np.uint8)
    counts[7] = 255
    counted = spark.createDataFrame([(k, bytearray(zlib.compress(counts.tobytes()))) for k in (0, 2, 2)],
                                    "chunk int, counts binary")
    tracemalloc.start()
    levels = np.frombuffer(group_matrix._levels(counted), dtype=np.uint8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    total = np.zeros(1 << group_matrix.SKETCH_BITS)
    total[:size], total[2 * size:3 * size] = counts, 2.0 * counts
    over = total - total.mean()
    want = np.where(over > 4 * np.sqrt(total.mean()) + 4, np.log2(np.maximum(over, 1)) + 1, 0).astype(np.uint8)
    assert (levels == want).all() and levels[7] > 0 and peak < 60 << 20


def test_join_odd_tables(spark):
    text = "a b c d e f"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (0, text)], PLAIN)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in group_matrix.jaccard_join(df).collect())
    assert [g[1] for g in got[1:]] == [0, 0, 0] and len(got) == 4
    assert group_matrix.jaccard_join(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [512, 2])
def test_join_with_a_short_row_without_id(spark, monkeypatch, block):
    monkeypatch.setattr(group_matrix, "BLOCK", block)
    core = " ".join(f"w{i}" for i in range(60))
    copies = [(i, f"{core} x{i} y{i} z{i}") for i in range(1, 7)]
    df = spark.createDataFrame([*copies, (None, core), (None, core)], PLAIN)
    rows_ = group_matrix.jaccard_join(df, group_matrix.Threshold(80, 4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows_} == {None: None, **{i: 1 for i in range(1, 7)}}
    assert len(rows_) == 8


@pytest.mark.parametrize("kind", ["int", "string"])
def test_join_of_other_id_types(spark, kind):
    core = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, f"{core} x{i}") for i in range(1, 9)], PLAIN)
    rows_ = group_matrix.jaccard_join(df.withColumn("doc_id", F.col("doc_id").cast(kind))).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows_} == {i: 1 for i in range(1, 9)}


def test_pipeline_keeps_texts_that_share_an_id(spark):
    import corpus_pipeline

    core = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    data = [(5, core + " x", "b"), (5, core + " x", "a"), (5, other, "a"), (3, core, "a"), (7, core + " y", "a"),
            (8, "lone text", "a"), (None, core, "a"), (None, None, "a"), (9, None, "a"), (9, "", "a")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, df, "").collect()]
    assert sorted(kept, key=str) == sorted([data[2], data[3], *data[5:]], key=str)


def test_pipeline_shuffles_only_texts_in_doubt(spark, monkeypatch):
    import corpus_pipeline

    told = []
    monkeypatch.setattr(corpus_pipeline, "may_be_listed",
                        lambda *a, real=corpus_pipeline.may_be_listed: told.append(real(*a)) or told[-1])
    core = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    data = [(i, t, "s") for i, t in enumerate([*core, core[0] + " x", core[0] + " y", core[1], "lone text", "other text"])]
    data += [data[2], (2, core[2], "r")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.keep_one_of_each_group(spark, df, "").collect()]
    assert sorted(kept) == [data[0], data[1], data[-1], data[6], data[7]]
    rows_ = [tuple(r) for r in told[-1].filter("_other AND _may_be_first").select("doc_id", "source").collect()]
    assert sorted(rows_) == [(2, "r"), (2, "s"), (2, "s")]


def test_pipeline_hands_python_little_at_once(spark):
    import corpus_pipeline

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, "x" * 50_000, "en", "a", 50_000) for i in range(400)],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    before = spark.conf.get(key)
    try:
        corpus_pipeline.mix_sources(spark, docs.limit(3), "")
        sizes = docs.coalesce(1).mapInPandas(
            lambda batches: (b[["n_chars"]].agg("sum").to_frame().T for b in batches), "n_chars bigint"
        ).collect()
        assert len(sizes) > 1 and max(r["n_chars"] for r in sizes) <= 5 << 20
        spark.conf.set(key, "1m")
        corpus_pipeline.mix_sources(spark, docs.limit(3), "")
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_workers_keep_nothing_of_earlier_operators():
    made = []

    def make(name):
        made.append(name)
        return name

    def work(batches):
        for b in batches:
            yield workers.per_worker("mine", lambda: make("mine")) + b

    workers.forget()
    workers.per_worker("theirs", lambda: make("theirs"))
    assert list(workers.tidy(work, "mine")(iter("ab"))) == ["minea", "mineb"]
    assert list(workers.tidy(work, "mine")(iter("c"))) == ["minec"] and made == ["theirs", "mine"]
    workers.per_worker("theirs", lambda: make("theirs"))
    assert list(workers.tidy(work)(iter("d"))) == ["mined"]
    workers.per_worker("mine", lambda: make("mine"))
    assert made == ["theirs", "mine", "theirs", "mine", "mine"]
    workers.forget()


def test_the_mix_runs_python_once_a_task(spark, capsys):
    docs = spark.createDataFrame([(i, "a b c d", "s", 7) for i in range(5)],
                                 "doc_id bigint, text string, source string, n_chars bigint")
    source_mix.mixed_documents(docs).explain()
    plan = capsys.readouterr().out
    assert plan.count("ArrowEvalPython [look(") == 1 and plan.count("ArrowEvalPython [cut(") == 1
    assert "ExistingRDD[_source" not in plan and "ExistingRDD[rank" not in plan


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in components(chain).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[101] == 100


# pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href=x>Home</a></li></ul></nav><div class="ad banner">Buy</div>
<article><header><h1>Big &amp; bold</h1><p>by me</p></header><p>First   para<br>graph &eacute;.<p>Second <b>one</p>
<form><input><label>mail</label></form><aside>side</aside><ul><li>item 1<li>item 2</ul>
<section class="comments"><p>nice!</p></section></article><footer>&copy; us</footer></body></html>"""


def test_main_text():
    assert html_density.main_text(PAGE).split("\n") == ["Big & bold", "First para graph é.", "Second one", "item 1", "item 2"]
    assert html_density.main_text(None) == html_density.main_text("") == html_density.main_text("<p></p>") == ""
    body = "<body><div><a href=a>x</a> <a href=b>y</a></div><div>" + "".join(f"<p>{'long text ' * 20}{i}</p>" for i in range(5)) + "</div><footer>f</footer>"
    assert html_density.main_text(body).count("\n") == 4 and "x y" not in html_density.main_text(body)
    assert html_density.main_text("<article><p>cut off &am").startswith("cut off")


def test_main_text_keeps_headings_lists_and_tables():
    long = [f"{'words of a long text ' * 30}{i}" for i in range(4)]
    inner = (f"<h1>T</h1><p>{long[0]}</p><p>{long[1]}</p><h2>S</h2><ul><li>one</li><li>two</li></ul>"
             f"<table><tr><th>k</th><td>v</td></tr></table><blockquote>q</blockquote><p>{long[2]}</p>")
    want = ["T", long[0], long[1], "S", "one", "two", "k v", "q", long[2]]
    menu = "<div><a href=a>Home</a> <a href=b>News</a></div>"
    for page in (
        f"<div>{inner}</div>", f"<body>{menu}<div>{inner}</div>{menu}</body>", f"<body>{menu}{inner}{menu}</body>",
        f"<div class='content-with-sidebar'>{menu}<div>{inner}</div><div class=sidebar>more</div></div>",
        f"<body>{menu}<div id='page-header-layout'>{inner}</div></body>",
        f"<main class='has-banner'><article>{inner}</article></main>",
        f"<div><table><tr><td>{menu}</td><td class='col-widget'>{inner}</td></tr></table></div>",
        f"<body><div id=content>{inner}</div><div id=comments><p>{long[3] * 9}</p></div></body>",
        f"<article>{inner}</article><div class=sidebar><p>{long[3] * 20}</p></div>",
    ):
        assert html_density.main_text(page).split("\n") == want, page


def test_main_text_of_several_articles():
    long = [f"{'words of a long text ' * 30}{i}" for i in range(3)]
    one, two = (f"<article class='tag-ad'><h2>{t}</h2><p>{x}</p></article>" for t, x in zip("ab", long))
    want = ["a", long[0], "b", long[1]]
    for page in (f"<div>{one}{two}</div>", f"<div>{one}</div><div>{two}</div>", f"<main>{one}{two}</main>"):
        assert html_density.main_text(page).split("\n") == want
    assert html_density.main_text(f"<main><p>intro</p>{one}</main>").split("\n") == ["intro", *want[:2]]
    outer = f"<body><div><h1>T</h1><div><h2>a</h2><p>{long[0]}</p></div><div><h2>b</h2><p>{long[1]}</p></div></div></body>"
    assert html_density.main_text(outer).split("\n") == ["T", *want]


def test_clusters_choose_the_region():
    story = "<div><p>" + "A long line of the story. " * 20 + "</p><p>" + "And another line of it. " * 20 + "</p></div>"
    beside = "".join(f"<div><b>Short</b> <i>line</i> {i}</div>" for i in range(6))
    page = f"<body>{beside}{story}{beside}</body>"
    kept = html_density.main_text(page).split("\n")
    # smoothing makes the lines next to the story dense; the other ten short ones are not
    assert [x[:8] for x in kept] == ["Short li", "A long l", "And anot", "Short li"]
    # all lines taken as dense
    assert len(html_density.main_text(page, lambda ratios: np.ones(len(ratios), bool)).split("\n")) == 14


@pytest.mark.parametrize("page, lines", [
    ("<div>" * 50_000 + "some text here", 1), ("<b>" * 50_000 + "<p>text</p>" * 20, 20),
    ("<div><p>some words</p>" * 20_000, 20_000), ("<div class='main text'>a word" * 20_000, 20_000),
    ("<div class='menu'>a word" * 20_000, 10_000), ("<li>item" * 20_000, 20_000),
])
def test_deep_pages_take_linear_time(page, lines):
    start = time.process_time()
    text = html_density.main_text(page)
    assert time.process_time() - start < 20
    assert len(text.split("\n")) == lines


def test_extract_table(spark):
    df = spark.createDataFrame([(1, "u", PAGE, 5), (2, None, None, 6), (3, "v", "<p>" + "w " * 50_000, 7)],
                               "page_id bigint, url string, html string, n_chars int")
    out = {r["page_id"]: r for r in html_density.extract(df).collect()}
    assert out[1]["n_chars"] == len(out[1]["text"]) and out[2]["text"] == "" and out[2]["n_chars"] == 0
    assert out[3]["n_chars"] == 2 * 50_000 - 1
    assert html_density.extract(df.limit(0)).count() == 0


# packing

def test_word_tokens_equal_whole_texts():
    from tokenizers import Tokenizer

    path = best_fit.tokenizer_path()
    whole, coder = Tokenizer.from_file(path), best_fit.WordTokens(path)
    for text in ("", "Hello  wORLD's 123\n\nIt’s ééé ǅ ﬁ", "a\x1cb c d <|endoftext|> e f", "x" * 500, "İstanbul ΣΑΣ Å é ́a"):
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == ids, text


def test_punctuation_behind_any_letter():
    """Every letter, digit and mark there is, before punctuation, as the tokenizer itself tells it."""
    import unicodedata

    from tokenizers import Tokenizer

    path = best_fit.tokenizer_path()
    whole, coder = Tokenizer.from_file(path), best_fit.WordTokens(path)
    kinds = [chr(c) for c in range(0x80, 0x30000) if unicodedata.category(chr(c))[0] in "LNM" and not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"x{c}, {c}! a{c}.b" for c in kinds[i:i + 50]) for i in range(0, len(kinds), 50)]
    texts += ["BİRLİĞİ, TÜRKİYE. TEKNOLOJİ!", "e\u0301. E\u0301! \u0958, क़."]
    for text, coded in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == coded.ids, text


@pytest.mark.parametrize("most", [0, 3, 1000])
def test_the_word_cache_is_one_and_bounded(monkeypatch, most):
    from tokenizers import Tokenizer

    monkeypatch.setattr(best_fit, "CACHED_WORDS", most)
    path = best_fit.tokenizer_path()
    whole, coder = Tokenizer.from_file(path), best_fit.WordTokens(path)
    texts = ["Word, word", "word WORD, wo,rd ,", "h\u0331, one", ", . one; Two two."]
    for text in texts * 2:
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    held = [d for d in vars(coder).values() if isinstance(d, dict)]
    assert len(held) == 1 and len(held[0]) <= most + 10 and (most < 10 or b"word" in held[0])
    assert not any(w for w in held[0]) if not most else b"" not in held[0]


def test_plain_words_are_tokenized_as_one_text():
    """New words cost one call of the tokenizer by the thousand, not one each; their ids are the same."""
    from itertools import product

    from tokenizers import Tokenizer

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, 0

        def encode(self, text, **how):
            self.texts += 1
            return self.tokenizer.encode(text, **how)

        def encode_batch_fast(self, texts, **how):
            self.texts += len(texts)
            return self.tokenizer.encode_batch_fast(texts, **how)

    path = best_fit.tokenizer_path()
    whole, coder = Tokenizer.from_file(path), best_fit.WordTokens(path)
    letters = "abhlqyzßàéñöøþÿ"
    words = ["".join(w) for n in (1, 2, 3, 4) for w in product(letters, repeat=n)][:20_000]
    words += [w.capitalize() for w in words[:300]] + [f"{w}**" for w in words[:300]] + [f'"{w}".)' for w in words[:300]]
    counted = [Counted(t) for t in vars(coder).values() if hasattr(t, "encode_batch_fast")]
    for name in [n for n, t in vars(coder).items() if hasattr(t, "encode_batch_fast")]:
        setattr(coder, name, next(c for c in counted if c.tokenizer is getattr(coder, name)))
    assert np.frombuffer(coder.encode(" ".join(words)), "<u4").tolist() == whole.encode(
        " ".join(words), add_special_tokens=False
    ).ids
    assert sum(c.texts for c in counted) < 1000


def test_every_punctuation_behind_letters():
    import string
    from tokenizers import Tokenizer

    path = best_fit.tokenizer_path()
    whole, coder = Tokenizer.from_file(path), best_fit.WordTokens(path)
    marks = [*string.punctuation, *(a + b for a in string.punctuation for b in string.punctuation)]
    cores = ["word", "It's", "don't'", "É5", "x²", "ß", "ñ", "क़", "a.b", "'", "<|endoftext|>", "<|", "ö̈", "TÜRKİ"]
    for core in cores:
        text = " ".join(f"{core}{m} {m}{core} {core}{m}s" for m in marks)
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, core


def test_texts_taken_together(monkeypatch):
    """Runs of texts cover all rows once, and what is looked up for many texts at once is what each has by itself."""
    import pyarrow as pa

    path = best_fit.tokenizer_path()
    texts = ["", None, " \t two  words\n", "x" * 30, None, "Word, word", "  \x0b", "a b c d e f g h", "", "ends "]
    for most in (1, 8, 20, 1 << 20):
        monkeypatch.setattr(best_fit, "TOGETHER", most)
        coder, alone = best_fit.WordTokens(path), best_fit.WordTokens(path)
        rows = pa.array(["cut off", *texts])[1:]
        runs, coded = best_fit.together(rows), []
        for first, behind in runs:
            body, at = coder.encode_all(rows.slice(first, behind - first))
            coded += [bytes(body[a:b]) for a, b in zip(at, at[1:])]
        assert [r for run in runs for r in range(*run)] == list(range(len(texts)))
        assert coded == [alone.encode(t or "") for t in texts]
    assert best_fit.together(rows[:0]) == []


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(rule):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 50, size=500)
    capacity = best_fit.Capacity(tokens=100, documents=5, attention=4000)
    bins, offsets = best_fit.best_fit(np.minimum(lengths, capacity.longest), capacity, rule)
    for b in range(bins.max() + 1):
        held = lengths[bins == b]
        order = np.argsort(offsets[bins == b])
        assert 0 < len(held) <= 5 and held.sum() <= 100 and (held ** 2).sum() <= 4000
        assert (np.cumsum(held[order]) - held[order] == offsets[bins == b][order]).all()


def test_packing_round_trip(spark):
    texts = [None, "", "some words here", "long " * 9000, "tie", "tie"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(4, "tie")], PLAIN)
    capacity = best_fit.Capacity()
    out = best_fit.pack(best_fit.pieces(df, capacity.longest), capacity).collect()
    coder = best_fit.WordTokens(best_fit.tokenizer_path())
    whole = {i: (coder.encode(t or "") + (1).to_bytes(4, "little")) for i, t in enumerate(texts)}
    seen = defaultdict(int)
    for r in out:
        part = whole[r["doc_id"]][4 * r["start"]:4 * (r["start"] + r["length"])]
        assert zlib.crc32(part) == r["ids_crc32"] and r["start"] == 4096 * r["piece"] and r["length"] <= 4096
        seen[r["doc_id"]] += r["length"]
    assert seen == {i: len(w) // 4 * (2 if i == 4 else 1) for i, w in whole.items()}
    total = defaultdict(list)
    for r in out:
        total[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in total.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(total) == -(-sum(seen.values()) // 4096)
    assert best_fit.pack(best_fit.pieces(df.limit(0), 4096)).count() == 0
