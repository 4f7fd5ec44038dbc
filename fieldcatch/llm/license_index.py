"""License scans with a positional index of rare template words.

Templates are short notices, each with a mandatory key phrase at a known place. Document frequencies of
the template words are counted over all files. A file looks up the two highest-IDF words of each
template's key phrase; the places they stand at, moved back by their place in the template, must
agree, and the key phrase is then verified word by word at each agreed place.

Null text counts as empty. Added columns replace input columns of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: what separates words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice and its key phrase, which is part of it; both in lower case."""

    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def span(self) -> tuple[int, int]:
        """First word of the key phrase in the notice, and the one after its last."""
        key, words = self.key.split(), self.words
        first = next(i for i in range(len(words)) if words[i:i + len(key)] == key)
        return first, first + len(key)


#: The base phrases.
BASE_TEMPLATES = (
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
)
#: Templates the method adds.
ADDED_TEMPLATES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy",
             "permission is hereby granted free of charge"),
    Template("gpl", "licensed under the gnu general public license", "gnu general public license"),
    Template("lgpl", "under the terms of the gnu lesser general public license",
             "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license",
             "gnu affero general public license"),
    Template("mpl-2", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification",
             "redistribution and use in source and binary forms"),
    Template("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    Template("unlicense", "free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)
TEMPLATES = BASE_TEMPLATES + ADDED_TEMPLATES


def words_of(text: Column) -> Column:
    """The words of a text. Only A-Z matter for templates, so the one letter outside ASCII that
    would fall on an ASCII letter (the Kelvin sign) is moved away before lower-casing."""
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ"))
    return F.array_remove(F.split(F.lower(body), BETWEEN), "")


def idf(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> dict[str, float]:
    """Inverse document frequency of every template word, over all rows.

    As many rows come back as the templates have words, however large the corpus.
    """
    vocabulary = sorted({w for t in templates for w in t.words})
    seen = docs.select(F.explode(F.array_append(
        F.array_intersect(words_of(F.col(text)), F.array(*map(F.lit, vocabulary))), F.lit("")
    )).alias("word")).groupBy("word").count()
    counts = {r["word"]: r["count"] for r in seen.collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _places(words: Column, word: str, shift: int) -> Column:
    """Where `word` stands, each place moved back by `shift`."""
    at = F.transform(words, lambda w, i: F.when(w == word, i - shift))
    return F.filter(at, lambda i: i.isNotNull())


def _rare(template: Template, weight: dict[str, float]) -> list[int]:
    """Where in the notice the two highest-IDF words of its key phrase are."""
    return sorted(range(*template.span), key=lambda i: (-weight[template.words[i]], i))[:2]


def _aligned(template: Template, weight: dict[str, float]) -> Column:
    """Places (of the notice's first word) where the key phrase stands."""
    words, (first, end), rare = F.col("_words"), template.span, _rare(template, weight)
    agreed = reduce(F.array_intersect, [_places(words, template.words[i], i) for i in rare])
    stands = [lambda o, i=i: F.get(words, o + i) == template.words[i] for i in range(first, end)]
    verified = F.filter(agreed, lambda o: reduce(lambda a, b: a & b, [s(o) for s in stands]))
    has = reduce(lambda a, b: a & b, [F.array_contains("_rare", template.words[i]) for i in rare])
    return F.when(has, verified).otherwise(F.array().cast("array<int>"))


def find_licenses(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """`docs` plus n_words, n_base, first_word, last_word, base_labels, labels, score.

    `n_base`, `first_word` and `last_word` describe the places of the base phrases; `score` is the
    best share of a notice's words found in place where its key phrase is verified, 0 without any.
    """
    weight = idf(docs, templates, text)
    names = [f"_at{i}" for i in range(len(templates))]
    anchors = sorted({t.words[i] for t in templates for i in _rare(t, weight)})
    found = docs.withColumn("_words", words_of(F.col(text))).withColumn(
        "_rare", F.array_intersect("_words", F.array(*map(F.lit, anchors)))
    ).withColumns({name: _aligned(t, weight) for name, t in zip(names, templates)})
    base = [(n, t) for n, t in zip(names, templates) if t.base]

    def moved(name: str, by: int) -> Column:
        return F.transform(name, lambda o: o + by)

    starts = F.concat(*[moved(n, t.span[0]) for n, t in base])

    def listed(pairs) -> Column:
        held = F.array_compact(F.array(*[F.when(F.size(n) > 0, F.lit(t.label)) for n, t in pairs]))
        return F.array_join(F.array_sort(F.array_distinct(held)), ",")

    def share(name: str, t: Template) -> Column:
        if len(t.words) == t.span[1] - t.span[0]:
            return F.when(F.size(name) > 0, F.lit(1.0)).otherwise(0.0)
        hits = F.transform(name, lambda o: reduce(lambda a, b: a + b, [
            F.coalesce((F.get("_words", o + i) == w).cast("int"), F.lit(0)) for i, w in enumerate(t.words)
        ]))
        return F.coalesce(F.array_max(hits), F.lit(0)) / len(t.words)

    return found.withColumns({
        "n_words": F.size("_words").cast("bigint"), "_starts": starts,
        "base_labels": listed(base), "labels": listed(list(zip(names, templates))),
        "score": F.greatest(*[share(n, t) for n, t in zip(names, templates)]).cast("double"),
    }).withColumns({
        "n_base": F.size("_starts").cast("bigint"),
        "first_word": F.array_min("_starts").cast("bigint"),
        "last_word": F.array_max("_starts").cast("bigint"),
    }).drop("_words", "_rare", "_starts", *names)
