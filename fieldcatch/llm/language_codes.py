"""Language identification with error-correcting output codes.

Every language has a codeword. Each bit has a binary classifier on hashed character bigrams and
trigrams: the log odds of an n-gram between the languages whose bit is set and the others. A text's
margins are decoded to the codeword of least loss, each bit's loss weighted by how well its
classifier does on that language; texts whose two nearest codewords are close for their length are flagged, as
texts of two languages, of none of those learned, or of a few letters are.

Null texts and texts without a letter are `und` with score 0 and not ambiguous. Without labelled rows every
text is `und`. Only the text decides; labels are read only from rows that are not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcatch.llm.workers import per_worker, tidy
from fieldcatch.runtime import materialise

BUCKETS = 1 << 14
#: About so many labelled rows of each language are fitted on (all, if there are fewer).
SAMPLE_PER_LANGUAGE = 2000
UNKNOWN = "und"
#: Below this score a text is flagged as ambiguous: in a long one, where another language has more than a third.
CLEAR = 0.3


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 and -1
    odds: np.ndarray  # buckets x bits
    trust: np.ndarray  # languages x bits, rows sum to 1
    pull: np.ndarray  # languages x bits, what an n-gram of the language adds to the right side of the bit on average


def codewords(n: int) -> np.ndarray:
    """`n` codewords: all splits of the languages in two for up to 7, else the best of random codes."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1)][1:]
        return np.array(columns, dtype=float).T
    rng = np.random.default_rng(11)
    bits, best, best_gap = int(np.ceil(10 * np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], size=(n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        near = code @ code.T
        gap = code.shape[1] - (near - np.diag(np.diag(near)) - np.diag(np.full(n, np.inf))).max()
        if gap > best_gap:
            best, best_gap = code, gap
    return best


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return per_worker("letters", lambda: np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of hashed bigrams and trigrams of the whole text; None if it has no letter.

    Letters are lower-cased; runs of anything else become one blank.
    """
    if not isinstance(text, str) or not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.where(letter, points, 32)[keep].astype(np.uint32)
    points = np.concatenate(([32], points, [32])).astype(np.uint32)
    pair = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
    three = pair[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - 14)
    return np.bincount(np.concatenate((pair >> shift, three >> shift)), minlength=BUCKETS)


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Rows kept out of training: crc32 of the id as text is a multiple of `folds`."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds == 0


def _margins(counts: np.ndarray, odds: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(counts)
    n = counts[at]
    return (n @ odds[at]) / np.sqrt(n.sum())


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang",
        per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on a sample of the labelled rows, about `per_language` of each language.

    The sample is written to the shared folder; what comes to the driver is one row per language
    and n-gram bucket.
    """
    rows = labelled.filter(F.col(lang).isNotNull())
    sizes = {r[lang]: r["count"] for r in rows.groupBy(lang).count().collect()}
    languages = sorted(sizes)
    codes = codewords(len(languages))
    if not languages:
        return Model([], codes, np.zeros((BUCKETS, 1)), codes, codes)
    steps = 1 << 20
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(steps, -(-steps * per_language // sizes[k])))])
    draw = F.pmod(F.xxhash64(F.col(text), F.lit(3)), F.lit(steps))
    sample = materialise(
        rows.filter(draw < F.element_at(share, F.col(lang))).select(F.col(text).alias("text"), F.col(lang).alias("lang")),
        "languages",
    )

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for body, name in zip(batch["text"], batch["lang"]):
                found = gram_counts(body)
                if found is not None:
                    sums[name] = sums[name] + found if name in sums else found.copy()
            for name, total in sums.items():
                at = np.flatnonzero(total)
                yield pd.DataFrame({"lang": name, "bucket": at.astype("int32"), "n": total[at].astype("int64")})

    summed = sample.mapInPandas(tidy(counts, "letters"), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toPandas()
    table = np.full((len(languages), BUCKETS), 0.5)
    index = {name: i for i, name in enumerate(languages)}
    table[summed["lang"].map(index).to_numpy(dtype=int), summed["bucket"].to_numpy()] += summed["n"].to_numpy()
    chance = table / table.sum(axis=1, keepdims=True)
    if len(languages) == 1:
        return Model(languages, codes, np.zeros((BUCKETS, 1)), codes, codes)
    ones = (codes > 0).astype(float)
    odds = np.log((chance.T @ ones) / ones.sum(axis=0)) - np.log((chance.T @ (1 - ones)) / (1 - ones).sum(axis=0))

    def right(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for body, name in zip(batch["text"], batch["lang"]):
                found = gram_counts(body)
                if found is not None:
                    side = _margins(found, odds) * codes[index[name]]
                    yield pd.DataFrame({
                        "lang": name, "bit": np.arange(len(side), dtype="int32"), "hit": (side > 0).astype(float),
                        "pull": side * np.sqrt(found.sum()), "n": found.sum(),
                    })

    rates = sample.mapInPandas(tidy(right, "letters"), "lang string, bit int, hit double, pull double, n bigint").groupBy("lang", "bit").agg(
        F.avg("hit").alias("hit"), (F.sum("pull") / F.sum("n")).alias("pull")
    ).toPandas()
    at = rates["lang"].map(index).to_numpy(dtype=int), rates["bit"].to_numpy()
    trust, pull = np.full(codes.shape, 0.5), np.zeros(codes.shape)
    trust[at], pull[at] = rates["hit"].to_numpy(), rates["pull"].to_numpy()
    trust = np.maximum(trust, 1e-3)
    return Model(languages, codes, odds.astype("float32"), trust / trust.sum(axis=1, keepdims=True), pull)


def decode(margins: np.ndarray, grams: int, model: Model) -> tuple[int, float]:
    """The language of least weighted loss, and how clearly it wins over the next one (0 to 1).

    Evidence alone grows with the length of the text, whatever it is made of. So what the text's `grams` n-grams
    add on average, in the bits that part the two languages, is compared with what those of the winner's own
    texts add: all of it in a text of one language, nothing in one that is half the other's or neither's. Of
    languages with equal loss the first wins.
    """
    loss = (model.trust * np.logaddexp(0.0, -model.codes * margins)).sum(axis=1)
    if len(loss) < 2:
        return 0, 1.0
    best, second = (int(i) for i in np.argsort(loss, kind="stable")[:2])
    fit_ = np.exp((loss[best] - loss) * model.codes.shape[1])
    parts = model.codes[best] != model.codes[second]
    usual = model.pull[best, parts].sum()
    added = (model.codes[best] * margins)[parts].sum() / np.sqrt(grams)
    purity = min(1.0, max(0.0, added / usual)) if usual > 0 else 0.0
    return best, float(fit_[best] / fit_.sum() * purity)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` plus lang_pred, score and ambiguous."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "ambiguous")]

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = [], []
            for body in texts:
                found = gram_counts(body) if model.languages else None
                if found is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best, won = decode(_margins(found, model.odds), int(found.sum()), model)
                    names.append(model.languages[best])
                    scores.append(won)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    guess = F.pandas_udf(tidy(score, "letters"), "lang_pred string, score double")
    return docs.select(*kept).withColumn("_guess", guess(F.col(text))).select(
        *kept, F.col("_guess.lang_pred").alias("lang_pred"), F.col("_guess.score").alias("score"),
        ((F.col("_guess.lang_pred") != UNKNOWN) & (F.col("_guess.score") < CLEAR)).alias("ambiguous"),
    )
