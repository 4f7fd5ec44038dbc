"""Packing documents into fixed-size sequences by vector best fit.

Documents become token ids; only those longer than a sequence are cut. Every piece has a size in three
resources: tokens, one document, and attention cost (the square of its length). Pieces are dealt to
shards of bounded size by a hash, and inside a shard, longest first, each goes to the open sequence that the chosen
rule likes best among those with room in every resource.

Null text counts as empty: one end-of-document id. Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import math
import os
import re
import string
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcatch.llm.workers import forget, per_worker, tidy
from fieldcatch.runtime import materialise

#: Token lists of so many distinct words and parts of words stay in a Python worker, of those up to so many bytes.
#: They take about 150 MB of a worker, and an executor keeps a worker for every task that runs at once.
CACHED_WORDS, CACHED_BYTES = 600_000, 32
#: Texts of about so many bytes are taken together: their words are told apart and looked up once.
TOGETHER = 4 << 20
#: Punctuation that is a token of its own behind a letter or digit.
TAIL = string.punctuation.encode()
#: Words that the tokenizer neither changes nor splits before it looks for tokens.
PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: Pieces a shard holds on average: enough that its last half-filled sequences do not matter.
SHARD_PIECES = 8192


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds. Attention cost is the sum of squared piece lengths."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096

    @property
    def longest(self) -> int:
        return min(self.tokens, math.isqrt(self.attention))


class WordTokens:
    """Token ids of texts, word by word.

    The tokenizer lower-cases and never joins what white space parts, nor a letter and punctuation
    behind it, so a text's ids are those of its parts one after the other. Each distinct part is
    tokenized once; when the cache is full, the words met first, among them all frequent ones, stay.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)  # the same model, for what is normal and one word already
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}  # of words, and of parts as well: a part has no other part

    @staticmethod
    def _parts(word: bytes) -> tuple[bytes, bytes]:
        """The word in lower case, and the punctuation split from its end."""
        if word.isalpha():
            return word.lower(), b""
        if b"<|" in word:  # a special token is written in lower case only
            return word, b""
        core = word.rstrip(TAIL)
        if len(core) < len(word) and core and WordTokens._ends_in_letter(core):
            return core.lower(), word[len(core):]
        return word.lower(), b""

    @staticmethod
    def _ends_in_letter(core: bytes) -> bool:
        """Whether a word ends in a letter or digit also when it has been composed and lower-cased: some end in a
        mark then, which the tokenizer joins with the punctuation behind it."""
        if core[-1] < 128:
            return core[-1:].isalnum()
        return core.decode()[-1].isalnum() and unicodedata.normalize("NFC", core.decode()).lower()[-1].isalnum()

    def _tokenize(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of parts. Plain ones are tokenized as one text, whose ids tell where a word ends."""
        found, plain, others = {}, [], []
        for part in parts:
            text = part.decode()
            (plain if PLAIN.fullmatch(text) else others).append((part, text))
        for i in range(0, len(plain), 1024):
            some, texts = zip(*plain[i:i + 1024])
            ids = np.asarray(self.plain.encode(" ".join(texts), add_special_tokens=False).ids, dtype="<u4")
            body, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
            found.update(zip(some, [body[a:b] for a, b in zip([0, *ends], ends)], strict=True))
        for i in range(0, len(others), 4096):
            some, texts = zip(*others[i:i + 4096])
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            found.update((w, struct.pack(f"<{len(c.ids)}I", *c.ids)) for w, c in zip(some, coded))
        return found

    def _code(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of the given words, and of those of their parts that are not held."""
        parts = [self._parts(w) for w in words]
        known = self.words
        found = self._tokenize(list({p for pair in parts for p in pair if p and p not in known}))
        found[b""] = b""
        for w, (a, b) in zip(words, parts):
            if w not in found:
                ids = known[a] if a in known else found[a]
                found[w] = ids + (known[b] if b in known else found[b]) if b else ids
        return found

    def encode_all(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """Ids of all texts in turn, little-endian unsigned 32-bit, and the bytes where each text's begin; the last one
        is where they end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        told = split.flatten().dictionary_encode()
        words = told.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        held = self.words
        ids = list(map(held.get, words))
        if None in ids:
            found = self._code([w for w, known in zip(words, ids) if known is None])
            ids = [found[w] if known is None else known for w, known in zip(words, ids)]
            room = CACHED_WORDS - len(held)
            if room > 0 and texts.nbytes < 2 * TOGETHER:  # not the rare words of one long text
                held.update(islice(((w, i) for w, i in found.items() if 0 < len(w) <= CACHED_BYTES), room))
        placed = pa.array(ids, pa.large_binary()).take(told.indices)
        at = np.zeros(len(placed) + 1, dtype="i8")
        np.cumsum(pc.binary_length(placed), out=at[1:])
        return memoryview(placed.buffers()[2] or b""), at[split.offsets.to_numpy()].tolist()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        body, (begin, stop) = self.encode_all(pa.array([text.encode("utf-8", "replace").decode()]))
        return bytes(body[begin:stop])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def together(texts: pa.Array) -> list[tuple[int, int]]:
    """Where runs of texts begin and end that have about `TOGETHER` bytes, or are a single longer one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    bounds = np.flatnonzero(np.diff(np.cumsum(sizes, dtype="i8") // TOGETHER, prepend=-1, append=-1)).tolist()
    return list(zip(bounds, bounds[1:]))


def pieces(docs: DataFrame, longest: int, path: str | None = None, end_id: int = 1,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and `end_id`, cut at `longest`."""
    where = path or tokenizer_path()
    name = f"tokens {where}"
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = per_worker(name, lambda: WordTokens(where))
        for batch in batches:
            rows = []
            for first, behind in together(batch["text"]):
                body, at = coder.encode_all(batch["text"].slice(first, behind - first))
                for row, begin, stop in zip(range(first, behind), at, at[1:]):
                    ids = bytes(body[begin:stop]) + end
                    for k, cut_at in enumerate(range(0, len(ids), 4 * longest)):
                        part = ids[cut_at:cut_at + 4 * longest]
                        rows.append((row, k, cut_at // 4, len(part) // 4, zlib.crc32(part)))
            row, piece, start, length, crc = np.array(rows, dtype="i8").reshape(-1, 5).T
            columns = [batch["doc_id"].take(pa.array(row)), *map(pa.array, (piece.astype("i4"), start, length, crc))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        tidy(cut, name), "doc_id string, piece int, start bigint, length bigint, ids_crc32 bigint"
    ).withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: str = "norm",
             weights=(1.0, 0.05, 0.05)) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, longest placed first.

    `norm` takes the sequence left with the smallest weighted residual norm, `dot` the one whose
    residual has the largest weighted dot product with the piece; ties go to the one opened first.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    order = np.argsort(-lengths, kind="stable")
    residual = np.empty((max(len(lengths), 1), 3))
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    used = 0
    live = np.empty(0, dtype=np.int64)  # sequences that still have room for a token and a document
    w = np.asarray(weights)
    for at in order:
        item = np.array([lengths[at], 1.0, float(lengths[at]) ** 2])
        left = residual[live]
        fits = np.flatnonzero((left >= item).all(axis=1))
        if len(fits):
            room = left[fits]
            if rule == "norm":
                pick = fits[np.argmin((((room - item) / full) ** 2) @ w)]
            else:
                pick = fits[np.argmax((room / full) @ (w * item / full))]
            chosen = live[pick]
        else:
            chosen, pick = used, len(live)
            residual[used] = full
            used += 1
            live = np.append(live, chosen)
        bins[at], offsets[at] = chosen, capacity.tokens - int(residual[chosen, 0])
        residual[chosen] -= item
        if (residual[chosen] < 1).any():
            live = np.delete(live, pick)
    return bins, offsets


def pack(parts: DataFrame, capacity: Capacity = Capacity(), rule: str = "norm",
         weights=(1.0, 0.05, 0.05), shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """`pieces` plus sequence_id and offset.

    The pieces are written once, so tokens are not computed again and their number gives the number
    of shards; what a shard holds does not depend on documents, sources or copies.
    """
    stored = materialise(parts, "pieces")
    shards = max(1, math.ceil(stored.count() / shard_pieces))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        forget()
        group = group.sort_values(["length", "_tie", "ids_crc32", "start"], ascending=False, kind="stable")
        bins, offsets = best_fit(group["length"].to_numpy(), capacity, rule, weights)
        group["sequence_id"] = group["_shard"].to_numpy() * (1 << 24) + bins
        group["offset"] = offsets
        return group[[*names, "sequence_id", "offset"]]

    names = stored.columns
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    tie = F.xxhash64("doc_id", "piece", "ids_crc32")
    return stored.withColumn("_tie", tie).withColumn("_shard", F.pmod("_tie", F.lit(shards))).groupBy(
        "_shard"
    ).applyInPandas(place, f"{kinds}, sequence_id bigint, offset bigint")
