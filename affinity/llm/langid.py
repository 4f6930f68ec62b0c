"""Language identification by prediction by partial matching (PPM).

Per language, a context tree of order ``ORDER`` counts the bytes that follow every
context of up to that many bytes in the training texts. The frozen statistics give
each byte a probability: in the longest context known for the language, a byte seen
there c times among n has c / (n + d), d being the number of different bytes seen;
else it costs the escape d / (n + d) and the next shorter context decides, down to
1 / 256. The code length of a whole text is the sum over its bytes; the language with
the shortest code wins, and ``score`` is its posterior under equal priors.

Training texts are a sample bounded by ``TRAIN_BYTES`` for each language: rows in
hash order, taken while their UTF-8 bytes fit in whole (a documented parameter; every
row is scored, whole). For scoring, each language's tree is kept whole as sorted arrays
of its grams and contexts with their codes, so its size is bounded by the training
bytes alone.

Defined results: ``und`` with score 0 for NULL texts, texts without letters, and
when nothing can be learnt; equal code lengths go to the first language in code
point order; repeated rows each get a row; an empty table gives no rows; rows with
NULL doc_id are neither held out nor learnt from; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

ORDER = 3
TRAIN_BYTES = 4_000_000
SLAB = 1 << 20


def held_out(doc_id: Column, modulus: int = 4, remainder: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


@dataclass(frozen=True)
class Tree:
    """One language's frozen context tree. ``grams[k]``: byte strings of length k + 1 seen,
    ascending, ``hits[k]``: bits of their last byte after the others; ``contexts[k]``:
    contexts of length k, ascending, ``escapes[k]``: bits to leave them."""

    grams: list[np.ndarray]
    hits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def bits(self, asked: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each string of ORDER + 1 bytes."""
        out, left = np.zeros(len(asked)), np.arange(len(asked))
        for k in range(ORDER, -1, -1):
            key = asked[left] & np.uint32((1 << 8 * (k + 1)) - 1)
            at, seen = _places(self.grams[k], key)
            out[left[seen]] += self.hits[k][at[seen]]
            left, key = left[~seen], key[~seen] >> np.uint32(8)
            at, known = _places(self.contexts[k], key)
            out[left[known]] += self.escapes[k][at[known]]
        out[left] += 8
        return out


def _places(names: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(names, asked), len(names) - 1)
    return at, (names[at] == asked if len(names) else np.zeros(len(asked), bool))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    trees: list[Tree]


def training_texts(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    """(lang, text) of the bounded sample: within a language, rows in hash order as
    long as the bytes before them and their own fit (of texts over an eighth of
    ``train_bytes`` a part of at most that size is in the sample, at a place drawn by the
    hash). Only the share of the hash range that can hold the sample is sorted."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    part = train_bytes // 32  # characters, of four bytes at most
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - part + 1, F.lit(1))).cast("int") + 1
    rows = rows.withColumn("text", F.when(F.octet_length("text") > train_bytes // 8, F.substring("text", place, F.lit(part))).otherwise(F.col("text")))
    rows = rows.select("lang", "text", F.octet_length("text").cast("bigint").alias("n"), F.xxhash64("doc_id").alias("h"))
    per_lang = rows.groupBy("lang").agg(F.sum("n").alias("total"))
    # the share of the hash range that holds the bytes, a fifth more
    share = F.least(F.lit(1.0), 1.2 * train_bytes / F.col("total"))
    limits = [(r["lang"], r["s"]) for r in per_lang.select("lang", share.alias("s")).collect()]  # one row per language
    if not limits:
        return rows.select("lang", "text").limit(0)
    position = (F.col("h").cast("double") + float(1 << 63)) / float(1 << 64)
    wanted = F.lit(False)
    for lang, s in limits:
        wanted = wanted | ((F.col("lang") == lang) & (position <= s))
    near = rows.filter(wanted)
    w = Window.partitionBy("lang").orderBy("h", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return near.withColumn("through", F.sum("n").over(w)).filter(F.col("through") <= train_bytes).select("lang", "text")


def _counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n): counts of all byte strings of length 1 to ORDER + 1. A gram is
    packed with a leading 1 bit pattern so that lengths differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                raw = np.frombuffer(text, np.uint8).astype(np.int64)
                for k in range(1, ORDER + 2):
                    n = len(raw) - k + 1
                    if n <= 0:
                        break
                    gram = np.ones(n, np.int64)
                    for j in range(k):
                        gram = (gram << 8) | raw[j:j + n]
                    found.setdefault(lang, []).append(np.unique(gram, return_counts=True))
        for lang, parts in found.items():
            grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

    counts = texts.mapInArrow(run, "lang string, gram bigint, n bigint")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> Model | None:
    """Count the sample and lay out one language's tree after the other. What reaches the driver
    for a language is bounded by its sample: at most ORDER + 1 grams for each training byte."""
    ship(docs.sparkSession)
    texts = stored(training_texts(docs, train_bytes).repartition(16), "langid-sample")
    counts = stored(_counts(texts), "langid-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    trees = []
    for lang in languages:
        t = counts.filter(F.col("lang") == lang).select("gram", "n").toArrow()
        trees.append(tree(t.column("gram").to_numpy(), t.column("n").to_numpy()))
    return Model(languages, trees) if languages else None


def tree(gram: np.ndarray, n: np.ndarray) -> Tree:
    """The tree of the packed grams of one language and their counts."""
    order = np.argsort(gram)
    gram, n = gram[order], n[order].astype(float)
    out = Tree([], [], [], [])
    for k in range(ORDER + 1):
        mine = gram >> (8 * (k + 1)) == 1
        names, count = (gram[mine] & ((1 << 8 * (k + 1)) - 1)).astype(np.uint32), n[mine]
        contexts, at, kinds = np.unique(names >> np.uint32(8), return_inverse=True, return_counts=True)
        whole = np.bincount(at, count, minlength=len(contexts)) + kinds
        out.grams.append(names)
        out.hits.append(-np.log2(count / whole[at]).astype(np.float32))
        out.contexts.append(contexts)
        out.escapes.append(-np.log2(kinds / whole).astype(np.float32))
    return out


def _slabs(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """(number of the text, ORDER bytes before the part and the part), about SLAB bytes together."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        padded = b" " * ORDER + text  # what stands before the text: spaces
        for at in range(0, len(text), SLAB):
            parts.append((i, padded[at:at + SLAB + ORDER]))
            size += len(parts[-1][1])
            if size >= SLAB:
                yield parts
                parts, size = [], 0
    if parts:
        yield parts


def all_code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of the whole texts (rows) under every language."""
    out = np.zeros((len(texts), len(model.languages)))
    for parts in _slabs(texts):
        raw = np.frombuffer(b"".join(p for _, p in parts), np.uint8).astype(np.uint32)
        gram = np.zeros(len(raw) - ORDER, np.uint32)
        for j in range(ORDER + 1):
            gram = gram << np.uint32(8) | raw[j:len(raw) - ORDER + j]
        size = np.array([len(p) for _, p in parts])
        ends = np.cumsum(size)
        inside = np.ones(len(raw), bool)  # no string reaches into the next part
        for j in range(1, ORDER + 1):
            inside[ends - j] = False
        asked, at = np.unique(gram[inside[:len(gram)]], return_inverse=True)
        starts = np.cumsum(size - ORDER) - (size - ORDER)
        number = [i for i, _ in parts]
        for l, t in enumerate(model.trees):
            np.add.at(out[:, l], number, np.add.reduceat(t.bits(asked)[at], starts))
    return out


def code_lengths(model: Model, text: bytes) -> np.ndarray:
    """Bits of the whole text under every language."""
    return all_code_lengths(model, [text])[0]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by TRAIN_BYTES for each language
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            usable = [i for i, text in enumerate(texts) if text is not None]
            for i, bits in zip(usable, all_code_lengths(m, [texts[i] for i in usable]), strict=True):
                best = int(bits.argmin())
                langs[i] = m.languages[best]
                scores[i] = float(1 / np.exp2(np.maximum(bits[best] - bits, -1000)).sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs), pa.array(scores)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> DataFrame:
    return predict(docs, fit(docs, train_bytes))
