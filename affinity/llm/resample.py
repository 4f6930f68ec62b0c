"""Importance resampling towards a target distribution, on Arrow kernels.

Every text's features are the hashes of its runs of 1 to ``orders`` words in ``buckets``
buckets. A bucket's gain is the log ratio of its smoothed shares in the target and in the
source; a document's weight is the mean gain of its features. Gumbel noise on the weights
turns the highest scores into a draw without replacement by those weights.

Inside a task Arrow does the work on slabs of texts: ascii_lower, split_pattern_regex,
list_flatten and dictionary_encode give word indices; shifted indices form the n-grams,
dictionary_encode again their distinct pairs, each of which gets its CRC once; gains are
taken by bucket and reduced by document. Pass one sends at most ``buckets`` counts a task;
the gains (``buckets`` numbers, whatever the corpus) go to every task; pass two returns one
narrow row per document. Ranks come from range partitions with prefix-summed counts.

Defined results: NULL text has no words; a document without features weighs 0; NULL doc_id
counts as an empty one in the noise and stands last among ties; repeated rows each get a
row and a rank; with no target texts every gain follows from smoothing alone; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_positions
from .common import ship, stored

BUCKETS = 10_000
ORDERS = 2
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after A-Z are lower-cased: words are 0-9, a-z and beyond ASCII
SLAB_BYTES = 4 << 20


def slabs(texts: pa.Array, size: int = SLAB_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of about ``size`` bytes (a longer text alone)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def features(texts: pa.Array, buckets: int, orders: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(words per text, [(text number, bucket) of every n-gram, by text] for n = 1..orders)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    coded = words.filter(real).dictionary_encode()
    owner = owner.filter(real).to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    spelled = coded.dictionary.cast(pa.large_binary()).to_pylist()
    crc = np.array([zlib.crc32(w) for w in spelled], np.int64)
    gram, gram_crc, out = index, crc, [(owner, crc[index] % buckets)]
    tails = [b" " + w for w in spelled]
    for n in range(2, orders + 1):
        # the n-gram at i is the (n-1)-gram at i followed by the word at i + n - 1 of the same text
        start = np.flatnonzero(owner[n - 1:] == owner[:max(0, len(owner) - n + 1)])
        pairs = pa.array(gram[start] * len(spelled) + index[start + n - 1]).dictionary_encode()
        distinct = pairs.dictionary.to_numpy(zero_copy_only=False)
        heads, lasts = np.divmod(distinct, max(len(spelled), 1))
        pair_crc = np.array([zlib.crc32(tails[w], c) for c, w in zip(gram_crc[heads].tolist(), lasts.tolist())], np.int64)
        inverse = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        out.append((owner[start], pair_crc[inverse] % buckets))
        gram = np.zeros(len(owner), np.int64)
        gram[start], gram_crc = inverse, pair_crc
    return np.bincount(owner, minlength=len(texts)), out


def counts(texts: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """(bucket, n): features of all texts by bucket."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for slab in slabs(batch.column(0)):
                for _, bucket in features(slab, buckets, orders)[1]:
                    total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> list[int]:
    """Gain of each bucket in thousandths: two tables of at most ``buckets`` counts are read."""
    def table(texts: DataFrame) -> tuple[list[int], int]:
        n = [0] * buckets
        for r in counts(texts, buckets, orders).collect():  # at most ``buckets`` rows
            n[r["bucket"]] = r["n"]
        return n, sum(n)

    (s, total_s), (t, total_t) = table(source), table(target)
    return [math.floor(1000 * math.log((b + 1.0) * (total_s + float(buckets)) / ((a + 1.0) * (total_t + float(buckets)))))
            for a, b in zip(s, t, strict=True)]


def weigh(docs: DataFrame, gain: list[int], orders: int = ORDERS) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    ship(docs.sparkSession)
    by_bucket, buckets = np.array(gain, np.int64), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n_features, weight = [], [], []
            for slab in slabs(batch.column(1)):
                n_words, grams = features(slab, buckets, orders)
                size, total = np.zeros(len(slab), np.int64), np.zeros(len(slab), np.int64)
                for owner, bucket in grams:
                    held = np.bincount(owner, minlength=len(slab))
                    ends = np.cumsum(held)
                    reduced = np.concatenate([[0], np.cumsum(by_bucket.take(bucket))])
                    size += held
                    total += reduced[ends] - reduced[ends - held]
                words.append(n_words)
                n_features.append(size)
                weight.append(np.floor_divide(total, np.maximum(size, 1)))
            columns = [np.concatenate(x).astype(np.int64) if x else np.empty(0, np.int64) for x in (words, n_features, weight)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: str, seed: int):
    """Gumbel noise in thousandths from the document's id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
         buckets: int = BUCKETS, orders: int = ORDERS) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; ``percent`` of those with
    ``min_words`` words are drawn and have a rank (1 = highest score)."""
    gain = gains(docs, target, buckets, orders)
    rows = weigh(docs, gain, orders).withColumn("score", F.col("weight") + noise("doc_id", seed))
    rows = stored(rows.withColumn("fit", F.col("n_words") >= min_words), "resample-scores")
    drawn = rows.filter("fit").count() * percent // 100
    ranked = with_positions(rows, F.col("fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                            F.col("weight").desc(), F.col("n_features"))
    return ranked.select("doc_id", "n_features", "weight", "score", F.when(F.col("position") <= drawn, F.col("position")).alias("rank"))


def sample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, with all their columns. A doc_id held by several rows is drawn
    with all of them if one is."""
    ids = draw(docs, target, **options).filter("rank IS NOT NULL").select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, docs["doc_id"].cast("bigint").eqNullSafe(ids["__drawn"]), "left_semi")
