"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard.

Two fixed permutations of [0, 2^20) give all signature coordinates: ``sigma``
places a shingle hash, and coordinate k is the smallest ``pi`` value over the
places shifted by k, so the coordinates of one shingle are one contiguous slice
of ``pi``. Documents with equal shingle sets form one class, carried by its
smallest doc_id; only classes are banded. A bucket gives each member one pair with the
bucket's smallest member, never all pairs. Pairs are confirmed on full sets.

Links that the stars miss are found afterwards: within every group connected
by buckets, the classes outside the group's largest component are compared
with the whole group, in blocks: signature bytes rule out pairs whose estimate is
below the similarity by more than five standard errors, full sets decide the
rest, and one link per class and component is enough. So no link between
different components is skipped, and no task emits a block's pairs.

Bands of 6 rows x 40 miss a pair at similarity 0.8 with probability 6e-6, and
a pair missed by the bands is still compared when its group is connected.

Defined results: NULL and empty texts and texts of spaces have no shingles, link
with nothing and stay; fewer words than ``shingle`` make one shingle; rows with
equal doc_id share a component; a NULL doc_id links with nothing, has a NULL
component and is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_prefix, ship, stored
from .components import components

SIMILARITY = 80  # per cent
ROWS, BANDS = 6, 40
COORDINATES = ROWS * BANDS
PLACES = 1 << 20
SEED = 20
CACHE_WORDS = 1 << 19
QUERY_ITEMS, GROUP_ITEMS = 1 << 18, 1 << 19  # shingles in a block

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, shingle: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = text.lower().split() if text else []  # bytes: A-Z only, ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    k = min(shingle, len(h))
    n = len(h) - k + 1
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc = mixed(acc * _C1 + h[j:j + n])
    return np.unique(acc)


@lru_cache(maxsize=1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    sigma = rng.permutation(PLACES)
    pi = rng.permutation(PLACES).astype(np.uint32)
    circle = np.concatenate([pi, pi[:COORDINATES - 1]])
    return sigma, np.lib.stride_tricks.sliding_window_view(circle, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    sigma, shifted = permutations()
    places = sigma[(shingles >> np.uint64(44)).astype(np.int64)]
    out = np.full(COORDINATES, PLACES, np.uint32)
    for i in range(0, len(places), 1024):
        np.minimum(out, shifted[places[i:i + 1024]].min(axis=0), out=out)
    return out


@lru_cache(maxsize=1)
def _band_weights() -> np.ndarray:
    return np.random.default_rng(SEED + 1).integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = (sig.reshape(BANDS, ROWS).astype(np.uint64) * _band_weights()).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64) * _C1).view(np.int64)


def _texts(batch: pa.RecordBatch, i: int) -> list[bytes | None]:
    return batch.column(i).cast(pa.large_binary()).to_pylist()


_SIGNED = "doc_id bigint, n_shingles bigint, content binary, bands array<bigint>, sig binary"


def signed(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, content, bands, sig) of every row; the last three are
    NULL without shingles or doc_id. ``sig`` has the low byte of each coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, n, content, bands, sigs = batch.column(0).to_pylist(), [], [], [], []
            for doc, text in zip(ids, _texts(batch, 1), strict=True):
                s = shingle_set(text, shingle, hashes)
                n.append(len(s))
                linked = len(s) > 0 and doc is not None
                sig = signature(s) if linked else None
                content.append(xxhash.xxh3_128_digest(s.tobytes()) if linked else None)
                bands.append(band_keys(sig) if linked else None)
                sigs.append(sig.astype(np.uint8).tobytes() if linked else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(content, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "content", "bands", "sig"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SIGNED)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(rep, items) of every document: its full set of shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, shingle, hashes).view(np.int64) for t in _texts(batch, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["rep", "items"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "rep bigint, items array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").filter(
        100 * both >= similarity * (F.size("x") + F.size("y") - both)).select("a", "b")


def _open_links(reps: DataFrame, sets: DataFrame, groups: DataFrame, comps: DataFrame, similarity: int) -> DataFrame:
    """Links between different components of one group.

    Every class outside its group's largest component meets the whole group, in
    blocks of a bounded number of shingles. Within a block a class takes the
    classes of each other component by falling estimate and stops at the first
    that full sets confirm, so one link is made per class and component at most.
    """
    members = groups.select(F.col("node").alias("rep"), F.col("comp").alias("grp")).join(
        comps.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    members = stored(members.join(reps.select("rep", "n_shingles", "sig"), "rep"), "group-members")
    sizes = members.groupBy("grp", "comp").agg(F.sum("n_shingles").alias("n")).groupBy("grp").agg(
        F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("total"), F.count("*").alias("kinds"))
    sizes = sizes.filter("kinds > 1").select(
        "grp", F.col("m.comp").alias("giant"),
        F.ceil((F.col("total") - F.col("m.n")) / QUERY_ITEMS).alias("qs"), F.ceil(F.col("total") / GROUP_ITEMS).alias("gs"))
    rows = stored(members.join(sizes, "grp").join(sets, "rep"), "open-members")
    spot = F.xxhash64("rep")
    asks = rows.filter("comp <> giant").withColumn("qb", F.pmod(spot, "qs")).withColumn(
        "gb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("gs") - 1)))
    all_rows = rows.withColumn("gb", F.pmod(spot, "gs")).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qs") - 1)))
    cols = ["grp", "qb", "gb", "rep", "comp", "sig", "items"]
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    both = asks.select(*cols, F.lit(True).alias("ask")).union(all_rows.select(*cols, F.lit(False).alias("ask"))).withColumn(
        "part", F.pmod(F.xxhash64("grp", "qb", "gb"), F.lit(parts)))
    j = similarity / 100
    least = j - 5 * (j * (1 - j) / COORDINATES) ** 0.5

    def confirm(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, block in part.groupby(["grp", "qb", "gb"], sort=False):
            rest, asking = block[~block["ask"]], block[block["ask"]]
            if rest.empty or asking.empty:
                continue
            sigs = np.frombuffer(b"".join(rest["sig"]), np.uint8).reshape(-1, COORDINATES)
            ids, comp, items = rest["rep"].to_numpy(), rest["comp"].to_numpy(), rest["items"].to_list()
            n = np.array([len(x) for x in items])
            for rep, own, sig, mine in zip(asking["rep"], asking["comp"], asking["sig"], asking["items"], strict=True):
                size = len(mine)
                at = np.flatnonzero((comp != own) & (100 * np.minimum(n, size) >= similarity * np.maximum(n, size)))
                equal = np.count_nonzero(sigs[at] == np.frombuffer(sig, np.uint8), axis=1) / COORDINATES
                estimate = (equal - 1 / 256) * 256 / 255
                order = np.argsort(-estimate, kind="stable")
                linked: set[int] = set()
                for i in at[order[estimate[order] >= least]].tolist():
                    if comp[i] not in linked:
                        shared = np.intersect1d(mine, items[i], assume_unique=True).size
                        if 100 * shared >= similarity * (size + n[i] - shared):
                            linked.add(comp[i])
                            found.append((min(rep, ids[i]), max(rep, ids[i])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return both.groupBy("part").applyInPandas(confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id
    reachable over links), kept (doc_id = component_id)."""
    ship(docs.sparkSession)
    sig = stored(signed(docs, shingle), "signed")
    full = sig.filter("content IS NOT NULL")
    reps = stored(full.groupBy("content").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sig")).alias("r")).select(
        "content", F.col("r.doc_id").alias("rep"), "r.n_shingles", "r.bands", "r.sig"), "classes")
    banded = reps.select("rep", F.explode("bands").alias("key"))
    shared = stored(banded.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("key", "a"), "buckets")
    stars = stored(banded.join(shared, "key").filter("rep <> a").groupBy("a", F.col("rep").alias("b")).agg(
        F.count("*").alias("bands")), "stars")
    groups = components(stars)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        groups.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").withColumn(
        "version", F.xxhash64("text")).dropDuplicates(["doc_id", "version"])
    sets = stored(shingle_sets(texts, shingle), "sets")
    first = stars.groupBy("b").agg(F.max_by("a", F.struct("bands", -F.col("a"))).alias("a")).select("a", "b")
    links = stored(_confirmed(first, sets, similarity), "links")
    comps = components(links)
    more = stored(_open_links(reps, sets, groups, comps, similarity), "links")
    comps = components(links.union(more))
    by_content = reps.select("content", "rep").join(comps.withColumnRenamed("node", "rep"), "rep", "left").select(
        "content", F.coalesce("comp", "rep").alias("comp"))
    by_content = stored(by_content, "class-components")
    return sig.select("doc_id", "n_shingles", "content").join(by_content, "content", "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"),
        F.coalesce(F.col("comp") == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The documents that stay, with their own columns: one doc_id of each group."""
    name = own_prefix(docs) + "gone"
    gone = near_duplicates(docs, shingle, similarity).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == F.col(name), "left_anti")
