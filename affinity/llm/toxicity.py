"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Examples: labelled rows outside the held-out remainder, at most ``MAX_EXAMPLES`` in
hash order (a documented bound; everything else covers all documents). Terms are
lower-cased letter runs, their prefixes of 5 letters, and for those found twice
or more in a text levels of their count and of their share of the words. Every text
becomes one sparse vector of all its terms, (1 + ln tf) * idf, idf counted over all
documents; terms held by toxic examples too often to be chance (Chernoff bound, corrected
for the number of terms) weigh more. A term that no example holds adds nothing to any
product; it counts in the text's length with the idf of df 0. Terms are known by
64-bit hashes.

The inverted index holds the examples' unit vectors. They stand in the order of a clustering,
so that neighbours in it are alike, in groups of 1024 and blocks of 64. What at least
``FREQUENT`` examples of a group hold of a term is a dense row of that group, with the term's
largest weight per block; the rest are posting lists. For some texts together the posting
lists are added up, then the blocks' largest weights bound what the dense rows can add; first
each text's blocks of the largest bounds are read, then those whose bound reaches the k-th
cosine found, by products of many texts and blocks. So blocks are skipped only where their
bound proves it, and neighbours are exact. Their cosine-weighted votes are calibrated by
isotonic regression on the examples' own leave-one-out votes.

Every text's terms are taken once, packed (known terms as differences, with their
frequencies) and stored; document frequencies and searches read the packed vectors.

Defined results: NULL, empty and termless texts have a zero vector, no
neighbours and the calibrated score of such examples; without examples every score is
0; ties in cosine go to the smaller doc_id; labels of one doc_id that differ count
as toxic; of several texts of one labelled doc_id the smallest is the example; repeated rows each get a row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import functools
import math
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .langid import held_out
from .lm import pack, unpack

MAX_EXAMPLES = 10_000
CHANCE_TERMS = 0.5  # expected number of terms taken for markers by chance
MARKED = 3.0  # by leave-one-out on the examples
SLAB = 256
QUERIES = 256  # searched together
EXAMPLES_AT_ONCE = 2048
NEIGHBOURS = 15
BLOCK = 64
GROUP = 16 * BLOCK  # examples whose frequent terms have dense rows together
FREQUENT = BLOCK  # a term that so many examples of a group hold has a dense row there
CHUNK = 8  # postings read together
RUN = 4  # blocks read together for the texts that need one of them
TOXIC = 0.7
PREFIXES = (5,)
COUNTS = (2, 4, 8)
SHARES = (8, 7, 6, 5, 4)
LONG = 32
WORDS_AT_ONCE = 1 << 15
CACHE_VECTORS = 1 << 15
CLUSTERS, CLUSTER_TERMS = 24, 256  # of examples by their commonest terms, for blocks of alike ones
FIRST_BLOCKS = 4  # read before the others are bounded by their k-th cosine
SLACK = 1e-5  # single precision sums of unit vectors are this close

_WORD = re.compile(r"[^\W\d_]+")


def _mixed(x: np.ndarray, salt: int | np.ndarray) -> np.ndarray:
    x = x + np.asarray(salt + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


_PLACES = _mixed(np.arange(LONG, dtype=np.uint64), 99).view(np.uint64) | np.uint64(1)
_SALTS = np.arange(2, 2 + len(COUNTS) + len(SHARES))


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter of a word, and its hash."""
    letter = np.zeros(sys.maxunicode + 1, bool)
    for m in _WORD.finditer("".join(map(chr, range(len(letter))))):
        letter[m.start():m.end()] = True
    return letter, _mixed(np.arange(len(letter), dtype=np.uint64), 0).view(np.uint64)


def word_terms(text: str) -> tuple[np.ndarray, int]:
    """Ids of the terms of all words of a lower-cased text: the words and their prefixes,
    with repeats; and the number of words."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, hashes = _letters()
    inside = np.zeros(len(codes) + 2, bool)
    np.take(letter, codes, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, size = edges[::2], edges[1::2] - edges[::2]
    out = []
    for at in range(0, len(starts), WORDS_AT_ONCE):
        start, n = starts[at:at + WORDS_AT_ONCE], np.minimum(size[at:at + WORDS_AT_ONCE], LONG)
        first = np.cumsum(n) - n
        place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        parts = hashes[codes[np.repeat(start, n) + place]] * _PLACES[place]
        whole = _mixed(np.add.reduceat(parts, first), 0)
        for i in np.flatnonzero(size[at:at + WORDS_AT_ONCE] > LONG).tolist():
            word = text[starts[at + i]:starts[at + i] + size[at + i]]
            whole[i] = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)
        out.append(whole)
        for k in PREFIXES:
            long = first[n >= k]
            out.append(_mixed(sum((parts[long + j] for j in range(1, k)), parts[long]), 1))
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), len(starts)


def terms_in(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(ids ascending, tf) of all terms of a whole text. A term found twice or more has
    further terms for the levels of its count and share."""
    ids, n_words = word_terms((text or "").lower())
    ids, tf = np.unique(ids, return_counts=True)
    often = tf >= 2
    base, n = ids[often], tf[often]
    level, which = np.nonzero(np.concatenate([n >= np.array(COUNTS)[:, None], n << np.array(SHARES)[:, None] >= n_words]))
    more = _mixed(base[which].view(np.uint64), _SALTS[level])
    tf = np.concatenate([tf, np.ones(len(more), np.int64)])
    ids = np.concatenate([ids, more])
    order = np.argsort(ids, kind="stable")
    return ids[order], tf[order]


# --- index -------------------------------------------------------------------

@dataclass
class Postings:
    """Sparse term x example weights, read by rows of terms: ``postings[terms]`` is dense.
    A term's postings fill rows of CHUNK, the last one with weights of 0."""

    shape: tuple[int, int]
    starts: np.ndarray  # term -> its first row
    packed: np.ndarray  # example, and its weight in the lower half

    def read(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of rows of each term; example and weight by row and place."""
        n = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(n)
        place = np.repeat(self.starts[terms] - ends + n, n)
        place += np.arange(len(place))
        found = self.packed[place]
        return n, found >> 32, found.view(np.float32)[:, ::2]

    def product(self, q: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """What the terms of weights ``q`` add to the product with each example."""
        n, who, weight = self.read(terms)
        return np.bincount(who.ravel(), (np.repeat(q, n)[:, None] * weight).ravel(), minlength=self.shape[1])

    def __getitem__(self, terms) -> np.ndarray:
        out = np.zeros((len(terms), self.shape[1]))
        n, who, weight = self.read(np.asarray(terms, np.int64))
        np.add.at(out, (np.repeat(np.arange(len(n)), n)[:, None], who), weight)
        return out


def _postings(shape: tuple[int, int], n: np.ndarray) -> Postings:
    """Empty lists for ``n`` postings of each term."""
    starts = np.zeros(shape[0] + 1, np.int64)
    np.cumsum(-(-n // CHUNK), out=starts[1:])
    return Postings(shape, starts, np.zeros((int(starts[-1]), CHUNK), np.int64))


@dataclass
class Blocks:
    """Dense weights of the terms that are frequent in a group of examples: for each group
    rows of its terms and an empty one, in one array."""

    shape: tuple[int, int, int]  # blocks, terms, examples of a block
    terms: list[np.ndarray]  # of each group, ascending
    row: np.ndarray  # group, term -> row of the group, the empty one if it has none
    first: np.ndarray  # group -> its first weight
    width: np.ndarray  # group -> examples
    weights: np.ndarray

    def group(self, g: int) -> np.ndarray:
        """The group's weights, term x example."""
        n, width = len(self.terms[g]), int(self.width[g])
        return self.weights[self.first[g]:self.first[g] + n * width].reshape(n, width)

    def of(self, who: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Weights of some examples, example x term."""
        groups, g = np.unique(who // GROUP, return_inverse=True)
        starts = self.row[groups][:, terms] * self.width[groups, None] + self.first[groups, None]
        return self.weights[starts[g] + (who % GROUP)[:, None]].astype(np.float64)


@dataclass
class Index:
    """Block-max inverted index of unit vectors over all terms of the examples."""

    ids: np.ndarray
    toxic: np.ndarray
    idf: np.ndarray  # with the term's marker weight
    weights: Postings
    dense: np.ndarray  # term -> its number in ``blocks``, -1: postings only
    blocks: Blocks
    most: np.ndarray  # term, block: the largest weight
    levels: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))  # calibration: vote, score

    def unit(self, terms: np.ndarray, tf: np.ndarray, rest: float = 0.0) -> np.ndarray:
        """The unit vector's weights; ``rest`` is the squared length of terms no example holds."""
        w = (1 + np.log(tf)) * self.idf[terms]
        return w / math.sqrt(float(w @ w) + rest) if len(w) else w

    def nearest(self, queries: list[tuple[np.ndarray, np.ndarray, int | None, float]], k: int) -> list[list[tuple[float, int]]]:
        """For each (terms, tf, but, rest) the k examples of the largest cosine above 0, as
        (cosine, number), ties to the smaller doc_id; the example with doc_id ``but`` takes no part."""
        if not len(self.ids):
            return [[] for _ in queries]
        rare = np.empty((len(queries), self.weights.shape[1]))  # what the posting lists add
        dense = np.zeros((len(queries), self.blocks.shape[1]), np.float32)
        parts = []
        for i, (terms, tf, _, rest) in enumerate(queries):
            q, at = self.unit(terms, tf, rest), self.dense[terms]
            many = at >= 0
            rare[i] = self.weights.product(q, terms)
            dense[i, at[many]] = q[many]
            parts.append((at[many], q[many]))
        by_block = rare.reshape(len(queries), -1, BLOCK)
        bound = dense @ self.most + by_block.max(axis=2) + SLACK
        found = np.full(by_block.shape, -1.0, np.float32)
        lead = np.argpartition(-bound, min(FIRST_BLOCKS, bound.shape[1]) - 1, axis=1)[:, :FIRST_BLOCKS]
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, lead, True, axis=1)
        self._read(first & (bound >= 2 * SLACK), dense, by_block, found, 1)
        least = np.zeros(len(queries))
        leading = np.take_along_axis(found, lead[:, :, None], axis=1).reshape(len(queries), -1)
        if leading.shape[1] > k:  # one more, for ``but``
            least = np.partition(leading, -k - 1, axis=1)[:, -k - 1] - SLACK
        # the blocks whose bound reaches what the first ones gave
        self._read(~first & (bound >= np.maximum(least, 2 * SLACK)[:, None]), dense, by_block, found, RUN)
        out = []
        for i, (_, _, but, _) in enumerate(queries):
            flat = found[i].reshape(-1)
            near = np.flatnonzero(flat >= max(least[i], 0.0))
            near = near[(flat[near] > 0) & (near < len(self.ids))]
            if len(near) > k + 1:
                near = near[flat[near] >= np.partition(flat[near], -k - 1)[-k - 1] - SLACK]
            at, q = parts[i]
            exact = np.round(rare[i, near] + self.blocks.of(near, at) @ q, 12)
            good = (exact > 0) & (self.ids[near] != but if but is not None else True)
            near, exact = near[good], exact[good]
            by = np.lexsort((self.ids[near], -exact))[:k]
            out.append([(float(exact[j]), int(near[j])) for j in by])
        return out

    def _read(self, wanted: np.ndarray, dense: np.ndarray, by_block: np.ndarray, found: np.ndarray, run: int) -> None:
        """Put the cosines of the wanted (query, block) into ``found``, by runs of blocks."""
        for g, terms in enumerate(self.blocks.terms):
            at = g * (GROUP // BLOCK)
            here = wanted[:, at:at + GROUP // BLOCK]
            rows = np.flatnonzero(here.any(axis=1))
            if not len(rows):
                continue
            here, mine, weights = here[rows], dense[rows[:, None], terms], self.blocks.group(g)
            for b in range(0, here.shape[1], run):
                some = np.flatnonzero(here[:, b:b + run].any(axis=1))
                if len(some):
                    product = (mine if len(some) == len(rows) else mine[some]) @ weights[:, b * BLOCK:(b + run) * BLOCK]
                    there = slice(at + b, at + min(b + run, here.shape[1]))
                    found[rows[some], there] = by_block[rows[some], there] + product.reshape(len(some), there.stop - there.start, BLOCK)

    def score(self, vote: float) -> float:
        if not len(self.levels):
            return 0.0
        return float(np.interp(vote, self.levels[:, 0], self.levels[:, 1]))


def _alike(x: np.ndarray, rounds: int = 5) -> np.ndarray:
    """Cluster number of unit vectors (rows), by cosine k-means from evenly spaced rows."""
    centres = x[np.linspace(0, len(x) - 1, min(CLUSTERS, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = np.argmax(x @ centres.T, axis=1)
        for c in range(len(centres)):
            members = x[own == c]
            if len(members):
                mean = members.sum(axis=0)
                centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-9)
    return own


def build(rows: list[tuple[int, int, list[int], list[int]]], idf: np.ndarray) -> Index:
    """Index of (doc_id, toxic, terms, tf) rows."""
    n, n_terms = -(-len(rows) // BLOCK) * BLOCK, len(idf)
    ids, toxic = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int8)
    if not rows or not n_terms:
        none, zero = np.zeros(0, np.float32), np.zeros(0, np.int64)
        return Index(ids, toxic, idf, _postings((n_terms, n), np.zeros(n_terms, np.int64)), np.full(n_terms, -1, np.int32),
                     Blocks((n // BLOCK, 0, BLOCK), [], np.zeros((0, 0), np.int32), zero, zero, none),
                     np.zeros((0, n // BLOCK), np.float32))
    df = np.zeros(n_terms, np.int64)
    for _, _, t, _ in rows:
        df[t] += 1
    widest = np.argsort(-df, kind="stable")[:CLUSTER_TERMS]
    column = np.full(n_terms, -1, np.int32)
    column[widest] = np.arange(len(widest))
    x = np.zeros((len(rows), len(widest)), np.float32)
    unit = Index(ids, toxic, idf, None, None, None, None).unit
    for i, (_, _, t, tf) in enumerate(rows):
        at = column[t]
        x[i, at[at >= 0]] = unit(np.asarray(t, np.int64), np.asarray(tf, float))[at >= 0]
    by = np.lexsort((ids, _alike(x)))
    del x, column
    # the frequent terms of each group, then a group at a time its dense rows and postings
    groups = [by[start:start + GROUP].tolist() for start in range(0, n, GROUP)]
    held = []
    for group in groups:
        own = np.bincount(np.concatenate([np.asarray(rows[i][2], np.int32) for i in group]), minlength=n_terms)
        held.append(np.flatnonzero(own >= FREQUENT))
        df[held[-1]] -= own[held[-1]]
    frequent = np.unique(np.concatenate(held))
    dense = np.full(n_terms, -1, np.int32)
    dense[frequent] = np.arange(len(frequent))
    own = [dense[h].astype(np.int64) for h in held]
    width = np.minimum(GROUP, n - GROUP * np.arange(len(groups)))
    ends = np.cumsum([(len(h) + 1) * w for h, w in zip(held, width.tolist(), strict=True)])
    blocks = Blocks((n // BLOCK, len(frequent), BLOCK), own, np.empty((len(groups), len(frequent)), np.int32),
                    np.append(0, ends[:-1]), width, np.zeros(ends[-1], np.float32))
    most, postings = np.zeros((len(frequent), n // BLOCK), np.float32), _postings((n_terms, n), df)
    free, packed = postings.starts[:-1] * CHUNK, postings.packed.view(np.int32).reshape(-1, 2)
    for g, (group, places) in enumerate(zip(groups, own, strict=True)):
        terms = np.concatenate([np.asarray(rows[i][2], np.int32) for i in group])
        weight = np.concatenate([unit(np.asarray(rows[i][2], np.int64), np.asarray(rows[i][3], float)).astype(np.float32) for i in group])
        who = np.repeat(np.arange(len(group)), [len(rows[i][2]) for i in group])
        blocks.row[g] = len(places)
        blocks.row[g, places] = np.arange(len(places))
        many = np.zeros(n_terms, bool)
        many[held[g]] = True
        many = many[terms]
        of_group = blocks.group(g)
        of_group[blocks.row[g, dense[terms[many]]], who[many]] = weight[many]
        at = g * (GROUP // BLOCK)
        n_blocks = of_group.shape[1] // BLOCK
        most[places, at:at + n_blocks] = of_group.reshape(len(places), n_blocks, BLOCK).max(axis=2)
        rest = np.flatnonzero(~many)
        rest = rest[np.argsort(terms[rest], kind="stable")]
        mine, start, count = np.unique(terms[rest], return_index=True, return_counts=True)
        at = np.repeat(free[mine] - start, count) + np.arange(len(rest))
        free[mine] += count
        packed[at, 0], packed[at, 1] = weight[rest].view(np.int32), who[rest] + g * GROUP
    return Index(ids[by], toxic[by], idf, postings, dense, blocks, most)


def votes_of(index: Index, queries: list[tuple]) -> list[tuple[float, int | None, float | None]]:
    """Vote of the nearest examples of each query, and doc_id and cosine of the nearest."""
    out = []
    for at in range(0, len(queries), QUERIES):
        for near in index.nearest(queries[at:at + QUERIES], NEIGHBOURS):
            total = sum(c for c, _ in near)
            vote = sum(c * int(index.toxic[i]) for c, i in near) / total if near else 0.0
            out.append((vote, int(index.ids[near[0][1]]) if near else None, near[0][0] if near else None))
    return out


def calibration(votes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Isotonic levels (vote, share of toxic examples, one good and one bad pseudo-example
    for each level), ascending in both."""
    levels: list[list[float]] = []  # vote, toxic, examples
    for v in np.unique(np.round(votes, 3)):
        at = np.round(votes, 3) == v
        levels.append([float(v) * at.sum(), float(toxic[at].sum()), float(at.sum())])
        while len(levels) > 1 and levels[-2][1] / levels[-2][2] >= levels[-1][1] / levels[-1][2]:
            last = levels.pop()
            levels[-1] = [a + b for a, b in zip(levels[-1], last, strict=True)]
    return np.array([[v / n, (t + 1) / (n + 2)] for v, t, n in levels])


# --- Spark jobs --------------------------------------------------------------

def examples(labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, toxic) of the bounded sample of labelled rows."""
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id"), 3, 1))
    rows = rows.groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)


def _held(ids: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``ids`` (ascending) of each of ``mine``, and whether it stands there."""
    at = np.searchsorted(ids, mine)
    held = at < len(ids)
    held[held] = ids[at[held]] == mine[held]
    return at, held


def example_terms(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids ascending, examples, toxic examples) of all terms of the (toxic, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLAB):
                part = batch.slice(at, SLAB)
                found = [terms_in(text)[0] for text in part.column(1).to_pylist()]
                ids, place = np.unique(np.concatenate(found), return_inverse=True)
                bad = np.repeat(np.array(part.column(0).to_pylist(), float), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.bincount(place, minlength=len(ids)), pa.int64()),
                     pa.array(np.bincount(place, bad, minlength=len(ids)).astype(np.int64))], names=["id", "n", "bad"])

    counts = texts.select("toxic", "text").mapInArrow(run, "id bigint, n bigint, bad bigint")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).toArrow()  # a row per term of the sample
    ids, n, bad = (counts.column(c).to_numpy() for c in ("id", "n", "bad"))
    order = np.argsort(ids)
    return ids[order], n[order], bad[order]


@dataclass
class Block:
    """Example vectors in little space, as they are sent."""

    ids: list[int]
    toxic: list[int]
    sizes: np.ndarray
    terms: bytes  # of each example: the first, then differences
    tf: bytes
    built: Index | None = None  # of all blocks, kept by the worker with the first one

    def rows(self) -> list[tuple]:
        steps, tf = (np.frombuffer(zlib.decompress(x), np.int32) for x in (self.terms, self.tf))
        ends, total = np.cumsum(self.sizes), np.append(0, np.cumsum(steps, dtype=np.int64))
        terms = (total[1:] - np.repeat(total[ends - self.sizes], self.sizes)).astype(np.int32)
        return list(zip(self.ids, self.toxic, np.split(terms, ends[:-1]), np.split(tf, ends[:-1]), strict=True))


def _index(blocks: list[Broadcast], idf: Broadcast) -> Index:
    """One index of all blocks, built once a worker."""
    if not blocks:
        return build([], idf.value)
    first = blocks[0].value
    if first.built is None:
        first.built = build([r for b in blocks for r in b.value.rows()], idf.value)
    return first.built


def _blocks(texts: DataFrame, known_ids: Broadcast, n_blocks: int) -> Iterator[Block]:
    """The example texts' vectors, about EXAMPLES_AT_ONCE at a time, so that the driver
    never holds all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLAB):
                part = batch.slice(at, SLAB)
                found = [terms_in(text) for text in part.column(2).to_pylist()]
                terms = pa.array([np.diff(_held(known_ids.value, ids)[0], prepend=0) for ids, _ in found], pa.list_(pa.int32()))
                tf = pa.array([tf for _, tf in found], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), terms, tf], names=["doc_id", "toxic", "terms", "tf"])

    for block in range(n_blocks):
        mine = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)) == block).select("doc_id", "toxic", "text")
        own = mine.mapInArrow(run, "doc_id bigint, toxic int, terms array<int>, tf array<int>").toArrow()
        if len(own):
            terms, tf = (own.column(c).combine_chunks() for c in ("terms", "tf"))
            yield Block(own.column("doc_id").to_pylist(), own.column("toxic").to_pylist(), terms.value_lengths().to_numpy(),
                        zlib.compress(terms.flatten().to_numpy(), 1), zlib.compress(tf.flatten().to_numpy(), 1))


def marker_weights(n: np.ndarray, bad: np.ndarray, total: int, total_bad: int) -> np.ndarray:
    """Weight of each term, held by ``n`` examples of which ``bad`` are toxic: 1, and for
    terms toxic too often to be chance more, by the information they give."""
    out = np.ones(len(n))
    if not total_bad or total_bad == total or not len(n):
        return out
    rate, share = total_bad / total, bad / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = share * np.log(share / rate) + np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0.0)
    marks = (share > rate) & (n * kl >= math.log(max(1, len(n)) / CHANCE_TERMS))
    out[marks] += MARKED * kl[marks] ** 2
    return out


def vectors(docs: DataFrame, known_ids: Broadcast) -> DataFrame:
    """(doc_id, content, vector, rest): hash of the text, its known terms and frequencies packed,
    and the sum of (1 + ln tf)^2 over the terms no example holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SLAB):
                batch = whole.slice(at, SLAB)
                content, packed, rest = [], [], []
                for text in batch.column(1).to_pylist():
                    mine, tf = terms_in(text)
                    place, held = _held(known_ids.value, mine)
                    content.append(blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest())
                    packed.append(pack(np.diff(place[held], prepend=0), tf[held]))
                    rest.append(float(((1 + np.log(tf[~held])) ** 2).sum()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary()), pa.array(packed, pa.binary()),
                                                  pa.array(rest, pa.float64())], names=["doc_id", "content", "vector", "rest"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, content binary, vector binary, rest double")


def unpacked(vector: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, tf = unpack(vector)
    return np.cumsum(steps, dtype=np.int64), tf.astype(np.int64)


def document_counts(rows: DataFrame, n_terms: int) -> tuple[int, np.ndarray]:
    """Number of all documents, and of those that hold each of the known terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            df[-1] += len(batch)
            for vector in batch.column(0).to_pylist():
                df[unpacked(vector)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["t", "n"])

    counts = rows.select("vector").mapInArrow(run, "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n")).toArrow()  # a row per term
    df = np.zeros(n_terms + 1, np.int64)
    df[counts.column("t").to_numpy()] = counts.column("n").to_numpy()
    return int(df[-1]), df[:-1]


def _voted(rows: DataFrame, blocks: list[Broadcast], idf: Broadcast, levels: np.ndarray, unknown: float) -> DataFrame:
    """Vectors with vote, score, nearest, cosine; an example doesn't vote on itself.
    ``unknown`` is the idf of terms no example holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = replace(_index(blocks, idf), levels=levels)  # bounded by the MAX_EXAMPLES texts
        own = set(index.ids.tolist())
        known: dict[tuple, tuple] = {}
        for whole in batches:
            for start in range(0, len(whole), QUERIES):
                batch = whole.slice(start, QUERIES)
                keys, asked = [], {}
                if len(known) >= CACHE_VECTORS:
                    known.clear()
                for doc, content, vector, rest in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    key = (content, doc if doc in own else None)
                    keys.append(key)
                    if key not in known and key not in asked:
                        terms, tf = unpacked(vector)
                        asked[key] = (terms, tf.astype(float), key[1], rest * unknown ** 2)
                for key, (vote, nearest, cosine) in zip(asked, votes_of(index, list(asked.values())), strict=True):
                    known[key] = (vote, index.score(vote), nearest, cosine)
                vote, score, nearest, cosine = zip(*(known[key] for key in keys), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(vote, pa.float64()), pa.array(score, pa.float64()), pa.array(nearest, pa.int64()),
                     pa.array(cosine, pa.float64())], names=["doc_id", "vote", "score", "nearest", "cosine"])

    return rows.mapInArrow(run, "doc_id bigint, vote double, score double, nearest bigint, cosine double")


def score(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and as evidence the
    nearest example and its cosine."""
    ship(docs.sparkSession)
    sample = stored(examples(labels, max_examples), "examples")  # at most max_examples rows, so it may be broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    texts = stored(texts.select(F.col("doc_id").cast("bigint"), "toxic", "text"), "example-texts")
    total, total_bad = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = docs.sparkSession.sparkContext.broadcast
    ids, n, bad = example_terms(texts)
    known_ids = share(ids)
    rows = stored(vectors(docs, known_ids), "vectors")
    n_docs, df = document_counts(rows, len(ids)) if total else (0, np.zeros(0))
    idf = (np.log((n_docs + 1) / (df + 1)) + 1) * marker_weights(n, bad, total, total_bad)
    unknown = math.log(n_docs + 1) + 1
    blocks, labelled = [], {}
    for block in _blocks(texts, known_ids, -(-total // EXAMPLES_AT_ONCE)):
        labelled.update(zip(block.ids, block.toxic, strict=True))
        blocks.append(share(block))
    shared_idf, levels = share(idf), np.zeros((0, 2))
    if labelled:
        own = _voted(vectors(texts, known_ids), blocks, shared_idf, levels, unknown)
        votes = {r["doc_id"]: r["vote"] for r in own.select("doc_id", "vote").collect()}  # at most MAX_EXAMPLES rows
        levels = calibration(np.array([votes[i] for i in labelled]), np.array(list(labelled.values())))
    out = _voted(rows, blocks, shared_idf, levels, unknown)
    return out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                      (F.col("score") >= TOXIC).cast("int").alias("predicted"), "nearest", "cosine")
