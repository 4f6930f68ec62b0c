"""Stupid-backoff scores of documents under a bigram model of all other documents.

A document is scored with its own counts taken out of the corpus counts (primed):
a word w after v costs ln(c'(v w) / c'(v)) if another document has the pair, else
ln(0.4 c'(w) / N'), and ln(0.4^2 / N') if no other document has the word. Texts start
with a start symbol and end with an end symbol, which is scored too.

The work is three joins of exploded n-grams with count tables, partitioned by
hash. Rows are packed: all pairs that a batch of documents sends to one partition
are one compressed row, so that a pair costs a few bytes in the shuffle.

1. Word counts over the corpus. The words above 1 / ``HOT_WORDS`` of all words (so at
   most that many) are known to every task, and packed rows name them by their number:
   the more partitions, the fewer pairs share a row and its list of 8-byte hashes.
2. Pairs go to the partition of their second word, where the counts of the pair and of
   the second word are complete; pairs of a hot second word are spread by the whole pair.
   Pairs without another document back off there. The others are divided by the count of
   their first word, if that is hot; else they go on.
3. What goes on joins the word counts in the partition of the first word.
4. Partial sums (single precision) meet per batch of documents.

Words are compared by 64-bit hashes. Defined results: NULL, empty and blank texts
have no words, log_score 0 and a NULL mean; they count nowhere. Repeated rows are
documents of their own (and see each other). Alone in the corpus a document has
N' = 1. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import ship, stored
from .minhash import WordHashes, mixed

BACKOFF = 0.4
HOT_WORDS = 1 << 16
BATCH_TOKENS = 3 << 19
PART_TOKENS = 3 << 18  # pairs in a partition, about
START, END = np.uint64(1), np.uint64(2)
LEAST_HASH = np.uint64(HOT_WORDS + 2)  # of a word: above the numbers of hot words, START and END
_C = np.uint64(0x9E3779B97F4A7C15)

PAIRS, DOCS, OPEN, SUMS = range(4)
_ROW = "kind int, part int, batch string, blob binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays in their smallest unsigned types (floats as they are), byte by byte, compressed."""
    head, body = [len(arrays)], []
    for a in arrays:
        if a.dtype.kind != "f":
            a = a.astype(np.min_scalar_type(int(a.max())) if len(a) else np.uint8)
        head += [len(a), a.dtype.itemsize, a.dtype.kind == "f"]
        body.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.compress(np.array(head, np.int64).tobytes() + b"".join(body), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 3 * n)[1:].reshape(n, 3)
    out, at = [], 8 * (1 + 3 * n)
    for count, size, real in head.tolist():
        planes = np.frombuffer(raw, np.uint8, count * size, at).reshape(size, count)
        out.append(np.ascontiguousarray(planes.T).view(np.dtype(f"{'f' if real else 'u'}{size}")).reshape(count))
        at += count * size
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of ascending hashes; ``np.cumsum`` gives the hashes back."""
    return np.diff(ascending, prepend=np.uint64(0))


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Partition of a hash; increases with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _hashed(text: bytes | None, hashes: WordHashes) -> np.ndarray:
    words = text.split() if text else []
    h = mixed(np.fromiter((hashes[w] for w in words), np.uint64, len(words)))
    return np.maximum(h, LEAST_HASH)


def numbered(words: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with the hot ones (``hot`` ascending) replaced by their numbers, and which are hot."""
    slot = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    known = hot[slot] == words
    return np.where(known, slot.astype(np.uint64), words), known


def named(numbers: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The words back from :func:`numbered`."""
    known = numbers < np.uint64(len(hot))
    return np.where(known, hot[np.where(known, numbers, 0).astype(np.int64)], numbers)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): word hash as bigint and its count, the end symbol included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0

        def flush():
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for batch in batches:
            for text in batch.column(0).cast(pa.large_binary()).to_pylist():
                h = _hashed(text, hashes)
                if len(h):
                    held += [h, np.array([END])]
                    size += len(h) + 1
                if size >= 2 * BATCH_TOKENS:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _exploded(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """Packed rows: the pairs of a batch of documents by partition, and the batch's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, done = WordHashes(), 0
        task = TaskContext.get().partitionId()
        ids: list[int | None] = []
        texts: list[np.ndarray] = []
        size = 0

        def flush():
            name = f"{task}-{done}"
            lens = np.array([len(t) for t in texts], np.int64)
            known = np.array([i is not None for i in ids])
            number = np.array([i or 0 for i in ids], np.int64).view(np.uint64)
            rows = [(DOCS, hash_part(name, parts), name, pack(number, known.astype(np.uint8), lens))]
            full = [t for t in texts if len(t)]
            if full:
                doc = np.repeat(np.flatnonzero(lens), lens[lens > 0] + 1)
                second = np.concatenate([x for t in full for x in (t, np.array([END]))])
                first = np.empty_like(second)
                first[1:] = second[:-1]
                begins = np.concatenate([[0], np.cumsum(lens[lens > 0] + 1)[:-1]])
                first[begins] = START
                # own count of every word in its document
                by = np.lexsort((second, doc))
                new = np.ones(len(by), bool)
                new[1:] = (second[by][1:] != second[by][:-1]) | (doc[by][1:] != doc[by][:-1])
                runs = np.diff(np.append(np.flatnonzero(new), len(by)))
                own = np.empty(len(by), np.int64)
                own[by] = np.repeat(runs, runs)
                own1 = np.empty_like(own)
                own1[1:] = own[:-1]
                own1[begins] = 1
                second_no, spread = numbered(second, hot)
                part = part_of(np.where(spread, mixed(first * _C + second), second), parts)
                first, second = numbered(first, hot)[0], second_no
                by = np.lexsort((second, part))
                edges = np.flatnonzero(np.diff(part[by], prepend=-1))
                for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by)], strict=True):
                    at = by[a:b]
                    w2, n2 = np.unique(second[at], return_counts=True)
                    w1, at1 = np.unique(first[at], return_inverse=True)
                    rows.append((PAIRS, int(part[at[0]]), name, pack(steps(w2), n2, steps(w1), at1, doc[at], own1[at], own[at])))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.string(), pa.binary()), strict=True)], names=["kind", "part", "batch", "blob"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                ids.append(doc_id)
                texts.append(_hashed(text, hashes))
                size += len(texts[-1]) + 1
                if size >= BATCH_TOKENS:
                    yield flush()
                    ids, texts, size, done = [], [], 0, done + 1
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _ROW)


def hash_part(name: str, parts: int) -> int:
    return int(part_of(mixed(np.array([hash_text(name)], np.uint64)), parts)[0])


def hash_text(name: str) -> int:
    return int.from_bytes(name.encode()[-8:], "little")


def _by_document(batch: np.ndarray, doc: np.ndarray, value: np.ndarray, misses: np.ndarray, names: list[str]) -> list[tuple]:
    """SUMS rows: per batch its documents' partial sums."""
    out = []
    by = np.lexsort((doc, batch))
    b, d = batch[by], doc[by]
    new = np.ones(len(by), bool)
    new[1:] = (b[1:] != b[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return out
    v, m = np.add.reduceat(value[by], at), np.add.reduceat(misses[by], at)
    b, d = b[at], d[at]
    edges = np.flatnonzero(np.diff(b, prepend=-1))
    for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(b)], strict=True):
        out.append((SUMS, -1, names[int(b[lo])], pack(d[lo:hi], v[lo:hi].astype(np.float32), m[lo:hi])))
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "part", "batch", "blob"])


def _paired(packed: DataFrame, parts: int, hot: np.ndarray, hot_n: np.ndarray) -> DataFrame:
    """Join of the pairs with their counts: SUMS, OPEN pairs that want their first
    word's count, and DOCS as they came."""

    def counts_of(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts with those of hot words put in, and which are hot."""
        slot = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
        known = hot[slot] == words
        return np.where(known, hot_n[slot], n), known

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = list(rows[rows["kind"] == DOCS].itertuples(index=False, name=None))
        rows = rows[rows["kind"] == PAIRS]
        if rows.empty:
            return _frame(out)
        names = rows["batch"].tolist()
        cols = [[] for _ in range(5)]
        for i, blob in enumerate(rows["blob"]):
            w2, n2, w1, at1, doc, own1, own2 = unpack(blob)
            for c, a in zip(cols, (named(np.cumsum(w1, dtype=np.uint64), hot)[at1], np.repeat(named(np.cumsum(w2, dtype=np.uint64), hot), n2),
                                   np.int64(i) << 32 | doc.astype(np.int64), own1.astype(np.int32), own2.astype(np.int32)), strict=True):
                c.append(a)
        second, first, place, own1, own2 = (np.concatenate(cols.pop(k)) for k in (1, 0, 0, 0, 0))
        pair = mixed(first * _C + second)
        by = np.lexsort((place, pair))
        p, d = pair[by], place[by]
        new_pair = np.ones(len(by), bool)
        new_pair[1:] = p[1:] != p[:-1]
        new = new_pair.copy()
        new[1:] |= d[1:] != d[:-1]
        at = np.flatnonzero(new)
        own = np.diff(np.append(at, len(by)))
        total = np.diff(np.append(np.flatnonzero(new_pair), len(by)))
        others = total[np.cumsum(new_pair)[at] - 1] - own
        row = by[at]
        del pair, p, d, by, new, new_pair, at
        words, index, n = np.unique(second, return_inverse=True, return_counts=True)
        second_n = counts_of(words, n)[0][index[row]]
        first_n, ready = counts_of(first[row], np.zeros(len(row), np.int64))
        hit = others > 0
        rest = second_n - own2[row]
        value = own * np.where(hit, np.log(np.maximum(others, 1)),
                               np.where(rest > 0, np.log(np.maximum(rest, 1)), np.log(BACKOFF)))
        value -= np.where(hit & ready, own * np.log(np.maximum(first_n - own1[row], 1)), 0)
        doc, batch = place & 0xFFFFFFFF, place >> 32
        out += _by_document(batch[row], doc[row], value, np.where(hit, 0, own), names)
        wait = hit & ~ready
        m, count = row[wait], own[wait]
        dest = part_of(first[m], parts)
        by = np.lexsort((first[m], dest))
        if not len(by):
            return _frame(out)
        edges = np.flatnonzero(np.diff(dest[by], prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(by)], strict=True):
            r = m[by[a:b]]
            w1, n1 = np.unique(first[r], return_counts=True)
            held, at = np.unique(batch[r], return_inverse=True)
            out.append((OPEN, int(dest[by[a]]), "\n".join(names[k] for k in held.tolist()),
                        pack(steps(w1), n1, at, doc[r], own1[r], count[by[a:b]])))
        return _frame(out)

    return packed.groupBy("part").applyInPandas(run, _ROW)


def _divided(waiting: DataFrame, counts: DataFrame, parts: int) -> DataFrame:
    """Join of the OPEN pairs with the counts of their first words: SUMS."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(part_of(words, parts).astype(np.int32)), *batch.columns], names=["part", "word", "n"])

    def run(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        words, n = known["word"].to_numpy().view(np.uint64), known["n"].to_numpy()
        by = np.argsort(words)
        words, n = words[by], n[by]
        if rows.empty:
            return _frame([])
        # one SUMS row per batch for all pairs of the partition, whichever partition they came from
        number: dict[str, int] = {}
        cols = [[] for _ in range(3)]
        for names, blob in zip(rows["batch"], rows["blob"], strict=True):
            w1, n1, at, doc, own, count = unpack(blob)
            others = np.repeat(n[np.searchsorted(words, np.cumsum(w1, dtype=np.uint64))], n1) - own.astype(np.int64)
            local = np.array([number.setdefault(x, len(number)) for x in names.split("\n")], np.int32)
            for c, a in zip(cols, (local[at], doc.astype(np.int32), (-np.log(others) * count).astype(np.float32)), strict=True):
                c.append(a)
        batch, doc, value = (np.concatenate(c) for c in cols)
        return _frame(_by_document(batch, doc, value.astype(np.float64), np.zeros(len(doc), np.int64), list(number)))

    table = counts.mapInArrow(placed, "part int, word bigint, n bigint")
    return waiting.groupBy("part").cogroup(table.groupBy("part")).applyInPandas(run, _ROW)


def score(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, log_score (natural logarithm, the end
    symbol included), mean_log_score (per scored symbol)."""
    spark = docs.sparkSession
    ship(spark)
    counts = stored(word_counts(docs), "word-counts")
    total, n_docs = counts.agg(F.sum("n"), F.max(F.when(F.col("word") == int(END), F.col("n")))).first()
    total, n_docs = total or 0, n_docs or 0
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_TOKENS))
    frequent = counts.filter(F.col("n") * HOT_WORDS >= total).collect() if total else []  # at most HOT_WORDS rows
    table = {int(START): n_docs, int(END): n_docs} | {r["word"] & ((1 << 64) - 1): r["n"] for r in frequent}
    hot = np.array(sorted(table), np.uint64)
    hot_n = np.array([table[int(w)] for w in hot], np.int64)
    paired = stored(_paired(_exploded(docs, parts, hot), parts, hot, hot_n), "lm-pairs")
    divided = _divided(paired.filter(F.col("kind") == OPEN), counts, parts)
    sums = paired.filter(F.col("kind").isin(DOCS, SUMS)).union(divided)

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        number, known, lens = unpack(rows.loc[rows["kind"] == DOCS, "blob"].iloc[0])
        value, missed = np.zeros(len(lens)), np.zeros(len(lens))
        lens = lens.astype(np.int64)
        for blob in rows.loc[rows["kind"] == SUMS, "blob"]:
            d, v, m = unpack(blob)
            value[d] += v
            missed[d] += m
        rest = np.maximum(total - lens - 1, 1)
        value += missed * (np.log(BACKOFF) - np.log(rest))
        value[lens == 0] = 0
        ids = pd.array(number.astype(np.uint64).view(np.int64), dtype="Int64")
        ids[known == 0] = pd.NA
        mean = [v / (n + 1) if n else None for v, n in zip(value.tolist(), lens.tolist(), strict=True)]
        return pd.DataFrame({"doc_id": ids, "n_words": lens, "log_score": value, "mean_log_score": mean})

    return sums.groupBy("batch").applyInPandas(finish, "doc_id bigint, n_words bigint, log_score double, mean_log_score double")
