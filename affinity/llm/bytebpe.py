"""Byte-level BPE encoding and decoding by DuckDB recursive queries inside each partition.

A task splits its texts by the tokenizer's pattern and gives the distinct pieces it has
not met yet to an in-process DuckDB as rows (piece, position, token), one per byte. A
recursive query joins neighbouring tokens to the merge table and contracts, in every
round, each piece's minimum-rank pair from the left; pieces without a known pair leave.
Ordered aggregation of the last rows' token bytes decodes the pieces, which are then cut
apart by their tokens' lengths. A text's ids and bytes are those of its pieces in order.

One round contracts all places of the minimum-rank pair that do not overlap, counted from
the left. That equals one place a round where a contraction never opens a pair of lower
rank, which :func:`merges_in_order` proves for a rank file: every token's own bytes must
merge into it by rising ranks. (A lower pair p·m opening beside m = b·c would be a token
whose own bytes merge through the higher-ranked m.) For other files a round contracts the
leftmost place alone, and a piece that is a token is taken as it is, as tiktoken has it.

The library splits by the Unicode tables of its own regular expressions. Characters that
Python's ``regex`` sorts otherwise (newer letters, for example) are found by asking both,
and stand as a plain character of the library's class while a text is split.

Nothing is shuffled: pieces repeat inside a partition, and only what a task has met (at
most KNOWN pieces, then it starts afresh) is kept. A long text passes in parts.

Defined results: NULL text is the empty text (no ids, SHA-256 of nothing); NULL doc_id
stays; repeated rows each get a row; strings of special tokens are ordinary text; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

PART = 1 << 19  # pieces handled at once
ROUND_BYTES = 1 << 20  # bytes of new pieces that one recursive query contracts (a longer piece alone)
KNOWN = 1_000_000  # pieces a task remembers

_ENCODE = """
WITH RECURSIVE s AS (
  SELECT 0 AS step, w, g, tok FROM start
  UNION ALL (
    WITH p AS MATERIALIZED (
      SELECT step, w, g, tok, lead(w) OVER o AS w2, lead(tok) OVER o AS tok2, row_number() OVER o AS n
      FROM s WINDOW o AS (ORDER BY g)),
    pair AS MATERIALIZED (SELECT w, n, m.r FROM p JOIN merges m ON m.a = p.tok AND m.b = p.tok2 WHERE w2 = w),
    best AS MATERIALIZED (SELECT w, min(r) AS r FROM pair GROUP BY w),
    place AS MATERIALIZED ({place})
    SELECT step + 1, p.w, p.g, coalesce(x.r, p.tok)
    FROM p JOIN best USING (w) LEFT JOIN place x ON x.n = p.n LEFT JOIN place y ON y.n = p.n - 1
    WHERE y.n IS NULL))
SELECT w, g, tok FROM s JOIN (SELECT w, max(step) AS step FROM s GROUP BY w) USING (w, step)
"""
_JOIN = "SELECT string_agg(v.hex, '' ORDER BY g) FROM contracted JOIN vocab v ON v.id = tok"
# every second place of a run of overlapping ones, from the left
_ALL = """
      WITH q AS MATERIALIZED (SELECT w, n, r, n - row_number() OVER (ORDER BY n) AS run FROM pair JOIN best USING (w, r))
      SELECT n, r FROM q JOIN (SELECT run, min(n) AS first FROM q GROUP BY run) USING (run) WHERE (n - first) % 2 = 0"""
_ONE = "SELECT min(n) AS n, r FROM pair JOIN best USING (w, r) GROUP BY w, r"
_DECODE = "SELECT w, string_agg(v.hex, '' ORDER BY pos) AS hex FROM coded JOIN vocab v USING (id) GROUP BY w"


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks of a rank file (base64 token, space, rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merges_in_order(ranks: dict[bytes, int]) -> bool:
    """Do every token's own bytes merge into it by rising ranks?"""
    for token in ranks:
        parts, last = [token[i:i + 1] for i in range(len(token))], -1
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 40 or rank < last:
                return False
            last = rank
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return True


@lru_cache(maxsize=1)
def class_repairs() -> dict[int, str]:
    """Characters whose class (letter, number, space) tiktoken and ``regex`` see differently,
    and a stand-in of tiktoken's class."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    ranks = {bytes([b]): b for b in range(256)}
    seen = {}
    for name, stand_in in ((r"\p{L}", "x"), (r"\p{N}", "0"), (r"\s", " ")):
        asked = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        theirs = set()
        for at in range(0, len(every), 4096):
            theirs.update(bytes(asked.encode_ordinary("".join(every[at:at + 4096]))).decode())
        ours = set(regex.findall(name, "".join(every)))
        seen |= {ord(c): "\ufffc" for c in ours - theirs if ord(c) not in seen} | {ord(c): stand_in for c in theirs - ours}
    return seen


class Codec:
    """DuckDB tables of one rank file and the pieces met so far."""

    def __init__(self, path: str, pattern: str, in_order: bool):
        ranks = ranks_of(path)
        self.pattern, self.in_order, self.ranks = regex.compile(pattern), in_order, ranks
        self.repairs = class_repairs()
        self.odd = frozenset(map(chr, self.repairs))
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        merges = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks]
        a, b, r = (np.array(x, np.int32) for x in zip(*merges)) if merges else (np.empty(0, np.int32),) * 3
        self._table("merges", {"a": a, "b": b, "r": r})
        self._table("vocab", {"id": np.array(list(ranks.values()), np.int32), "hex": [t.hex() for t in ranks]})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        self.lengths[list(ranks.values())] = [len(t) for t in ranks]
        self._forget()

    def split(self, text: str) -> Iterator[str]:
        """The pattern's matches as the library finds them."""
        if text.isascii() or self.odd.isdisjoint(text):
            return iter(self.pattern.findall(text)) if len(text) <= PART else (m.group() for m in self.pattern.finditer(text))
        return (text[m.start():m.end()] for m in self.pattern.finditer(text.translate(self.repairs)))

    def _table(self, name: str, columns: dict) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.sizes, self.decoded = np.empty(0, np.uint32), np.empty(0, np.int64), []

    def _contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Ids of all pieces by the recursive query, their number and decoded bytes by piece."""
        whole = [] if self.in_order else [self.ranks.get(p) for p in pieces]
        if self.in_order:
            raw = np.frombuffer(b"".join(pieces), np.uint8)
            w, tok = np.repeat(np.arange(len(pieces), dtype=np.int32), [len(p) for p in pieces]), self.bytes[raw]
        else:
            rows = [(i, r) for i, (p, known) in enumerate(zip(pieces, whole, strict=True))
                    for r in ([known] if known is not None else self.bytes[np.frombuffer(p, np.uint8)].tolist())]
            w, tok = (np.array(x, np.int32) for x in zip(*rows))
        self._table("start", {"w": w, "g": np.arange(len(w), dtype=np.int32), "tok": tok})
        self.con.execute("CREATE OR REPLACE TABLE contracted AS " + _ENCODE.format(place=_ALL if self.in_order else _ONE))
        last = self.con.execute("SELECT w, tok FROM contracted ORDER BY g").fetchnumpy()
        decoded = bytes.fromhex(self.con.execute(_JOIN).fetchall()[0][0])
        w, ids = np.asarray(last["w"]), np.asarray(last["tok"])
        ends = np.cumsum(np.bincount(w, self.lengths[ids], len(pieces)).astype(np.int64)).tolist()
        return ids.astype(np.uint32), np.bincount(w, minlength=len(pieces)), [decoded[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces not met yet, ROUND_BYTES at a time."""
        batch, size = [], 0
        new = [p for p in pieces if p not in self.known]
        for i, piece in enumerate(new):
            batch.append(piece.encode())
            size += len(batch[-1])
            if size >= ROUND_BYTES or i + 1 == len(new):
                ids, sizes, decoded = self._contract(batch)
                self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
                self.decoded += decoded
                batch, size = [], 0
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))

    def encode(self, parts: list[list[str]]) -> list[tuple[np.ndarray, bytes]]:
        """(ids, decoded bytes) of lists of pieces."""
        flat = [p for part in parts for p in part]
        distinct = set(flat)
        if len(self.known) + len(distinct) > KNOWN and self.known:
            self._forget()
        self.learn(distinct)
        codes = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        sizes = self.sizes[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        starts = (np.cumsum(self.sizes) - self.sizes)[codes]
        ids = self.ids[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])] if len(flat) else self.ids[:0]
        at = np.concatenate([[0], np.cumsum([len(part) for part in parts])]).astype(np.int64)
        words = codes.tolist()
        return [(ids[ends[a]:ends[b]], b"".join([self.decoded[c] for c in words[a:b]])) for a, b in zip(at[:-1], at[1:])]

    def decode(self, rows: list[list[int]]) -> list[bytes]:
        """Bytes of id lists by ordered aggregation of (row, position, id)."""
        sizes = [len(r) for r in rows]
        self._table("coded", {"w": np.repeat(np.arange(len(rows)), sizes), "pos": np.concatenate([np.arange(n) for n in sizes] or [[]]),
                              "id": np.concatenate([np.asarray(r, np.int64) for r in rows] or [[]])})
        out = [b""] * len(rows)
        for row, text in self.con.execute(_DECODE).fetchall():
            out[int(row)] = bytes.fromhex(text)
        return out


@lru_cache(maxsize=1)
def codec(path: str, pattern: str, in_order: bool) -> Codec:
    return Codec(path, pattern, in_order)


class Digest:
    """n_tokens, ids_sha256, decoded_sha256 of one text, part by part."""

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    types = (pa.int64(), pa.string(), pa.string())

    def __init__(self):
        self.n, self.ids, self.decoded = 0, hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, decoded: bytes) -> None:
        self.n += len(ids)
        self.ids.update(ids.astype("<u4").tobytes())
        self.decoded.update(decoded)

    def row(self) -> tuple:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


class Whole:
    """ids and decoded bytes of one text."""

    schema = "ids array<bigint>, decoded binary"
    types = (pa.list_(pa.int64()), pa.binary())

    def __init__(self):
        self.ids, self.decoded = [], []

    def add(self, ids: np.ndarray, decoded: bytes) -> None:
        self.ids.append(ids.astype(np.int64))
        self.decoded.append(decoded)

    def row(self) -> tuple:
        return np.concatenate(self.ids or [np.empty(0, np.int64)]), b"".join(self.decoded)


def _parts(codec: Codec, texts: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
    """(text number, pieces), at most PART pieces each."""
    for i, text in enumerate(texts):
        found = codec.split(text)
        while part := list(islice(found, PART)):
            yield i, part


def code(docs: DataFrame, path: str, pattern: str, result: type = Digest) -> DataFrame:
    """One row per document: doc_id and the columns of ``result`` (``Digest``: n_tokens,
    ids_sha256, decoded_sha256; ``Whole``: ids and decoded bytes)."""
    ship(docs.sparkSession)
    in_order = merges_in_order(ranks_of(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, in_order)
        for batch in batches:
            out = [result() for _ in range(batch.num_rows)]
            texts = (x.as_py() or "" for x in batch.column(1))
            waiting, size = [], 0

            def flush():
                for (i, _), (ids, decoded) in zip(waiting, own.encode([p for _, p in waiting]), strict=True):
                    out[i].add(ids, decoded)

            for i, part in _parts(own, texts):
                waiting.append((i, part))
                size += len(part)
                if size >= PART:
                    flush()
                    waiting, size = [], 0
            flush()
            columns = zip(*(x.row() for x in out)) if out else [[] for _ in result.types]
            names = [c.split()[0] for c in result.schema.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), t) for c, t in zip(columns, result.types))],
                                             names=["doc_id", *names])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id bigint, {result.schema}")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded) of rows (doc_id, ids): the bytes of the ids (NULL ids: none)."""
    ship(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, True)
        for batch in batches:
            decoded = own.decode([x or [] for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=["doc_id", "decoded"])

    rows = tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<bigint>").alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, decoded binary")
