"""BPE encoding and decoding with reuse of content-defined chunks.

1. A rolling hash over the bytes cuts every distinct text into chunks, so texts that
   share passages share chunks wherever these stand.
2. Chunk hashes held twice or more are shared; one text owns each of them.
3. Texts are encoded where they lie: the owner encodes a shared chunk, everybody
   encodes what lies between shared chunks.
4. Shared ids are joined to their other places. A chunk's ids hold there from its first
   to its last *anchor*; the stretch between the last anchor of one piece and the
   first anchor of the next is re-encoded, which repairs the join.

An anchor is a single space between two visible ASCII characters. The split
pattern of byte-level BPE always starts a new piece there, whatever stands
before or behind, so ids on either side agree with those of the whole text; that an
anchor is a boundary in the chunk's ids is checked (a text where one isn't is encoded again as a whole),
and a chunk without two anchors is encoded as part of its surroundings.

Texts are handled by content, so exact copies are encoded once and a hot group
of copies costs one text. Only hashes, compressed texts (once) and ids around
shared chunks are shuffled.

Defined results: NULL text is the empty text (no ids); repeated rows each get a
row; special tokens' strings in a text are special tokens, as the tokenizers library
has it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

CUT_BITS = 10  # a cut every 1024 bytes on average, beyond MIN_CHUNK
MIN_CHUNK = 256
WINDOW = 32  # bytes the rolling hash sees
SLAB = 1 << 20
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed pattern of byte-level BPE

RUN = 1 << 12  # white space of this length is split outside the pattern
# fixed: the characters of \s in Unicode
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{_WHITE}]{{{RUN},}}")

_GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, dtype=np.uint32)

DONE, LITERAL, REFERENCE, SHARED = range(4)


# --- tokenizer -------------------------------------------------------------

def _byte_symbols() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers JSON file. Its ids must follow the order of the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    symbols = _byte_symbols()
    ranks = {bytes(symbols[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    if sorted(ranks.values()) != list(range(len(ranks))) or any(
            spec["model"]["vocab"][a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"{path}: ids don't follow the merges")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return tiktoken.Encoding("bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def encode_text(tok: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of a text. The split pattern looks back over a run of white space as deep as the run
    is long, so long runs are cut out: all but a run's last character (the whole run at the
    text's end) is one piece, as the pattern has it, and the text goes on with that character."""
    ids: list[int] = []
    done = 0
    for run in LONG_RUN.finditer(text) if len(text) >= RUN else ():
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += tok.encode(text[done:run.start()], allowed_special="all")
        ids += tok._encode_single_piece(text[run.start():end])
        done = end
    ids += tok.encode(text[done:], allowed_special="all")
    return np.asarray(ids, dtype=np.uint32)


def decode_ids(tok: tiktoken.Encoding, ids: np.ndarray) -> str:
    return tok.decode_bytes(ids.tolist()).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def _lengths(path: str) -> np.ndarray:
    """Bytes of every id."""
    tok = tokenizer(path)
    return np.array([len(tok.decode_single_token_bytes(i)) for i in range(tok.n_vocab)], dtype=np.int64)


# --- chunks and anchors ------------------------------------------------------

def cuts(data: bytes) -> list[int]:
    """Chunk ends: where the rolling hash of the last 32 bytes says so, at a character's
    start, at least MIN_CHUNK after the last; the text's end is the last."""
    raw = np.frombuffer(data, np.uint8)
    found = []
    for at in range(0, len(raw), SLAB):
        first = max(0, at - WINDOW)
        part = raw[first:at + SLAB + 1]
        h = _GEAR[part]
        step = 1
        while step < WINDOW:
            h[step:] += h[:-step] << np.uint32(step)
            step *= 2
        ends = np.flatnonzero((h[:-1] >> np.uint32(32 - CUT_BITS) == 0) & (part[1:] & 0xC0 != 0x80)) + 1 + first
        found.append(ends[(ends > at) & (ends <= at + SLAB)])
    out, last = [], 0
    for end in np.concatenate(found).tolist() if found else []:
        if end - last >= MIN_CHUNK and len(raw) - end >= MIN_CHUNK:
            out.append(end)
            last = end
    return [*out, len(raw)]


def anchors(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if len(raw) < 3:
        return np.empty(0, np.int64)
    seen = (raw > 0x20) & (raw < 0x7F)
    return np.flatnonzero((raw[1:-1] == 0x20) & seen[:-2] & seen[2:]) + 1


def pieces(data: bytes, shared: dict[int, tuple[bytes, bool]]) -> Iterator[tuple]:
    """Plan of one text: (LITERAL, start, end), (REFERENCE, hash, skip, take) in text
    order, and (SHARED, hash, start, end) for chunks that this text owns."""
    if not shared:
        yield LITERAL, 0, len(data)
        return
    ends = cuts(data)
    marks = anchors(data)
    done = start = 0
    for k, end in enumerate(ends):
        if k in shared:
            digest, own = shared[k]
            if own:
                yield SHARED, digest, start, end
            inside = marks[np.searchsorted(marks, start, "right"):np.searchsorted(marks, end)]
            # an anchor needs its neighbours within the chunk
            inside = inside[inside + 1 < end]
            left = start if start == 0 else (int(inside[0]) if len(inside) else end)
            right = end if end == len(data) else (int(inside[-1]) if len(inside) else start)
            if left < right:
                if done < left:
                    yield LITERAL, done, left
                yield REFERENCE, digest, left - start, right - left
                done = right
        start = end
    if done < len(data):
        yield LITERAL, done, len(data)


# --- Spark jobs --------------------------------------------------------------

def _packed(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<u4").tobytes(), 3)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), "<u4")


def digest(tok: tiktoken.Encoding, ids: np.ndarray) -> tuple:
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(decode_ids(tok, ids).encode()).hexdigest())


DIGEST = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def whole(tok: tiktoken.Encoding, ids: np.ndarray) -> tuple:
    return (ids.astype(np.int64), decode_ids(tok, ids))


WHOLE = "ids array<bigint>, decoded string"


def _chunked(docs: DataFrame) -> DataFrame:
    """(doc_id, version, chunks): content hash of the text, hashes of its chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for data in batch.column(2).cast(pa.large_binary()).to_pylist():
                ends = cuts(data)
                out.append([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip([0, *ends], ends, strict=False)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))],
                                             names=["doc_id", "version", "chunks"])

    return docs.mapInArrow(run, "doc_id bigint, version binary, chunks array<binary>")


def _squeezed(docs: DataFrame) -> DataFrame:
    """(doc_id, version, z): texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [squeeze.compress(x) for x in batch.column(2).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(z, pa.binary())],
                                             names=["doc_id", "version", "z"])

    return docs.mapInArrow(run, "doc_id bigint, version binary, z binary")


def _encoded(texts: DataFrame, path: str, finish: Callable, fields: str) -> DataFrame:
    """Encode every text's own pieces. Rows by kind: DONE has the finished columns,
    LITERAL and SHARED have ids, REFERENCE a chunk hash and its byte range."""
    schema = f"kind int, version binary, seq int, hash binary, skip bigint, take bigint, packed binary, {fields}"
    n_fields = len(fields.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, unpack = tokenizer(path), zstandard.ZstdDecompressor()
        target = None
        for batch in batches:
            rows = []
            for version, z, info in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data = unpack.decompress(z, max_output_size=1 << 31) if z else b""
                shared = {x["idx"]: (x["hash"], x["own"]) for x in info or ()}
                plan = list(pieces(data, shared))
                if all(p[0] != REFERENCE for p in plan):
                    ids = encode_text(tok, data.decode())
                    rows.append((DONE, version, 0, None, None, None, None, *finish(tok, ids)))
                    plan = [p for p in plan if p[0] == SHARED]
                for seq, p in enumerate(plan):
                    if p[0] == REFERENCE:
                        rows.append((REFERENCE, version, seq, p[1], p[2], p[3], None, *[None] * n_fields))
                    else:
                        start, end = p[-2:]
                        ids = _packed(encode_text(tok, data[start:end].decode()))
                        rows.append((p[0], version, seq, p[1] if p[0] == SHARED else None, None, None, ids, *[None] * n_fields))
            target = target or _arrow_schema(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), target, strict=True)] if rows else
                [pa.array([], t.type) for t in target], schema=target)

    return texts.mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string(),
             "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(","))])


def _joined(segments: DataFrame, path: str, finish: Callable, fields: str) -> DataFrame:
    """Put the segments of each text together: rows sorted by (version, seq). Where a shared
    chunk's ids have no boundary at an anchor the text is told apart (``agrees`` false)."""
    schema = f"version binary, agrees boolean, {fields}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, lengths, target = tokenizer(path), _lengths(path), _arrow_schema(schema)
        current, parts, agrees = None, [], True

        def end():
            if not agrees:
                return (current, False, *[None] * len(fields.split(",")))
            return (current, True, *finish(tok, np.concatenate(parts)))

        for batch in batches:
            rows = []
            for version, skip, take, blob in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if version != current:
                    if current is not None:
                        rows.append(end())
                    current, parts, agrees = version, [], True
                ids = _unpacked(blob)
                if take is not None:
                    at = np.concatenate([[0], np.cumsum(lengths[ids])])
                    first, last = np.searchsorted(at, (skip, skip + take)).tolist()
                    agrees = agrees and last < len(at) and (at[first], at[last]) == (skip, skip + take)
                    ids = ids[first:last]
                parts.append(ids)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), target, strict=True)],
                                                 schema=target)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip(end(), target, strict=True)], schema=target)

    return segments.mapInArrow(run, schema)


def _again(texts: DataFrame, path: str, finish: Callable, fields: str) -> DataFrame:
    """Whole texts (version, z) encoded afresh."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, unpack, target = tokenizer(path), zstandard.ZstdDecompressor(), _arrow_schema(f"version binary, {fields}")
        for batch in batches:
            rows = [(version, *finish(tok, encode_text(tok, (unpack.decompress(z, max_output_size=1 << 31) if z else b"").decode())))
                    for version, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), target, strict=True)], schema=target)

    return texts.mapInArrow(run, f"version binary, {fields}")


def code(docs: DataFrame, path: str, finish: Callable = digest, fields: str = DIGEST) -> DataFrame:
    """One row per document: doc_id and the columns of ``finish`` (by default
    n_tokens, ids_sha256, decoded_sha256; ``whole``: ids and decoded text)."""
    ship(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.select("doc_id", F.unhex(F.md5("text")).alias("version"), "text")
    names = [f.split()[0] for f in fields.split(",")]
    chunked = stored(_chunked(source), "chunks")
    # one owner row for each distinct text; NULL ids stand last
    low = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    texts = stored(chunked.groupBy("version").agg(F.min(low).alias("owner"), F.first("chunks").alias("chunks")), "texts")
    places = texts.select("version", F.posexplode("chunks").alias("idx", "hash"))
    shared = stored(places.groupBy("hash").agg(F.count("*").alias("n"), F.min(F.struct("version", "idx")).alias("first"))
                    .filter("n > 1").select("hash", "first"), "shared-chunks")
    info = places.join(shared, "hash").groupBy("version").agg(F.collect_list(F.struct(
        "idx", "hash", (F.col("first") == F.struct("version", "idx")).alias("own"))).alias("info"))
    wanted = stored(texts.select("version", "owner").join(info, "version", "left"), "wanted")
    squeezed = _squeezed(source).withColumn("owner", low).drop("doc_id")
    mine = squeezed.join(wanted, ["owner", "version"]).select("version", "z", "info")
    out = stored(_encoded(mine, path, finish, fields), "encoded")
    done = out.filter(F.col("kind") == DONE).select("version", *names)
    defs = out.filter(F.col("kind") == SHARED).select("hash", "packed").dropDuplicates(["hash"])
    refs = out.filter(F.col("kind") == REFERENCE).drop("packed").join(defs, "hash")
    cols = ["version", "seq", "skip", "take", "packed"]
    segments = out.filter(F.col("kind") == LITERAL).select(*cols).union(refs.select(*cols)).dropDuplicates(["version", "seq"])
    rest = stored(_joined(segments.repartition("version").sortWithinPartitions("version", "seq"), path, finish, fields), "joined")
    parts = [done, rest.filter("agrees").drop("agrees")]
    open_ = rest.filter("NOT agrees").select("version")
    if not open_.isEmpty():
        whole_texts = squeezed.join(texts.select("version", "owner").join(open_, "version"), ["owner", "version"]).select("version", "z")
        parts.append(_again(whole_texts.dropDuplicates(["version"]), path, finish, fields))
    by_text = stored(reduce(DataFrame.union, parts).dropDuplicates(["version"]), "coded")
    return chunked.select("doc_id", "version").join(by_text, "version").select("doc_id", *names)
