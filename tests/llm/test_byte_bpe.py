"""Byte-level BPE against tiktoken, and its rules on awkward input."""

import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from affinity.llm import bytebpe
from affinity.llm.queries import queries

from .conftest import SMOKE

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library(path=RANKS):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bytebpe.ranks_of(path), special_tokens={})


def digest(ids, decoded):
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def own(texts, path=RANKS, in_order=True):
    c = bytebpe.codec(path, P.PATTERN, in_order)
    return [(ids.tolist(), b) for ids, b in c.encode([list(c.split(t)) for t in texts])]


def test_query_equals_tiktoken(spark):
    enc = library()
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    want = sorted((r["doc_id"], *digest(enc.encode_ordinary(r["text"] or ""), (r["text"] or "").encode())) for r in docs)
    assert sorted(tuple(r) for r in queries()["op11_byte_bpe"](spark, SMOKE).collect()) == want


def test_code_points_of_all_classes():
    enc = library()
    points = [c for c in [*range(0x3000), *range(0xA000, 0xD800), *range(0xE000, 0x1F000), *bytebpe.class_repairs()] if not 0xD800 <= c < 0xE000]
    texts = [" ".join(chr(c) + "a " + chr(c) for c in points[k:k + 8192]) for k in range(0, len(points), 8192)]
    for text, (ids, decoded) in zip(texts, own(texts), strict=True):
        assert ids == enc.encode_ordinary(text)
        assert decoded == text.encode()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aabbnnee \n\t's'll019.,!é東😀\x85\xa0"), max_size=60), min_size=1, max_size=4))
def test_random_texts(texts):
    enc = library()
    assert own(texts) == [(enc.encode_ordinary(t), t.encode()) for t in texts]


def test_long_pieces_take_few_rounds():
    enc = library()
    pieces = ["\n" * 1_000_000, "a" * 50_000, "ab" * 30_000, " " * 200_000]
    for text, (ids, decoded) in zip(pieces, own(pieces), strict=True):
        assert ids == enc._core_bpe.encode_single_piece(text.encode())
        assert decoded == text.encode()


def test_files_whose_merges_are_out_of_order(tmp_path):
    """Ranks that no training gives: one place a round, whole tokens first, as in tiktoken."""
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"abc", b"cd", b"ab", b"abcd", b"aaa", b"aa", b"xyz"]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" " + str(i).encode() + b"\n" for i, t in enumerate(tokens)))
    assert not bytebpe.merges_in_order(bytebpe.ranks_of(str(path)))
    enc = library(str(path))
    texts = ["abcd abc bcd aaaa aaaaaaa xyz xyzxyz", "aabcdabcd", "cdcd abab aaa", ""]
    assert own(texts, str(path), False) == [(enc.encode_ordinary(t), t.encode()) for t in texts]


def test_the_public_file_is_in_order():
    assert bytebpe.merges_in_order(bytebpe.ranks_of(RANKS))


def test_awkward_rows(spark, weird, nothing):
    enc = library()
    rows = weird.collect()
    want = sorted(((r["doc_id"], *digest(enc.encode_ordinary(r["text"] or ""), (r["text"] or "").encode())) for r in rows), key=repr)
    got = bytebpe.code(weird.repartition(3), RANKS, P.PATTERN)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert bytebpe.code(nothing, RANKS, P.PATTERN).collect() == []


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(bytebpe, "PART", 50)
    monkeypatch.setattr(bytebpe, "KNOWN", 40)
    monkeypatch.setattr(bytebpe, "ROUND_BYTES", 30)
    own_codec = bytebpe.Codec(RANKS, P.PATTERN, True)
    texts = ["one two three 'll four\n\n" * 30, "", "five six " * 5]
    got = {i: [] for i in range(3)}
    for i, part in bytebpe._parts(own_codec, texts):
        (ids, _), = own_codec.encode([part])
        got[i] += ids.tolist()
    assert [got[i] for i in range(3)] == [library().encode_ordinary(t) for t in texts]


def test_round_trip(spark, weird):
    coded = bytebpe.code(weird, RANKS, P.PATTERN, bytebpe.Whole)
    back = bytebpe.decode(coded, RANKS, P.PATTERN)
    want = sorted((repr(r["doc_id"]), (r["text"] or "").encode()) for r in weird.collect())
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in back.collect()) == want
    assert sorted((repr(r["doc_id"]), bytes(r["decoded"])) for r in coded.collect()) == want
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<bigint>")
    assert [bytes(r["decoded"]) for r in bytebpe.decode(none, RANKS, P.PATTERN).collect()] == [b"", b""]


@pytest.fixture(autouse=True, scope="module")
def _fresh():
    yield
    bytebpe.codec.cache_clear()
