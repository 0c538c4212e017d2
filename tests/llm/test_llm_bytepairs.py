"""Byte-level BPE by tree reduction against the library and round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from brute import EDGES
from plumbline.llm import bytepairs

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
POOL = [*"abcdeyytm", "yyyy", "the", "ing", "'", "'s", "'ll", "'re", "é", "中", "😀", "1", "22", " ", "  ", "\n", "\x1c", "\x85", "\xa0",
        "　", "͸", "ß", "Ж", "٣", "\x00", "Ᲊ", "\U00031350"]


@pytest.fixture(scope="module")
def ranks():
    return bytepairs.load_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(n, size, seed):
    r = random.Random(seed)
    return ["".join(r.choice(POOL) for _ in range(r.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("leaf, reach", [(1, 1), (3, 1), (8, 2), (32, 2)])
def test_ids_equal_the_library(ranks, library, leaf, reach):
    codec = bytepairs.Codec(ranks, leaf, reach)
    own = texts(1500, 40, leaf)
    ids = codec.encode(own)
    assert ids == [library.encode_ordinary(t) for t in own]
    assert [codec.decode(i).decode() for i in ids] == own
    # One match of many bytes, so that joins matter.
    for t in own[:300]:
        data = t.replace(" ", "").encode()
        assert codec.merges.tree(data) == codec.merges.merged(data) == codec.merges._merged_long(data)


def test_joins_of_a_vocabulary_whose_ranks_do_not_rise():
    # A longer token of lower rank than its parts: merges do not come in the order of ranks.
    ranks = {bytes([b]): 1000 + b for b in range(256)}
    ranks |= {b"abc": 1, b"bc": 2, b"ab": 3, b"cd": 4, b"aa": 5, b"aaaa": 6, b"aab": 7, b"cda": 8}
    library = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks | {b"\xff\xfe": 1256}, special_tokens={})
    r = random.Random(9)
    for leaf in (1, 2, 5):
        merges = bytepairs.Merges(ranks, leaf, 1)
        for _ in range(800):
            text = "".join(r.choice("aaabcd") for _ in range(r.randint(1, 30)))
            assert merges.of_matches([text.encode()])[0] == library.encode_ordinary(text), text


def test_long_matches_and_texts(ranks, library):
    codec = bytepairs.Codec(ranks)
    for text in ("y" * 20_000, "ab" * 20_000, "-" * 3000, "".join(random.Random(2).choice("abcdefgh") for _ in range(20_000)),
                 "word and 12 words, isn't it?\n\n  " * 20_000):
        ids = codec.encode([text])[0]
        assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_caches_stay_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(bytepairs, "MOST", 50)
    codec = bytepairs.Codec(ranks)
    for t in texts(60, 200, 7):
        assert codec.encode([t])[0] == library.encode_ordinary(t)
        assert len(codec.words) < 300 and len(codec.merges.known) <= 51


def test_encode_decode_and_digests(spark, edges, library, corpus):
    docs = edges.select("doc_id", "text", "key").union(corpus.selectExpr("doc_id + 1000", "text", "'k'"))
    coded = bytepairs.encode(docs, RANKS, "doc_id", "key")
    back = bytepairs.decode(coded, RANKS, "doc_id", "key").collect()
    want = docs.collect()
    assert sorted((str(r.doc_id), bytes(r.data).decode()) for r in back) == sorted((str(r.doc_id), r.text or "") for r in want)
    assert sorted((str(r.doc_id), list(r.ids)) for r in coded.collect()) == sorted(
        (str(r.doc_id), library.encode_ordinary(r.text or "")) for r in want)
    got = bytepairs.round_trip(docs, RANKS, "doc_id").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for r in want:
        ids = library.encode_ordinary(r.text or "")
        expected.append((str(r.doc_id), len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expected)
    assert len(EDGES) <= len(got) and bytepairs.round_trip(edges.limit(0), RANKS, "doc_id").count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [5, None]), (4, [10 ** 6])], "doc_id long, ids array<int>")
    assert [r.data for r in bytepairs.decode(odd, RANKS, "doc_id").orderBy("doc_id").collect()] == [b"", b"", None, None]
