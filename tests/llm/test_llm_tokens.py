"""Pieces, word-piece lengths and packing against plain versions and round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from brute import EDGES, words
from plumbline.llm import packing, pieces, wordpiece

PIECES = public_tokenizers.path("piece_bpe_32k.model")
IDS = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"abcdeth", "the", "ing", ".", ",", " ", "  ", "\n", "▁", "é", "中", "😀", "1", "'", "\x1c", "\xa0", "\t", "<|endoftext|>"]


def texts(n, size, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, size))) for _ in range(n)]


def plain_viterbi(v, text):
    best, back = [0.0], [None]
    for e in range(1, len(text) + 1):
        top = None
        for s in range(e):
            found = v.pieces.get(text[s:e])
            if found and (top is None or best[s] + found[1] > top[0]):
                top = (best[s] + found[1], s, [found[0]])
        if text[e - 1] not in v.pieces and (top is None or best[e - 1] + v.other > top[0]):
            top = (best[e - 1] + v.other, e - 1, [v.bytes_at[b] for b in text[e - 1].encode()])
        best.append(top[0])
        back.append(top)
    out, e = [], len(text)
    while e:
        out, e = back[e][2] + out, back[e][1]
    return out


def test_streaming_viterbi_equals_the_whole_table():
    v = pieces.Vocabulary.load(PIECES)
    encoder, decoder = pieces.Encoder(v), pieces.Decoder(v)
    for text in texts(1500, 20):
        ids = np.frombuffer(encoder.of(text), dtype="<i4").tolist()
        assert decoder.of(ids) == text
        if text and "▁" not in text:
            marked = "▁" + text.replace(" ", "▁")
            parts = [marked[i:i + 3] for i in range(0, len(marked), 3)]
            assert plain_viterbi(v, marked) == ids == list(pieces.encode_stream(v, iter(parts))) == list(pieces.settled(v, marked))


def test_stream_keeps_a_bounded_window():
    v = pieces.Vocabulary.load(PIECES)
    stream, most, out = pieces.Stream(v), 0, []
    for c in "theinger" * 3000:
        out += stream.feed(c)
        most = max(most, len(stream.best))
    out += stream.finish()
    assert most <= v.longest + 1
    assert pieces.Decoder(v).of(out) == "theinger" * 3000


def test_encode_and_decode_tables(spark, edges):
    got = pieces.decode(pieces.encode(edges, PIECES, "doc_id", "key"), PIECES, "doc_id", "key").collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t or "") for i, t in EDGES)
    rows = pieces.round_trip(edges, PIECES, "doc_id").collect()
    assert len(rows) == len(EDGES) and all(r.exact for r in rows)
    assert pieces.round_trip(edges.limit(0), PIECES, "doc_id").count() == 0
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), PIECES, "doc_id").collect() == [
        (1, None), (2, "")]


def test_greedy_lengths(edges):
    vocabulary = wordpiece.sentencepiece_vocabulary(PIECES)
    auto = wordpiece.build(vocabulary, "▁".encode())
    known = set(vocabulary) | {bytes([b]) for b in range(256)}
    longest = max(map(len, known))

    def greedy(word):
        s, at, n = b"\xe2\x96\x81" + word.encode(), 0, 0
        while at < len(s):
            at += next(k for k in range(min(longest, len(s) - at), 0, -1) if s[at:at + k] in known)
            n += 1
        return n

    got = wordpiece.count_pieces(edges, auto, "doc_id", per_word=True).collect()
    want = [[greedy(w) for w in words(t)] for _, t in EDGES]
    assert sorted(r.pieces for r in got) == sorted(want)
    assert sorted((r.n_words, r.n_pieces, r.most_pieces) for r in got) == sorted((len(w), sum(w), max(w, default=0)) for w in want)
    assert wordpiece.count_pieces(edges.limit(0), auto, "doc_id").count() == 0


def test_popped_counts_of_a_small_vocabulary():
    auto = wordpiece.build([b"abc", b"bcd", b"cde", b"abcdx"])
    data = np.frombuffer(b"abcdeabcdxbcde", dtype=np.uint8)
    got = wordpiece.lengths(auto, data, np.array([0, 5, 10, 0]), np.array([5, 5, 4, 0]))
    assert got.tolist() == [3, 1, 2, 0]  # abc d e; abcdx; bcd e


def test_fast_ids_equal_the_tokenizer():
    tok, ids = Tokenizer.from_file(IDS), packing.Ids(IDS)
    assert ids.ranks is not None
    for text in texts(3000, 14):
        assert np.frombuffer(ids.of(text), dtype="<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_packing_keeps_every_id_once(spark, edges, corpus):
    tok = Tokenizer.from_file(IDS)
    docs = edges.select("doc_id", "text", "key").where("doc_id is null or doc_id <> 9")
    docs = docs.union(corpus.selectExpr("doc_id + 1000", "text", "'k'").limit(60))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [0])
    rows = packing.pack(docs.repartition(3), IDS).collect()
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and r.length == len(r.ids)
    for pieces_of in windows.values():
        pieces_of.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces_of] == [sum(p.length for p in pieces_of[:k]) for k in range(len(pieces_of))]
        size = sum(r.length for r in pieces_of)
        assert size <= 1024 and size & (size - 1) == 0, "no window needs padding"
    for key, ids in want.items():
        if key is None:
            continue
        own = sorted((r for r in rows if r.doc_id == key), key=lambda r: r.start)
        assert [i for r in own for i in r.ids] == ids[0] and {r.doc_tokens for r in own} == {len(ids[0])}
    assert packing.pack(edges.limit(0), IDS).count() == 0


def test_sum_of_squares_rule_and_bounded_open_windows():
    r = random.Random(3)
    windows, level = packing.Windows(64, 0, most_open=10_000), [0] * 65
    for k in range(3000):
        n = r.randint(1, 63)
        options = []
        for h in range(0, 64 - n + 1):
            if h == 0 or level[h]:
                after = level[:]
                if h:
                    after[h] -= 1
                if h + n < 64:
                    after[h + n] += 1
                options.append((sum(x * x for x in after), -h, after))
        level = min(options)[2]
        windows.add(k, b"\1\0\0\0" * n)
        assert windows.level[:64].tolist() == level[:64]
    small = packing.Windows(64, 0, most_open=5)
    for k in range(500):
        small.add(k, b"\1\0\0\0" * 40)
        assert small.n_open <= 6
    small.recut(last=True)
    assert sum(d[2] for d in small.done) == 500 * 40


def test_overflow_recuts_only_the_hottest_level():
    windows = packing.Windows(64, 0, most_open=26)
    for k, n in enumerate([41, 42, 43] + [40] * 24):
        windows.add(k, b"\1\0\0\0" * n)
    assert np.flatnonzero(windows.level).tolist() == [41, 42, 43] and windows.n_open == 3
    assert len(windows.done) and sum(d[2] for d in windows.done) == 24 * 40
    tiny = packing.Windows(64, 0, most_open=2)
    for k in range(300):
        tiny.add(k, b"\1\0\0\0" * (1 + k * 7 % 63))
        assert tiny.n_open <= 2
    tiny.recut(last=True)
    assert sum(d[2] for d in tiny.done) == sum(1 + k * 7 % 63 for k in range(300))
