"""SentencePiece encoding and decoding by streaming Viterbi.

The pieces' scores are summed and the best segmentation wins; equal sums go to the longer last
piece. Text streams in: what is kept are the boundaries that a piece still open may start
from, never more than the longest piece, and ids are given out as soon as all paths that are
left agree on them. Where no piece holds two neighbouring characters together every path meets,
so a text falls into short segments, which workers keep encoded in a bounded cache.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import lean

MARK = "▁"


class Vocabulary:
    """Pieces with scores, byte pieces, and the pairs of characters that some piece joins."""

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_at: list[int], names: list[str]):
        self.pieces, self.bytes_at, self.names = pieces, bytes_at, names
        self.longest = max(map(len, pieces), default=1)
        # A character without a piece costs more than any piece.
        self.other = min((s for _, s in pieces.values()), default=0.0) - 10.0
        self.pairs = {(p[i], p[i + 1]) for p in pieces for i in range(len(p) - 1)}
        self.trie: dict = {}
        for p, (i, s) in pieces.items():
            node = self.trie
            for c in p:
                node = node.setdefault(c, {})
            node[None] = (i, s)
        self.byte_of = {i: b for b, i in enumerate(bytes_at)}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a SentencePiece model file with byte pieces and identity normalisation."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        text = [i for i in range(len(names)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        return cls({names[i]: (i, sp.get_score(i)) for i in text},
                   [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], names)


class Stream:
    """Viterbi over characters as they come; ``feed`` and ``finish`` give the ids that are settled."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.at = 0
        # Boundary: its best sum and the ids up to it as a chain (chain before, ids of the last piece).
        self.best: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        self.open: list[tuple[int, dict]] = []

    def feed(self, text: str) -> Iterator[int]:
        v = self.v
        for c in text:
            self.open.append((self.at, v.trie))
            self.at += 1
            still, score, chain = [], None, None
            for start, node in self.open:
                node = node.get(c)
                if node is None:
                    continue
                still.append((start, node))
                if None in node:
                    i, s = node[None]
                    sum_ = self.best[start][0] + s
                    # Starts come in order, so an equal sum of a shorter piece changes nothing.
                    if score is None or sum_ > score:
                        score, chain = sum_, (self.best[start][1], (i,))
            if c not in v.pieces:
                before, link = self.best[self.at - 1]
                if score is None or before + v.other > score:
                    score, chain = before + v.other, (link, tuple(v.bytes_at[b] for b in c.encode("utf-8", "surrogatepass")))
            self.best[self.at] = (score, chain)
            self.open = [(s, n) for s, n in still if any(k is not None for k in n)]
            live = {s for s, _ in self.open} | {self.at}
            self.best = {b: x for b, x in self.best.items() if b in live}
            if len(live) == 1 or self.at % (4 * v.longest) == 0:
                yield from self._settle()

    def _settle(self) -> list[int]:
        """Give out what all live paths share and cut it from their chains."""
        paths = {}
        for b, (score, chain) in self.best.items():
            out = []
            while chain is not None:
                out.append(chain[1])
                chain = chain[0]
            paths[b] = (score, out[::-1])
        lists = [p for _, p in paths.values()]
        same = 0
        while all(len(p) > same for p in lists) and all(p[same] == lists[0][same] for p in lists):
            same += 1
        for b, (score, path) in paths.items():
            chain = None
            for ids in path[same:]:
                chain = (chain, ids)
            self.best[b] = (score, chain)
        return [i for ids in lists[0][:same] for i in ids]

    def finish(self) -> list[int]:
        self.best = {self.at: self.best[self.at]}
        self.open = []
        return self._settle()


def encode_stream(vocabulary: Vocabulary, parts: Iterator[str]) -> Iterator[int]:
    """Ids of a text that comes in parts, already marked; memory does not grow with it."""
    stream = Stream(vocabulary)
    for part in parts:
        yield from stream.feed(part)
    yield from stream.finish()


def settled(v: Vocabulary, text: str) -> Iterator[int]:
    """The same recurrence for a short segment that is there whole.

    ``reach`` is how far any piece begun so far goes. A boundary that none crosses is one where
    all surviving paths meet: the ids up to it are given out and the window starts anew.
    """
    trie, pieces = v.trie, v.pieces
    n, base, reach = len(text), 0, 0
    best: list[float | None] = [0.0]
    back: list[tuple] = [()]
    for s in range(n):
        if s == reach and s > base:
            yield from _path(back)
            best, back, base = [0.0], [()], s
        here = best[s - base]
        if text[s] not in pieces:
            if s + 1 > reach:
                reach = s + 1
                best.append(None)
                back.append(())
            if best[s + 1 - base] is None or here + v.other > best[s + 1 - base]:
                best[s + 1 - base] = here + v.other
                back[s + 1 - base] = (s - base, [v.bytes_at[b] for b in text[s].encode("utf-8", "surrogatepass")])
        node, e = trie, s
        for c in text[s:] if s else text:
            node = node.get(c)
            if node is None:
                break
            e += 1
            if None in node:
                i, score = node[None]
                while reach < e:
                    reach += 1
                    best.append(None)
                    back.append(())
                now = best[e - base]
                if now is None or here + score > now:
                    best[e - base], back[e - base] = here + score, (s - base, i)
    yield from _path(back)


def _path(back: list[tuple]) -> list[int]:
    """Ids along the best path to the last boundary of a window."""
    out, e = [], len(back) - 1
    while e:
        e, ids = back[e]
        if type(ids) is int:
            out.append(ids)
        else:
            out += reversed(ids)
    return out[::-1]


class Encoder:
    """Texts to ids with bounded caches of chunks and segments."""

    def __init__(self, vocabulary: Vocabulary, most: int = 500_000):
        self.v, self.most = vocabulary, most
        self.chunks: dict[str, bytes] = {}
        self.segments: dict[str, bytes] = {}
        # A mark never follows another character inside a piece, so chunks meet at spaces.
        self.cut_at_spaces = not any(b == MARK and a != MARK for a, b in vocabulary.pairs)

    def _segment(self, text: str) -> bytes:
        found = self.segments.get(text)
        if found is None:
            ids = list(settled(self.v, text) if len(text) <= 4 * self.v.longest else encode_stream(self.v, iter([text])))
            found = np.array(ids, dtype="<i4").tobytes()
            if len(text) <= 32:
                if len(self.segments) >= self.most:
                    self.segments.clear()
                self.segments[text] = found
        return found

    def marked(self, text: str) -> bytes:
        """Ids of a marked text, cut where no piece joins two characters.

        A mark that the text itself has is written as bytes, so decoding gives it back.
        """
        pairs, out, start = self.v.pairs, [], 0
        for i, pair in enumerate(zip(text, text[1:]), start=1):
            if pair not in pairs:
                out.append(self._segment(text[start:i]))
                start = i
        if start < len(text):
            out.append(self._segment(text[start:]))
        return b"".join(out)

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a space and what follows up to the next space."""
        found = self.marked(MARK + chunk)
        if len(chunk) <= 32:
            if len(self.chunks) >= self.most:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    def of(self, text: str) -> bytes:
        """Ids (little-endian int32) of a text; a space is put in front of it."""
        if not text:
            return b""
        if MARK in text:
            own = np.array([self.v.bytes_at[b] for b in MARK.encode()], dtype="<i4").tobytes()
            first, *rest = text.split(MARK)
            return self.marked((" " + first).replace(" ", MARK)) + b"".join(
                own + self.marked(r.replace(" ", MARK)) for r in rest)
        if "  " in text or text[0] == " " or text[-1] == " " or not self.cut_at_spaces:
            return self.marked((" " + text).replace(" ", MARK))
        chunks = text.split(" ")
        try:
            return b"".join(map(self.chunks.__getitem__, chunks))
        except KeyError:
            get = self.chunks.get
            return b"".join([get(c) or self._chunk(c) for c in chunks])


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.text = [n.replace(MARK, " ").encode("utf-8", "surrogatepass") for n in vocabulary.names]
        for i, b in vocabulary.byte_of.items():
            self.text[i] = bytes([b])

    def of(self, ids) -> str:
        """The text of ids; the space that encoding put in front is taken off."""
        out = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


_TOOLS: dict[str, tuple[Encoder, Decoder]] = {}


def _tools(path: str) -> tuple[Encoder, Decoder]:
    """One pair per worker process and file."""
    if path not in _TOOLS:
        v = Vocabulary.load(path)
        _TOOLS[path] = Encoder(v), Decoder(v)
    return _TOOLS[path]


def _with_keys(docs: DataFrame, keys: tuple[str, ...], column: str, kind: str):
    kept = docs.select(*keys, F.col(column).cast(kind).alias(column))
    return kept, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])


def encode(docs: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, ids) of every whole text. Null and empty texts have no ids."""
    kept, head = _with_keys(docs, keys, "text", "string")

    def run(batches):
        for batch in batches:
            encoder, _ = _tools(path)
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.frombuffer(encoder.of(t or ""), dtype="<i4") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keys], pa.array(ids, pa.list_(pa.int32()))], names=[*keys, "ids"])

    return kept.mapInArrow(lean(run), f"{head}ids array<int>")


def decode(encoded: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, text) of rows of (keys, ids); null ids give null, no ids an empty text."""
    kept, head = _with_keys(encoded, keys, "ids", "array<int>")

    def run(batches):
        for batch in batches:
            _, decoder = _tools(path)
            text = [None if ids is None else decoder.of(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(text, pa.string())], names=[*keys, "text"])

    return kept.mapInArrow(lean(run), f"{head}text string")


def round_trip(docs: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, n_ids, ids_crc32, exact): every whole text encoded, decoded and compared.

    Null counts as empty; repeated rows give the same; keys may be null; an empty table gives
    no rows.
    """
    kept, head = _with_keys(docs, keys, "text", "string")

    def run(batches):
        for batch in batches:
            encoder, decoder = _tools(path)
            n, crc, exact = [], [], []
            for at in range(0, batch.num_rows, 256):
                for text in batch.column("text").slice(at, 256).to_pylist():
                    ids = encoder.of(text or "")
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    exact.append(decoder.of(np.frombuffer(ids, dtype="<i4").tolist()) == (text or ""))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(exact, pa.bool_())],
                names=[*keys, "n_ids", "ids_crc32", "exact"])

    return kept.mapInArrow(lean(run), f"{head}n_ids long, ids_crc32 long, exact boolean")
