"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary's byte trie gets failure links and, for each node, how many pieces are popped
when a text leaves it: the greedy pieces of the node's string that end before the link's
string. Walking a word then costs a step per byte and no backing up, and the number of pieces
is a sum of popped counts. All words of a slice of texts walk together, one byte at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm import words
from plumbline.llm.common import lean

#: Words longer than this walk alone.
LONG = 2048


@dataclass
class Automaton:
    """``row`` of a node in ``step`` (one column per byte, -1: no child), its link and popped count."""

    row: np.ndarray = field(repr=False)
    step: np.ndarray = field(repr=False)
    link: np.ndarray = field(repr=False)
    pops: np.ndarray = field(repr=False)
    start: int

    def child(self, node, byte):
        return self.step[self.row[node], byte]


def build(pieces: list[bytes], start: bytes = b"") -> Automaton:
    """Automaton of the pieces and all single bytes; walks begin behind the string ``start``.

    Every byte is a piece of its own, so any text has greedy pieces. ``start`` must begin a
    piece; without one a word begins at the root.
    """
    children: list[dict[int, int]] = [{}]
    ends = [False]
    for piece in [*(bytes([b]) for b in range(256)), *pieces]:
        node = 0
        for b in piece:
            node_next = children[node].get(b)
            if node_next is None:
                node_next = children[node][b] = len(children)
                children.append({})
                ends.append(False)
            node = node_next
        ends[node] = node > 0
    link, pops = [0] * len(children), [0] * len(children)
    level = [0]
    while level:
        following = []
        for parent in level:
            for b, node in children[parent].items():
                if ends[node]:
                    link[node], pops[node] = 0, 1
                else:
                    at, n = link[parent], pops[parent]
                    while b not in children[at]:
                        n += pops[at]
                        at = link[at]
                    link[node], pops[node] = children[at][b], n
                following.append(node)
        level = following
    inner = [i for i, c in enumerate(children) if c]
    row = np.full(len(children), len(inner), dtype=np.int32)
    step = np.full((len(inner) + 1, 256), -1, dtype=np.int32)
    for r, i in enumerate(inner):
        row[i] = r
        for b, node in children[i].items():
            step[r, b] = node
    begin = 0
    for b in start:
        begin = children[begin][b]
    return Automaton(row, step, np.array(link, dtype=np.int32), np.array(pops, dtype=np.int32), begin)


def sentencepiece_vocabulary(path: str) -> list[bytes]:
    """The pieces of a SentencePiece model file that stand for text, as bytes."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i).encode() for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def _one(auto: Automaton, word: bytes) -> int:
    node, n = auto.start, 0
    row, step, link, pops = auto.row, auto.step, auto.link, auto.pops
    for b in word:
        while (following := step[row[node], b]) < 0:
            n += pops[node]
            node = link[node]
        node = following
    while node:
        n += pops[node]
        node = link[node]
    return int(n)


def lengths(auto: Automaton, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Number of greedy pieces of each word data[begin:begin + size]."""
    order = np.argsort(-size, kind="stable")
    out = np.zeros(len(size), dtype=np.int64)
    alone = int(np.searchsorted(-size[order], -LONG, side="left"))
    for i in order[:alone]:
        out[i] = _one(auto, data[begin[i]:begin[i] + size[i]].tobytes())
    order = order[alone:]
    begin, size = begin[order], size[order]
    node, n = np.full(len(order), auto.start, dtype=np.int32), np.zeros(len(order), dtype=np.int64)
    for j in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -j, side="left"))
        byte, now = data[begin[:live] + j], node[:live]
        following = auto.step[auto.row[now], byte]
        miss = np.flatnonzero(following < 0)
        while len(miss):
            at = now[miss]
            n[miss] += auto.pops[at]
            now[miss] = at = auto.link[at]
            found = auto.step[auto.row[at], byte[miss]]
            following[miss] = found
            miss = miss[found < 0]
        node[:live] = following
    rest = np.flatnonzero(node)
    while len(rest):
        n[rest] += auto.pops[node[rest]]
        node[rest] = auto.link[node[rest]]
        rest = rest[node[rest] != 0]
    out[order] = n
    return out


def count_pieces(docs: DataFrame, auto: Automaton, *keys: str, per_word: bool = False) -> DataFrame:
    """(keys, n_words, n_pieces, most_pieces) of every whole text, with ``per_word`` also the counts.

    Words are runs of anything but space and TAB to CR. Null and empty texts have no words and
    no pieces; repeated rows count alike; keys may be null; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(auto)
    kept = docs.select(*keys, F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            n_words, n_pieces, most, each = [], [], [], []
            for _, _, data, starts in words.slices(batch):
                begin, end, counts = words.spans(data, starts)
                n = lengths(held.value, data, begin, end - begin)
                cuts = np.concatenate([[0], np.cumsum(counts)])
                total = np.concatenate([[0], np.cumsum(n)])
                n_words.append(counts)
                n_pieces.append(total[cuts[1:]] - total[cuts[:-1]])
                top = np.zeros(len(counts), dtype=np.int64)
                some = np.flatnonzero(counts)
                if len(some):
                    top[some] = np.maximum.reduceat(n, cuts[:-1][some])
                most.append(top)
                if per_word:
                    each += [n[a:b].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]
            whole = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
            cols = [*[batch.column(k) for k in keys], whole(n_words), whole(n_pieces), whole(most)]
            names = [*keys, "n_words", "n_pieces", "most_pieces"]
            if per_word:
                cols.append(pa.array(each, pa.list_(pa.int32())))
                names.append("pieces")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields[:-1])
    return kept.mapInArrow(lean(run), f"{head}n_words long, n_pieces long, most_pieces long" + (
        ", pieces array<int>" if per_word else ""))
