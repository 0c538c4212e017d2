"""Packing of token ids into fixed-size windows by the sum-of-squares rule.

Every partition packs its own documents online, so nothing is shuffled and no state is
shared: a task holds the level array and the open windows (at most ``most_open``; beyond that
those of the hottest level are joined and cut), whatever the input's size. A partition is read in one order, so a task that runs again after a lost
executor gives the same windows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbline.llm.common import lean

#: The id after each document; the window size.
END_ID, WINDOW = 0, 1024
#: Open windows of a task (4 kB of ids each at most) beyond which the hottest level is recut.
MOST_OPEN = 1 << 14

# Code points whose classes all Unicode tables agree on since long; a text with any other
# goes to the slower encoder of the two.
_RARE = re.compile("[^\x00-\u024f\u0370-\u0373\u0391-\u03ce\u0400-\u052f\u2010-\u2027\u20ac\u3040-\u30ff\u4e00-\u9fa5]")


class Ids:
    """Token ids of texts as little-endian uint32 bytes, as the tokenizer file gives them.

    A byte-level vocabulary whose ids follow its merges is the same as a table of ranks; its
    texts are encoded by ranks, several times faster. Every other file, and texts with rare
    code points, go through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.ranks = self._ranks(json.load(f))

    @staticmethod
    def _ranks(spec: dict):
        import tiktoken
        from public_tokenizers import PATTERN

        model, split = spec["model"], spec["pre_tokenizer"] or {}
        own = {k: model.get(k) for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout")}
        if (model["type"], split.get("type"), split.get("add_prefix_space"), split.get("use_regex"), spec["normalizer"]) != (
                "BPE", "ByteLevel", False, True, None) or any(own.values()) or model.get("ignore_merges"):
            return None
        # Printable bytes stand for themselves, the others for code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            return None
        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def of(self, text: str) -> bytes:
        if self.ranks is None or _RARE.search(text):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.ranks.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


# One per worker process and file, so that later tasks find the cache warm.
_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


class Windows:
    """Online packing: ``level[h]`` counts the open windows filled to h."""

    def __init__(self, size: int, first_id: int, most_open: int = MOST_OPEN):
        self.size, self.next_id, self.most_open = size, first_id, most_open
        self.level = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]
        self.n_open = 0
        self.done: list[tuple] = []

    def _close(self, pieces: list) -> None:
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            self.done.append((key, start, n, zlib.crc32(ids), total, self.next_id, offset, ids))
            offset += n
        self.next_id += 1

    def add(self, key, ids: bytes) -> None:
        """Whole windows of a long document stand alone; its rest is placed by the rule."""
        total, full = len(ids) // 4, len(ids) // 4 // self.size * self.size
        for s in range(0, full, self.size):
            self._close([(key, s, ids[4 * s:4 * (s + self.size)], total)])
        if total > full:
            self.place([(key, full, ids[4 * full:], total)], total - full)
            if self.n_open > self.most_open:
                self.recut()

    def place(self, pieces: list, n: int) -> None:
        """Fill the level whose move gives the least sum of squared counts.

        Level 0 opens a window; a full window leaves the count. Ties go to the fullest level.
        """
        level, size = self.level, self.size
        low = level[:size - n + 1]
        cost = np.where(low > 0, 1 - 2 * low, 1 << 40)
        cost[0] = 0
        cost[:size - n] += 2 * level[n:size] + 1
        h = size - n - int(np.argmin(cost[::-1]))
        if h:
            pieces = self.open[h].pop() + pieces
            level[h] -= 1
            self.n_open -= 1
        if h + n == size:
            self._close(pieces)
        else:
            self.open[h + n].append(pieces)
            level[h + n] += 1
            self.n_open += 1

    def _hottest(self) -> list[int]:
        """The level with most open windows; further ones while it is too few to fill a window."""
        taken, windows, ids = [], 0, 0
        for h in np.lexsort((-np.arange(self.size + 1), -self.level)).tolist():
            taken.append(h)
            windows, ids = windows + int(self.level[h]), ids + h * int(self.level[h])
            if windows > 1 and ids >= self.size:
                break
        return taken

    def recut(self, last: bool = False) -> None:
        """Join open windows end to end and cut them anew: the hottest level's, or at the end all.

        The other levels stay as they are. What is left over is placed by the rule, or at the end
        becomes windows of powers of two, which need no padding.
        """
        levels = range(self.size + 1) if last else self._hottest()
        pieces = [p for h in levels for window in self.open[h] for p in window]
        for h in levels:
            self.n_open -= len(self.open[h])
            self.level[h], self.open[h] = 0, []
        run, n = [], 0
        rest = sum(len(p[2]) for p in pieces) // 4
        want = min(self.size, rest) if not last or rest >= self.size else 1 << (rest.bit_length() - 1)
        for key, start, ids, total in pieces:
            while ids:
                take = min(want - n, len(ids) // 4)
                run.append((key, start, ids[:4 * take], total))
                start, ids, n = start + take, ids[4 * take:], n + take
                if n == want:
                    rest -= n
                    if n == self.size or last:
                        self._close(run)
                    else:
                        self.place(run, n)
                    run, n = [], 0
                    if rest:
                        want = min(self.size, rest) if not last or rest >= self.size else 1 << (rest.bit_length() - 1)

    def taken(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in range(8)]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
    if with_ids:
        names.append("ids")
        flat = np.frombuffer(b"".join(cols[7]), dtype="<u4").astype(np.int32)
        ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in cols[7]])]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(docs: DataFrame, path: str, size: int = WINDOW, end_id: int = END_ID, with_ids: bool = True,
         most_open: int = MOST_OPEN) -> DataFrame:
    """Pack every document of (doc_id, text) into windows of at most ``size`` ids.

    A document's ids are those of the tokenizer file ``path`` without special tokens, then
    ``end_id``. One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, with ``with_ids``, ids. Null and empty texts give the end id alone; a null
    doc_id stays null; repeated rows are packed each; an empty table gives no rows; other
    columns are ignored. sequence_id is unique, ordered within a partition, and has gaps.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = None
        windows = Windows(size, TaskContext.get().partitionId() << 40, most_open)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids = ids or ids_of(path)
            # Text columns are turned into Python strings a slice at a time.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    windows.add(key, (ids.of(text) if text else b"") + end)
                if len(windows.done) >= 2000:
                    yield _batch(windows.taken(), with_ids)
        windows.recut(last=True)
        yield _batch(windows.taken(), with_ids)

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(lean(run), schema)
