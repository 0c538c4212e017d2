"""Byte-level BPE by tree reduction, and back.

Token lists form a monoid: two neighbours are joined by encoding a window around their boundary
anew, and the window grows until the tokens outside can no longer change. That is proven by a
property of the merge order: a list of tokens is the encoding of its bytes exactly if every two
neighbours, encoded alone, stay as they are. (Until a merge first crosses a boundary the two
sides go through the same states as in the pair alone, so it would cross there too.) A match of
the pattern is halved down to short leaves, whose merges are done one by one, and reduced up the
tree. Decoding concatenates bytes up the tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import lean, texts_of

#: Bytes of a leaf; tokens on each side of a boundary that are encoded anew at first.
LEAF, REACH = 32, 2
#: Entries of the caches of words (a generation) and of pairs; characters of the longest word that is kept.
MOST, LONGEST = 400_000, 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a token in base64 and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


# -------------------------------------------------------------------- matches
#: Classes of code points: others, letters, numbers, spaces.
OTHER, LETTER, NUMBER, SPACE = range(4)
# Endings that belong to an apostrophe, s t m d re ve ll; column 0 for single letters.
ENDINGS = np.zeros((128, 128), dtype=bool)
for _ending in ("s\0", "t\0", "m\0", "d\0", "re", "ve", "ll"):
    ENDINGS[ord(_ending[0]), ord(_ending[1])] = True


def _class_table() -> np.ndarray:
    """The class of every code point, as the library's own pattern engine has it.

    Unicode tables differ between engines, so the library is asked about every code point.
    """
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    table = np.zeros(0x110000, dtype=np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        members = bytes(tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(members.decode().encode("utf-32-le"), dtype=np.uint32)] = kind
    return table


class Matches:
    """Matches of ``public_tokenizers.PATTERN``, by classes of code points instead of a scan.

    Runs of one class are matches; the last space before a run belongs to it if it is an
    ordinary one and else stands alone; a lone apostrophe without a space before it takes the
    endings s, t, re, ve, m, ll and d from the letters behind it.
    """

    def __init__(self) -> None:
        self.table = _class_table()

    def starts(self, codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """First code points of the matches of texts laid end to end; ``texts`` holds their starts.

        No text is empty; two code points that belong to none follow the last one.
        """
        kind = self.table[codes]
        first = np.empty(len(codes), dtype=bool)
        first[1:] = kind[1:] != kind[:-1]
        first[texts] = first[-2] = True
        run = np.flatnonzero(first[:-2])
        opening = np.zeros(len(codes), dtype=bool)
        opening[texts] = opening[-2] = True
        behind = run[(kind[run] != SPACE) & ~opening[run]]
        behind = behind[kind[behind - 1] == SPACE]
        first[behind - 1] = True
        first[behind] = codes[behind - 1] != 32
        alone = np.flatnonzero((codes[:-2] == 39) & first[:-2])
        alone = alone[(kind[alone + 1] == LETTER) & ~opening[alone + 1]]
        one, two = codes[alone + 1], np.where(opening[alone + 2], 0, codes[alone + 2])
        size = np.where(ENDINGS[np.minimum(one, 127), 0], 2, 0)
        size[ENDINGS[np.minimum(one, 127), np.minimum(two, 127)] & (two > 0)] = 3
        alone, size = alone[size > 0], size[size > 0]
        first[alone + 1] = False
        first[alone + size] = True
        return np.flatnonzero(first[:-2])

    def findall(self, texts: list[str]) -> tuple[list[str], list[int]]:
        """The matches of all texts, one after another, and how many each text has."""
        size = np.array([len(t) for t in texts], dtype=np.int64)
        flat = "".join(texts)
        if not flat:
            return [], [0] * len(texts)
        codes = np.frombuffer((flat + "\0\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum(size)
        at = self.starts(codes, (ends - size)[size > 0])
        cuts = np.searchsorted(at, np.append(0, ends)).tolist()
        at = at.tolist()
        return [flat[a:b] for a, b in zip(at, [*at[1:], len(flat)])], [b - a for a, b in zip(cuts, cuts[1:])]


# -------------------------------------------------------------------- merges
class Pairs:
    """The token that two neighbours merge into, in a table that is looked up for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.none = max(ranks.values(), default=0) + 1
        found = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    found[a * self.none + b] = rank
        bits = max(4, (8 * len(found)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.key, self.value = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, self.none, dtype=np.int64)
        keys = np.fromiter(found.keys(), dtype=np.int64, count=len(found))
        values = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        slot = self._slot(keys)
        # Of the keys that want a slot one gets it, the others go on to the next.
        while len(keys):
            free = self.key[slot] < 0
            self.key[slot[free]] = keys[free]
            done = self.key[slot] == keys
            self.value[slot[done]] = values[done]
            keys, values, slot = keys[~done], values[~done], (slot[~done] + 1) & (len(self.key) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Ranks of merged pairs; ``none`` where a pair does not merge."""
        keys = one * self.none + two
        slot = self._slot(keys)
        held = self.key[slot]
        out = np.where(held == keys, self.value[slot], self.none)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.key) - 1)
            held = self.key[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.value[slot[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Merges:
    """Encoding of byte strings by ranks: leaves, joins, the tree."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF, reach: int = REACH):
        self.ranks, self.leaf, self.reach = ranks, max(1, leaf), max(1, reach)
        self.bytes_of = [b""] * (1 + max(ranks.values(), default=-1))
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.single < 0).any():
            raise ValueError("a byte has no rank")
        self.pairs = Pairs(ranks)
        self.known: dict[tuple[int, int], bool] = {}

    def leaves(self, parts: list[bytes]) -> list[list[int]]:
        """Tokens of short byte strings, all walked together.

        Each round merges in every string the pair of lowest rank, the first of equal ones.
        """
        out: list[list[int]] = [[]] * len(parts)
        size = np.array([len(p) for p in parts], dtype=np.int64)
        for low, high in ((0, 4), (4, 8), (8, 16), (16, max(17, int(size.max(initial=0))))):
            which = np.flatnonzero((size > low) & (size <= high))
            for at in range(0, len(which), 1 << 14):
                rows = which[at:at + (1 << 14)].tolist()
                for i, ids in zip(rows, self._leaves([parts[i] for i in rows])):
                    out[i] = ids
        return out

    def _leaves(self, parts: list[bytes]) -> list[list[int]]:
        size = np.array([len(p) for p in parts], dtype=np.int64)
        n, width, none = len(parts), int(size.max()), self.pairs.none
        alive = np.arange(width) < size[:, None]
        token = np.full((n, width + 1), -1, dtype=np.int64)
        token[:, :width][alive] = self.single[np.frombuffer(b"".join(parts), dtype=np.uint8)]
        following = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        rank = np.full((n, width + 1), none, dtype=np.int64)
        row, col = np.nonzero(alive[:, 1:])
        rank[row, col] = self.pairs.of(token[row, col], token[row, col + 1])
        row = np.arange(n)
        while True:
            at = rank[row].argmin(axis=1)
            low = rank[row, at]
            on = low < none
            row, at, low = row[on], at[on], low[on]
            if not len(row):
                break
            gone = following[row, at]
            after = following[row, gone]
            token[row, at], token[row, gone] = low, -1
            rank[row, at] = rank[row, gone] = none
            following[row, at] = after
            inside = np.flatnonzero(after < size[row])
            r, a, f = row[inside], at[inside], after[inside]
            before[r, f] = a
            rank[r, a] = self.pairs.of(token[r, a], token[r, f])
            left = before[row, at]
            inside = np.flatnonzero(left >= 0)
            r, a, f = row[inside], at[inside], left[inside]
            rank[r, f] = self.pairs.of(token[r, f], token[r, a])
        flat = token[token >= 0].tolist()
        ends = np.cumsum((token >= 0).sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merged(self, data: bytes) -> list[int]:
        """Tokens of bytes by merging the pair of lowest rank, the first of equal ones, until none is left."""
        if len(data) > 2 * self.leaf:
            return self._merged_long(data)
        rank, none = self.ranks.get, self.pairs.none
        parts = [data[i:i + 1] for i in range(len(data))]
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            at = pairs.index(low)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, for long windows."""
        rank, n = self.ranks.get, len(data)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, to = heapq.heappop(heap)
            # Stale unless the part at ``at`` lives and it and the next one end where the pair did.
            middle = end[at]
            if middle < 0 or middle >= n or end[middle] != to:
                continue
            end[at], end[middle] = to, -1
            if to < n:
                before[to] = at
                if (r := rank(data[at:end[to]])) is not None:
                    heapq.heappush(heap, (r, at, end[to]))
            if (left := before[at]) >= 0 and (r := rank(data[left:to])) is not None:
                heapq.heappush(heap, (r, left, to))
        out, at = [], 0
        while at < n:
            out.append(self.ranks[data[at:end[at]]])
            at = end[at]
        return out

    def apart(self, one: int, two: int) -> bool:
        """Two neighbouring tokens that stay as they are when encoded alone."""
        found = self.known.get((one, two))
        if found is None:
            if len(self.known) > MOST:
                self.known.clear()
            found = self.known[one, two] = self.merged(self.bytes_of[one] + self.bytes_of[two]) == [one, two]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes from their encodings; ``left`` is used up."""
        if not left or not right:
            return left + right
        a, b = min(self.reach, len(left)), min(self.reach, len(right))
        while True:
            middle = self.merged(b"".join([self.bytes_of[t] for t in chain(left[-a:], right[:b])]))
            still_left = a == len(left) or self.apart(left[-a - 1], middle[0])
            still_right = b == len(right) or self.apart(middle[-1], right[b])
            if still_left and still_right:
                left[-a:] = middle
                left += right[b:]
                return left
            a = a if still_left else min(2 * a, len(left))
            b = b if still_right else min(2 * b, len(right))

    def tree(self, data: bytes) -> list[int]:
        """The encoding of bytes: halves down to leaves, joined on the way up."""
        if len(data) <= self.leaf:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def of_matches(self, parts: list[bytes]) -> list[list[int]]:
        """Tokens of matches of the pattern: a token of its own if it is one, else the tree's."""
        out = [[whole] if (whole := self.ranks.get(p)) is not None else None for p in parts]
        short = [i for i, p in enumerate(parts) if out[i] is None and len(p) <= self.leaf]
        for i, ids in zip(short, self.leaves([parts[i] for i in short])):
            out[i] = ids
        return [self.tree(p) if ids is None else ids for p, ids in zip(parts, out)]


class Codec:
    """Ids of texts, and bytes of ids, by one file of ranks."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF, reach: int = REACH):
        self.merges, self.matches = Merges(ranks, leaf, reach), Matches()
        self.words: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}
        self.shown = [str(i) for i in range(len(self.merges.bytes_of))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts. Words are kept in two generations, so that frequent ones outlive a full cache."""
        words, counts = self.matches.findall(texts)
        if len(self.words) > MOST:
            self.old, self.words = self.words, {}
        new = []
        for w in set(words).difference(self.words):
            if w in self.old:
                self.words[w] = self.old[w]
            else:
                new.append(w)
        found = self.merges.of_matches([w.encode("utf-8", "surrogatepass") for w in new])
        self.words.update(zip(new, found))
        ids = map(self.words.__getitem__, words)
        out = [list(chain.from_iterable(islice(ids, n))) for n in counts]
        for w in new:
            if len(w) > LONGEST:
                del self.words[w]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids, concatenated up the tree."""
        token = self.merges.bytes_of.__getitem__
        parts = [b"".join(map(token, ids[i:i + 1024])) for i in range(0, len(ids), 1024)]
        while len(parts) > 1:
            parts = [b"".join(parts[i:i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


# One per worker process and file, so that later tasks find the cache warm.
_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS.clear()
        _CODECS[path] = Codec(load_ranks(path))
    return _CODECS[path]


def _slices(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``size`` bytes of text, a longer text by itself."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("__text")), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _fields(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)


def encode(docs: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, ids) of every whole text by the ranks in ``path``, without special tokens.

    Each match of ``public_tokenizers.PATTERN`` is encoded by itself. Null and empty texts give an empty list; keys may be null and
    rows may repeat; an empty table gives no rows; other columns are ignored.
    """
    own = docs.select(*keys)

    def run(batches):
        codec = _codec(path)
        for batch in batches:
            for part in _slices(batch):
                ids = codec.encode(texts_of(part, "__text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids, pa.list_(pa.int32()))], names=[*keys, "ids"])

    return docs.select(*keys, F.col("text").cast("string").alias("__text")).mapInArrow(lean(run), f"{_fields(own)}ids array<int>")


def decode(table: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, data): the bytes of each list of ``ids``.

    Null and empty lists give no bytes; a list with a null or an id that the file lacks gives null.
    """
    own = table.select(*keys)

    def run(batches):
        codec = _codec(path)
        known = set(codec.merges.ranks.values())
        for batch in batches:
            lists = [x or [] for x in batch.column("__ids").to_pylist()]
            data = [codec.decode(x) if known >= set(x) else None for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(data, pa.binary())], names=[*keys, "data"])

    return table.select(*keys, F.col("ids").alias("__ids")).mapInArrow(lean(run), f"{_fields(own)}data binary")


def round_trip(docs: DataFrame, path: str, *keys: str) -> DataFrame:
    """(keys, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    The digests are those of the decimal ids joined by commas and of the bytes that the ids
    decode to. Edge cases as in :func:`encode`.
    """
    own = docs.select(*keys)

    def run(batches):
        codec = _codec(path)
        for batch in batches:
            for part in _slices(batch):
                count, first, second = [], [], []
                for ids in codec.encode(texts_of(part, "__text")):
                    count.append(len(ids))
                    first.append(hashlib.sha256(",".join(map(codec.shown.__getitem__, ids)).encode()).hexdigest())
                    second.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(count, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                    names=[*keys, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(*keys, F.col("text").cast("string").alias("__text")).mapInArrow(
        lean(run), f"{_fields(own)}n_tokens long, ids_sha256 string, decoded_sha256 string")
