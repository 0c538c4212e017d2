"""Phrases of a table of any length, looked up in texts by hashes of their letters.

An automaton over all phrases grows with their number. Here a table of bits says which hashes some
phrase has: a text's letters are read once, and at each of them the beginnings of 1, 2, 4, 8 ... letters
are tried while they pass, then the whole phrases of every size below the next beginning. What comes out
is a key per phrase, for a join. No phrase is missed; a key may be there by chance, so its texts are to
be looked through again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.sources.phrases import phrase_letters, text_letters

# Bits of the table for each hash, as powers of two at least and at most. A hash sets PROBES bits of one block.
PER_KEY, LEAST_BITS, MOST_BITS, BLOCK_BITS, PROBES = 32, 18, 29, 9, 4
# Tables are made in parts of so many bits, as a power of two.
PART_BITS = 19
#: Letters that are hashed at once.
SLICE = 1_000_000

_BASE, _SIZE = 0x9E3779B97F4A7C15, np.uint64(0xD1B54A32D192ED03)
_ENDS = np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base, and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


class Letters:
    """Some letters whose stretches, whatever their size, are hashed from two running sums."""

    def __init__(self, letters: str):
        self.codes = np.frombuffer(letters.encode("utf-32-le"), np.uint32)
        power, self.back = _powers(max(20, len(self.codes).bit_length()))
        self.sums = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(self.codes * power[:len(self.codes)], out=self.sums[1:])

    def keys(self, at: np.ndarray, size: int | np.ndarray, whole: bool) -> np.ndarray:
        """Keys of the stretches that start at these places, as whole phrases or as beginnings of longer ones."""
        own = (self.sums[at + size] - self.sums[at]) * self.back[at]
        return _mixed(own + np.asarray(size).astype(np.uint64) * _SIZE + (_ENDS if whole else np.uint64(0)))


def _bits(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits that keys have in a table, all of a key in one block."""
    block = (keys >> np.uint64(64 - bits + BLOCK_BITS)) << np.uint64(BLOCK_BITS)
    for probe in range(PROBES):
        yield block | ((keys >> np.uint64(probe * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1))


class Asked:
    """Which phrases may stand in some letters, by a table of bits and the sizes of the phrases."""

    def __init__(self, table: bytes, sizes: Sequence[int]):
        self.table, self.sizes = np.frombuffer(table, np.uint8), sorted(sizes)
        self.bits = len(self.table).bit_length() + 2
        every = np.arange(0x110000, dtype=np.uint64)
        # A single letter's hash is the letter.
        self.first = self._has(_mixed(every + _SIZE))

    def _has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for bit in _bits(keys, self.bits):
            found &= (self.table[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    def found(self, letters: str) -> tuple[np.ndarray, np.ndarray]:
        """(place, key) of what may be a phrase."""
        text = Letters(letters)
        at, begun, out = np.flatnonzero(self.first[text.codes]), 1, []
        while len(at) and begun <= self.sizes[-1]:
            if begun > 1:
                at = at[at + begun <= len(text.codes)]
                at = at[self._has(text.keys(at, begun, False))]
            for size in self.sizes:
                if begun <= size < 2 * begun:
                    here = at[at + size <= len(text.codes)]
                    keys = text.keys(here, size, True)
                    passed = self._has(keys)
                    out.append((here[passed], keys[passed]))
            begun *= 2
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        places, keys = zip(*out)
        return np.concatenate(places), np.concatenate(keys)


def _sliced(texts: Sequence[str], reach: int) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of texts and their letters, about SLICE letters at a time; pieces of a long text overlap by ``reach``."""
    numbers, pieces, held = [], [], 0
    for number, text in enumerate(texts):
        for low in range(0, len(text), SLICE):
            piece = text[low:low + SLICE + reach]
            if pieces and held + len(piece) >= SLICE:
                yield numbers, pieces
                numbers, pieces, held = [], [], 0
            numbers.append(number)
            pieces.append(piece)
            held += len(piece) + 1
    if pieces:
        yield numbers, pieces


def phrase_keys(specs: DataFrame, spec: str, phrases: str) -> DataFrame:
    """(_spec, _key, _size) of each phrase of each row; and the keys of their beginnings, with a null ``_spec``.

    A phrase without a word has size 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, texts = batch.column(0).to_numpy(), [phrase_letters(p) for p in batch.column(1).to_pylist()]
            lengths = np.array([len(t) for t in texts], np.int64)
            none = np.flatnonzero(lengths == 0)
            whole, begun = [(none, np.zeros(len(none), np.uint64), lengths[none])], []
            part = np.where(lengths > 0, (np.cumsum(lengths) - lengths) // SLICE, -1)
            for number in np.unique(part[part >= 0]):
                own = np.flatnonzero(part == number)
                letters, sizes = Letters("".join([texts[n] for n in own])), lengths[own]
                at = np.cumsum(sizes) - sizes
                whole.append((own, letters.keys(at, sizes, True), sizes))
                size = 1
                while (longer := at[sizes >= size]).size:
                    begun.append(np.unique(letters.keys(longer, size, False)))
                    size *= 2
            numbers, keys, sizes = (np.concatenate(x) for x in zip(*whole))
            starts = np.unique(np.concatenate(begun)) if begun else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(owners[numbers], pa.int64()), pa.nulls(len(starts), pa.int64())]),
                pa.array(np.concatenate([keys, starts]).view(np.int64)),
                pa.array(np.concatenate([sizes, np.zeros(len(starts), np.int64)]).astype(np.int32)),
            ], names=["_spec", "_key", "_size"])

    return specs.select(F.col(spec).cast("long"), F.explode(phrases)).mapInArrow(run, "_spec long, _key long, _size int")


def asked(keys: DataFrame) -> Asked | None:
    """What rows of ``phrase_keys`` ask for; None without a phrase."""
    some = keys.where("_spec is null or _size > 0")
    about, sizes = some.agg(F.approx_count_distinct("_key"), F.collect_set(F.when(F.col("_spec").isNotNull(), F.col("_size")))).first()
    if not sizes:
        return None
    bits = min(MOST_BITS, max(LEAST_BITS, (PER_KEY * about).bit_length()))
    part_bits = min(bits, PART_BITS)
    part = F.shiftrightunsigned("_key", 64 - bits + part_bits) if bits > part_bits else F.lit(0).cast("long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            numbers, found = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for number in np.unique(numbers).tolist():
                table = own.setdefault(number, np.zeros(1 << part_bits - 3, np.uint8))
                for bit in _bits(found[numbers == number], bits):
                    bit &= np.uint64((1 << part_bits) - 1)
                    np.bitwise_or.at(table, bit >> np.uint64(3), np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8))
        if own:
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([t.tobytes() for t in own.values()], pa.binary())], names=["part", "bits"])

    table = bytearray(1 << bits - 3)
    placed = some.select(part.alias("part"), "_key").distinct().repartition("part").sortWithinPartitions("part")
    for row in placed.mapInArrow(run, "part long, bits binary").collect():
        start = row["part"] << part_bits - 3
        table[start:start + len(row["bits"])] = row["bits"]
    return Asked(bytes(table), sizes)


def near_phrases(docs: DataFrame, wanted: Asked) -> DataFrame:
    """The rows whose texts, in the last column, may hold some phrase, with the keys of those phrases as ``_keys``."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = held.value
        for batch in batches:
            letters = [text_letters(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            rows, keys = [], []
            for numbers, pieces in _sliced(letters, search.sizes[-1] - 1):
                starts = np.array(list(accumulate((len(p) + 1 for p in pieces), initial=0)))
                place, key = search.found("\0".join(pieces))
                rows.append(np.array(numbers)[np.searchsorted(starts, place, "right") - 1])
                keys.append(key)
            row, key = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows, keys))
            if not len(row):
                continue
            order = np.lexsort((key, row))
            row, key = row[order], key[order]
            first = np.ones(len(row), bool)
            first[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            row, key = row[first], key[first]
            numbers, starts = np.unique(row, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array([*starts.tolist(), len(row)], pa.int32()), pa.array(key.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(numbers)) for c in batch.columns), lists], names=[*batch.schema.names, "_keys"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_keys", T.ArrayType(T.LongType()))]))
