"""An interpolated modified Kneser-Ney n-gram model over word hashes.

Counting: every task combines the n-grams of its texts and sends them to shards by the top
bits of their hash, packed as arrays. A shard sums its n-grams, writes them as sorted hash
arrays into the shared folder, and sends on what the next lower order counts (each different
n-gram once, without its first word) and what contexts need. A frequent word therefore
arrives as one entry per task. Scoring: workers map the arrays into memory and look up the
sorted n-grams of a batch of texts.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm import words
from plumbline.llm.common import lean, new_path, runs

#: Tokens that a task combines before it sends them; bytes of text for which there is a shard.
RUN_TOKENS, SHARD_BYTES = 3 << 20, 12 << 20

END, START = words.mix(np.array([0xE0D, 0x57A], dtype=np.uint64))
_STEPS = words.mix(np.arange(101, 117, dtype=np.uint64)) | np.uint64(1)


#: Top bits of an n-gram's hash that its context alone gives.
CONTEXT_BITS = 4


def keys_of(grams: list[np.ndarray]) -> np.ndarray:
    """Hash of n-grams given as one array per word; of single words, their own hash.

    The top bits come from the context, so that a context's n-grams meet in a sixteenth of the
    shards and share their entries there; the rest spreads a frequent context over all of those.
    """
    if len(grams) == 1:
        return grams[0]
    out = np.full(len(grams[0]), np.uint64(len(grams)), dtype=np.uint64)
    for g, s in zip(grams, _STEPS):
        out += g * s
    top = np.uint64(64 - CONTEXT_BITS)
    group = words.mix(keys_of(grams[:-1]) * _STEPS[-1] + np.uint64(len(grams))) >> top
    return (group << top) | (words.mix(out) >> np.uint64(CONTEXT_BITS))


def _sum_equal(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys, place of one row of each, summed rows of values)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], order[first], np.add.reduceat(values[order], first, axis=0) if len(key) else values


# ------------------------------------------------------------------ packed rows
ROWS = "name string, shard int, data binary, total long, types long, n1 long, n2 long, n3 long, n4 long"


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in range(9)]
    kinds = [pa.string(), pa.int32(), pa.binary(), *[pa.int64()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[
        "name", "shard", "data", "total", "types", "n1", "n2", "n3", "n4"])


def _coded(column: np.ndarray) -> bytes:
    """A column of hashes as its distinct values and small indexes into them."""
    values, index = np.unique(column, return_inverse=True)
    kind = np.uint16 if len(values) <= 1 << 16 else np.uint32
    return np.int64(len(values)).tobytes() + values.tobytes() + index.astype(kind).tobytes()


def _packed(name: str, shift: int, key: np.ndarray, grams: list[np.ndarray], values: np.ndarray) -> Iterator[tuple]:
    """One row per shard: columns of words, then of values, sorted to compress well."""
    shard = (key >> np.uint64(shift)).astype(np.int64)
    order = np.lexsort((*reversed(grams), shard))
    shard = shard[order]
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for a, b in zip(first, np.append(first[1:], len(shard))):
        at = order[a:b]
        words_ = [g[at] for g in grams]
        # The first column is sorted, which the shuffle's compression makes use of.
        coded = [words_[0].tobytes(), *map(_coded, words_[1:])]
        columns = [values[at, i].astype(np.int64).tobytes() for i in range(values.shape[1])]
        yield (name, int(shard[a]), b"".join([np.int64(b - a).tobytes(), *coded, *columns]), 0, 0, 0, 0, 0, 0)


def _unpacked(data: bytes, n_words: int, n_values: int) -> tuple[list[np.ndarray], np.ndarray]:
    at = 8

    def take(kind, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype=kind, count=n, offset=at)
        at += out.nbytes
        return out

    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    grams = []
    for i in range(n_words):
        if not i:
            grams.append(take(np.uint64, n))
        else:
            m = int(take(np.int64, 1)[0])
            values = take(np.uint64, m)
            grams.append(values[take(np.uint16 if m <= 1 << 16 else np.uint32, n)])
    return grams, np.stack([take(np.int64, n) for _ in range(n_values)], axis=1)


def _joined(group: pa.Table, n_words: int, n_values: int) -> tuple[list[np.ndarray], np.ndarray]:
    parts = [_unpacked(x.as_py(), n_words, n_values) for x in group["data"]]
    return ([np.concatenate([p[0][i] for p in parts]) for i in range(n_words)], np.concatenate([p[1] for p in parts]))


# ----------------------------------------------------------------- array files
def _put(where: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays under final names; a task that runs again writes the same once more."""
    fs, path = pafs.FileSystem.from_uri(where)
    fs.create_dir(path)
    for part, array in arrays.items():
        held = f"{path}/_{name}.{part}.{os.getpid()}"
        with fs.open_output_stream(held) as out:
            out.write(np.ascontiguousarray(array).tobytes())
        fs.move(held, f"{path}/{name}.{part}")


def _get(where: str, name: str, dtype) -> np.ndarray:
    """Map an array file; one that is not on a mounted disk is copied, mapped and unlinked."""
    fs, path = pafs.FileSystem.from_uri(where)
    path = f"{path}/{name}"
    info = fs.get_file_info(path)
    if not info.size:
        return np.zeros(0, dtype=dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r")
    with tempfile.NamedTemporaryFile() as own, fs.open_input_stream(path) as source:
        while block := source.read(8 << 20):
            own.write(block)
        own.flush()
        return np.memmap(own.name, dtype=dtype, mode="r")


# -------------------------------------------------------------------- counting
def _tokens(batch: pa.RecordBatch, order: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, tokens, place of each text's first start mark).

    Every text is order - 1 start marks, its words and an end mark.
    """
    for row, to, data, starts in words.slices(batch):
        found, counts = words.hashes(data, starts)
        pad = order - 1
        lengths = counts + pad + 1
        begins = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(begins[-1], END, dtype=np.uint64)
        for k in range(pad):
            out[begins[:-1] + k] = START
        text = np.repeat(np.arange(to - row), counts)
        out[np.arange(len(found)) + text * (pad + 1) + pad] = found
        yield row, to, out, begins


def _grams(tokens: np.ndarray, begins: np.ndarray, order: int, size: int) -> list[np.ndarray]:
    """The n-grams of ``size`` words that end at each token that is not a start mark."""
    real = np.ones(len(tokens), dtype=bool)
    for k in range(order - 1):
        real[begins[:-1] + k] = False
    at = np.flatnonzero(real)
    return [tokens[at - size + 1 + k] for k in range(size)]


def _count(order: int, shift: int):
    def flush(held):
        grams = [np.concatenate([h[i] for h in held]) for i in range(order)]
        held.clear()
        for name, parts in ((f"g{order}", grams), ("w", grams[-1:])):
            key, at, n = np.unique(keys_of(parts), return_index=True, return_counts=True)
            rows = _packed(name, shift, key, [p[at] for p in parts], n[:, None])
            while some := list(islice(rows, 16)):
                yield _row_batch(some)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for _, _, tokens, begins in _tokens(batch, order):
                held.append(_grams(tokens, begins, order, order))
                n += len(held[-1][0])
                if n >= RUN_TOKENS:
                    yield from flush(held)
                    n = 0
        if held:
            yield from flush(held)

    return run


def _numbers(name: str, counts: np.ndarray) -> tuple:
    return (name, -1, None, int(counts.sum()), len(counts), *[int((counts == k).sum()) for k in range(1, 5)])


def _reduce(where: str, shift: int):
    """Sum the rows of each (name, shard), write its arrays, send on what follows from it."""
    def counted(name, shard, group):
        size = int(name[1:]) if name[0] == "g" else 1
        grams, values = _joined(group, size, 1)
        key, at, n = _sum_equal(keys_of(grams), values)
        n, grams = n[:, 0], [g[at] for g in grams]
        large = np.flatnonzero(n >= 255)
        _put(where, f"{name}-{shard}", {"key": key, "n": np.minimum(n, 255).astype(np.uint8),
                                        "at": large.astype(np.uint32), "large": n[large]})
        out = [_numbers(name, n)]
        if size > 1:
            ctx, at, sums = _sum_equal(keys_of(grams[:-1]), np.stack([n, n == 1, n == 2, n > 2], axis=1).astype(np.int64))
            out += _packed(f"c{size}", shift, ctx, [ctx], sums)
            lower = grams[1:]
            key, at, n = _sum_equal(keys_of(lower), np.ones((len(n), 1), dtype=np.int64))
            out += _packed(f"g{size - 1}", shift, key, [g[at] for g in lower], n)
        return out

    def run(batches):
        for group in runs(batches, ["name", "shard"]):
            name, shard = group["name"][0].as_py(), group["shard"][0].as_py()
            if shard < 0:
                yield from group.to_batches()
            elif name[0] == "c":
                (ctx,), values = _joined(group, 1, 4)
                ctx, _, sums = _sum_equal(ctx, values)
                wide = sums.max(initial=0) >= 1 << 32
                _put(where, f"{name}-{shard}", {"key": ctx, "sums8" if wide else "sums4": sums.astype(np.int64 if wide else np.uint32)})
                yield _row_batch([])
            else:
                yield _row_batch(counted(name, shard, group))

    return run


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and per table the totals and counts of counts."""

    where: str
    order: int
    shift: int
    numbers: dict[str, tuple[int, ...]]

    @property
    def train_tokens(self) -> int:
        return self.numbers.get("w", (0,))[0]

    @property
    def distinct_tokens(self) -> int:
        return self.numbers.get("w", (0, 0))[1]

    def discounts(self, name: str) -> np.ndarray:
        """Discounts of counts 0, 1, 2 and 3 or more; each lies within a tenth and the count."""
        _, _, n1, n2, n3, n4 = self.numbers.get(name, (0,) * 6)
        y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.5
        d = [0.0]
        for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
            d.append(min(k, max(0.1, k - (k + 1) * y * b / a)) if a else 0.5 * k)
        return np.array(d)


def train(docs: DataFrame, order: int = 2) -> Model:
    """Count the whole texts of ``docs`` into a model of the given order (2 or more).

    Null texts count as empty; every row is a text of its own, ended by a mark; no rows give a
    model that knows no word.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    where = new_path(spark, "ngrams")
    text = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(CONTEXT_BITS, int(size // SHARD_BYTES).bit_length())
    rows = text.mapInArrow(lean(_count(order, 64 - bits)), ROWS)
    # Order by order downward; the last round reduces contexts of the bigrams.
    for _ in range(order):
        rows = rows.repartition(1 << bits, "name", "shard").sortWithinPartitions("name", "shard").mapInArrow(
            lean(_reduce(where, 64 - bits)), ROWS)
    sums = ["total", "types", "n1", "n2", "n3", "n4"]
    found = rows.where("shard < 0").groupBy("name").agg(*[F.sum(c).alias(c) for c in sums]).collect()
    return Model(where, order, 64 - bits, {r["name"]: tuple(r[c] for c in sums) for r in found})


# --------------------------------------------------------------------- scoring
class Tables:
    """The arrays of a model, mapped when first used."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def _shard(self, name: str, shard: int) -> tuple:
        if (name, shard) not in self.open:
            get = lambda part, dtype: _get(self.model.where, f"{name}-{shard}.{part}", dtype)
            if name[0] == "c":
                small, wide = get("sums4", np.uint32), get("sums8", np.int64)
                self.open[name, shard] = get("key", np.uint64), (small if len(small) else wide).reshape(-1, 4)
            else:
                self.open[name, shard] = (get("key", np.uint64), get("n", np.uint8), get("at", np.uint32), get("large", np.int64))
        return self.open[name, shard]

    def find(self, name: str, keys: np.ndarray) -> np.ndarray:
        """Counts (or context sums) of sorted keys; 0 for keys that training did not see."""
        wide = (4,) if name[0] == "c" else ()
        out = np.zeros((len(keys), *wide), dtype=np.int64)
        shard = (keys >> np.uint64(self.model.shift)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(keys) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
            have, n, *large = self._shard(name, int(shard[a]))
            if not len(have):
                continue
            at = np.searchsorted(have, keys[a:b])
            at[at == len(have)] = 0
            hit = have[at] == keys[a:b]
            got = np.zeros((b - a, *wide), dtype=np.int64)
            got[hit] = n[at[hit]]
            if large and len(large[0]):
                full = np.flatnonzero(got == 255)
                got[full] = large[1][np.searchsorted(large[0], at[full])]
            out[a:b] = got
        return out


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def token_scores(tables: Tables, tokens: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log10 probability, base log10 probability, training count) of every token but start marks."""
    model = tables.model
    word = _grams(tokens, begins, model.order, 1)[0]
    distinct, back = _unique(word)
    count = tables.find("w", distinct)
    vocabulary = model.distinct_tokens
    base = np.log10((count + 0.5) / (model.train_tokens + 0.5 * (vocabulary + 1)))
    d = model.discounts("g1")
    total, _, n1, n2, *_ = model.numbers.get("g1", (0,) * 6)
    if total:
        types = model.numbers["g1"][1]
        seen = tables.find("g1", distinct)
        spare = d[1] * n1 + d[2] * n2 + d[3] * (types - n1 - n2)
        p = (np.maximum(seen - d[np.minimum(seen, 3)], 0) + spare / (vocabulary + 1)) / total
    else:
        p = np.full(len(distinct), 1 / (vocabulary + 1))
    p = p[back]
    for size in range(2, model.order + 1):
        grams = _grams(tokens, begins, model.order, size)
        d = model.discounts(f"g{size}")
        key, at = _unique(keys_of(grams))
        n = tables.find(f"g{size}", key)
        kept = np.maximum(n - d[np.minimum(n, 3)], 0)[at]
        ctx, at = _unique(keys_of(grams[:-1]))
        sums = tables.find(f"c{size}", ctx)
        held, spare = sums[:, 0][at], (sums[:, 1:] @ d[1:])[at]
        known = held > 0
        p[known] = (kept[known] + spare[known] * p[known]) / held[known]
    return np.log10(p), base[back], count[back]


def score(docs: DataFrame, model: Model, *keys: str) -> DataFrame:
    """(keys, n_tokens, n_known, base_score, score) of every whole text.

    score is the model's log10 probability of the text and its end mark, base_score that of
    single tokens with half a count added. Null texts count as empty, which leaves the end
    mark; repeated rows score alike; an empty table gives no rows.
    """
    kept = docs.select(*keys, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        tables = Tables(model)
        for batch in batches:
            parts = []
            for _, _, tokens, begins in _tokens(batch, model.order):
                log, base, count = token_scores(tables, tokens, begins)
                at = begins[:-1] - np.arange(len(begins) - 1) * (model.order - 1)
                add = lambda x: np.add.reduceat(x, at)
                parts.append((np.diff(np.append(at, len(log))), add((count > 0).astype(np.int64)), add(base), add(log)))
            cols = [np.concatenate(c) for c in zip(*parts)] if parts else [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=[*keys, "n_tokens", "n_known", "base_score", "score"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    return kept.mapInArrow(lean(run), f"{names}, n_tokens long, n_known long, base_score double, score double")


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds
