"""Set-similarity join on word shingles with signature trees.

Texts with equal shingle sets share a *node*, so copies cost nothing further. Of each set the
smallest hashes are taken, as many as a set of 0.8 similarity must share ``c`` of; a node
whose share of hashes that occur elsewhere is too small links with nothing, and most end
there. What is left is grouped into blocks that share a rare hash. Inside a block, or between
two chunks of a large one, signature trees are walked against each other: every tree node
holds the OR of its members' bitmaps and their range of sizes, and pairs of tree nodes whose
largest possible overlap is too small are dropped whole. What reaches the leaves is verified
on the whole sets. The result is exact: no candidate, bucket or partner is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plumbline.llm import words
from plumbline.llm.common import EDGES, components, drop_written, edge_batch, lean, runs, written

#: Similarity as a fraction, words in a shingle.
TIMES, OUT_OF, WORDS = 80, 100, 5
#: Share of a set that the longer prefix adds; members and bytes of a chunk.
SLACK, CHUNK_NODES, CHUNK_BYTES = 10, 1024, 8 << 20
#: Bits of the filter per candidate, and at least and at most (32 MB, which 16 million candidates fill).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 28
#: Ways a large block is dealt into chunks at random before its chunks meet in pairs.
PASSES = 2
#: A hash is common in a cell where more than one in so many of its sets hold it; a cell's common
#: hashes are no more than so many of its sets hold (3 % of a full chunk).
COMMON = 32
#: Hashes a task combines before it sends them; bytes of bitmaps that are compared at a time.
RUN_HASHES, BITMAP_BYTES = 400_000, 4 << 20


def _up(n: np.ndarray | int, times: int, out_of: int):
    return -(-n * times // out_of)


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of the texts of a batch."""
    for row, _, data, starts in words.slices(batch):
        found, counts = words.hashes(data, starts)
        for i, part in enumerate(np.split(found, np.cumsum(counts)[:-1])):
            yield row + i, np.unique(words.shingles(part, size))


def _node(shingle_set: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingle_set.tobytes(), digest_size=8).digest(), "little", signed=True)


def _need(n: int, slack: int = SLACK, times: int = TIMES, out_of: int = OUT_OF) -> tuple[int, int]:
    """(prefix length, shared hashes needed) of a set of n.

    A partner shares at least s = ceil(0.8 n) hashes, so the n - s + c smallest of both hold c
    in common. c follows the smaller set of a pair, which has at least 0.8 n.
    """
    least = _up(n, times, out_of)
    return min(n, n - least + _up(n, slack, 100)), max(1, _up(least, slack, 100))


def documents(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, node) per row; node is null for texts without words."""
    def run(batches):
        for batch in batches:
            n, node = [], []
            for _, s in _sets(batch, size):
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64())],
                names=["doc_id", "n_shingles", "node"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, n_shingles long, node long")


def _prefix_rows(size: int):
    """Rows (key, node, n, k) of the prefixes, combined before the shuffle.

    A hash that several nodes of a run of texts hold is known to be shared: the nodes count it
    here (rows with k > 0) and one row with k = -1 tells the others. So a hash sends one row per
    run, however many texts hold it.
    """
    def flush(token, node, n):
        token, node, n = np.concatenate(token), np.concatenate(node), np.concatenate(n)
        order = np.lexsort((node, token))
        token, node, n = token[order], node[order], n[order]
        keep = np.ones(len(token), dtype=bool)
        keep[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, n = token[keep], node[keep], n[keep]
        first = np.ones(len(token), dtype=bool)
        first[1:] = token[1:] != token[:-1]
        length = np.diff(np.append(np.flatnonzero(first), len(token)))
        many = np.repeat(length > 1, length)
        single = ~many
        heads = first & many
        seen, at, k = np.unique(node[many], return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([token[single], token[heads], words.mix(seen.view(np.uint64))]).view(np.int64)),
            pa.array(np.concatenate([node[single], node[heads], seen])),
            pa.array(np.concatenate([n[single], n[heads], n[many][at]])),
            pa.array(np.concatenate([np.zeros(single.sum()), np.full(heads.sum(), -1), k]).astype(np.int32)),
        ], names=["key", "node", "n", "k"])

    def run(batches):
        token, node, n, held = [], [], [], 0
        for batch in batches:
            for _, s in _sets(batch, size):
                if not len(s):
                    continue
                upto = _need(len(s))[0]
                token.append(s[:upto])
                node.append(np.full(upto, _node(s)))
                n.append(np.full(upto, len(s), dtype=np.int32))
                held += upto
                if held >= RUN_HASHES:
                    yield flush(token, node, n)
                    token, node, n, held = [], [], [], 0
        if held:
            yield flush(token, node, n)

    return run


def _shared(batches):
    """(node, n, k): how many of a node's hashes other nodes hold too, from rows sorted by key."""
    def out(node, n, k):
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(k)], names=["node", "n", "k"])

    tail = None
    for batch in batches:
        part = [np.asarray(batch.column(i)) for i in range(4)]
        if tail is not None:
            part = [np.concatenate([a, b]) for a, b in zip(tail, part)]
        key = part[0]
        # The last key may go on in the next batch; its rows wait.
        cut = int(np.searchsorted(key, key[-1], side="left")) if len(key) else 0
        tail = [p[cut:] for p in part]
        if cut:
            yield out(*_count_runs(*[p[:cut] for p in part]))
    if tail is not None and len(tail[0]):
        yield out(*_count_runs(*tail))


def _count_runs(key, node, n, k):
    counted = k > 0
    a = (node[counted], n[counted], k[counted])
    key, node, n, k = key[~counted], node[~counted], n[~counted], k[~counted]
    if not len(key):
        return a
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    length = np.diff(np.append(first, len(key)))
    many = np.minimum.reduceat(node, first) != np.maximum.reduceat(node, first)
    many |= np.minimum.reduceat(k, first) < 0
    hit = np.repeat(many, length) & (k == 0)
    return tuple(np.concatenate([x, y]) for x, y in zip(a, (node[hit], n[hit], np.ones(hit.sum(), dtype=np.int32))))


def _candidates(docs: DataFrame, size: int) -> DataFrame:
    """Nodes that hold enough hashes that occur in other nodes too."""
    text = docs.select(F.col("text").cast("string").alias("text"))
    rows = text.mapInArrow(lean(_prefix_rows(size)), "key long, node long, n int, k int")
    shared = rows.repartition("key").sortWithinPartitions("key").mapInArrow(lean(_shared), "node long, n int, k int")
    least = F.ceil(F.col("n") * TIMES / OUT_OF)
    return shared.groupBy("node").agg(F.max("n").alias("n"), F.sum("k").alias("k")).where(
        F.col("k") >= F.greatest(F.lit(1), F.ceil(least * SLACK / 100))).select("node")


def _filter_bits(nodes: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter (bits / 8 bytes) over node ids.

    It only saves work: what passes wrongly is dropped by a join.
    """
    def run(batches):
        found = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            x = np.asarray(batch.column(0)).view(np.uint64)
            for at in _places(x, bits):
                np.bitwise_or.at(found, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], names=["bits"])

    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in nodes.coalesce(8).mapInArrow(lean(run), "bits binary").toLocalIterator():
        out |= np.frombuffer(row[0], dtype=np.uint8)
    return out


def _places(x: np.ndarray, bits: int) -> list[np.ndarray]:
    y = words.mix(x)
    return [y & np.uint64(bits - 1), (y >> np.uint64(32)) & np.uint64(bits - 1)]


def _set_rows(docs: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """(node, n, hashes) of the candidate nodes, one row each."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * candidates.count()).bit_length()))
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(candidates, width).tobytes())

    def run(batches):
        have = np.frombuffer(bits.value, dtype=np.uint8)
        done: set[int] = set()
        for batch in batches:
            node, n, data, held = [], [], [], 0
            for _, s in _sets(batch, size):
                if not len(s) or (key := _node(s)) in done:
                    continue
                at = _places(np.array([key]).view(np.uint64), width)
                if all(have[int(p[0]) >> 3] >> (int(p[0]) & 7) & 1 for p in at):
                    done.add(key)
                    node.append(key)
                    n.append(len(s))
                    data.append(s.tobytes())
                    held += len(data[-1])
                if held > 2 << 20:
                    yield pack(node, n, data)
                    node, n, data, held = [], [], [], 0
            yield pack(node, n, data)

    def pack(node, n, data):
        return pa.RecordBatch.from_arrays(
            [pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(data, pa.binary())],
            names=["node", "n", "hashes"])

    text = docs.select(F.col("text").cast("string").alias("text"))
    rows = text.mapInArrow(lean(run), "node long, n int, hashes binary")
    return rows.join(candidates, "node", "left_semi").groupBy("node").agg(
        F.first("n").alias("n"), F.first("hashes").alias("hashes"))


def _explode_prefix(batches):
    for batch in batches:
        token, node = [], []
        for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = np.frombuffer(data, dtype=np.uint64)
            s = s[:_need(len(s))[0]]
            token.append(s)
            node.append(np.full(len(s), key))
        if token:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token).view(np.int64)), pa.array(np.concatenate(node))], names=["token", "node"])


def _blocks(sets: DataFrame) -> DataFrame:
    """(node, block): nodes that may be linked, directly or through others, share a block.

    Of a node's shared hashes all but c - 1 are taken, the rarest first: one of them is common
    to any two linked nodes. Each is an edge to the smallest node that holds the hash.
    """
    rows = sets.select("node", "hashes").mapInArrow(lean(_explode_prefix), "token long, node long")
    common = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(common, "token")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("df", "token"))
    held = shared.withColumn("rank", rank).withColumn("k", F.count("*").over(Window.partitionBy("node")))
    least = F.ceil(F.col("n") * TIMES / OUT_OF)
    used = held.join(sets.select("node", "n"), "node").where(
        F.col("rank") <= F.col("k") - F.greatest(F.lit(1), F.ceil(least * SLACK / 100)) + 1).select("token", "node")
    used = written(used, "prefix")
    head = used.groupBy("token").agg(F.min("node").alias("u"))
    return components(used.join(head, "token").select("u", F.col("node").alias("v")).where("u <> v").distinct())


class Tree:
    """A signature tree: level 0 holds the sets, each level above four of the one below."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        n = np.array([len(s) for s in sets], dtype=np.int64)
        band = np.floor(np.log(n) / np.log(OUT_OF / TIMES))
        order = np.lexsort(([int(s[len(s) // 2]) for s in sets], [int(s[0]) for s in sets], band))
        self.order = order
        held = np.zeros((len(sets), bits), dtype=bool)
        for i, at in enumerate(order):
            held[i, (sets[at] & np.uint64(bits - 1)).astype(np.int64)] = True
        low = np.packbits(held, axis=1).view(np.uint64)
        size = n[order]
        spare = size - np.bitwise_count(low).sum(axis=1)
        self.levels = [(low, size, size, spare)]
        while len(self.levels[-1][0]) > 1:
            bit, a, b, c = self.levels[-1]
            at = np.arange(0, len(bit), 4)
            self.levels.append((np.bitwise_or.reduceat(bit, at, axis=0), np.minimum.reduceat(a, at),
                                np.maximum.reduceat(b, at), np.maximum.reduceat(c, at)))


def _possible(one, two, i, j):
    """Whether members of tree nodes i and j may overlap enough."""
    bit1, least1, most1, spare1 = one
    bit2, least2, most2, spare2 = two
    most = np.minimum(most1[i], most2[j])
    need = TIMES * (least1[i] + least2[j])
    ok = (OUT_OF + TIMES) * most >= need
    i, j, most, need = i[ok], j[ok], most[ok], need[ok]
    over = np.minimum(spare1[i], spare2[j])
    step = max(1, BITMAP_BYTES // bit1[0].nbytes)
    for at in range(0, len(i), step):
        part = slice(at, at + step)
        over[part] += np.bitwise_count(bit1[i[part]] & bit2[j[part]]).sum(axis=1, dtype=np.int64)
    keep = (OUT_OF + TIMES) * np.minimum(over, most) >= need
    return i[keep], j[keep]


def _children(i, j, n1, n2, same):
    step = np.arange(4)
    a = np.repeat(i * 4, 16) + np.tile(np.repeat(step, 4), len(i))
    b = np.repeat(j * 4, 16) + np.tile(step, 4 * len(j))
    ok = (a < n1) & (b < n2)
    if same:
        ok &= a <= b
    return a[ok], b[ok]


def walk(one: Tree, two: Tree, labels1, labels2, most: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dual traversal: pairs of sets that no bound excludes, a slab at a time.

    ``labels`` are the sets' current components; pairs of one component are left out, at the
    leaves and, where both tree nodes lie in it whole, above.
    """
    same = one is two
    while len(one.levels) < len(two.levels):
        one.levels.append(one.levels[-1])
    while len(two.levels) < len(one.levels):
        two.levels.append(two.levels[-1])
    top = len(one.levels) - 1
    stack = [(top, np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64))]
    while stack:
        level, i, j = stack.pop()
        i, j = _possible(one.levels[level], two.levels[level], i, j)
        if level == 0:
            if same:
                i, j = i[i < j], j[i < j]
            apart = labels1[i] != labels2[j]
            if apart.any():
                yield i[apart], j[apart]
            continue
        if not len(i):
            continue
        n1, n2 = len(one.levels[level - 1][0]), len(two.levels[level - 1][0])
        for at in range(0, len(i), most):
            stack.append((level - 1, *_padded(one, two, level, i[at:at + most], j[at:at + most], n1, n2, same)))


def _padded(one, two, level, i, j, n1, n2, same):
    """Children of pairs; a tree that was padded to the other's height keeps its one node."""
    up1 = len(one.levels[level][0]) == n1 == 1
    up2 = len(two.levels[level][0]) == n2 == 1
    if not up1 and not up2:
        return _children(i, j, n1, n2, same)
    step = np.arange(4)
    if up1 and up2:
        return i, j
    if up1:
        a, b = np.repeat(i, 4), np.repeat(j * 4, 4) + np.tile(step, len(j))
    else:
        a, b = np.repeat(i * 4, 4) + np.tile(step, len(i)), np.repeat(j, 4)
    ok = (a < n1) & (b < n2)
    return a[ok], b[ok]


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return OUT_OF * both >= TIMES * (len(a) + len(b) - both)


def links(sets: list[np.ndarray], sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect every component of the similarity graph of some sets.

    With ``sides`` (0 or 1 per set) only sets of different sides are compared.
    """
    if not sets:
        return []
    middle = int(np.median([len(s) for s in sets]))
    bits = int(min(1 << 14, max(256, 1 << (2 * middle - 1).bit_length())))
    label = np.arange(len(sets))
    if sides is None:
        parts = [np.arange(len(sets))] * 2
    else:
        parts = [np.flatnonzero(sides == k) for k in (0, 1)]
        if not len(parts[0]) or not len(parts[1]):
            return []
    one = Tree([sets[i] for i in parts[0]], bits)
    two = one if sides is None else Tree([sets[i] for i in parts[1]], bits)
    at1, at2 = parts[0][one.order], parts[1][two.order]
    found: list[tuple[int, int]] = []
    labels1, labels2 = label[at1], label[at2]
    for i, j in walk(one, two, labels1, labels2):
        while len(i):
            a, b = int(i[0]), int(j[0])
            if _similar(sets[at1[a]], sets[at2[b]]):
                found.append((int(at1[a]), int(at2[b])))
                old, new = label[at2[b]], label[at1[a]]
                label[label == old] = new
                labels1[:], labels2[:] = label[at1], label[at2]
                apart = labels1[i] != labels2[j]
                i, j = i[apart], j[apart]
            else:
                i, j = i[1:], j[1:]
    return found


def _link_groups(batches):
    """Verified links (u, v) of each group of (block, one, two), rows sorted by group."""
    for group in runs(batches, ["block", "one", "two"]):
        node = np.asarray(group["node"])
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group["hashes"].to_pylist()]
        cross = group["one"][0].as_py() != group["two"][0].as_py()
        sides = (np.asarray(group["chunk"]) == group["two"][0].as_py()).astype(np.int64) if cross else None
        pairs = links(sets, sides)
        if pairs:
            a, b = np.array(pairs).T
            yield edge_batch(node[a], node[b])


def _bands(most: int = 1 << 31) -> list[int]:
    """Smallest sizes of bands such that two linked sets lie in one band or in neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * OUT_OF // TIMES + 1)
    return out


def _least(n: str = "n"):
    """Hashes that a set of n shares with any set it is linked to, at least."""
    return F.ceil(F.col(n) * TIMES / OUT_OF)


def _in_parts(rows: DataFrame) -> DataFrame:
    """Rows of (block, node, n, hashes) and the number of chunks that their block needs."""
    return rows.join(rows.groupBy("block").agg(_chunks()), "block")


def _chunks():
    return F.greatest(F.ceil(F.count("*") / CHUNK_NODES), F.ceil(F.sum(F.col("n").cast("long") * 8) / CHUNK_BYTES)).cast(
        "int").alias("parts")


def _windows(large: DataFrame) -> DataFrame:
    """(cell, node, n, hashes): each set in the windows of its own band and of the next one.

    A window holds a band and the one below it, and is left out where nothing is in the former:
    then the window of the band below has the same sets.
    """
    band = F.size(F.filter(F.array(*map(F.lit, _bands())), lambda least: least <= F.col("n")))
    rows = large.withColumn("band", band).withColumn("window", F.explode(F.array("band", F.col("band") + 1)))
    rows = rows.withColumn("cell", F.xxhash64("block", "window"))
    own = rows.select("cell", "band", "window").groupBy("cell").agg(F.max(F.col("band") == F.col("window")).alias("own"))
    return rows.join(own.where("own").select("cell"), "cell", "left_semi").select("cell", "node", "n", "hashes")


def _placed(sets: DataFrame, size: DataFrame) -> DataFrame:
    """Rows of (cell, part, parts, node, hashes): the sets of a cell dealt to its chunks at random."""
    part = F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int")
    return sets.join(size.select("cell", "parts"), "cell").select("cell", part.alias("part"), "parts", "node", "hashes")


def _chunk_hashes(batches):
    """Rows (cell, piece, token, node, held) of chunks of sets (cell, part), a chunk's hashes of a range in one row.

    The arrays hold every hash of the chunk once, with one of its nodes and the number of them. A cell has as many
    ranges as chunks, so a range of the whole cell is no larger than a chunk, however common a hash.
    """
    for group in runs(batches, ["cell", "part"]):
        sets = [np.frombuffer(x, dtype=np.uint64) for x in group["hashes"].to_pylist()]
        token, at, held = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
        node = np.repeat(np.asarray(group["node"]), [len(x) for x in sets])[at]
        parts = group["parts"][0].as_py()
        piece = ((token >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        arrays = [[x.tobytes() for x in np.split(y, first[1:])] for y in (token, node, held)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(first), group["cell"][0].as_py())), pa.array(piece[first]), *(pa.array(x, pa.binary()) for x in arrays)],
            names=["cell", "piece", "token", "node", "held"])


def _ranges(batches):
    """(cell, token, node, held) of each range of a cell: its hashes, one of their nodes and the number of them."""
    for group in runs(batches, ["cell", "piece"]):
        token, node, held = (np.frombuffer(b"".join(group[c].to_pylist()), dtype=np.int64) for c in ("token", "node", "held"))
        token, at, back = np.unique(token, return_index=True, return_inverse=True)
        yield group["cell"][0].as_py(), token, node[at], np.bincount(back, weights=held).astype(np.int64)


def _alone(batches):
    """(cell, node, alone): hashes of a set that no other set of its cell holds."""
    for cell, _, node, held in _ranges(batches):
        node, alone = np.unique(node[held == 1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), cell)), pa.array(node), pa.array(alone)], names=["cell", "node", "alone"])


def _shared_hashes(batches):
    """(cell, token, df) of the hashes that several sets of a cell hold."""
    for cell, token, _, held in _ranges(batches):
        token, held = token[held > 1], held[held > 1]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), cell)), pa.array(token), pa.array(held)], names=["cell", "token", "df"])


def _over_ranges(placed: DataFrame, run, schema: str) -> DataFrame:
    """A task function over the ranges of hashes of each cell, combined in the chunks of its sets first."""
    chunks = placed.repartition("cell", "part").sortWithinPartitions("cell", "part").mapInArrow(
        lean(_chunk_hashes), "cell long, piece int, token binary, node binary, held binary")
    return chunks.repartition("cell", "piece").sortWithinPartitions("cell", "piece").mapInArrow(lean(run), schema)


def _covered(sets: DataFrame) -> DataFrame:
    """The sets of which other sets of their cell hold enough hashes between them."""
    placed = _placed(sets, sets.groupBy("cell").agg(_chunks()))
    alone = _over_ranges(placed, _alone, "cell long, node long, alone long").groupBy("cell", "node").agg(F.sum("alone").alias("alone"))
    enough = F.col("n") - F.coalesce("alone", F.lit(0)) >= _least()
    return sets.join(alone, ["cell", "node"], "left").where(enough).drop("alone")


def _lookup_rows(batches):
    """(cell, node, n, often, token, first) of groups (cell, part) of sets and their cell's common hashes.

    ``often`` common hashes are in the set. No other hash is held by as many sets, so of the common
    ones only those go out (``first``) that are among the rarest even behind all others.
    """
    for group in runs(batches, ["cell", "part"]):
        listed = group.filter(group["tokens"].is_valid())
        common = listed["tokens"][0].values.to_numpy() if listed.num_rows else np.zeros(0, dtype=np.int64)
        place = np.argsort(common)
        common = common[place]
        out = []
        group = group.filter(group["hashes"].is_valid())
        for node, data in zip(group["node"].to_pylist(), group["hashes"].to_pylist()):
            s = np.frombuffer(data, dtype=np.int64)
            at = np.searchsorted(common, s)
            hit = at < len(common)
            hit[hit] = common[at[hit]] == s[hit]
            often = int(hit.sum())
            head = s[hit][np.argsort(place[at[hit]])][:max(0, often - _up(len(s), TIMES, OUT_OF) + 1)]
            out.append((node, len(s), often, np.append(head, s[~hit]), len(head)))
        if not out:
            continue
        node, n, often, token, first = zip(*out)
        long = [len(t) for t in token]
        flat = [np.repeat(np.array(x, dtype=t), long) for x, t in ((node, np.int64), (n, np.int32), (often, np.int32))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(sum(long), group["cell"][0].as_py())), *map(pa.array, flat), pa.array(np.concatenate(token)),
             pa.array(np.concatenate([np.arange(m) < k for m, k in zip(long, first)]))],
            names=["cell", "node", "n", "often", "token", "first"])


def _rarest(sets: DataFrame) -> DataFrame:
    """(cell, token, v): of every set (cell, node) the hashes of which two linked sets share one.

    In a cell the hashes are ordered by the sets that hold them, rarest first, as in
    :func:`_blocks`, but over whole sets: two linked ones share one of the first
    n - ceil(0.8 n) + 1, and hashes that nobody else holds are among those for nothing.
    Common hashes, a bounded list per cell, are looked up where the sets lie, a chunk of sets at a
    time; so a hash is only joined to sets where few of its cell hold it.
    """
    size = sets.groupBy("cell").agg(F.count("*").alias("sets"), _chunks())
    placed = _placed(sets, size)
    counts = _over_ranges(placed, _shared_hashes, "cell long, token long, df long")
    counts = written(counts.join(size.select("cell", "sets"), "cell"), "counts")
    few = F.col("df") * COMMON <= F.col("sets")
    listed = counts.where(~few).groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("c"))
    listed = listed.join(size, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("node"),
        F.lit(None).cast("binary").alias("hashes"), F.col("c.token").alias("tokens"))
    placed = placed.select("cell", "part", "node", "hashes", F.lit(None).cast("array<long>").alias("tokens"))
    rows = placed.union(listed).repartition("cell", "part").sortWithinPartitions("cell", "part")
    rows = written(rows.mapInArrow(
        lean(_lookup_rows), "cell long, node long, n int, often int, token long, first boolean"), "lookup")
    one = Window.partitionBy("cell", "node")
    held = rows.where("not first").join(counts.where(few).select("cell", "token", "df"), ["cell", "token"]).withColumns(
        {"rank": F.row_number().over(one.orderBy("df", "token")), "k": F.count("*").over(one) + F.col("often")})
    used = held.where(F.col("rank") <= F.col("k") - _least() + 1).select("cell", "token", "node").union(
        rows.where("first").select("cell", "token", "node"))
    used = written(used.select("cell", "token", F.xxhash64("cell", "node").alias("v")), "prefix")
    drop_written(counts)
    drop_written(rows)
    return used


def _narrowed(large: DataFrame) -> DataFrame:
    """(block, node, n, hashes, parts): large blocks as smaller ones that hold the same links."""
    sets = written(_covered(written(_windows(large), "windows")), "narrow")
    used = _rarest(sets)
    head = used.groupBy("cell", "token").agg(F.min("v").alias("u"))
    found = written(components(used.join(head, ["cell", "token"]).select("u", "v").where("u <> v").distinct()), "blocks")
    drop_written(used)
    own = found.select("node", "root").union(found.select(F.col("root").alias("node"), "root").distinct())
    own = own.withColumnsRenamed({"node": "vertex", "root": "block"})
    sets = sets.withColumn("vertex", F.xxhash64("cell", "node")).join(own, "vertex")
    return _in_parts(sets.select("block", "node", "n", "hashes"))


def _verified(dealt: DataFrame) -> DataFrame:
    """Links inside groups of (block, one, two); where one is not two, those between their chunks."""
    keys = ["block", "one", "two"]
    return dealt.select(*keys, "chunk", "node", "hashes").repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(
        lean(_link_groups), EDGES)


def _at_random(rows: DataFrame) -> DataFrame:
    """Links inside the chunks of several random deals; blocks of one chunk are dealt once."""
    last = F.when(F.col("parts") > 1, PASSES - 1).otherwise(0)
    dealt = rows.withColumn("deal", F.explode(F.sequence(F.lit(0), last)))
    chunk = F.pmod(F.xxhash64("node", "deal"), F.col("parts").cast("long"))
    return _verified(dealt.withColumn("one", chunk).withColumns(
        {"block": F.xxhash64("block", "deal"), "two": F.col("one"), "chunk": F.col("one")}))


def _across(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Links between the chunks of large blocks, but for chunks already known to be connected.

    A component of at least half a chunk has chunks of its own, which meet those of others
    but not each other; the rest of a block shares chunks, and all pairs of those meet.
    """
    known = components(found, combine=False)
    rows = rows.join(known, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root", "parts")
    rows = written(rows, "labelled")
    large = (F.count("*") * 2 >= CHUNK_NODES) | (F.sum(F.col("n").cast("long") * 16) >= CHUNK_BYTES)
    own = rows.groupBy("block", "label").agg(large.alias("own"))
    rows = rows.join(own, ["block", "label"]).withColumn("unit", F.when(F.col("own"), F.col("label")).otherwise(F.col("block")))
    units = written(rows.groupBy("block", "unit", "own").agg(_chunks()), "units")
    a, b = (units.select("block", *(F.col(c).alias(c + side) for c in ("unit", "own", "parts"))) for side in "12")
    pairs = a.join(b, "block").where("unit1 < unit2 or (unit1 = unit2 and not own1 and not own2)")
    for side in "12":
        pairs = pairs.withColumn("i" + side, F.explode(F.sequence(F.lit(0), F.col("parts" + side) - 1)))
    pairs = pairs.where("unit1 <> unit2 or i1 <= i2").select(
        "block", F.xxhash64("unit1", "own1", "i1").alias("one"), F.xxhash64("unit2", "own2", "i2").alias("two"))
    ends = pairs.withColumn("chunk", F.explode(F.array_distinct(F.array("one", "two"))))
    place = F.pmod(F.xxhash64("node"), F.col("parts").cast("long")).cast("int")
    rows = rows.join(units, ["block", "unit", "own"]).withColumn("chunk", F.xxhash64("unit", "own", place))
    return _verified(rows.join(ends, ["block", "chunk"]))


def _linked(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """Verified links between nodes.

    A set is in one small block, or, of a large one, in at most two windows of sizes. What is
    large even then (thousands of sets alike) is first linked inside random chunks, so that
    only chunks of different components are left to meet.
    """
    blocks = blocks.select("node", F.col("root").alias("block")).union(
        blocks.select(F.col("root").alias("node"), F.col("root").alias("block")).distinct())
    rows = written(_in_parts(written(sets.join(blocks, "node").select("block", "node", "n", "hashes"), "blocks")), "parts")
    small, large = rows.where("parts = 1"), rows.where("parts > 1")
    if large.isEmpty():
        return _at_random(small)
    narrow = written(_narrowed(large), "narrowed")
    found = written(_at_random(small.unionByName(narrow)), "links")
    still = narrow.where("parts > 1")
    return found if still.isEmpty() else found.union(_across(still, found))


def _components(docs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, node) of every row and (node, root, component_id) of every node."""
    own = written(documents(docs, size), "documents")
    candidates = written(_candidates(docs, size), "candidates")
    sets = written(_set_rows(docs, candidates, size), "sets")
    drop_written(candidates)
    found = components(_linked(sets, _blocks(sets)), combine=False)
    drop_written(sets)
    first = own.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    first = first.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = written(first, "first")
    root = first.groupBy("root").agg(F.min("first").alias("component_id"))
    return own, first.join(root, "root").select("node", "root", "component_id")


def join_similar(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text).

    Documents are linked when their sets of distinct ``size``-word shingles have a Jaccard
    similarity of 0.8 or more; component_id is the smallest doc_id reachable by links. Null and
    empty texts, and texts without words, have no shingles and are linked with nothing: their
    component is their own id. A text of fewer words is one shingle. Repeated rows are copies of
    each other; a null doc_id is returned with the component of its text's copies, or null. An
    empty table gives no rows; other columns are ignored.
    """
    own, of_node = _components(docs, size)
    return own.join(of_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _with_nodes(docs: DataFrame, size: int) -> DataFrame:
    """All columns of ``docs`` and the node of the text as ``__node``."""
    def run(batches):
        for batch in batches:
            node = [_node(s) if len(s) else None for _, s in _sets(batch.select(["__text"]).rename_columns(["text"]), size)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(node, pa.int64())], names=[*names, "__node"])

    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField("__node", LongType())])
    return docs.withColumn("__text", F.col("text").cast("string")).mapInArrow(lean(run), schema)


def keep_one(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One row of ``docs`` per group of linked texts: one with the smallest doc_id.

    All columns stay as they are. Where a doc_id has several texts, each is decided by itself,
    so one that is linked to a smaller id takes no other along; of linked texts of one doc_id
    the one with the smallest node stays, and of equal ones one row. Rows with a null doc_id
    go where a linked text has one; of a group without any one row stays. Texts without shingles are linked with nothing: all of a null doc_id
    stay, and of a doc_id's equal ones one.
    """
    own, of_node = _components(docs.select("doc_id", "text"), size)
    found = written(own.join(of_node, "node", "left").select(
        "doc_id", "node", "root", F.coalesce("component_id", "doc_id").alias("component_id")), "components")
    leave = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(leave, docs["doc_id"] == leave["doc_id"], "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    twice = written(twice, "twice")
    repeated, nulls = not twice.isEmpty(), not found.where("doc_id is null").isEmpty()
    if not repeated and not nulls:
        return kept
    # Rows that their doc_id does not tell apart are decided by their nodes.
    same = docs["doc_id"] == twice["doc_id"]
    odd = docs.where("doc_id is null").unionByName(docs.join(twice, same, "left_semi"))
    kept = kept.where("doc_id is not null").join(twice, kept["doc_id"] == twice["doc_id"], "left_anti")
    odd = written(_with_nodes(odd, size), "odd")
    stay = found.where("doc_id is null").unionByName(found.join(twice, "doc_id", "left_semi")).where(
        "node is not null and (coalesce(doc_id, component_id) is null or doc_id = component_id)")
    stay = stay.groupBy("root", "doc_id").agg(F.min("node").alias("__keep")).select(F.col("doc_id").alias("__doc"), "__keep")
    hit = (odd["__node"] == stay["__keep"]) & odd["doc_id"].cast("long").eqNullSafe(stay["__doc"])
    chosen = odd.join(stay, hit, "left_semi").dropDuplicates(["doc_id", "__node"])
    bare = odd.where("__node is null")
    once = bare.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    for part in (chosen, bare.where("doc_id is null"), once):
        kept = kept.unionByName(part.drop("__node"))
    return kept
