"""Hard negatives by exact integer scores from tables of subset sums.

A row travels as the bit planes of its components, eight components a byte. For each group of
eight an anchor has a table of the sums of all 256 subsets; looking up a plane's bytes and
shifting and adding over the planes gives the full inner product. Anchors are the queries: they
meet all rows in blocks of bounded size (first those of their label, for the positives; then
those of other labels, inside the scores that each positive allows), and every block hands on
only the rows that can still be among the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import lean, runs, written
from plumbline.llm.vectors import matrices, scaled

#: Scale of the components; scaled ones are held to this.
SCALE, HELD = 256, 1 << 40
#: Anchors and rows of a block; anchors whose tables are made at a time, rows scored at a time.
ANCHORS, ROWS, TABLES, STEP = 8192, 4096, 256, 1024
POSITIVES, NEGATIVES, EVERY = 5, 3, 50


def planes_of(x: np.ndarray) -> list[bytes]:
    """Bit planes of the rows of a matrix of integers, lowest plane first, the sign's last.

    Each plane is packed into a byte per eight components; a row has as many as it needs.
    """
    need = np.maximum(x.max(axis=1), ~x.min(axis=1))
    count = np.array([int(m).bit_length() + 1 for m in need.tolist()])
    groups = -(-x.shape[1] // 8)
    packed = np.packbits((x[:, None, :] >> np.arange(int(count.max()))[:, None] & 1).astype(np.uint8), axis=2, bitorder="little")
    return [row.tobytes()[:groups * n] for row, n in zip(packed, count.tolist())]


def stacked(data: list[bytes], size: int) -> np.ndarray:
    """(plane, row, group): planes of rows, those with fewer continued by their sign's."""
    groups = -(-size // 8)
    count = np.array([len(d) // groups for d in data])
    out = np.empty((int(count.max()), len(data), groups), dtype=np.uint8)
    for n in np.unique(count).tolist():
        at = np.flatnonzero(count == n)
        own = np.frombuffer(b"".join([data[i] for i in at]), dtype=np.uint8).reshape(len(at), n, groups)
        out[:n, at] = own.transpose(1, 0, 2)
        out[n:, at] = own[:, -1]
    return out


def integers(planes: np.ndarray, size: int) -> np.ndarray:
    """The components that planes stand for."""
    bits = np.unpackbits(planes, axis=2, bitorder="little")[:, :, :size].astype(np.int64)
    weight = 1 << np.arange(len(planes), dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.tensordot(weight, bits, axes=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, subset, anchor): sums of each subset of eight components of each anchor."""
    size = anchors.shape[1]
    groups = -(-size // 8)
    padded = np.zeros((8 * groups, len(anchors)), dtype=kind)
    padded[:size] = anchors.T
    out = np.zeros((groups, 256, len(anchors)), dtype=kind)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + padded[j::8][:, None]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(row, anchor): full inner products, from the sign's plane down."""
    total = None
    for number in range(len(planes) - 1, -1, -1):
        part = tables[0][planes[number, :, 0]]
        for g in range(1, len(tables)):
            part += tables[g][planes[number, :, g]]
        if total is None:
            total = -part
        else:
            total <<= 1
            total += part
    return total


def _firsts(row: np.ndarray, col: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Entries that come among the first ``most`` of their column: higher values, then smaller rows."""
    order = np.lexsort((row, -value, col))
    c = col[order]
    start = np.flatnonzero(np.append(True, c[1:] != c[:-1])) if len(c) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(c)) - np.repeat(start, np.diff(np.append(start, len(c))))
    return order[rank < most]


class Block:
    """The anchors and rows of one block, rows in the order of ties."""

    def __init__(self, group: pa.Table):
        self.size = group["size"][0].as_py()
        role = np.asarray(group["role"])
        self.anchors, self.rows = group.filter(pa.array(role == 0)), group.filter(pa.array(role == 1))

    def scored(self) -> Iterator[tuple[pa.Table, pa.Table, np.ndarray]]:
        """(anchors, rows, scores of rows by anchors) for pieces of the block."""
        if not self.anchors.num_rows or not self.rows.num_rows:
            return
        planes = stacked(self.rows["data"].to_pylist(), self.size)
        x = integers(stacked(self.anchors["data"].to_pylist(), self.size), self.size)
        # The largest sum of a subset, shifted up to the highest plane, decides the numbers' width.
        narrow = int(np.abs(x).sum(axis=1).max()) << len(planes) < 1 << 31
        for at in range(0, len(x), TABLES):
            tables = subset_sums(x[at:at + TABLES], np.int32 if narrow else np.int64)
            for row in range(0, self.rows.num_rows, STEP):
                yield (self.anchors.slice(at, TABLES), self.rows.slice(row, STEP),
                       scores(tables, planes[:, row:row + STEP]))


def _ids(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.asarray(table[n]) for n in names]


POSITIVE = "anchor long, positive long, positive_id long, score long"


def _positives(most: int):
    """The rows of a block that can be among the first ``most`` other rows of an anchor's label."""
    def run(batches):
        for group in runs(batches, ["size", "label", "one", "two"]):
            for anchors, rows, s in Block(group).scored():
                (a_node,), (node, ident) = _ids(anchors, "node"), _ids(rows, "node", "vec_id")
                keep = np.ones(s.shape, dtype=bool)
                if len(s) > most + 1:
                    # One more than asked for, as the anchor itself may be among them.
                    keep = s >= np.partition(s, len(s) - most - 1, axis=0)[len(s) - most - 1]
                row, col = np.nonzero(keep)
                other = node[row] != a_node[col]
                row, col = row[other], col[other]
                best = _firsts(row, col, s[row, col], most)
                row, col = row[best], col[best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a_node[col]), pa.array(node[row]), pa.array(ident[row]), pa.array(s[row, col].astype(np.int64))],
                    names=["anchor", "positive", "positive_id", "score"])

    return run


NEGATIVE = "anchor long, place int, negative long, negative_id long, score long"


def _negatives(positives: int, most: int):
    """The rows of a block that can be among the first ``most`` negatives of an anchor's positive."""
    def run(batches):
        for group in runs(batches, ["size", "one", "two"]):
            for anchors, rows, s in Block(group).scored():
                (a_node, a_label), (node, ident, label) = _ids(anchors, "node", "label"), _ids(rows, "node", "vec_id", "label")
                # 50 p <= 100 s <= 95 p in whole numbers; an empty place allows nothing.
                p = np.full((positives, len(a_node)), -1, dtype=np.int64)
                for i, own in enumerate(anchors["scores"].to_pylist()):
                    p[:len(own), i] = own
                low, high = -(-p // 2), p + -p // 20
                row, col = np.nonzero((s >= np.where(p < 0, 1 << 62, low).min(axis=0)) & (s <= high.max(axis=0)))
                other = label[row] != a_label[col]
                row, col = row[other], col[other]
                value = s[row, col].astype(np.int64)
                for k in range(positives):
                    inside = (value >= low[k, col]) & (value <= high[k, col]) & (p[k, col] >= 0)
                    r, c, v = row[inside], col[inside], value[inside]
                    best = _firsts(r, c, v, most)
                    r, c, v = r[best], c[best], v[best]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a_node[c]), pa.array(np.full(len(c), k + 1, dtype=np.int32)), pa.array(node[r]), pa.array(ident[r]), pa.array(v)],
                        names=["anchor", "place", "negative", "negative_id", "score"])

    return run


def prepared(table: DataFrame, by: float = SCALE) -> DataFrame:
    """(node, vec_id, label, size, data) of the rows that take part, each different row once."""
    def run(batches):
        for batch in batches:
            for at, rows in matrices(batch.column(2)):
                own = batch.take(pa.array(at))
                size = pa.array(np.full(len(at), rows.shape[1], dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), size, pa.array(planes_of(scaled(rows, by, HELD)), pa.binary())],
                    names=["vec_id", "label", "size", "data"])

    own = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.col("embedding").cast("array<double>").alias("vector")).where("vec_id is not null and label is not null")
    out = own.mapInArrow(lean(run), "vec_id long, label long, size int, data binary").distinct()
    return out.select(F.xxhash64("vec_id", "label", "size", "data").alias("node"), "*")


def _dealt(anchors: DataFrame, rows: DataFrame, keys: list[str], anchor_block: int, row_block: int, *extra: str) -> DataFrame:
    """Anchors copied to every block of rows of their group, rows to every block of its anchors."""
    many = rows.groupBy(*keys).agg(F.ceil(F.count("*") / row_block).cast("int").alias("row_parts"))
    few = anchors.groupBy(*keys).agg(F.ceil(F.count("*") / anchor_block).cast("int").alias("anchor_parts"))
    # A row per group; groups without anchors end here.
    parts = written(many.join(few, keys), "blocks")
    label = [] if "label" in keys else ["label"]

    def side(df, role, own, other, mine, theirs, *more):
        place = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(mine)
        return df.join(parts, keys).select(
            *keys, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(theirs), place, "vec_id", "node", *label, "data",
            *more, F.lit(role).alias("role"))

    a = side(anchors, 0, "anchor_parts", "row_parts", "one", "two", *extra)
    b = side(rows, 1, "row_parts", "anchor_parts", "two", "one")
    both = a.unionByName(b, allowMissingColumns=True)
    at = [*keys, "one", "two"]
    return both.repartition(*at).sortWithinPartitions(*at, "role", "vec_id", "node")


def mine(table: DataFrame, by: float = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY,
         anchor_block: int = ANCHORS, row_block: int = ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, embedding, label).

    Components become floor(256 * x); a score is the integer inner product with the anchor.
    Higher scores come first, ties go to the smaller vec_id. Anchors are the rows whose vec_id is
    divisible by ``every``; an anchor's positives are its first ``positives`` other rows of the
    same label; of each the first ``negatives`` rows of other labels are returned that score from
    50 to 95 hundredths of the positive's score. Rows with a null vec_id, label or vector, an
    empty vector or null or non-finite components take no part; vectors of different lengths do
    not meet. A row that repeats another in every value counts once; rows that share a vec_id
    otherwise are rows of their own. A scaled component beyond 2**40 is held there, and scores
    beyond a long wrap around. An empty table gives no rows; other columns are ignored.
    """
    own = written(prepared(table, by), "planes")
    anchors = own.where(F.col("vec_id") % every == 0)
    dealt = _dealt(anchors, own, ["size", "label"], anchor_block, row_block)
    found = dealt.mapInArrow(lean(_positives(positives)), POSITIVE)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive")
    found = written(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
    # At most ``positives`` scores of an anchor, in the order of their places.
    lists = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("all")).select(
        F.col("anchor").alias("node"), F.col("all.score").alias("scores"))
    asking = written(anchors.join(lists, "node"), "anchors")
    dealt = _dealt(asking, own, ["size"], anchor_block, row_block, "scores")
    near = dealt.mapInArrow(lean(_negatives(positives, negatives)), NEGATIVE)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "negative_id", "negative")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    near = near.select("anchor", "place", "rank", "negative_id", F.col("score").alias("negative_score"))
    named = found.select("anchor", "place", "positive_id", F.col("score").alias("positive_score")).join(
        asking.select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return near.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
