"""Near-duplicate vectors by sorted projection passes.

Each pass draws random hyperplanes through a label's mean, writes the signs of a vector's
projections one after another as its key, orders the label's vectors by it and compares each with
the next ``window`` ones, also over the edges of partitions; pairs whose cosine is high enough are
united across passes. The number of passes follows from the label's size and spread, so that a
pair at the threshold is missed with a chance of about ``MISS``; one pass compares all pairs of a
label that the window holds. Equal vectors count as one throughout. Once components are known,
links are counted exactly inside them, in blocks of bounded size, so a large group loses none to
the window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import EDGES, Forest, components, edge_batch, lean, runs, written

THRESHOLD, PASSES, WINDOW, KEY_BITS, CHUNK = 0.93, 16, 512, 62, 1024
#: Chance that all passes miss a pair at the threshold; passes of a label at most.
MISS, MOST_PASSES = 0.001, 100


def _unit(data: list[bytes]) -> np.ndarray:
    """Rows of unit length from vectors in double precision."""
    x = np.frombuffer(b"".join(data), dtype=np.float64).reshape(len(data), -1)
    # The largest component first, so that no square overflows or vanishes.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, data): the vector as bytes of doubles; null where it links with nothing."""
    def run(batches):
        for batch in batches:
            data = []
            for vector, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if vector is None or label is None or not len(vector) or None in vector:
                    data.append(None)
                    continue
                x = np.array(vector, dtype=np.float64) + 0.0
                data.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(data, pa.binary())], names=["vec_id", "label", "data"])

    return table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                        F.col("label").cast("long").alias("label")).mapInArrow(lean(run), "vec_id long, label long, data binary")


def _planes(size: int, number: int, bits: int) -> np.ndarray:
    return np.random.default_rng([size, number]).standard_normal((size, bits))


def passes_for(n: int, spread: float, threshold: float, window: int, least: int) -> float:
    """Passes after which a pair at the threshold is missed with a chance of ``MISS``.

    ``spread`` is the mean squared distance of the unit vectors from their mean. Seen from there
    the pair's cosine is smaller; each of the first log2(n / window) signs parts it or not.
    """
    cosine = max(-1.0, 1 - (1 - threshold) / max(spread, 1e-12))
    hit = (1 - math.acos(cosine) / math.pi) ** math.log2(max(2.0, n / window))
    return max(least, math.ceil(math.log(MISS) / math.log1p(-hit))) if hit > 1e-9 else math.inf


def _by_label(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, int, int]]:
    """Rows of each (label, size) of a batch."""
    label, size = np.asarray(batch.column("label")), np.asarray(batch.column("size"))
    order = np.lexsort((size, label))
    cut = np.flatnonzero((np.diff(label[order]) != 0) | (np.diff(size[order]) != 0)) + 1
    for at in np.split(order, cut):
        if len(at):
            yield at, int(label[at[0]]), int(size[at[0]])


def _sums(batches):
    """Partial sums (label, size, n, total) of the unit vectors of labels."""
    def pack():
        keys = list(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([held[k][0] for k in keys], pa.int64()), pa.array([held[k][1].tobytes() for k in keys], pa.binary())],
            names=["label", "size", "n", "total"])

    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        data = batch.column("data").to_pylist()
        for at, label, size in _by_label(batch):
            own = held.setdefault((label, size), [0, np.zeros(size)])
            own[0] += len(at)
            own[1] = own[1] + _unit([data[i] for i in at]).sum(axis=0)
        if len(held) > 5000:
            yield pack()
            held.clear()
    yield pack()


PLAN = "label long, size int, passes int, mean binary"


def _plans(threshold: float, passes: int, window: int, most: int):
    """How many passes around its mean a label takes; one, if the window holds all its vectors."""
    def run(batches):
        for group in runs(batches, ["label", "size"]):
            n = int(np.asarray(group["n"]).sum())
            mean = sum(np.frombuffer(d, dtype=np.float64) for d in group["total"].to_pylist()) / n
            need = 1 if n <= window else min(most, passes_for(n, 1 - float(mean @ mean), threshold, window, passes))
            yield pa.RecordBatch.from_arrays(
                [group["label"].slice(0, 1).combine_chunks(), group["size"].slice(0, 1).combine_chunks(),
                 pa.array([int(need)], pa.int32()), pa.array([mean.tobytes()], pa.binary())],
                names=["label", "size", "passes", "mean"])

    return run


SORTED = "pass int, label long, size int, key long, node long, data binary"


def _keyed(bits: int):
    """A row per vector and pass: the signs of ``bits`` projections as one number, first sign highest."""
    def run(batches):
        weight = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            data = batch.column("data").to_pylist()
            for at, _, size in _by_label(batch):
                own = batch.take(pa.array(at))
                x = _unit([data[i] for i in at]) - np.frombuffer(own.column("mean")[0].as_py(), dtype=np.float64)
                for number in range(own.column("passes")[0].as_py()):
                    key = (x @ _planes(size, number, bits) > 0) @ weight
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), number, dtype=np.int32)), own.column("label"), own.column("size"),
                         pa.array(key), own.column("node"), own.column("data")],
                        names=["pass", "label", "size", "key", "node", "data"])

    return run


def _span(near: np.ndarray, one: np.ndarray, two: np.ndarray, forest: Forest) -> None:
    """Unite the rows and columns of a matrix of near pairs, with one edge for each that is reached."""
    if not near.any():
        return
    sides, nodes = (near, np.ascontiguousarray(near.T)), (one, two)
    unseen = [near.any(axis=1), near.any(axis=0)]
    for first in np.flatnonzero(unseen[0]).tolist():
        if not unseen[0][first]:
            continue
        unseen[0][first] = False
        stack = [(0, first)]
        while stack:
            side, at = stack.pop()
            new = np.flatnonzero(sides[side][at] & unseen[1 - side])
            unseen[1 - side][new] = False
            for other in nodes[1 - side][new].tolist():
                forest.join(int(nodes[side][at]), other)
            stack += [(1 - side, k) for k in new.tolist()]


def _near(x: np.ndarray, y: np.ndarray, threshold: float, step: int = 512) -> np.ndarray:
    out = np.empty((len(x), len(y)), dtype=bool)
    for at in range(0, len(x), step):
        out[at:at + step] = x[at:at + step] @ y.T >= threshold
    return out


def _window_links(threshold: float, window: int, edges: bool = False):
    """Edges of a spanning forest of the near pairs in sorted runs of one pass and label.

    With ``edges`` the first and last ``window`` rows of the partition follow, as rows without
    u and v: what meets over the edges of partitions is among them.
    """
    empty = [pa.nulls(0, t) for t in (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())]
    names = ["pass", "label", "size", "key", "node", "data"]

    def links(forest):
        u, v = forest.edges()
        if not edges:
            return edge_batch(u, v)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), *[
            pa.nulls(len(u), c.type) for c in empty]], names=["u", "v", *names])

    def rows(table):
        for part in table.combine_chunks().to_batches():
            none = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, *part.columns], names=["u", "v", *names])

    def run(batches):
        forest, held, last, head, tail = Forest(), None, None, 0, None
        for group in _pieces(batches):
            ident = tuple(group[k][0].as_py() for k in ("pass", "label", "size"))
            node, x = np.asarray(group["node"]), _unit(group["data"].to_pylist())
            if edges:
                # Rows of the head go at once; the tail holds none of them.
                now = group.select(names)
                out = min(window - head, now.num_rows)
                if out:
                    yield from rows(now.slice(0, out))
                head += out
                tail = now.slice(out) if tail is None else pa.concat_tables([tail, now.slice(out)])
                tail = tail.slice(max(0, tail.num_rows - window))
            if held is None or last != ident:
                held = node[:0], x[:0]
            for at in range(0, len(node), window):
                own, mine = node[at:at + window], x[at:at + window]
                both, all_x = np.concatenate([held[0], own]), np.concatenate([held[1], mine])
                near = _near(mine, all_x, threshold)
                near[np.arange(len(own)), len(held[0]) + np.arange(len(own))] = False
                _span(near, own, both, forest)
                held = both[-window:], all_x[-window:]
            last = ident
            if len(forest.up) > 200_000:
                yield links(forest)
                forest = Forest()
        if tail is not None and tail.num_rows:
            yield from rows(tail)
        yield links(forest)

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches cut where pass, label or size changes."""
    for batch in batches:
        yield from runs(iter([batch]), ["pass", "label", "size"])


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows copied to every pair of their chunk with one of the ``parts`` chunks of their group."""
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *columns, F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two"), "chunk", "node", "data")


def _links(nodes: DataFrame, threshold: float, passes: int, window: int, bits: int, most: int) -> DataFrame:
    """(u, v): edges that connect the near vectors of each label."""
    nodes = nodes.select("label", F.expr("cast(length(data) / 8 as int)").alias("size"), "node", "data")
    same = ["label", "size"]
    sums = nodes.mapInArrow(lean(_sums), "label long, size int, n long, total binary")
    plan = written(sums.repartition(*same).sortWithinPartitions(*same).mapInArrow(
        lean(_plans(threshold, passes, window, most)), PLAN), "plan")
    order = ["pass", "label", "size", "key", "node"]
    keyed = nodes.join(plan, same).mapInArrow(lean(_keyed(bits)), SORTED)
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    first = written(sorted_rows.mapInArrow(lean(_window_links(threshold, window, edges=True)), f"{EDGES}, {SORTED}"), "windows")
    met = first.where("node is not null").select(*order, "data").repartition(*order[:3]).sortWithinPartitions(*order)
    return first.where("u is not null").select("u", "v").union(met.mapInArrow(lean(_window_links(threshold, window)), EDGES))


def _count_links(threshold: float):
    """(node, links) inside one chunk or between two chunks of a component."""
    def run(batches):
        for group in runs(batches, ["root", "one", "two"]):
            node, copies = np.asarray(group["node"]), np.asarray(group["copies"])
            x = _unit(group["data"].to_pylist())
            one, two = group["one"][0].as_py(), group["two"][0].as_py()
            chunk = np.asarray(group["chunk"])
            a, b = np.flatnonzero(chunk == one), np.flatnonzero(chunk == two)
            near = x[a] @ x[b].T >= threshold
            if one == two:
                np.fill_diagonal(near, False)
                found = [(a, near @ copies[b])]
            else:
                found = [(a, near @ copies[b]), (b, near.T @ copies[a])]
            for at, n in found:
                yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(n.astype(np.int64))], names=["node", "links"])

    return run


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW,
                    bits: int = KEY_BITS, chunk: int = CHUNK, most: int = MOST_PASSES) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Vectors are linked when their labels are equal and their cosine is ``threshold`` or more;
    no pair below it is linked, and pairs of a component are all counted. A label of at
    most ``window`` vectors loses none; in a larger one a pair is missed only if no chain of near
    pairs joins it within the window of any pass. ``passes`` is the least number of them there,
    ``most`` the largest: where size and spread ask for more, more pairs are missed. Null labels, and vectors
    that are null, empty, zero or hold null or non-finite components, link with nothing; nor do
    vectors of different lengths. n_links counts the other rows linked; component_id is the
    smallest vec_id reachable; kept says that the row has it as its own id. Repeated rows are
    copies that link with each other; a null vec_id gets the component of its copies, or null,
    and is not kept. An empty table gives no rows; other columns are ignored.
    """
    own = distinct_vectors(table).withColumn("node", F.when(F.col("data").isNotNull(), F.xxhash64("label", "data")))
    own = written(own, "vectors")
    nodes = own.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("data").alias("data"), F.count("*").alias("copies"),
        F.min("vec_id").alias("first"))
    nodes = written(nodes, "nodes")
    found = components(_links(nodes, threshold, passes, window, bits, most), combine=False)
    roots = found.select(F.col("root").alias("node"), "root").distinct().union(found.select("node", "root"))
    members = written(nodes.join(roots, "node").select("root", "node", "copies", "data"), "members")
    parts = members.groupBy("root").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    dealt = _dealt(members.join(parts, "root"), "root", "copies")
    keys = ["root", "one", "two"]
    counted = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(_count_links(threshold)), "node long, links long")
    links = counted.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "copies", "first").join(roots, "node", "left").join(links, "node", "left")
    known = written(known.withColumn("root", F.coalesce("root", "node")), "known")
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = known.join(least, "root").select(
        "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = own.select("vec_id", "node").join(of_node, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
