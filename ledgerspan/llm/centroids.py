"""Centroid clustering in whole numbers; a vantage-point tree finds each vector's nearest centroid.

Components become the integers floor(scale * x), so sums, means and distances are exact and a rerun, or
another partitioning, gives the same clusters. In each round the driver builds a vantage-point tree over the
centroids and broadcasts it. Tasks search it for their vectors best first: of the nodes still open for a vector
that with the least possible distance comes next, and a node stays open while that distance is at most the best
so far (inclusive, so that ties reach the smaller number). All distances that decide are exact integers;
roots only bound them, with a margin. Tasks send one row of sums per cluster, so a cluster that holds most of
the vectors costs no more than another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ledgerspan.llm.common import stored

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
LEAF = 2  # most centroids in a leaf
MOST = 1 << 27  # of a whole component: 64 squares of twice that fit in a long
OPEN = 1 << 21  # nodes kept open at once, over the vectors of a block
MARGIN = 1e-12


@dataclass
class Node:
    members: np.ndarray  # numbers of centroids: the vantage point, or those of a leaf
    near: int = -1  # the children's nodes, and bounds of their distance to the vantage point
    far: int = -1
    bounds: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)


def distances(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors to a whole point."""
    apart = vectors - point
    return np.einsum("ij,ij->i", apart, apart)


def vantage_tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of the tree, the root first. The vantage point is the member farthest from the members' first one."""
    nodes: list[Node] = []

    def build(members: np.ndarray) -> int:
        at = len(nodes)
        if len(members) <= leaf:
            nodes.append(Node(members))
            return at
        vantage = members[distances(centroids[members], centroids[members[0]]).argmax()]
        rest = members[members != vantage]
        apart = distances(centroids[rest], centroids[vantage])
        order = np.argsort(apart, kind="stable")
        rest, roots = rest[order], np.sqrt(apart[order].astype(np.float64))
        half = (len(rest) + 1) // 2
        nodes.append(node := Node(np.array([vantage])))
        low = lambda r: r[0] * (1 - MARGIN)
        high = lambda r: r[-1] * (1 + MARGIN)
        node.near = build(rest[:half])
        if half < len(rest):
            node.far = build(rest[half:])
            node.bounds = (low(roots[:half]), high(roots[:half]), low(roots[half:]), high(roots[half:]))
        else:
            node.bounds = (low(roots), high(roots), 0.0, 0.0)
        return at

    if len(centroids):
        build(np.arange(len(centroids)))
    return nodes


def nearest(nodes: list[Node], centroids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of every vector; of equally near ones the smallest number."""
    block = max(1, OPEN // max(1, len(nodes)))
    parts = [_search(nodes, centroids, vectors[i : i + block]) for i in range(0, len(vectors), block)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _search(nodes: list[Node], centroids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of every vector's own best-first search at a time, until no vector has an open node that could matter."""
    n = len(vectors)
    least = np.full((n, len(nodes)), np.inf)  # possible distance in each open node
    least[:, 0] = 0.0
    best, squared, radius = np.full(n, len(centroids), np.int32), np.full(n, np.iinfo(np.int64).max), np.full(n, np.inf)
    active = np.arange(n)
    while True:
        at = least[active].argmin(1)
        bound = least[active, at]
        go = np.isfinite(bound) & (bound <= radius[active])
        active, at, bound = active[go], at[go], bound[go]
        if not len(active):
            return best, squared
        least[active, at] = np.inf
        for number in np.unique(at):
            node, here = nodes[number], at == number
            rows, its_bound = active[here], bound[here]
            points = vectors[rows]
            for c in node.members:
                apart = distances(points, centroids[c])
                better = (apart < squared[rows]) | ((apart == squared[rows]) & (c < best[rows]))
                taken = rows[better]
                squared[taken], best[taken] = apart[better], c
                radius[taken] = np.sqrt(apart[better].astype(np.float64)) * (1 + MARGIN)
            if node.near >= 0:
                root = np.sqrt(apart.astype(np.float64))  # to the vantage point, the only member
                low, high = root * (1 - MARGIN), root * (1 + MARGIN)
                for child, nearest_, farthest in ((node.near, *node.bounds[:2]), (node.far, *node.bounds[2:])):
                    if child >= 0:
                        least[rows, child] = np.maximum(its_bound, np.maximum(low - farthest, nearest_ - high))


def _whole(dimensions: int, scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dimensions), False)
            ids, lists = batch.column(0).filter(fits), batch.column(1).filter(fits)
            values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, dimensions)
            finite = np.isfinite(values).all(1)
            ids, values = ids.filter(pa.array(finite)), values[finite]
            if (beyond := np.abs(values).max(1, initial=0) > MOST).any():
                raise ValueError(f"vector {ids[int(beyond.argmax())].as_py()} has a component beyond {MOST / scale:.0f}, whose distances a long may not hold")
            flat = pa.array(values.astype(np.int32).ravel())
            offsets = pa.array(np.arange(0, len(flat) + 1, dimensions), pa.int32())
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "whole"])

    return run


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, whole) of the vectors with `dimensions` components, none null or non-finite, as integers floor(scale * x)."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(_whole(dimensions, scale), f"vec_id {kind}, whole array<int>")


def first_centroids(whole: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose hash of seed and id is smallest (a top-k; equal ids go by their components), in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = whole.select(mark.alias("mark"), "whole").orderBy("mark", "whole").limit(clusters).collect()
    return np.array([r["whole"] for r in rows], np.int64)


def _vectors(batch: pa.RecordBatch, column: int, dimensions: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def _summed(sent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, centroids = sent.value
        sizes, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            vectors = _vectors(batch, 0, centroids.shape[1])
            number, _ = nearest(nodes, centroids, vectors)
            order = np.argsort(number, kind="stable")
            found, starts = np.unique(number[order], return_index=True)
            if len(found):
                sums[found] += np.add.reduceat(vectors[order], starts, axis=0)
                sizes += np.bincount(number, minlength=len(centroids))
        held = np.flatnonzero(sizes)
        offsets = pa.array(np.arange(0, len(held) * centroids.shape[1] + 1, centroids.shape[1]), pa.int32())
        columns = [pa.array(held.astype(np.int32)), pa.array(sizes[held]), pa.ListArray.from_arrays(offsets, pa.array(sums[held].ravel()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    return run


def moved(whole: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floors of their vectors' means, and empty ones where they were."""
    sent = whole.sparkSession.sparkContext.broadcast((vantage_tree(centroids), centroids))
    parts = whole.select("whole").mapInArrow(_summed(sent), "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(centroids.shape[1])]).alias("sums"))
    out = centroids.copy()
    for row in totals.collect():  # one row per cluster
        out[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    sent.unpersist()
    return out


def _assigned(sent, id_type: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, centroids, digests = sent.value
        for batch in batches:
            number, squared = nearest(nodes, centroids, _vectors(batch, 1, centroids.shape[1]))
            columns = [batch.column(0).cast(id_type), pa.array(number), pa.array(squared), pa.array(digests, pa.string()).take(pa.array(number))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "centroid_sha256"])

    return run


def clusters(
    vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance, centroid_sha256) of every kept vector, and the final centroids.

    Vectors of another length, null ones, and those with a null or non-finite component are left out. A null
    id hashes as the empty text; repeated rows count each. With fewer than `k` vectors there are fewer clusters,
    and an empty table gives no rows. A finite component beyond 131,072 (2^27 / scale) is an error: the
    squared distance may not fit in a long. Rounds end early where no centroid moves.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    whole = stored(whole_vectors(vectors, dimensions, scale), "whole-vectors")
    centroids = first_centroids(whole, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, moved(whole, centroids)
        if (before == centroids).all():
            break
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sent = whole.sparkSession.sparkContext.broadcast((vantage_tree(centroids), centroids, digests))
    field = whole.schema["vec_id"].dataType
    schema = f"vec_id {field.simpleString()}, cluster int, distance long, centroid_sha256 string"
    return whole.mapInArrow(_assigned(sent, to_arrow_type(field)), schema), centroids


def report(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """The clusters with cluster_inertia and inertia, the distances summed over the cluster and over all."""
    found = stored(clusters(vectors, k, rounds, seed)[0], "clusters")
    per = found.groupBy(F.col("cluster").alias("of")).agg(F.sum("distance").alias("cluster_inertia"))
    per = stored(per, "cluster-inertia")  # one row per cluster, hence broadcast
    total = per.agg(F.sum("cluster_inertia")).scalar()
    met = found.join(F.broadcast(per), F.col("cluster") == F.col("of")).drop("of")
    return met.select("vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"), "centroid_sha256")
