"""Approximate nearest neighbours (operator 8): a directed graph with robust pruning, searched shard by shard.

Vectors are dealt to shards: first by length, in bands of some four percent, then by a hash, so that a shard has about
``SHARD_POINTS`` points at most. In each shard, points are added in growing batches: a greedy beam search in the
graph so far proposes neighbours, and pruning keeps the nearest one and drops what is nearer to it, by a
factor ``alpha``, than to the point, and so on, which keeps edges in many directions. Edges run both ways, and lists
that get too long are pruned again. Queries run a beam search in every shard, and the nearest of all shards are the
result. A shard is placed once, and the queries stream past it in batches.

Nearness is the inner product. For the graph, the vectors of a shard are divided by the longest one and get one more
coordinate, so that all have the same length and the largest product is the smallest distance. Searches by product lose
their way where lengths differ (without bands, recall on all directions in 64 dimensions is 0.97 for equal lengths, 0.79
for lengths up to 1.2 and 0.41 up to 2); within a band they hardly do, and very long or short vectors are by themselves.
Searches rank by the product itself, and scores are computed from the vectors as they are, both in double precision.

Equal vectors are one point; of their ids, the least ``k + 1`` can appear in a result, so no more
are kept. Vectors that are null, zero, empty, or hold nulls or non-finite numbers take no part. Vectors of
different numbers of components do not meet. Rows that repeat an id with the same vector count once; a query id with
several vectors gets the nearest to any of them. Rows without an id take no part. An empty table gives no rows.
Ties go to the smaller id. All vectors are indexed; what bounds the work is the size of a shard, the width of the beam
and the number of edges, which are chosen together: see the README for the recall measured on full shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed

EDGES = 24
# Width of the beam while a graph grows, and in searches.
BUILD_BEAM = 64
BEAM = 128
ALPHA = 1.2
SHARD_POINTS = 8_000
# Bands of length for each power of two.
BANDS = 16
_BATCH = 512


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("...d,...d->...", x, x)


def _distances(points: np.ndarray, near: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return _squares(points[near] - queries[:, None, :])


def _products(points: np.ndarray, near: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products, negative, so that the largest is nearest."""
    return -np.einsum("qnd,qd->qn", points[near], queries)


def _beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, width: int, measure: Callable = _distances
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``width`` nearest points that a greedy search finds, nearest first, and how far they are.

    All queries take a step at a time: they go to the neighbours of their nearest point not yet visited.
    """
    n = len(queries)
    ids = np.full((n, width), -1, np.int64)
    far = np.full((n, width), np.inf)
    visited = np.zeros((n, width), bool)
    ids[:, 0], far[:, 0] = start, measure(points, np.full((n, 1), start), queries)[:, 0]
    active = np.arange(n)
    while len(active):
        open_ = np.where(visited[active], np.inf, far[active])
        at = open_.argmin(1)
        going = np.isfinite(open_[np.arange(len(active)), at])
        active, at = active[going], at[going]
        if not len(active):
            break
        visited[active, at] = True
        near = edges[ids[active, at]]
        known = (near[:, :, None] == ids[active][:, None, :]).any(2)
        distance = np.where((near < 0) | known, np.inf, measure(points, np.maximum(near, 0), queries[active]))
        all_far = np.concatenate([far[active], distance], 1)
        best = np.argsort(all_far, 1, kind="stable")[:, :width]
        far[active] = np.take_along_axis(all_far, best, 1)
        ids[active] = np.where(np.isfinite(far[active]), np.take_along_axis(np.concatenate([ids[active], near], 1), best, 1), -1)
        visited[active] = np.take_along_axis(np.concatenate([visited[active], np.zeros(near.shape, bool)], 1), best, 1)
    return ids, far


def _prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning for many points at once; ``candidates`` are padded with -1 and may repeat."""
    candidates = np.where(candidates == own[:, None], -1, candidates)
    candidates = np.sort(candidates, 1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    vectors = points[np.maximum(candidates, 0)]
    distance = np.where(candidates < 0, np.inf, _squares(vectors - points[own][:, None, :]))
    order = np.argsort(distance, 1, kind="stable")
    candidates, distance = np.take_along_axis(candidates, order, 1), np.take_along_axis(distance, order, 1)
    vectors = np.take_along_axis(vectors, order[:, :, None], 1)
    kept = np.full((len(own), EDGES), -1, np.int64)
    open_ = candidates >= 0
    rows = np.arange(len(own))
    for i in range(EDGES):
        first = open_.argmax(1)
        some = open_[rows, first]
        if not some.any():
            break
        kept[some, i] = candidates[some, first[some]]
        between = _squares(vectors - vectors[rows, first][:, None, :])
        open_ &= ALPHA**2 * between > distance
        open_[rows, first] = False
    return kept


def build_graph(points: np.ndarray) -> tuple[np.ndarray, int]:
    """Neighbours of each point, padded with -1, and the point at which searches start."""
    n = len(points)
    edges = np.full((n, EDGES), -1, np.int64)
    start = int(_squares(points - points.mean(0)).argmin())
    order = np.random.default_rng(0).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        batch = order[done : done + min(done, _BATCH)]
        found, _ = _beam_search(points, edges, start, points[batch], BUILD_BEAM)
        # Points of one batch may be neighbours too.
        inside = _squares(points[batch][:, None, :] - points[batch][None, :, :]).argsort(1, kind="stable")[:, :9]
        edges[batch] = _prune(points, batch, np.concatenate([found, batch[inside]], 1))
        _add_back(points, edges, batch)
        done += len(batch)
    return edges, start


def _add_back(points: np.ndarray, edges: np.ndarray, batch: np.ndarray) -> None:
    """Add the edges back to the points of a batch; lists that become too long are pruned."""
    source = np.repeat(batch, EDGES)
    target = edges[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    while len(target):
        # Up to so many new edges at a time for each point.
        first = np.searchsorted(target, target)
        turn = np.arange(len(target)) - first
        now = turn < EDGES
        nodes, place = np.unique(target[now], return_inverse=True)
        lists = np.full((len(nodes), 2 * EDGES), -1, np.int64)
        lists[:, :EDGES] = edges[nodes]
        lists[place, EDGES + turn[now]] = source[now]
        sizes = (lists >= 0).sum(1)
        short = sizes <= EDGES
        packed = np.take_along_axis(lists, np.argsort(lists < 0, 1, kind="stable"), 1)[:, :EDGES]
        edges[nodes[short]] = packed[short]
        for begin in range(0, int((~short).sum()), _BATCH):
            some = np.flatnonzero(~short)[begin : begin + _BATCH]
            edges[nodes[some]] = _prune(points, nodes[some], lists[some])
        source, target = source[~now], target[~now]


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.Array, dtype: type = np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def _band(vector: Column) -> Column:
    """Which band a length falls into; a length of one is in the middle of its band. The largest component is taken out
    first, so nothing overflows."""
    most = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    return F.floor(BANDS * (F.log2(most) + F.log2(squares) / 2) + 0.5).cast("int")


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Vectors by the same factor, of which the longest has a length of one."""
    matrix = matrix / np.abs(matrix).max()
    return matrix / np.sqrt(_squares(matrix).max())


def build_index(
    vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", shard_points: int | None = None
) -> DataFrame:
    """Points of all shards: ``size``, ``band`` and ``shard``, ``node``, the ids, the vector, its neighbours, and ``start``."""
    shard_points = shard_points or SHARD_POINTS
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & _valid(F.col("vector"))).distinct()
    # Before the shuffle too, Spark keeps no more rows than these of a vector that very many share.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    points = rows.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = checkpointed(points.withColumns({"size": F.size("vector"), "band": _band(F.col("vector"))}))
    kind = ["size", "band"]
    # A row for each number of components and each band of lengths that occurs: there are 2100 powers of two.
    shards = points.groupBy(*kind).agg(F.ceil(F.count("*") / shard_points).cast("int").alias("shards"))
    points = points.join(F.broadcast(shards), kind).withColumn("shard", F.pmod(F.xxhash64("vector"), "shards").cast("int"))
    schema = "size int, band int, shard int, node int, start int, ids array<long>, vector array<double>, edges array<int>"

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by([("first", "ascending")])
        matrix = scaled(_matrix(group["vector"]))
        last = np.sqrt(np.maximum(1.0 - _squares(matrix), 0.0))
        edges, start = build_graph(np.concatenate([matrix, last[:, None]], 1).astype(np.float32))
        n = len(matrix)
        lists = pa.ListArray.from_arrays(np.arange(0, (n + 1) * EDGES, EDGES, np.int32), pa.array(edges.ravel().astype(np.int32)))
        columns = [*(group[c] for c in ("size", "band", "shard")), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, start, np.int32))]
        kept = group["ids"].cast(pa.list_(pa.int64())), group["vector"].cast(pa.list_(pa.float64()))
        return pa.table([*columns, *kept, lists], ["size", "band", "shard", "node", "start", "ids", "vector", "edges"])

    # The order in which points are added is that of their least ids, so that reruns agree.
    points = points.withColumn("first", F.col("ids")[0]).drop("shards")
    return checkpointed(points.groupBy(*kind, "shard").applyInArrow(build, schema))


class _Shard:
    """The points of one shard, for searches."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        self.vectors, self.ids = _matrix(rows["vector"]), rows["ids"].to_pylist()
        self.points, self.edges, self.start = scaled(self.vectors), _matrix(rows["edges"], np.int64), rows["start"][0].as_py()

    def nearest(self, names: list[int], queries: np.ndarray, k: int, width: int) -> Iterator[tuple[int, int, float]]:
        """Query, id and score of the nearest of this shard."""
        # The length of a query does not change which products are largest.
        unit = np.stack([scaled(query[None, :])[0] for query in queries])
        found, _ = _beam_search(self.points, self.edges, self.start, unit, width, _products)
        for name, query, nodes in zip(names, queries, found, strict=True):
            nodes = nodes[nodes >= 0]
            with np.errstate(over="ignore"):
                scores = (self.vectors[nodes] * query).sum(1)
            best: dict[int, float] = {}
            for node, score in zip(nodes.tolist(), scores.tolist(), strict=True):
                for i in self.ids[node]:
                    # An id may have several vectors.
                    if i != name and score > best.get(i, -np.inf):
                        best[i] = score
            for i in sorted(best, key=lambda i: (-best[i], i))[:k]:
                yield name, i, best[i]


def search(
    index: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = BEAM
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the ``k`` nearest found for each query, without itself."""
    queries = queries.select(F.col(id_col).cast("long").alias("query_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    queries = queries.filter(F.col("query_id").isNotNull() & _valid(F.col("vector"))).distinct()
    place = ["size", "band", "shard"]
    # As few rows as there are shards.
    shards = checkpointed(index.select(*place).distinct())
    asked = queries.withColumn("size", F.size("vector")).join(F.broadcast(shards), "size")
    # The points of a shard come first, and the queries stream past them.
    both = index.unionByName(asked, allowMissingColumns=True).repartition(*place).sortWithinPartitions(*place, F.col("node").asc_nulls_last())
    width = max(beam, k + 1)

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard = at = None
        for part in parts:
            where = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in place], 1)
            asks = part.column("node").is_null().to_numpy(zero_copy_only=False)
            # Where another shard begins, or queries follow points.
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(1) | (asks[1:] != asks[:-1])) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(asks)], strict=True):
                if begin == end:
                    continue
                if not asks[begin]:
                    if at != tuple(where[begin]):
                        held, shard, at = [], None, tuple(where[begin])
                    held.append(part.slice(begin, end - begin))
                    continue
                shard = shard or _Shard(held)
                held = []
                for first in range(begin, end, _BATCH):
                    block = part.slice(first, min(_BATCH, end - first))
                    found = list(shard.nearest(block.column("query_id").to_pylist(), _matrix(block.column("vector")), k, width))
                    names, ids, scores = zip(*found, strict=True) if found else ((), (), ())
                    columns = pa.array(names, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.float64())
                    yield pa.RecordBatch.from_arrays(list(columns), ["query_id", "vec_id", "score"])

    found = both.mapInArrow(look, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # A query id with several vectors may find the same row twice.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
