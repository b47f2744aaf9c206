"""Nearest neighbours by largest inner product, on robust-pruned graphs.

Vectors of about one length get one more component that makes them equally long; the
largest inner product is then the least distance. They are dealt over shards by their
length, to within a factor of two, so that no long vector drowns the others, and scaled
to one. Each shard becomes a directed graph: points enter in batches, a greedy search through the graph proposes
their neighbours, and a neighbour is pruned where one already kept is nearer to it by a
factor, so that edges go to all sides. Queries search every shard by beam, and their
shard results are merged and scored on the original vectors in double precision.

Equal vectors are one point. A point keeps the ids that can be asked for: the ``k + 1``
smallest; more could not show in any result, as ties go to the smaller id.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlake.session import scratch_dir

from .common import arrow_rows, load, save, settle, shuffle_partitions

K = 20
#: Points of a shard at most, about; a task holds one shard, and more shards cost each
#: query more.
SHARD = 50_000
#: Shards at least, so that small tables use several executors, too.
LEAST_SHARDS = 6
#: Edges of a point, beam while building, beam of a query, pruning factors by round.
DEGREE, BUILD_BEAM, BEAM, RELAXED = 32, 48, 96, (1.0, 1.2)
#: Points that enter the graph together; queries that search together.
BATCH = 256


class Graph:
    """A directed graph over unit-free vectors, searched from their middle."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, start: int, by_product: bool = False):
        self.vectors, self.edges, self.start = vectors, edges, start
        # equally long vectors are told apart by the inner product alone
        self.norms = np.zeros(len(vectors), np.float32) if by_product else np.einsum("ij,ij->i", vectors, vectors)

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        n = len(vectors)
        rng = np.random.default_rng(n)
        middle = vectors.mean(axis=0)
        start = int(np.argmin(((vectors - middle) ** 2).sum(axis=1)))
        degree = min(DEGREE, n - 1)
        edges = np.full((n, DEGREE), -1, np.int32)
        if degree:
            edges[:, :degree] = (np.arange(n)[:, None] + rng.integers(1, n, (n, degree))) % n
        graph = cls(vectors, edges, start)
        for relaxed in RELAXED:
            order = rng.permutation(n)
            for at in range(0, n if degree else 0, BATCH):
                graph.enter(order[at : at + BATCH], relaxed)
        return graph

    def distances(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Squared, without the query's own part; none for points below zero."""
        found = self.norms[points] - 2 * np.einsum("bd,bpd->bp", queries, self.vectors[points])
        return np.where(points < 0, np.inf, found)

    def search(self, queries: np.ndarray, beam: int, visited: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest points found for each query, nearest first.

        All queries take their next step together, from the nearest points of their
        beams that have not been left yet.
        """
        b = len(queries)
        points = np.full((b, beam), -1, np.int64)
        points[:, 0] = self.start
        far = np.full((b, beam), np.inf)
        far[:, 0] = self.distances(queries, points[:, :1])[:, 0]
        left = np.zeros((b, beam), bool)
        live = np.arange(b)
        seen = np.zeros((b, len(self.vectors)), bool)
        seen[:, self.start] = True
        while len(live):
            open_far = np.where(left[live], np.inf, far[live])
            steps = np.argsort(open_far, axis=1)[:, :2]
            rows = np.arange(len(live))[:, None]
            going = np.isfinite(open_far[rows, steps])
            left[live[:, None], steps] = True
            live, steps, going = (x[going[:, 0]] for x in (live, steps, going))
            if not len(live):
                break
            own = live[:, None]
            next_points = self.edges[points[own, steps]]
            next_points[~going] = -1
            next_points = np.sort(next_points.reshape(len(live), -1), axis=1)
            again = np.zeros(next_points.shape, bool)
            again[:, 1:] = next_points[:, 1:] == next_points[:, :-1]
            next_points[again | seen[own, next_points]] = -1
            fresh_rows, fresh_columns = np.nonzero(next_points >= 0)
            seen[live[fresh_rows], next_points[fresh_rows, fresh_columns]] = True
            all_points = np.concatenate([points[live], next_points], axis=1)
            all_far = np.concatenate([far[live], self.distances(queries[live], next_points)], axis=1)
            all_left = np.concatenate([left[live], np.zeros(next_points.shape, bool)], axis=1)
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            rows = np.arange(len(live))[:, None]
            points[live], far[live], left[live] = all_points[rows, best], all_far[rows, best], all_left[rows, best]
        order = np.argsort(far, axis=1)
        rows = np.arange(b)[:, None]
        return points[rows, order], far[rows, order]

    def enter(self, new: np.ndarray, relaxed: float) -> None:
        """Give ``new`` points their neighbours, and those the edges back."""
        found, _ = self.search(self.vectors[new], BUILD_BEAM)
        pool = np.concatenate([found, self.edges[new]], axis=1)
        self.edges[new] = self.prune(new, pool, relaxed)
        sources = np.repeat(new, DEGREE)
        targets = self.edges[new].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        ends, counts = np.unique(targets, return_counts=True)
        # edges back: as many as a batch brings, beside those there are, then pruned
        nth = np.arange(len(targets)) - np.repeat(np.cumsum(counts) - counts, counts)
        width = int(counts.max()) if len(counts) else 0
        back = np.full((len(ends), width), -1, np.int64)
        back[np.repeat(np.arange(len(ends)), counts), nth] = sources
        for at in range(0, len(ends), BATCH):
            own = ends[at : at + BATCH]
            pool = np.concatenate([self.edges[own], back[at : at + BATCH]], axis=1)
            self.edges[own] = self.prune(own, pool, relaxed)

    def prune(self, points: np.ndarray, pool: np.ndarray, relaxed: float) -> np.ndarray:
        """At most ``DEGREE`` neighbours of each point, nearest first.

        One is left out if a kept one is ``relaxed`` times nearer to it than the point.
        """
        pool = np.sort(pool, axis=1)
        again = np.zeros(pool.shape, bool)
        again[:, 1:] = pool[:, 1:] == pool[:, :-1]
        pool = np.where(again | (pool == points[:, None]), -1, pool)
        far = self.distances(self.vectors[points], pool) + self.norms[points][:, None]
        order = np.argsort(far, axis=1)[:, : 3 * DEGREE]
        rows = np.arange(len(points))[:, None]
        pool, far = pool[rows, order], far[rows, order]
        vectors, norms = self.vectors[pool], self.norms[pool]
        apart = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        out, kept = np.full((len(points), DEGREE), -1, np.int64), np.zeros(len(points), int)
        free = np.isfinite(far)
        everyone = np.arange(len(points))
        for place in range(pool.shape[1]):
            take = free[:, place] & (kept < DEGREE)
            who = everyone[take]
            out[who, kept[who]] = pool[who, place]
            kept[who] += 1
            free[who] &= relaxed * relaxed * apart[who, place] > far[who]
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    good = F.col("embedding").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return vectors.where(good & some & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def largest() -> F.Column:
    """The largest component of ``v``, without its sign."""
    return F.array_max(F.transform("v", lambda x: F.abs(x)))


def band() -> F.Column:
    """The binary logarithm of the length of ``v``, rounded; no component overflows."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / F.col("_largest")) * (x / F.col("_largest")))
    return F.floor(F.log2("_largest") + F.log2(square) / 2 + 0.5).cast("int")


def deal(points: DataFrame) -> DataFrame:
    """``points`` with their ``shard``: of about one length, and ``SHARD`` at most, about."""
    counts = sorted((r["band"], r["count"]) for r in points.groupBy("band").count().collect())
    total = sum(n for _, n in counts)
    first, places = 0, []
    for at, n in counts:
        parts = max(math.ceil(n / SHARD), math.ceil(LEAST_SHARDS * n / total))
        places.append((at, first, parts))
        first += parts
    plan = points.sparkSession.createDataFrame(places, "band int, _first int, _parts int")
    number = F.col("_first") + F.pmod(F.xxhash64("point"), F.col("_parts"))
    return points.join(F.broadcast(plan), "band").select("v", "ids", number.cast("int").alias("shard"))


def unit_scaled(v: np.ndarray) -> np.ndarray:
    """Rows by powers of two so that the largest component is about one."""
    shift = np.frexp(np.abs(v).max(axis=1, initial=0, keepdims=True))[1]
    return np.ldexp(v, -shift)


def lifted(v: np.ndarray) -> np.ndarray:
    """Vectors of one shard, scaled together and made equally long."""
    scaled = np.ldexp(v, -int(np.frexp(np.abs(v).max())[1]))
    square = np.einsum("ij,ij->i", scaled, scaled)
    top = square.max()
    return (np.column_stack([scaled, np.sqrt(np.maximum(top - square, 0))]) / math.sqrt(top)).astype(np.float32)


def build_index(dealt: DataFrame) -> dict[int, str]:
    """A graph for each ``shard`` of ``v, ids`` rows, in a file of its own.

    Tasks write under names of their own
    attempt; only what Spark has committed to the list is read. The list has a row for
    each ``SHARD`` points.
    """
    folder = scratch_dir(dealt.sparkSession, "graphs")

    def build(group: pa.Table) -> pa.Table:
        v = matrix(group.column("v").combine_chunks())
        graph = Graph.build(lifted(v))
        ids = group.column("ids").combine_chunks()
        arrays = [v, graph.vectors, graph.edges, np.array([graph.start]), ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()]
        shard = group.column("shard")[0].as_py()
        files, place = arrow_fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.npy"
        with files.open_output_stream(f"{place}/{name}") as out:
            out.write(save(arrays))
        return pa.table({"shard": pa.array([shard], pa.int32()), "file": [f"{folder}/{name}"]})

    made = dealt.groupBy("shard").applyInArrow(build, "shard int, file string")
    return {r["shard"]: r["file"] for r in settle(made, "graph-list").collect()}


def search_index(queries: DataFrame, files: dict[int, str], k: int) -> DataFrame:
    """``asked, ids, score``: the ``k`` points found in each shard for each ``v``.

    ``asked`` is the hash of the query. Queries are dealt by shard and hash, so a task
    has a bounded part of them and holds the graph of one shard at a time.
    """
    numbers = F.lit(sorted(files)).cast("array<int>") if files else F.array().cast("array<int>")
    asked = queries.withColumn("asked", F.xxhash64("v")).withColumn("shard", F.explode(numbers))
    parts = shuffle_partitions(queries.sparkSession)
    dealt = asked.repartitionByRange(parts, "shard", "asked").sortWithinPartitions("shard")

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        at, opened = None, None
        for batch in batches:
            shards = batch["shard"].to_numpy()
            for shard in np.unique(shards):
                if shard != at:
                    at, opened = shard, open_graph(files[int(shard)])
                graph, v, bounds, ids = opened
                own = pa.array(np.flatnonzero(shards == shard))
                names, q = batch["asked"].take(own).to_numpy(), matrix(batch["v"].take(own))
                for i in range(0, len(q), BATCH):
                    part = q[i : i + BATCH]
                    flat = np.column_stack([unit_scaled(part), np.zeros(len(part))]).astype(np.float32)
                    found = graph.search(flat, min(max(BEAM, 2 * k), len(v)))[0][:, :k]
                    there = found >= 0
                    who, place = np.repeat(np.arange(len(part)), there.sum(axis=1)), found[there]
                    yield {
                        "asked": names[i : i + BATCH][who],
                        "ids": [ids[bounds[p] : bounds[p + 1]] for p in place],
                        "score": np.einsum("ij,ij->i", part[who], v[place]),
                    }

    return arrow_rows(dealt, run, "asked long, ids array<long>, score double")


def open_graph(file: str) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    files, place = arrow_fs.FileSystem.from_uri(file)
    with files.open_input_file(place) as source:
        v, vectors, edges, start, bounds, ids = load(source.read())
    return Graph(vectors, edges, int(start[0]), by_product=True), v, bounds, ids


def nearest(vectors: DataFrame, queries: F.Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query.

    ``vectors`` has ``vec_id`` and ``embedding``; rows where the column ``queries``
    holds are queries against all rows but their own. Ties go to the smaller
    ``vec_id``. Null, zero and non-finite vectors and rows without id take no part;
    other lengths than most vectors have are an error. Rows with the same id and
    vector are one row. Without candidates a query has no rows.
    """
    rows = settle(usable(vectors).withColumn("asks", F.coalesce(queries, F.lit(False))).distinct(), "vectors")
    # equal vectors are one point with its smallest ids
    by_id = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.select("v", "vec_id").distinct().withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= k + 1)
    points = kept.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("point", F.col("ids")[0])
    points = points.withColumn("_largest", largest()).withColumn("band", band()).drop("_largest")
    files = build_index(deal(settle(points, "points")))
    hits = search_index(rows.where("asks").select("v").distinct(), files, k + 1)
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    ranked = (
        hits.select("asked", "score", F.explode("ids").alias("vec_id"))
        .withColumn("_n", F.row_number().over(best))
        .where(F.col("_n") <= k + 1)
        .groupBy("asked")
        .agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("hits"))
    )
    own = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("asked"))
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    met = own.join(ranked, "asked").select("query_id", F.posexplode(others).alias("at", "hit"))
    return met.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")

