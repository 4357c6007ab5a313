"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

Fitting takes a bounded sample of the distinct vectors and halves it again and again at the median of its
main direction, so that all leaves have about the same number of vectors; the leaves' means are the
centroids. They lie in an in-memory graph of nearest neighbours, small enough for every task, which a
beam search walks for many vectors at once; a search keeps its beam, not all centroids. Only where a beam is so wide
that it would come by every node anyway, all centroids are compared.

Every distinct vector is put on the list of its nearest centroid and, where it lies near a boundary, on
those of up to REPLICAS centroids whose distance is at most CLOSURE times the least, unless another of its centroids is
nearer to that one than the vector is. A query goes to the lists whose centroid's distance is at most a ratio times that
of the nearest, up to a number of lists, and in any case on to the next lists until these hold k candidates for sure.
Ratio and number are those at which sampled queries find WANTED of their nearest in the sample with the fewest lists;
they have no upper bound, so where lists tell nothing, all are searched. Vectors are replicated only if, by that count, it saves comparisons.

Inner products become distances by one more component: a vector over the largest norm gets what it lacks to
length 1, a query gets 0. Scores are inner products in double precision of the vectors as given.

Neighbouring lists are searched together, as a shard of about CHUNK vectors, and a vector that a query meets on several of
a shard's lists is compared once. Longer lists are cut into chunks, and the queries of a shard into blocks, so no task has
to hold a list of any length or all queries that go to it. Equal vectors are indexed once, with the least
k + 1 of their ids: no more of them can be among anyone's nearest k.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component, and rows without an
id, take no part. Vectors of different lengths have no inner product; each length is searched by itself. Products that
overflow without a sign come last. Rows that share an id are one query if their vectors are
equal, and never each other's neighbours. An empty table gives an empty result. Other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import bounded, written

#: Distinct vectors that centroids are fitted on, in expectation. Every vector is indexed.
SAMPLE = 131072
#: Sampled vectors for each centroid.
PER_CENTROID = 16
REPLICAS = 4
CLOSURE = 1.1
WANTED = 0.95
QUERIES = 256
DEGREE = 16
BEAM = 48
#: Nodes of a beam that a step opens.
STEP = 8
CHUNK = 4096
#: Vectors that one task routes at least.
TASK = 8192


def usable(vector: Column) -> Column:
    """Not null, with finite components only, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


@dataclass(frozen=True)
class Model:
    """Centroids in the space with one more component, their graph, where searches start, the largest norm, and the ratio of distances and the number up to which lists are searched."""

    centroids: np.ndarray
    graph: np.ndarray
    starts: np.ndarray
    norm: float
    ratio: float = 1.0
    probes: int = 1
    replicas: int = 1

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / self.norm
        return np.hstack([unit, np.sqrt(np.maximum(0, 1 - (unit**2).sum(axis=1, keepdims=True)))]).astype(np.float32)

    def lifted_queries(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # first, as squares of tiny or huge components would be lost
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        return np.hstack([unit, np.zeros((len(unit), 1))]).astype(np.float32)

    def nearest(self, points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of about the k nearest centroids of each point, nearest first, by beam search in the graph."""
        found, far = [], []
        for i in range(0, len(points), 256):
            p, d = self._beam(points[i : i + 256], max(BEAM, k + k // 4))
            found.append(p[:, :k])
            far.append(d[:, :k])
        return np.concatenate(found), np.concatenate(far)

    def lists_to_fill(self, points: np.ndarray, closure: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of a point, list that it is put on)."""
        found, far = self.nearest(points, self.replicas)
        take = far <= far[:, :1] * closure + 1e-6
        for j in range(1, found.shape[1]):
            for i in range(j):
                apart = np.linalg.norm(self.centroids[found[:, i]] - self.centroids[found[:, j]], axis=1)
                take[:, j] &= ~take[:, i] | (apart > far[:, j])
        row, col = np.nonzero(take)
        return row, found[row, col]

    def lists_to_search(self, points: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (place of a point, list to search): by ratio and number, and further until least entries are in reach or all lists are."""
        rows, lists, todo, k = [], [], np.arange(len(points)), 32
        while len(todo):
            found, far = self.nearest(points[todo], k)
            size = sizes[found]
            open_ = (far <= far[:, :1] * self.ratio + 1e-6) & (np.arange(far.shape[1]) < self.probes) | (np.cumsum(size, axis=1) - size < least)
            done = np.full(len(todo), True) if found.shape[1] == len(self.centroids) else ~open_[:, -1]
            row, col = np.nonzero(open_ & done[:, None])
            rows.append(todo[row])
            lists.append(found[row, col])
            todo, k = todo[~done], 4 * k
        return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *lists])

    def calibrated(self, points: np.ndarray, sample: np.ndarray, k: int, replicas: int, closure: float, wanted: float) -> Model:
        """The model with as many replicas, the ratio and the number of lists at which the wanted share of sampled queries' nearest k is on lists that are searched, with the fewest comparisons."""
        tries = [replace(self, replicas=n)._calibrated(points, sample, k, closure, wanted) for n in sorted({1, replicas})]
        return min(tries, key=lambda x: x[0])[1]

    def _calibrated(self, points: np.ndarray, sample: np.ndarray, k: int, closure: float, wanted: float) -> tuple[float, Model]:
        asked = np.linspace(0, len(sample) - 1, min(QUERIES, len(sample))).astype(int)
        queries, needed, ranks, entries = self.lifted_queries(sample[asked]), [], [], []
        far = np.sqrt(np.maximum(0, 1 + (self.centroids**2).sum(axis=1) - 2 * queries @ self.centroids.T))
        score = points[:, :-1] @ queries[:, :-1].T
        for j, own in enumerate(asked):
            score[own, j] = -np.inf
            best = np.argpartition(-score[:, j], min(k, len(sample) - 1))[:k]
            best = best[best != own]
            if len(best):
                row, lists = self.lists_to_fill(points[best], closure)
                entries.append(len(lists) / len(best))
                nearest = np.full(len(best), np.inf)
                np.minimum.at(nearest, row, far[j, lists])
                needed.append(nearest / max(far[j].min(), 1e-6))
                ranks.append((far[j] < nearest[:, None]).sum(axis=1))
        if not needed:
            return 0, self
        ratio, rank = np.concatenate(needed), np.concatenate(ranks)
        ratios = np.sort(far / np.maximum(far.min(axis=1, keepdims=True), 1e-6), axis=1)
        found, best, probes = int(np.ceil(wanted * len(rank))), None, 1
        while True:
            inside = np.sort(ratio[rank < probes])
            if len(inside) >= found:
                least = inside[found - 1]
                cost = np.minimum((ratios <= least).sum(axis=1), probes).sum()
                if best is None or cost < best[0]:
                    best = cost, float(least), probes
            if probes >= len(self.centroids):
                return best[0] * np.mean(entries), replace(self, ratio=best[1], probes=best[2])
            probes = probes * 17 // 16 + 1

    def _beam(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The centroids in the final beam of each point, nearest first, and their distances."""
        n, width = len(points), min(width, len(self.centroids))
        lengths, own = (self.centroids**2).sum(axis=1), (points**2).sum(axis=1)[:, None]
        if width * self.graph.shape[1] >= len(self.centroids):
            return self._every(points, width)
        ids, far = np.full((n, width), -1, np.int32), np.full((n, width), np.inf, np.float32)
        opened = np.ones((n, width), bool)

        def met(at: np.ndarray, node: np.ndarray, d: np.ndarray) -> None:
            """Nodes (a row for each of at) with their distances come into the beams, each once."""
            all_ids, all_far = np.hstack([ids[at], node]), np.hstack([far[at], d])
            all_opened = np.hstack([opened[at], np.zeros(node.shape, bool)])
            order = np.argsort(all_ids, axis=1, kind="stable")  # a node of the beam comes before its repetitions
            named = np.take_along_axis(all_ids, order, 1)
            again = np.zeros(named.shape, bool)
            np.put_along_axis(again, order[:, 1:], named[:, 1:] == named[:, :-1], 1)
            all_far[again] = np.inf
            keep = np.argpartition(all_far, width - 1, axis=1)[:, :width]
            ids[at], far[at], opened[at] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_far, all_opened))
            opened[at] |= ~np.isfinite(far[at])

        active, node = np.arange(n), np.broadcast_to(self.starts, (n, len(self.starts)))
        met(active, node, (own + lengths[self.starts] - 2 * points @ self.centroids[self.starts].T).astype(np.float32))
        step = min(STEP, width)
        while True:
            ahead = np.where(opened[active], np.inf, far[active])
            pick = np.argpartition(ahead, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(ahead, pick, 1))
            some = live.any(axis=1)
            if not some.any():
                break
            active, pick, live = active[some], pick[some], live[some]
            opened[active[:, None], pick] = True
            near = self.graph[ids[active[:, None], pick]].reshape(len(active), -1)
            d = own[active] + lengths[near] - 2 * np.einsum("nd,ngd->ng", points[active], self.centroids[near])
            d[np.repeat(~live, self.graph.shape[1], axis=1)] = np.inf
            met(active, near, d.astype(np.float32))
        order = far.argsort(axis=1, kind="stable")  # full, as the graph is in one piece
        return np.take_along_axis(ids, order, 1), np.sqrt(np.maximum(np.take_along_axis(far, order, 1), 0))


    def _every(self, points: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """As _beam, of all centroids."""
        far = (self.centroids**2).sum(axis=1) - 2 * points @ self.centroids.T
        near = np.argpartition(far, width - 1, axis=1)[:, :width] if width < far.shape[1] else np.broadcast_to(np.arange(width), far.shape)
        d = np.take_along_axis(far, near, 1)
        order = d.argsort(axis=1, kind="stable")
        return np.take_along_axis(near, order, 1), np.sqrt(np.maximum(np.take_along_axis(d, order, 1) + (points**2).sum(axis=1)[:, None], 0))


def _leaves(points: np.ndarray, at: np.ndarray, parts: int) -> list[np.ndarray]:
    if parts < 2 or len(at) < 2:
        return [at]
    left = parts // 2
    own = points[at] - points[at].mean(axis=0)
    way = own[np.linalg.norm(own, axis=1).argmax()]
    for _ in range(6):
        way = own.T @ (own @ way)
        way /= max(np.linalg.norm(way), 1e-30)
    order = np.argsort(own @ way, kind="stable")
    cut = len(at) * left // parts
    return _leaves(points, at[order[:cut]], left) + _leaves(points, at[order[cut:]], parts - left)


def fit(sample: np.ndarray, norm: float, k: int = 20, replicas: int = REPLICAS, closure: float = CLOSURE, wanted: float = WANTED, per_centroid: int = PER_CENTROID) -> Model:
    """Centroids, graph and ratio, from a sample of distinct vectors; norm is the largest of all vectors."""
    model = Model(np.zeros((0, 0), np.float32), np.zeros((0, 0), np.int32), np.zeros(0, np.int32), norm)
    points = model.lifted(sample)
    parts = max(1, len(points) // per_centroid)
    centroids = np.array([points[x].mean(axis=0) for x in _leaves(points, np.arange(len(points)), parts)], np.float32)
    near = []
    for i in range(0, len(centroids), 512):
        d = -2 * centroids[i : i + 512] @ centroids.T + (centroids**2).sum(axis=1)
        d[np.arange(len(d)), np.arange(i, i + len(d))] = -np.inf  # a node itself, which is not linked
        near.append(np.argsort(d, axis=1, kind="stable")[:, 1 : DEGREE + 1])
    near = np.concatenate(near)
    # Each node also gets some links to nodes anywhere, and one to the next leaf, which keeps the graph in one piece.
    far = np.random.default_rng(5).integers(0, len(centroids), (len(centroids), 3))
    graph = np.hstack([near, far, (np.arange(len(centroids))[:, None] + 1) % len(centroids)]).astype(np.int32)
    starts = np.unique(np.linspace(0, len(centroids) - 1, min(len(centroids), 32)).astype(np.int32))
    return replace(model, centroids=centroids, graph=graph, starts=starts).calibrated(points, sample, k, replicas, closure, wanted)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _listed(lists_of, shard: np.ndarray | None = None):
    """Rows (id, vector, ids, lists) with the lists that lists_of names for a vector; with shard, the shard of each list, a row for each shard and a column with it."""
    names = ["id", "vector", "ids"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                part = batch.slice(i, 1024)
                row, lists = lists_of(_matrix(part.column("vector")))
                of = np.zeros(len(lists), np.int64) if shard is None else shard[lists]
                order = np.lexsort((lists, of, row))
                row, lists, of = row[order], lists[order], of[order]
                first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0))
                ends = np.append(first, len(row)).astype(np.int32)
                for j in range(0, len(first), 4096):
                    take, at = pa.array(row[first[j : j + 4096]]), pa.array(ends[j : j + 4097])
                    columns = [part.column(n).take(take) for n in names] + [pa.ListArray.from_arrays(at, pa.array(lists.astype(np.int32)))]
                    if shard is not None:
                        columns.append(pa.array(of[first[j : j + 4096]].astype(np.int32)))
                    yield pa.RecordBatch.from_arrays(columns, names=[*names, "lists", *["shard"] * (shard is not None)])

    return go


def _by_list(lists: pa.ChunkedArray) -> dict[int, np.ndarray]:
    """The rows that name each list."""
    of = lists.to_pylist()
    flat, row = np.concatenate([np.array(x, np.int64) for x in of]), np.repeat(np.arange(len(of)), [len(x) for x in of])
    order = np.argsort(flat, kind="stable")
    names, first = np.unique(flat[order], return_index=True)
    return dict(zip(names.tolist(), np.split(row[order], first[1:]), strict=True))


def _searched(k: int):
    """The k best of a chunk of a shard for each query of a block, and on one row of each query the inner products that took."""

    def go(queries: pa.Table, members: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float, int]] = []
        if len(queries) and len(members):
            v, ids = _matrix(members.column("vector")), members.column("ids").to_pylist()
            on = _by_list(members.column("lists"))
            longest = np.linalg.norm(v, axis=1).max()
            for i in range(0, len(queries), 256):
                part = queries.slice(i, 256)
                q, names = _matrix(part.column("vector")), part.column("id").to_pylist()
                about, there, compared = np.full((len(q), len(v)), -np.inf), np.zeros((len(q), len(v)), bool), np.zeros(len(q), np.int64)
                with np.errstate(all="ignore"):
                    for name, rows in _by_list(part.column("lists")).items():
                        if name in on:
                            cells = np.ix_(rows, on[name])
                            about[cells], there[cells] = q[rows] @ v[on[name]].T, True
                            compared[rows] += len(on[name])
                    top = min(k + 1, len(v))
                    least = np.partition(about, len(v) - top, axis=1)[:, len(v) - top]
                    near = there & ~(about < (least - 1e-12 * np.linalg.norm(q, axis=1) * longest)[:, None])
                    for j, name in enumerate(names):
                        hit = np.flatnonzero(near[j])
                        scores = np.nan_to_num((v[hit] * q[j]).sum(axis=1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                        best = sorted((-s, x) for s, h in zip(scores.tolist(), hit.tolist(), strict=True) for x in ids[h] if x != name)[:k]
                        out += [(name, x, -s, 0 if n else int(compared[j])) for n, (s, x) in enumerate(best)]
        columns = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score", "products"), columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64()), strict=True)})

    return go


FOUND = "query_id long, vec_id long, score double, products long"


def _search(every: DataFrame, queries: Column, k: int, sample: int, replicas: int, closure: float, wanted: float) -> DataFrame:
    """Candidates of vectors of one length, as FOUND; a vector on several lists may be found several times, with one score."""
    least = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = every.select("vec_id", "vector").distinct().withColumn("n", least).where(F.col("n") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # at most k + 1 to a vector
    distinct = written(distinct.select(F.get("ids", F.lit(0)).alias("id"), "vector", "ids"), "ann-distinct")
    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.array_max("vector"), -F.array_min("vector"))).alias("largest")).first()
    unit = distinct.agg(F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / size["largest"]) * (x / size["largest"])))).first()[0]
    norm = min(float(np.sqrt(unit)) * size["largest"], 1e308)
    # A sample of the expected size, drawn by a hash of the id: no task sorts, and as many rows at any number of vectors.
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    chosen = distinct if size["n"] <= sample else distinct.where(draw < int((1 << 30) * sample / size["n"]))
    chosen = _matrix(chosen.select("id", "vector").orderBy("id").toArrow().column("vector"))  # one order, so that reruns agree
    model = fit(chosen, norm, k, replicas, closure, wanted)
    schema, files = "id long, vector array<double>, ids array<long>, lists array<int>", 1 + size["n"] // TASK
    members = written(distinct.mapInArrow(_listed(lambda v: model.lists_to_fill(model.lifted(v), closure)), schema), "ann-lists", files)
    # One number for each centroid on the driver; the sample bounds them.
    sizes = np.zeros(len(model.centroids), np.int64)
    for r in members.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    # Leaves that follow each other are neighbours: they make up shards of about CHUNK entries; a longer list is a shard of its own, cut into chunks.
    _, shard = np.unique(np.cumsum(sizes) // CHUNK, return_inverse=True)
    shards = int(shard.max()) + 1
    number = lambda of: F.get(F.lit(of), F.col("shard"))
    shard_of = lambda x: F.get(F.lit(shard.tolist()), x)
    parts = F.transform(F.array_distinct(F.transform("lists", shard_of)), lambda s: F.struct(s.alias("shard"), F.filter("lists", lambda x: shard_of(x) == s).alias("lists")))
    members = members.select("id", "vector", "ids", F.explode(parts).alias("p")).select("id", "vector", "ids", "p.shard", "p.lists")
    asked = every.where(queries).select(F.col("vec_id").alias("id"), "vector", F.array().cast("array<long>").alias("ids")).distinct()
    # A vector is on at most that many lists, so that many entries hold k others than the query's own.
    asked = written(asked.mapInArrow(_listed(lambda v: model.lists_to_search(model.lifted_queries(v), sizes, (k + 1) * model.replicas), shard), schema + ", shard int"), "ann-asked", files)
    chunks = [-(-int(n) // CHUNK) for n in np.bincount(shard, sizes, shards)]
    blocks = [1] * shards
    for r in asked.groupBy("shard").count().collect():
        blocks[r["shard"]] = -(-r["count"] // CHUNK)
    chunks, blocks = (F.greatest(number(x), F.lit(1)).cast("long") for x in (chunks, blocks))
    draw = F.pmod(F.xxhash64("id", "vector"), F.lit(1 << 20))
    members = members.select("shard", (draw % chunks).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "vector", "ids", "lists")
    asked = asked.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), (draw % blocks).alias("block"), "id", "vector", "lists")
    key = ["shard", "chunk", "block"]
    return asked.groupBy(*key).cogroup(members.groupBy(*key)).applyInArrow(_searched(k), FOUND)


def found(rows: DataFrame, queries: Column, k: int = 20, *, sample: int = SAMPLE, replicas: int = REPLICAS, closure: float = CLOSURE, wanted: float = WANTED) -> DataFrame:
    """The best k of each searched shard for each query, as FOUND; products, summed up, is the number of inner products."""
    spark = bounded(rows).sparkSession
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked"))
    every = every.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    out = spark.createDataFrame([], FOUND)
    for r in every.groupBy(F.size("vector").alias("n")).count().orderBy("n").collect():  # one row for each length
        out = out.union(_search(every.where(F.size("vector") == r["n"]), F.col("asked"), k, sample, replicas, closure, wanted))
    return out


def search(rows: DataFrame, queries: Column, k: int = 20, **more) -> DataFrame:
    """The k nearest found, among all rows (vec_id, embedding), of each row for which the condition queries holds: query_id, rank, vec_id, score. more: as found takes."""
    best = found(rows, queries, k, **more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
