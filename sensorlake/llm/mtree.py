"""Exact top-k inner products by best-first search in an M-tree of paged nodes.

Inner products become distances in one more dimension: with M the largest
squared norm, x' = (x, sqrt(M - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + M - 2 <q, x>, a metric, so nearest means highest score.

Top level: up to ``PIVOTS`` routing vectors (a bounded, documented sample,
the first by hash of the id); every vector belongs to its nearest one and
keeps its distance to it. Below, pages of at most ``PAGE_ROWS`` vectors
each hold a subtree: nodes with a routing object, a covering radius, the
distance to the parent's routing object, and leaves with the distance of
every entry. A query first searches the pages of its nearest routing
vector; its k-th score then rules out whole routing vectors (by covering
radius and nearest member) and, in the pages left, nodes and entries: first
by stored distances alone, without computing anything, then by distance.

Queries travel in blocks of at most ``BLOCK_QUERIES``; blocks and pages
meet by an equi-join on the routing vector and a salt, so a routing vector
with a third of all rows is spread over many tasks.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part; shorter vectors count as padded with zeros; equal
scores go to the smaller id; repeated rows are separate candidates, while a
repeated query id is answered once; rows with the query's own id are never its candidates;
fewer than k candidates are all returned; an empty table gives an empty
result; further columns are not looked at. Scores are exact: inner
products are computed in doubles, which hold integers below 2^53, so a
vector with a squared norm of 2^53 or more (components of about 90,000 and
up) raises an error instead of giving a wrong score.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm._util import bound_batches, staged, table

PIVOTS, PAGE_ROWS, LEAF_ROWS, FANOUT, BLOCK_QUERIES = 64, 4096, 48, 12, 128
#: Pages a routing vector has in one salt, on average over all.
PAGES_PER_SALT = 16
SCALE = 1024
EXACT = 2.0 ** 53


def quantized(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, v, norm): floor(1024 x) as little-endian 64-bit integers, and the squared norm."""
    bound_batches(vectors.sparkSession)

    def each(batches):
        for batch in batches:
            ids, raw, norms = [], [], []
            for i, x in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                if i is None or not x or any(c is None for c in x):
                    continue
                x = np.array(x, np.float64)
                if not np.isfinite(x).all():
                    continue
                q = np.floor(SCALE * x)
                if float(q @ q) >= EXACT:
                    raise OverflowError(f"vector {i}: its squared norm of {float(q @ q):.3g} is beyond exact scores (2^53)")
                q = q.astype("<i8")
                ids.append(i)
                raw.append(q.tobytes())
                norms.append(int(q @ q))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(norms, pa.int64())],
                                             ["id", "v", "norm"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(
        each, "id long, v binary, norm long")


def _matrix(raw: list[bytes], dims: int) -> np.ndarray:
    out = np.zeros((len(raw), dims))
    if raw and all(len(r) == 8 * dims for r in raw):
        return np.frombuffer(b"".join(raw), "<i8").reshape(-1, dims).astype(np.float64)
    for i, r in enumerate(raw):
        out[i, :len(r) // 8] = np.frombuffer(r, "<i8")
    return out


def _lifted(x: np.ndarray, most: int) -> np.ndarray:
    """Vectors with the coordinate that makes all norms equal."""
    rest = np.sqrt(np.maximum(most - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    d = x - to
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Page:
    """A subtree over the rows of one page, as arrays: one entry per node, children and leaf entries contiguous.

    ``center`` is the row of the routing object, ``radius`` covers all rows below, ``parent`` is the distance to the parent's
    routing object; ``first``/``last`` are child nodes, or positions in ``order`` if ``leaf``.
    """

    def __init__(self, x: np.ndarray, most: int):
        self.x, self.points = x, _lifted(x, most)
        self.center, self.radius, self.parent, self.first, self.last, self.leaf = [], [], [], [], [], []
        self.order, self.entry = [], []
        if len(x):
            self._node()
            self._grow(0, np.arange(len(x)), None)
        for name, kind in (("center", np.int64), ("radius", np.float64), ("parent", np.float64), ("first", np.int64),
                           ("last", np.int64), ("leaf", bool), ("order", np.int64), ("entry", np.float64)):
            setattr(self, name, np.array(getattr(self, name), kind))

    def _node(self) -> int:
        for values, v in ((self.center, -1), (self.radius, 0.0), (self.parent, 0.0), (self.first, 0), (self.last, 0), (self.leaf, True)):
            values.append(v)
        return len(self.center) - 1

    def _grow(self, node: int, rows: np.ndarray, above: int | None) -> None:
        points = self.points
        middle = points[rows].mean(axis=0)
        center = int(rows[np.argmin(_distances(points[rows], middle))])
        d = _distances(points[rows], points[center])
        self.center[node], self.radius[node] = center, float(d.max())
        if above is not None:
            self.parent[node] = float(_distances(points[[center]], points[above])[0])
        if len(rows) <= LEAF_ROWS or d.max() == 0:
            by = np.argsort(d, kind="stable")
            self.first[node], self.last[node] = len(self.order), len(self.order) + len(rows)
            self.order.extend(rows[by].tolist())
            self.entry.extend(d[by].tolist())
            return
        # this node's object and others far from all before, then every row to the nearest: two groups at least
        near, owner, chosen = d.copy(), np.zeros(len(rows), np.int64), 1
        while chosen < FANOUT and near.max() > 0:
            to = _distances(points[rows], points[rows[int(np.argmax(near))]])
            owner = np.where(to < near, chosen, owner)
            near = np.minimum(near, to)
            chosen += 1
        groups = [g for g in (rows[owner == k] for k in range(chosen)) if len(g)]
        children = [self._node() for _ in groups]
        self.leaf[node], self.first[node], self.last[node] = False, children[0], children[-1] + 1
        for child, group in zip(children, groups):
            self._grow(child, group, center)

    def search(self, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray, most: int):
        """Best-first over the nodes for a block of queries: (query, id, score) with at most k rows of at least its floor for each.

        A node waits with the queries that may still need it, by the lowest of their bounds; every query has a reach of its own,
        the distance beyond which nothing can enter its result.
        """
        n = len(queries)
        q2 = np.einsum("ij,ij->i", queries, queries)
        lifted = np.concatenate([queries, np.zeros((n, 1))], axis=1)
        slack = 0.5 + 1e-9 * (q2 + most)                # scores are integers

        def reach_of(score):
            return np.where(np.isneginf(score), np.inf, np.sqrt(np.maximum(q2 + most - 2 * (np.maximum(score, -2.0 ** 60) - slack), 0)))

        def away(who, rows):
            x, y = lifted[who], self.points[rows]
            return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0))

        # distances from squares: their rounding error, as a distance, widens every comparison
        blur = 1e-6 * (1 + np.sqrt(q2 + most))
        top, held = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        reach = reach_of(floors) + blur
        everyone = np.arange(n)
        d0 = away(everyone, self.center[:1])[:, 0]
        low = np.maximum(d0 - self.radius[0], 0)
        heap = [(float(low.min()), 0, everyone, d0, low)]
        while heap:
            _, node, who, d, low = heapq.heappop(heap)
            stay = low <= reach[who]
            who, d = who[stay], d[stay]
            if not len(who):
                continue
            a, b = self.first[node], self.last[node]
            if self.leaf[node]:
                near = np.abs(d[:, None] - self.entry[None, a:b]) <= reach[who][:, None]    # stored distances alone
                some = near.any(axis=0)
                rows = self.order[a:b][some]
                if not len(rows):
                    continue
                scores = queries[who] @ self.x[rows].T
                scores[~near[:, some] | (ids[rows][None] == own[who][:, None])] = -np.inf
                both = np.concatenate([top[who], scores], axis=1)
                names = np.concatenate([held[who], np.broadcast_to(ids[rows], scores.shape)], axis=1)
                best = np.lexsort((names, -both), axis=1)[:, :k]
                top[who], held[who] = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
                reach = np.minimum(reach, reach_of(top[:, -1]) + blur)
            else:
                children = np.arange(a, b)
                near = np.abs(d[:, None] - self.parent[None, a:b]) - self.radius[None, a:b] <= reach[who][:, None]
                some = near.any(axis=0)
                children, near = children[some], near[:, some]
                to = away(who, self.center[children])
                bound = np.maximum(to - self.radius[children][None], 0)
                near &= bound <= reach[who][:, None]
                for j, c in enumerate(children.tolist()):
                    at = np.flatnonzero(near[:, j])
                    if len(at):
                        heapq.heappush(heap, (float(bound[at, j].min()), c, who[at], to[at, j], bound[at, j]))
        good = np.isfinite(top) & (top >= floors[:, None])
        return np.nonzero(good)[0], held[good], top[good].astype(np.int64)


def _assigned(rows: DataFrame, pivots: np.ndarray, dims: int, most: int) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""
    def each(batches):
        for batch in batches:
            points = _lifted(_matrix(batch.column("v").to_pylist(), dims), most)
            d = np.sqrt(np.maximum(((points[:, None, :] - pivots[None]) ** 2).sum(axis=2), 0)) if len(points) else np.zeros((0, len(pivots)))
            near = d.argmin(axis=1) if len(points) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                                             ["id", "v", "norm", "pivot", "away"])

    return rows.mapInArrow(each, "id long, v binary, norm long, pivot int, away double")


def _paged(rows: DataFrame, dims: int, most: int, page_rows: int) -> DataFrame:
    """Pages (pivot, salt, ids, x, tree arrays) of sorted rows: a page is closed when full or when the pivot or salt changes."""
    def emit(key, ids, raw):
        x = _matrix(raw, dims)
        page = Page(x, most)
        arrays = [np.array(ids, "<i8"), x.astype("<i8"), page.center, page.radius, page.parent, page.first, page.last, page.leaf,
                  page.order, page.entry]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()),
                                           *[pa.array([a.tobytes()], pa.binary()) for a in arrays]], _PAGE)

    def each(batches):
        key, ids, raw = None, [], []
        for batch in batches:
            for p, s, i, v in zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "id", "v"))):
                if ids and ((p, s) != key or len(ids) == page_rows):
                    yield emit(key, ids, raw)
                    ids, raw = [], []
                key = (p, s)
                ids.append(i)
                raw.append(v)
        if ids:
            yield emit(key, ids, raw)

    return rows.mapInArrow(each, "pivot int, salt long, " + ", ".join(f"{c} binary" for c in _PAGE[2:]))


_PAGE = ["pivot", "salt", "ids", "x", "center", "radius", "parent", "first", "last", "leaf", "ordering", "entry"]


def _load(row: dict, dims: int, most: int) -> tuple[np.ndarray, Page]:
    page = Page(np.zeros((0, dims)), most)
    page.x = np.frombuffer(row["x"], "<i8").reshape(-1, dims).astype(np.float64)
    page.points = _lifted(page.x, most)
    for name, column, kind in (("center", "center", np.int64), ("radius", "radius", np.float64), ("parent", "parent", np.float64),
                               ("first", "first", np.int64), ("last", "last", np.int64), ("leaf", "leaf", bool),
                               ("order", "ordering", np.int64), ("entry", "entry", np.float64)):
        setattr(page, name, np.frombuffer(row[column], kind))
    return np.frombuffer(row["ids"], "<i8"), page


def _searched(pages: DataFrame, wanted: DataFrame, salts: int, dims: int, most: int, k: int) -> DataFrame:
    """(qid, id, score): per page the best of every query in ``wanted`` (qid, qv, floor, pivot)."""
    sent = wanted.select("qid", "qv", "floor", "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))

    def blocks(batches):
        key, rows = None, []

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.binary())), pa.array([[r[2] for r in rows]], pa.list_(pa.float64()))],
                ["bpivot", "bsalt", "qids", "qvs", "floors"])

        for batch in batches:
            for p, s, *r in zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "qid", "qv", "floor"))):
                if rows and ((p, s) != key or len(rows) == BLOCK_QUERIES):
                    yield out()
                    rows = []
                key = (p, s)
                rows.append(r)
        if rows:
            yield out()

    block = (sent.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "qid").mapInArrow(
        blocks, "bpivot int, bsalt long, qids array<long>, qvs array<binary>, floors array<double>"))
    met = block.join(pages, (block.bpivot == pages.pivot) & (block.bsalt == pages.salt)).select(
        "qids", "qvs", "floors", *_PAGE[2:])

    def search(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                ids, page = _load(one, dims, most)
                qids = np.array(one["qids"], np.int64)
                who, found, scores = page.search(ids, _matrix(one["qvs"], dims), qids, k, np.array(one["floors"], np.float64), most)
                yield pa.RecordBatch.from_arrays([pa.array(qids[who]), pa.array(found), pa.array(scores)], ["qid", "id", "score"])

    return met.mapInArrow(search, "qid long, id long, score long")


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
          pivots: int = PIVOTS, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for every row that meets ``queries`` (a condition on its id column), its best k others."""
    spark = vectors.sparkSession
    rows = staged(quantized(vectors, id_col, vector), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max("norm").alias("most"), F.max(F.length("v")).alias("bytes")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    dims, most = facts["bytes"] // 8, int(facts["most"])
    # a bounded sample: PIVOTS rows reach the driver
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()
    centers = np.unique(_lifted(_matrix([bytes(r["v"]) for r in sample], dims), most), axis=0)
    salts = max(1, -(-facts["n"] // (len(centers) * page_rows * PAGES_PER_SALT)))
    placed = staged(_assigned(rows, centers, dims, most).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts))), "placed-vectors")
    pages = staged(_paged(placed.select("pivot", "salt", "id", "v").repartition("pivot", "salt")
                          .sortWithinPartitions("pivot", "salt"), dims, most, page_rows), "metric-pages")
    # the directory: one row per pivot
    ring = {r["pivot"]: (r["low"], r["high"]) for r in placed.groupBy("pivot").agg(F.min("away").alias("low"), F.max("away").alias("high")).collect()}
    asked = (rows.where(queries).groupBy(F.col("id").alias("qid")).agg(F.min("v").alias("qv")))
    no_floor = F.lit(float("-inf"))

    def routed(with_floor: DataFrame, home: bool) -> DataFrame:
        """Queries with the pivots to search: the nearest that has rows, or all others that may hold better rows."""
        held = np.array(sorted(ring))
        low, high = np.array([ring[p][0] for p in held]), np.array([ring[p][1] for p in held])

        def each(batches):
            for batch in batches:
                q = _matrix(batch.column("qv").to_pylist(), dims)
                take, pivot = [], []
                for i, (x, floor) in enumerate(zip(q, batch.column("floor").to_pylist())):
                    d = _distances(centers[held], np.append(x, 0.0))
                    near = int(np.argmin(d))
                    if home:
                        chosen = [near]
                    else:
                        q2 = float(x @ x)
                        reach = np.inf if floor == -np.inf else np.sqrt(max(q2 + most - 2 * (floor - 0.5 - 1e-9 * (q2 + most)), 0.0))
                        chosen = [j for j in np.flatnonzero(np.maximum(d - high, low - d) <= reach).tolist() if j != near]
                    take += [i] * len(chosen)
                    pivot += held[chosen].tolist()
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(take, pa.int64())) for c in ("qid", "qv", "floor")],
                                                  pa.array(pivot, pa.int32())], ["qid", "qv", "floor", "pivot"])

        return with_floor.select("qid", "qv", "floor").mapInArrow(each, "qid long, qv binary, floor double, pivot int")

    best_first = Window.partitionBy("qid").orderBy(F.desc("score"), "id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)

    first = staged(best(_searched(pages, routed(asked.withColumn("floor", no_floor), True), salts, dims, most, k)), "first-round")
    floors = first.where(F.col("rank") == k).select("qid", F.col("score").cast("double").alias("kth"))
    second = _searched(pages, routed(asked.join(floors, "qid", "left").withColumn("floor", F.coalesce("kth", no_floor)), False),
                       salts, dims, most, k)
    out = best(first.select("qid", "id", "score").union(second))
    return out.select(F.col("qid").alias("query_id"), F.col("rank").cast("int").alias("rank"), "id", "score")


def op2_mtree_top_k(spark, sf_dir):
    """The 10 highest inner products of every hundredth vector with all others."""
    out = top_k(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 100 == 0)
    return out.withColumnRenamed("id", "vec_id")


OP2_SQL = """
WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
q AS (SELECT vec_id AS query_id, v AS qv FROM ok WHERE vec_id % 100 = 0),
s AS (SELECT query_id, vec_id, CAST(list_sum(list_transform(range(1, len(v) + 1), lambda i: qv[i] * v[i])) AS BIGINT) AS score
  FROM q JOIN ok ON query_id <> vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
