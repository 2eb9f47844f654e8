"""Exact top-k search by inner product over an M-tree.

An M-tree needs a metric, so every vector gets one more coordinate, sqrt(R^2 - |x|^2) with R the largest norm, and a query
a zero: then the squared distance is |q|^2 + R^2 - 2 q.x, and the nearest vectors are those of the
greatest inner product. The tree has three levels. Routing objects are drawn from a bounded sample and
every vector is filed under its nearest; each routing object's vectors are cut into subtrees of bounded size
(so a vector that makes up a third of the table fills many), and those into pages. A page stores its own
routing object, its covering radius and its distance to its parent; an entry its distance to the page's.

Subtrees are written once. A block of queries meets every subtree, and searches it best first: pages wait in the
order of the least distance they can hold. A page whose stored parent distance already shows it to be too
far costs no distance computation, nor does an entry that its own shows to be too far. Entries that are
left are scored exactly in integers. Subtrees give their k best for each query; the k best of those remain.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows without
an id. Shorter vectors are filled up with zeros. Of rows that share an id the one with the smallest
vector counts. Ties go to the smaller id; a query is never its own result; with fewer candidates than k all
are returned. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.session import durable, ship_package

ROUTERS = 64  # routing objects, drawn from as many rows
SUBTREE = 4096  # vectors in a subtree, about
PAGE = 256  # entries in a page
QUERY_BLOCK = 1024
SLACK = 1e-6  # relative: what rounding may hide in a bound


def quantized(vector: Column) -> Column:
    """Components as floor(256 * x), or null for a vector that takes no part."""
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), whole)


def _lifted(vectors: np.ndarray, radius2: float) -> np.ndarray:
    """Vectors with the coordinate that makes all norms equal."""
    plain = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(radius2 - (plain * plain).sum(axis=1), 0.0))
    return np.concatenate([plain, rest[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


class Subtree:
    """Pages of metric entries under one routing object."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, router: np.ndarray, radius2: float):
        lifted = _lifted(vectors, radius2)
        self.router = router
        self.pages = []
        # pages gather around entries that are spread evenly by their distance from the routing object
        order = np.argsort(_distances(lifted, router[None, :])[:, 0], kind="stable")
        seeds = lifted[order[:: max(1, PAGE // 2)]]
        nearest = _distances(lifted, seeds).argmin(axis=1)
        for seed, centre in enumerate(seeds):
            rows = np.flatnonzero(nearest == seed)
            to_parent = float(_distances(centre[None, :], router[None, :])[0, 0])
            apart = _distances(lifted[rows], centre[None, :])[:, 0]
            near = np.argsort(apart, kind="stable")
            for start in range(0, len(rows), PAGE):
                part = near[start : start + PAGE]
                radius = float(apart[part[-1]])
                self.pages.append((centre, radius, to_parent, apart[part], ids[rows[part]], vectors[rows[part]]))
        self.radii = np.array([p[1] for p in self.pages])
        self.to_parent = np.array([p[2] for p in self.pages])

    def search(self, query_id: int, query: np.ndarray, k: int, radius2: float) -> list[tuple[int, int]]:
        """The k best ``(score, id)`` of one query in this subtree, best first."""
        point = np.append(query.astype(np.float64), 0.0)
        scale = float(point @ point) + radius2
        slack = SLACK * (np.sqrt(scale) + 1.0)
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst on top
        to_router = float(np.sqrt(((point - self.router) ** 2).sum()))
        # what the stored parent distances say, before any page's own distance is computed
        least = np.maximum(np.abs(to_router - self.to_parent) - self.radii, 0.0)
        queue = [(bound, page, None) for page, bound in enumerate(least.tolist())]  # None: own distance not computed
        heapq.heapify(queue)
        reach = np.inf
        while queue:
            bound, page, away = heapq.heappop(queue)
            if bound > reach + slack:
                break
            centre, radius, _, apart, ids, vectors = self.pages[page]
            if away is None:
                away = float(np.sqrt(((point - centre) ** 2).sum()))
                heapq.heappush(queue, (max(bound, away - radius), page, away))
                continue
            low, high = (0, len(apart)) if reach == np.inf else np.searchsorted(apart, [away - reach - slack, away + reach + slack])
            if low >= high:
                continue
            scores = vectors[low:high] @ query
            own = ids[low:high] != query_id
            floor = best[0][0] if len(best) == k else None
            keep = np.flatnonzero(own if floor is None else own & (scores >= floor))
            for score, name in zip(scores[keep].tolist(), ids[low:high][keep].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (score, -name))
                elif (score, -name) > best[0]:
                    heapq.heapreplace(best, (score, -name))
            if len(best) == k:
                reach = float(np.sqrt(max(scale - 2.0 * best[0][0], 0.0)))
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of 32-bit components; what the table rejects would not fit."""
    return np.stack([np.frombuffer(x.as_buffer(), "<i8") for x in column])


def search_top_k(embeddings: DataFrame, queries: Column, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows ``queries`` holds for, against all rows.

    ``embeddings`` has ``vec_id`` and ``embedding``.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    usable = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), quantized(F.col("embedding")).alias("vector"))
    usable = usable.where("vec_id IS NOT NULL AND vector IS NOT NULL").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = durable(usable, "zstd")
    norm = F.aggregate("vector", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    seen = rows.agg(F.max(norm).alias("norm"), F.max(F.size("vector")).alias("width"), F.count("*").alias("n")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not seen["n"]:
        return spark.createDataFrame([], schema)
    radius2, width = float(seen["norm"]), max(seen["width"], 1)

    def padded(vectors: list) -> np.ndarray:
        out = np.zeros((len(vectors), width), np.int64)
        for row, vector in enumerate(vectors):
            out[row, : len(vector)] = vector
        return out

    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(ROUTERS).collect()
    routers = _lifted(padded([r["vector"] for r in drawn]), radius2)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = padded(batch.column(1).to_pylist())
            nearest = _distances(_lifted(vectors, radius2), routers).argmin(axis=1).astype(np.int32)
            data = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data, pa.array(nearest)], ["vec_id", "data", "router"])

    filed = durable(rows.mapInArrow(file, "vec_id bigint, data binary, router int"), "zstd")
    sizes = filed.groupBy("router").agg(F.ceil(F.count("*") / SUBTREE).cast("int").alias("cuts"))
    cut = F.pmod(F.xxhash64("vec_id"), F.col("cuts")).cast("int")
    placed = filed.join(F.broadcast(sizes), "router").withColumn("cut", cut)  # a row for each routing object
    grouped = ["router", "cut"]
    trees = durable(placed.groupBy(*grouped).agg(F.collect_list("vec_id").alias("ids"), F.collect_list("data").alias("data")))
    asked = filed.where(queries)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    asked = asked.groupBy(block.alias("block")).agg(
        F.collect_list("vec_id").alias("query_ids"), F.collect_list("data").alias("query_data")
    )
    met = trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(durable(asked), "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                router, _, ids, data, query_ids, query_data = (batch.column(i)[row] for i in range(6))
                tree = Subtree(np.array(ids.as_py(), np.int64), _vectors(data.values), routers[router.as_py()], radius2)
                out = [], [], []
                for query_id, query in zip(query_ids.as_py(), _vectors(query_data.values), strict=True):
                    for score, name in tree.search(query_id, query, k, radius2):
                        for column, value in zip(out, (query_id, name, score), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    wanted = met.select(*grouped, "ids", "data", "query_ids", "query_data")
    found = wanted.repartition(*grouped).mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
