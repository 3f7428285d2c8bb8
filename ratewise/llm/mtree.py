"""Exact top-k search by inner product over M-trees.

Vectors become whole numbers. With one more component that lifts every vector to the same norm, a larger
inner product is a smaller Euclidean distance, so triangle inequalities hold. Vectors are dealt to cells of
near pivots and cells are cut into blocks of bounded size; each block is an M-tree whose pages have a routing
vector, a covering radius and their entries' distances to it. A query first searches one block near it; the
k-th distance found there then rules out cells, pages and entries, unseen, by stored distances. Queries are
cut into slices as well, so a task holds one block and one slice at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import stage

SCALE = 64
#: The index's shape: pivots at most, vectors to a block, entries to a page, queries to a slice.
PIVOTS, BLOCK, PAGE, SLICE = 1024, 4096, 256, 4096
#: Queries that visit the pages of a block together.
TOGETHER = 512
_SLACK = 1e-6


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a double holds it."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number products of the rows of a and b; by floating point only where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**52:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def unpack(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<i8").reshape(-1, dim)


def distances(products_: np.ndarray, a_norm: np.ndarray, b_norm: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(a_norm[:, None] + b_norm[None, :] - 2.0 * products_, 0))


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """The extra component that gives each vector the squared norm `top`."""
    return np.sqrt(np.maximum(top - (x.astype(np.float64) ** 2).sum(axis=1), 0))


def between(a: np.ndarray, a_up: np.ndarray, b: np.ndarray, b_up: np.ndarray) -> np.ndarray:
    """Euclidean distances of lifted vectors."""
    square = lambda x, up: (x.astype(np.float64) ** 2).sum(axis=1) + up**2
    return distances(products(a, b) + a_up[:, None] * b_up[None, :], square(a, a_up), square(b, b_up))


class Tree:
    """One block: pages of entries around routing vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float, page: int = PAGE):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.top = ids[order], x[order], top
        up = lifted(self.x, top)
        n = len(ids)
        at = np.linspace(0, n - 1, max(1, math.ceil(n / page))).astype(int)
        d = between(self.x, up, self.x[at], up[at])
        nearest = d.argmin(axis=1)
        self.routing, self.routing_up = self.x[at], up[at]
        # The entries of a page by their distance to its routing vector.
        by = np.lexsort((d[np.arange(n), nearest], nearest))
        ends = np.searchsorted(nearest[by], np.arange(len(at) + 1))
        self.pages = [by[a:b] for a, b in zip(ends, ends[1:])]
        self.to_routing = [d[p, k] for k, p in enumerate(self.pages)]
        self.radius = np.array([t.max(initial=0.0) for t in self.to_routing])

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Queries, ids and scores of the k best of each query beside itself, at distances up to the bound; and
        the number of distances computed. Queries near the same page search together."""
        to_routing = between(q, np.zeros(len(q)), self.routing, self.routing_up)
        near = np.argsort(to_routing.argmin(axis=1), kind="stable")
        found, computed = [], 0
        for start in range(0, len(q), TOGETHER):
            at = near[start : start + TOGETHER]
            own, ids, scores, n = self._together(query_ids[at], q[at], k, bounds[at], to_routing[at])
            found.append((query_ids[at][own], ids, scores))
            computed += n
        return *(np.concatenate([f[i] for f in found] or [np.empty(0, np.int64)]) for i in range(3)), computed

    def _together(self, query_ids: np.ndarray, q: np.ndarray, k: int, bounds: np.ndarray, to_routing: np.ndarray):
        """Best first for several queries: pages by their least bound over the queries, each of which leaves out
        the pages beyond its own reach."""
        norms = (q.astype(np.float64) ** 2).sum(axis=1)
        reach, computed = bounds + _SLACK, 0
        low = np.maximum(to_routing - self.radius, 0)
        own = ids = scores = np.empty(0, np.int64)
        for p in np.argsort(low.min(axis=0, initial=np.inf), kind="stable").tolist():
            asks = np.flatnonzero(low[:, p] <= reach)
            if not len(asks) or not len(self.pages[p]):
                continue
            # Entries within reach of any of them, by the stored distances to the routing vector.
            first = np.searchsorted(self.to_routing[p], (to_routing[asks, p] - reach[asks]).min(), "left")
            last = np.searchsorted(self.to_routing[p], (to_routing[asks, p] + reach[asks]).max(), "right")
            rows = self.pages[p][first:last]
            if not len(rows):
                continue
            score = products(q[asks], self.x[rows])
            computed += score.size
            least = (norms[asks] + self.top - reach[asks] ** 2) / 2 - 1
            if len(rows) > k + 1:  # one of them may be the query itself
                least = np.maximum(least, np.partition(score, len(rows) - k - 1, axis=1)[:, len(rows) - k - 1])
            i, j = np.nonzero(score >= least[:, None])
            other = self.ids[rows[j]] != query_ids[asks[i]]
            i, j = i[other], j[other]
            own, ids, scores = np.append(own, asks[i]), np.append(ids, self.ids[rows[j]]), np.append(scores, score[i, j])
            order = np.lexsort((ids, -scores, own))
            place = np.arange(len(order)) - np.searchsorted(own[order], own[order])
            order = order[place < k]
            own, ids, scores = own[order], ids[order], scores[order]
            ends = np.flatnonzero(np.bincount(own, minlength=len(q)) == k)
            kth = scores[np.searchsorted(own, ends, "right") - 1]
            reach[ends] = np.minimum(reach[ends], np.sqrt(np.maximum(norms[ends] + self.top - 2.0 * kth, 0)) + _SLACK)
        return own, ids, scores, computed


def _searcher(k: int, top: float):
    schema = "query_id long, vec_id long, score long"

    def search(key, block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if block.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        dim = len(block["x"].iloc[0]) // 8
        tree = Tree(block["vec_id"].to_numpy(np.int64), unpack(block["x"], dim), top)
        own, ids, scores, _ = tree.search(queries["query_id"].to_numpy(np.int64), unpack(queries["x"], dim), k, queries["bound"].to_numpy(np.float64))
        return pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores})

    return search, schema


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the highest whole-number inner product of each query.

    Ties go to the smaller id. Null vectors, vectors with null or non-finite components and null ids take no
    part; only vectors of equal length are compared. Ids must be unique: rows that repeat an id count once
    (the smallest vector). An empty table gives no rows. More than 64 different lengths raise.
    """
    pack = F.col(vector_col)
    spark = vectors.sparkSession
    known = vectors.filter(F.col(id_col).isNotNull() & usable(pack)).select(F.col(id_col).cast("long").alias("vec_id"), whole_numbers(pack, scale).alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    known = stage(known.groupBy("vec_id").agg(F.min("x").alias("x"), F.max("asks").alias("asks")), "mtree-vectors")
    size = F.size("x")
    norm = F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    shape = known.groupBy(size.alias("dim")).agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("asks"), F.max(norm).alias("top")).filter("dim > 0").limit(65).collect()
    if len(shape) > 64:
        raise ValueError("vectors of more than 64 different lengths")
    parts = [_top_k(known.filter(size == r["dim"]), r["n"], r["asks"], r["top"], k, block) for r in shape if r["asks"]]
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _top_k(known: DataFrame, n: int, asks: int, top: float, k: int, block: int) -> DataFrame:
    spark = known.sparkSession
    count = min(PIVOTS, max(1, math.ceil(n / block)))
    rows = known.orderBy(F.xxhash64("vec_id"), "vec_id").select("x").limit(count).collect()  # bounded by PIVOTS
    pivots = np.array([r["x"] for r in rows], dtype=np.int64)
    up = lifted(pivots, top)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), dtype=np.int64).reshape(-1, pivots.shape[1])
            d = between(x, lifted(x, top), pivots, up)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.astype("<i8").tobytes() for r in x], pa.binary()), batch.column("asks"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell] if len(x) else np.empty(0))],
                names=["vec_id", "x", "asks", "cell", "away"],
            )

    placed = stage(known.mapInArrow(assign, "vec_id long, x binary, asks boolean, cell int, away double"), "mtree-cells")
    cells = {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()}
    blocks = np.array([math.ceil(cells.get(c, (0, 0))[0] / block) for c in range(len(pivots))], dtype=np.int64)
    radius = np.array([cells.get(c, (0, 0.0))[1] for c in range(len(pivots))])
    slices = max(1, math.ceil(asks / SLICE))
    sub = F.element_at(F.lit(blocks.tolist()).cast("array<long>"), F.col("cell") + 1)
    slice_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slices)).cast("int")
    held = placed.select("vec_id", "x", "cell", F.pmod(F.xxhash64("vec_id"), sub).cast("int").alias("sub"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    queries = placed.filter("asks").select(F.col("vec_id").alias("query_id"), "x", "cell", F.pmod(F.xxhash64("vec_id"), sub).cast("int").alias("sub"), slice_of.alias("slice"))
    search, schema = _searcher(k, top)
    key = ["cell", "sub", "slice"]
    # The first visit needs a query's own block alone, so no vector is copied for the slices.
    home = ["cell", "sub"]
    once = placed.select("vec_id", "x", "cell", F.pmod(F.xxhash64("vec_id"), sub).cast("int").alias("sub"))
    near = stage(once.groupBy(*home).cogroup(queries.withColumn("bound", F.lit(float("inf"))).groupBy(*home)).applyInPandas(search, schema), "mtree-near")
    # The k-th score near the query, if there are k.
    kth = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).select(F.col("query_id").alias("k_query"), F.when(F.col("n") >= k, F.col("kth")).alias("kth"))
    asked = queries.join(kth, queries["query_id"] == kth["k_query"], "left").select("query_id", "x", "cell", "sub", "slice", "kth")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query_id", "x", "cell", "sub", "slice", "bound"]
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                q = unpack(batch.column("x").to_pylist(), pivots.shape[1])
                kth = np.array([np.nan if v is None else v for v in batch.column("kth").to_pylist()], dtype=np.float64)
                reach = np.where(np.isnan(kth), np.inf, np.sqrt(np.maximum((q.astype(np.float64) ** 2).sum(axis=1) + top - 2 * np.nan_to_num(kth), 0)))
                open_ = between(q, np.zeros(len(q)), pivots, up) - radius[None, :] <= reach[:, None] + _SLACK
                home = list(zip(batch.column("cell").to_pylist(), batch.column("sub").to_pylist()))
                out = [(i, c, s) for i in range(len(q)) for c in np.flatnonzero(open_[i]).tolist() for s in range(blocks[c]) if (c, s) != home[i]]
                at = pa.array([o[0] for o in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id").take(at), batch.column("x").take(at), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32()), batch.column("slice").take(at), pa.array([float(reach[o[0]]) for o in out], pa.float64())],
                    names=names,
                )

    routed = asked.mapInArrow(route, "query_id long, x binary, cell int, sub int, slice int, bound double")
    rest = held.groupBy(*key).cogroup(routed.groupBy(*key)).applyInPandas(search, schema)
    return near.unionByName(rest)
