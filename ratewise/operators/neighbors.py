"""Exact k-nearest-neighbour joins and classification.

Train rows are assigned to the nearest of a few pivots, at most the root of their number and ``PIVOTS``. A cell knows the
range of its members' distances to the pivot and the box of their leading components under one rotation
(the sample's principal axes), with the norm of what is left; every row stores its own. Each of these bounds
the distance of a query row to a member from below, cell by cell and then row by row.

Query rows visit cells in the order of that bound: first the nearest cell, then, in a single round, all others that the
k-th distance found does not rule out. Rows that have not found k yet visit eightfold as many cells before that. Cells
are packed into slabs, cut where they are crowded: about ``SLABS`` at any size until a slab would not fit into a task. In
a round a query row is sent once to each slab that holds a cell it visits, with a bit for each cell there, and the slab is
sent once for each slice of its query rows; so what is shuffled grows with the rows, and not with the cells or rounds. A
task sees one slice and one slab, goes through them tile by tile with the k-th distance found so far, and returns at most
k rows per query row. Vectors travel in single precision where that is exact.

Equal train vectors are reduced to their k smallest ids first: more copies can never be among the k nearest,
so a group of copies of any size costs k rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.operators.sampling import hash_sample
from ratewise.sources.scratch import stage

BLOCK_ROWS = 4096  # a slab's rows, if there are not more than SLABS times as many
SLABS, SLAB_ROWS, SLAB_VALUES = 5, 1 << 17, 1 << 23  # above these rows, or components, there are more slabs
TILE, TILE_TRAIN = 1024, 2048  # query and train rows that are compared at once
PIVOTS = 256
CELL_ROWS = 256  # a pivot stands for at least so many train rows
GROWTH = 8  # of the cells visited up to a round, by rows that have not found k yet
LEAD = 8  # leading components that are stored beside a vector
SPARSE = 0.25  # share of a block's pairs below which they are looked at one by one
NO_GROUP = -1


def vector_of(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in cols])


def points(df: DataFrame, id_column: str, vector: str | Column, y: str | Column, group: str | None = None) -> DataFrame:
    """(id, v, y, g): the input form of every function below. Ids are whole numbers or texts. Rows never become
    neighbours of rows of their own group; without a group column everything may match."""
    v = F.col(vector) if isinstance(vector, str) else vector
    y = F.col(y) if isinstance(y, str) else y
    id_ = F.col(f"`{id_column}`")
    whole = dict(df.dtypes)[id_column] in ("tinyint", "smallint", "int", "bigint")
    return df.select(
        id_.cast("long" if whole else "string").alias("id"),
        v.cast("array<double>").alias("v"),
        y.cast("int").alias("y"),
        (F.col(group).cast("int") if group else F.lit(NO_GROUP)).alias("g"),
    )


def _id_type(*frames: DataFrame) -> str:
    return "long" if all(dict(f.dtypes)["id"] == "bigint" for f in frames) else "string"


def _ids(column: pd.Series, kind: str) -> np.ndarray:
    return column.to_numpy(dtype=np.int64) if kind == "long" else column.to_numpy(dtype=object)


def _to_bytes(v: np.ndarray) -> list[bytes]:
    """Each row's components, in single precision if that loses nothing."""
    with np.errstate(over="ignore"):
        single = v.astype("<f4")
    short = (single == v).all(1)
    return [a.tobytes() if s else b.tobytes() for a, b, s in zip(single, v.astype("<f8", copy=False), short)]


def _from_bytes(column: pd.Series, width: int) -> np.ndarray:
    rows = column.tolist()
    short = np.fromiter(map(len, rows), np.int64, len(rows)) == 4 * width
    out = np.empty((len(rows), width))
    for kind, where in (("<f4", short), ("<f8", ~short)):
        at = np.flatnonzero(where)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at]), kind).reshape(len(at), width)
    return out


@dataclass
class _Axes:
    """Where vectors are seen from: the sample's mean and its leading principal axes."""

    centre: np.ndarray
    axes: np.ndarray  # components x leading ones

    def lead(self, v: np.ndarray) -> np.ndarray:
        """The leading components, and the norm of the rest as the last column."""
        moved = v - self.centre
        lead = moved @ self.axes
        rest = np.sqrt(np.maximum((moved * moved).sum(1) - (lead * lead).sum(1), 0.0))
        return np.column_stack([lead, rest])


@dataclass
class _Cells:
    """What is known about the train cells: one row per pivot."""

    pivots: np.ndarray
    size: np.ndarray
    nearest: np.ndarray
    farthest: np.ndarray
    low: np.ndarray  # boxes of the members' leading components
    high: np.ndarray
    axes: _Axes
    scale: float


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def _without_spare_copies(train: DataFrame, k: int) -> DataFrame:
    """Keep the k smallest ids of every group of equal vectors. The rank limit also applies before the
    shuffle, and comparing a hash first keeps the sort cheap."""
    copies = Window.partitionBy(F.xxhash64("v"), "v", "g").orderBy("id")
    return train.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k).drop("copy")


def _principal(sample: np.ndarray) -> _Axes:
    centre = sample.mean(0)
    moved = sample - centre
    _, axes = np.linalg.eigh(moved.T @ moved)
    return _Axes(centre, np.ascontiguousarray(axes[:, ::-1][:, :LEAD]))


def _place(train: DataFrame, pivots: np.ndarray, axes: _Axes, kind: str, chunk: int = 256) -> DataFrame:
    """Adds each row's cell, its distance to the pivot and its leading components; vectors become bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), chunk):
                part = batch.iloc[start : start + chunk]
                v = np.stack(part["v"].to_numpy())
                d = _distances(v, pivots)
                cell = d.argmin(1)
                yield part.assign(v=_to_bytes(v), cell=cell.astype("int32"), dist=d[np.arange(len(cell)), cell], lead=list(axes.lead(v)))

    return train.mapInPandas(run, f"id {kind}, v binary, y int, g int, cell int, dist double, lead array<double>")


def _describe(placed: DataFrame, pivots: np.ndarray, axes: _Axes) -> _Cells:
    count, width = len(pivots), axes.axes.shape[1] + 1
    ends = [f(F.col("lead")[i]).alias(f"{n}{i}") for i in range(width) for f, n in ((F.min, "low"), (F.max, "high"))]
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"), *ends)
    size, nearest, farthest = np.zeros(count, dtype=np.int64), np.full(count, np.inf), np.zeros(count)
    low, high = np.zeros((count, width)), np.zeros((count, width))
    for r in stats.collect():  # one row per pivot
        c = r["cell"]
        size[c], nearest[c], farthest[c] = r["n"], r["lo"], r["hi"]
        low[c], high[c] = [r[f"low{i}"] for i in range(width)], [r[f"high{i}"] for i in range(width)]
    scale = float(np.sqrt((pivots * pivots).sum(1)).max()) + float(farthest.max()) + 1e-300
    return _Cells(pivots, size, nearest, farthest, low, high, axes, scale)


def _cell_bounds(v: np.ndarray, cells: _Cells) -> tuple[np.ndarray, np.ndarray]:
    """For each row and cell what no member's distance is below, and the distance to the pivot."""
    d = _distances(v, cells.pivots)
    lead = cells.axes.lead(v)
    slack = 1e-5 * (cells.scale + np.sqrt((v * v).sum(1)))  # covers rounding in the distances
    low = np.maximum(d - cells.farthest[None, :], cells.nearest[None, :] - d)
    own = d.argmin(1)
    between = _distances(cells.pivots[own], cells.pivots)
    near = d[np.arange(len(d)), own]
    far_enough = between > 1e-3 * cells.scale
    plane = np.where(far_enough, (d * d - (near * near)[:, None]) / np.where(far_enough, 2.0 * between, 1.0), -np.inf)
    box = np.zeros_like(d)
    for i in range(lead.shape[1]):
        gap = np.maximum(np.maximum(cells.low[None, :, i] - lead[:, None, i], lead[:, None, i] - cells.high[None, :, i]), 0.0)
        box += gap * gap
    low = np.maximum(np.maximum(low, plane), np.sqrt(box)) - slack[:, None]
    return np.where((cells.size > 0)[None, :], np.maximum(low, 0.0), np.inf), d


@dataclass
class _Slabs:
    """Where the train rows of each cell lie: its rows are dealt to ``pieces[cell]`` pieces, each in a slab."""

    pieces: list[int]
    units: list[tuple[int, int, int]]  # cell, piece, slab
    cells: list[np.ndarray]  # of each slab
    rows: int  # of a slab, about


def _pack(size: np.ndarray, rows: int) -> _Slabs:
    """Cells in their order, cut into pieces of at most ``rows`` rows (about: rows are dealt by a hash), into slabs."""
    pieces = [max(1, -(-int(n) // rows)) for n in size]
    units, cells, room = [], [], 0
    for cell, n in enumerate(size):
        for piece in range(pieces[cell]):
            need = -(-int(n) // pieces[cell])
            if not cells or need > room:
                cells.append([])
                room = rows
            cells[-1].append(cell)
            units.append((cell, piece, len(cells) - 1))
            room -= need
    return _Slabs(pieces, units, [np.unique(c) for c in cells], rows)


def _visited(part: pd.DataFrame, v: np.ndarray, cells: _Cells, start: int, stop: int) -> np.ndarray:
    """Rows x cells: whether a row visits a cell in this round. These are the cells from place ``start`` of the row's order on that may hold
    something within its bound; without a bound, up to place ``stop``. The order does not change with the bound, so no
    visit comes twice."""
    low, d = _cell_bounds(v, cells)
    order = np.lexsort((d, low), axis=1)[:, start:]
    fits = np.take_along_axis(low, order, axis=1)
    bound = part["bound"].to_numpy(dtype=np.float64)[:, None]
    goes = np.isfinite(fits) & (fits <= bound * (1 + 1e-9)) & (np.isfinite(bound) | (np.arange(start, len(cells.size)) < stop))
    out = np.zeros(low.shape, bool)
    np.put_along_axis(out, order, goes, axis=1)
    return out


def _visits(asked: DataFrame, cells: _Cells, start: int, stop: int, chunk: int = 256) -> DataFrame:
    """(cell): one row per visit of this round, equal ones together."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), chunk):
                part = batch.iloc[first : first + chunk]
                goes = _visited(part, np.stack(part["v"].to_numpy()), cells, start, stop)
                yield pd.DataFrame({"cell": np.repeat(np.arange(goes.shape[1], dtype=np.int32), goes.sum(0))})

    return asked.select("v", "bound").mapInPandas(run, "cell int")


def _route(asked: DataFrame, cells: _Cells, slabs: _Slabs, start: int, stop: int, kind: str, chunk: int = 256) -> DataFrame:
    """One row per query row and slab of this round's visits; ``cells`` has a bit for each cell of the slab."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), chunk):
                part = batch.iloc[first : first + chunk]
                v = np.stack(part["v"].to_numpy())
                goes = _visited(part, v, cells, start, stop)
                part = part.assign(v=_to_bytes(v))
                for slab, held in enumerate(slabs.cells):
                    here = goes[:, held]
                    some = np.flatnonzero(here.any(1))
                    if len(some):
                        yield part.iloc[some].assign(slab=np.int32(slab), cells=[b.tobytes() for b in np.packbits(here[some], axis=1)])

    return asked.mapInPandas(run, f"id {kind}, v binary, y int, g int, bound double, slab int, cells binary")


def closest_pairs(
    a: np.ndarray, b: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None, bound: np.ndarray, k: int, lead_a: np.ndarray | None, lead_b: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k closest allowed rows of b for each row of a, ties by id.

    Leading components and norms of the rest, if given, rule out pairs beyond the bound. If many are left, a matrix
    product finds the candidates among them. Distances are then computed from differences, so equal
    vectors get equal distances in every block."""
    noise = 1e-9 * ((a * a).sum(1).max() + (b * b).sum(1).max()) + 1e-300
    most = bound * bound * (1 + 1e-9) + noise
    keep = allowed
    if lead_a is not None:
        near = np.square(_distances(lead_a, lead_b)) <= (most + 1e-5 * np.sqrt(np.where(np.isfinite(most), most * noise, 0.0)))[:, None] + noise
        keep = near if keep is None else near & keep
    if keep is None or keep.mean() > SPARSE:
        rough = (-2.0 * a) @ b.T
        rough += (b * b).sum(1)
        own = (a * a).sum(1)
        limit = most - own
        found = rough <= limit[:, None]
        if keep is not None:
            found &= keep
        # The k-th of those within the bound is looked for where the bound leaves many.
        if len(b) > k and found.sum() > 4 * k * len(a):
            rough[~found] = np.inf
            limit = np.minimum(limit, np.partition(rough, k - 1, axis=1)[:, k - 1] + noise)
            found = np.isfinite(rough) & (rough <= limit[:, None])
        keep = found
    rows, cols = np.nonzero(keep)
    exact = np.empty(len(rows))
    step = max(1, 4_000_000 // max(1, a.shape[1]))
    for s in range(0, len(rows), step):
        diff = a[rows[s : s + step]] - b[cols[s : s + step]]
        exact[s : s + step] = np.sqrt((diff * diff).sum(1))
    order = np.lexsort((ids[cols], exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    starts = np.searchsorted(rows, np.arange(len(a)))
    first = np.arange(len(rows)) - starts[rows] < k
    return rows[first], cols[first], exact[first]


def _nearest_in_slab(a, b, ids, cell, goes, qg, tg, bound, k, lead_a, lead_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, distance) of the k closest rows of b for each row of a, among the cells it goes to and the
    other groups, ties by id. ``b`` is sorted by ``cell``, whose numbers are the columns of ``goes``."""
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    if goes.mean() > 0.5:  # small cells together
        starts = starts[np.append(True, np.diff(starts // TILE_TRAIN) > 0)]
    ends = np.append(starts[1:], len(b))
    tiles = [(s, min(s + TILE_TRAIN, e)) for i, e in zip(starts, ends) for s in range(i, e, TILE_TRAIN)]
    use_lead, grouped, out = True, (qg != NO_GROUP).any(), []
    for q in range(0, len(a), TILE):
        part = slice(q, min(q + TILE, len(a)))
        most, kept = bound[part].copy(), tuple(np.empty(0, t) for t in (np.int64, np.int64, np.float64))
        for s, e in tiles:
            wants = goes[part][:, cell[s:e]] if cell[s] != cell[e - 1] else np.repeat(goes[part][:, cell[s : s + 1]], e - s, axis=1)
            some = np.flatnonzero(wants.any(1))
            if not len(some):
                continue
            whole = bool(wants[some].all())
            allowed = None if whole else wants[some]
            if grouped:
                other = (qg[part][some][:, None] != tg[None, s:e]) | (qg[part][some][:, None] == NO_GROUP)
                allowed = other if allowed is None else allowed & other
            leads = (lead_a[part][some], lead_b[s:e]) if use_lead and np.isfinite(most[some]).any() else (None, None)
            rows, cols, dist = closest_pairs(a[part][some], b[s:e], ids[s:e], allowed, most[some], k, *leads)
            if leads[0] is not None and q == 0 and whole:
                # Where the leading components rule out little they are not looked at again.
                use_lead = np.mean(_distances(*leads) <= most[some][:, None]) <= SPARSE
            rows, cols, dist = np.append(kept[0], some[rows]), np.append(kept[1], cols + s), np.append(kept[2], dist)
            order = np.lexsort((ids[cols], dist, rows))
            rows, cols, dist = rows[order], cols[order], dist[order]
            begin = np.searchsorted(rows, np.arange(part.stop - q + 1))
            first = np.arange(len(rows)) - begin[rows] < k
            full = np.flatnonzero(np.diff(begin) >= k)
            most[full] = np.minimum(most[full], dist[begin[full] + k - 1])
            kept = rows[first], cols[first], dist[first]
        out.append((kept[0] + q, kept[1], kept[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _visit(asked: DataFrame, visits: DataFrame, queries: int, placed: DataFrame, cells: _Cells, slabs: _Slabs, start: int, stop: int, k: int, kind: str, query_kind: str) -> DataFrame:
    """Compare every query row with the cells it visits; at most k rows per query row and slab come back."""
    asks = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row per cell
    slices = [max(1, -(-min(queries, sum(asks.get(int(c), 0) for c in held)) // slabs.rows)) for held in slabs.cells]
    spark = placed.sparkSession
    # One row per cell, or per piece of a crowded one.
    units = F.broadcast(spark.createDataFrame([(c, p, slabs.pieces[c], s, slices[s]) for c, p, s in slabs.units], "u_cell int, u_piece int, u_pieces int, slab int, slices int"))
    ways = F.broadcast(spark.createDataFrame(list(enumerate(slices)), "w_slab int, slices int"))
    piece = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = _route(asked, cells, slabs, start, stop, query_kind).join(ways, F.col("slab") == F.col("w_slab")).withColumn("slice", piece("slices")).drop("w_slab", "slices")
    right = placed.drop("dist", "lead").join(units, (F.col("cell") == F.col("u_cell")) & (piece("u_pieces") == F.col("u_piece")))
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("u_cell", "u_piece", "u_pieces", "slices")
    held, axes, width = slabs.cells, cells.axes, cells.pivots.shape[1]

    def compare(key: tuple, queries_part: pd.DataFrame, train_part: pd.DataFrame) -> pd.DataFrame:
        # An empty column of texts is not taken as a result; this row is left out below.
        nothing = pd.DataFrame({n: [None] for n in ("id", "y", "g", "neighbor", "neighbor_y", "distance")})
        if not len(queries_part) or not len(train_part):
            return nothing
        train_part = train_part.sort_values("cell", kind="stable")
        here = held[key[0]]
        bits = np.frombuffer(b"".join(queries_part["cells"]), dtype=np.uint8).reshape(len(queries_part), -1)
        goes = np.unpackbits(bits, axis=1)[:, : len(here)].astype(bool)
        ids, a, b = _ids(train_part["id"], kind), _from_bytes(queries_part["v"], width), _from_bytes(train_part["v"], width)
        qg = queries_part["g"].to_numpy()
        rows, cols, dist = _nearest_in_slab(
            a,
            b,
            ids,
            np.searchsorted(here, train_part["cell"].to_numpy()),
            goes,
            qg,
            train_part["g"].to_numpy(),
            queries_part["bound"].to_numpy(),
            k,
            axes.lead(a),
            axes.lead(b),
        )
        if not len(rows):
            return nothing
        return pd.DataFrame(
            {
                "id": queries_part["id"].to_numpy()[rows],
                "y": queries_part["y"].to_numpy()[rows],
                "g": qg[rows],
                "neighbor": ids[cols],
                "neighbor_y": train_part["y"].to_numpy()[cols],
                "distance": dist,
            }
        )

    found = f"id {query_kind}, y int, g int, neighbor {kind}, neighbor_y int, distance double"
    keys = ["slab", "slice"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, found).filter(F.col("distance").isNotNull())


def _closest(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("id").orderBy("distance", "neighbor")
    return (
        found.withColumn("rank", F.row_number().over(nearest))
        .filter(F.col("rank") <= k)
        .select("id", "y", "g", "rank", "neighbor", "neighbor_y", "distance")
    )


def knn_neighbors(
    train: DataFrame,
    test: DataFrame,
    k: int,
    block_rows: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(id, y, g, rank, neighbor, neighbor_y, distance) with the k closest train rows of every test row,
    ties by smaller neighbour id (texts by their bytes). Inputs come from ``points``; ids are unique within each
    side. An empty side gives no rows.

    ``block_rows`` fixes the rows of a slab. Only the pivots and one row per cell pass through the driver, the root of the
    train rows and ``PIVOTS`` at most."""
    kind, query_kind = _id_type(train), _id_type(test)
    train = stage(_without_spare_copies(train, k), "knn-points")
    size = train.count()
    pivot_count = max(1, min(math.isqrt(size), size // cell_rows, PIVOTS))
    sample = hash_sample(train.select("id", "v"), ["id"], pivot_count).collect()  # the root of the rows at most
    if not sample:
        return test.sparkSession.createDataFrame([], f"id {query_kind}, y int, g int, rank int, neighbor {kind}, neighbor_y int, distance double")
    pivots = np.array([r["v"] for r in sample], dtype=np.float64)
    axes = _principal(pivots)
    placed = stage(_place(train, pivots, axes, kind), "knn-train")
    cells = _describe(placed, pivots, axes)
    most = min(SLAB_ROWS, max(BLOCK_ROWS, SLAB_VALUES // pivots.shape[1]))
    slabs = _pack(cells.size, block_rows or max(BLOCK_ROWS, min(-(-size // SLABS), most)))
    asked, queries = test.withColumn("bound", F.lit(math.inf)), test.count()
    best, bound = None, None
    start, stop = 0, 1
    while True:
        visits = stage(_visits(asked, cells, start, stop), "knn-visits")
        found = _visit(asked, visits, queries, placed, cells, slabs, start, stop, k, kind, query_kind)
        best = stage(_closest(found if best is None else best.drop("rank").unionByName(found), k), "knn-best")
        if stop >= pivot_count:
            return best
        rest = test
        if bound is not None:  # rows that had one in this round have seen all cells within it
            rest = test.join(bound, F.col("id") == F.col("k_id"), "left_anti")
            queries = rest.count()
            if not queries:
                return best
        bound = best.filter(F.col("rank") == k).select(F.col("id").alias("k_id"), F.col("distance").alias("kth"))
        asked = rest.join(bound, F.col("id") == F.col("k_id"), "left").select("id", "v", "y", "g", F.coalesce("kth", F.lit(math.inf)).alias("bound"))
        start, stop = stop, stop * GROWTH


def knn_classify(train: DataFrame, test: DataFrame, k: int, **options) -> DataFrame:
    """(id, y, pred, score): uniform votes, score = share of positive votes, a tied vote is class 0."""
    votes = (
        knn_neighbors(train, test, k, **options)
        .groupBy("id")
        .agg(F.first("y").alias("y"), F.sum("neighbor_y").alias("votes"), F.count("*").alias("n"))
    )
    return votes.select(
        "id",
        "y",
        (F.col("votes") * 2 > F.col("n")).cast("int").alias("pred"),
        (F.col("votes") / F.col("n")).alias("score"),
    )


def knn_k_search(folded: DataFrame, k_max: int = 30, digits: int = 9, **options) -> DataFrame:
    """(k, accuracy_mean, accuracy_std, best) over the folds in ``g``. One neighbour pass at the largest k
    serves every k: the running vote over the neighbour rank is the vote of that many neighbours. Every k must be
    within reach of every row: the rows outside the largest fold are the limit."""
    per_group = folded.groupBy("g").agg(F.count("*").alias("n"))
    reachable = per_group.agg(F.sum("n") - F.max("n")).first()[0]
    if reachable is not None and reachable < k_max:
        raise ValueError(f"k_max is {k_max}, but some rows have only {reachable} others outside their fold")
    found = knn_neighbors(folded, folded, k_max, **options)
    so_far = Window.partitionBy("id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    voted = found.withColumn("votes", F.sum("neighbor_y").over(so_far))
    correct = ((F.col("votes") * 2 > F.col("rank")).cast("int") == F.col("y")).cast("double")
    per_fold = voted.groupBy(F.col("rank").alias("k"), "g").agg(F.avg(correct).alias("accuracy"))
    # Stored before the best row is looked up: the neighbour pass must not run twice.
    table = stage(
        per_fold.groupBy("k").agg(
            F.round(F.avg("accuracy"), digits).alias("accuracy_mean"),
            F.round(F.stddev_pop("accuracy"), digits).alias("accuracy_std"),
        ),
        "k-search",
    )
    best = table.agg(F.min_by("k", F.struct(-F.col("accuracy_mean"), "k")).alias("best_k"))
    return (
        table.join(F.broadcast(best), F.col("k") == F.col("best_k"), "left")  # one row
        .select("k", "accuracy_mean", "accuracy_std", F.col("best_k").isNotNull().alias("best"))
        .orderBy("k")
    )
