"""Hard negatives of anchors by Fagin's threshold algorithm over sorted component lists.

Vectors become whole numbers. Rows are dealt to chunks of bounded size; in a chunk every dimension has its
list of rows sorted by component. An anchor reads each list from the end its own component's sign favours
and computes the whole-number score of each row it meets. What it has not met scores at most the threshold,
the sum of its components times the last values read; a window of scores is done once that lies strictly
below its k-th score, or its lower end. One search gives an anchor's positives (same label, one open
window), a second its negatives (other labels, one window to a positive).

Chunks are visited in rounds that grow eightfold; the k-th scores of a round raise the windows' lower ends
in the next, so most rows of later chunks are neither met nor sent on. Anchors are cut into slices as well:
a task holds one chunk and one slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import stage
from ratewise.llm.mtree import products, usable, whole_numbers

SCALE = 256
#: Rows to a chunk, anchors to a slice, anchors scored at once, growth of the rounds.
CHUNK, SLICE, AT_ONCE, GROWTH = 8192, 2048, 256, 8
#: Scores are compared after a product with a percentage, which must fit into 64 bits.
_MOST = 2.0**56
_FAR = 1 << 62


class SortedLists:
    """A chunk's rows and, for each dimension, their places in order of the component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[by_id], labels[by_id], x[by_id]
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.values = np.take_along_axis(self.x, self.order, axis=0)
        self.norm = float(np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0.0))
        self.scored = 0

    def threshold(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """The most that rows not among the first `depth` of any list can score, for each anchor."""
        m = len(self.ids)
        last = max(depth, 1)
        return products(np.maximum(anchors, 0), self.values[m - last][None, :])[:, 0] + products(np.minimum(anchors, 0), self.values[last - 1][None, :])[:, 0]

    def met(self, anchor: np.ndarray, depth: int) -> np.ndarray:
        """The rows among the first `depth` of the anchor's lists."""
        m = len(self.ids)
        top, bottom = self.order[m - depth :, anchor > 0], self.order[:depth, anchor < 0]
        seen = np.zeros(m, bool)
        seen[top.ravel()] = True
        seen[bottom.ravel()] = True
        return np.flatnonzero(seen)

    def best(self, rows: np.ndarray, score: np.ndarray, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        inside = (score >= low) & (score <= high)
        rows, score = rows[inside], score[inside]
        if len(rows) > k:
            cut = np.partition(score, len(score) - k)[len(score) - k]
            rows, score = rows[score >= cut], score[score >= cut]
        # Rows are in order of their ids, so a stable sort resolves ties.
        order = np.argsort(-score, kind="stable")[:k]
        return rows[order], score[order]

    def search(self, anchors: np.ndarray, own: np.ndarray, labels: np.ndarray, lows: list, highs: list, k: int, same: bool) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, window, rows, scores): the k best rows of each window, of the anchor's label or another."""
        m, dims = len(self.ids), max(self.x.shape[1], 1)
        reach = np.ceil(np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1)) * self.norm * (1 + 1e-9)) + 1
        open_ = [[w for w in range(len(lows[i])) if lows[i][w] <= highs[i][w]] for i in range(len(anchors))]
        first = self.threshold(anchors, 1)
        # Nothing in this chunk reaches a window whose lower end lies above the first values of all lists.
        open_ = [[w for w in ws if lows[i][w] <= first[i]] for i, ws in enumerate(open_)]
        active = [i for i, ws in enumerate(open_) if ws]
        out, depth = [], max(1, m // (8 * dims))

        def fit(i: int, rows: np.ndarray, score: np.ndarray):
            ok = ((self.labels[rows] == labels[i]) if same else (self.labels[rows] != labels[i])) & (self.ids[rows] != own[i])
            rows, score = rows[ok], score[ok]
            return [(w, *self.best(rows, score, lows[i][w], highs[i][w], k)) for w in open_[i]]

        while active and depth * dims < m:
            limit = self.threshold(anchors[active], depth)
            going = []
            for i, most in zip(active, limit.tolist()):
                # No window's k-th score can be above its upper end, so sorted access goes on to where that may be reached.
                if most >= min(min(highs[i][w] for w in open_[i]), reach[i]):
                    going.append(i)
                    continue
                rows = self.met(anchors[i], depth)
                self.scored += len(rows)
                found = fit(i, rows, products(anchors[i : i + 1], self.x[rows])[0])
                if all(most < (int(score[-1]) if len(score) == k else lows[i][w]) for w, _, score in found):
                    out.extend((i, *f) for f in found)
                else:
                    going.append(i)
            active, depth = going, depth * 4
        everything = np.arange(m)
        for start in range(0, len(active), AT_ONCE):
            part = active[start : start + AT_ONCE]
            self.scored += len(part) * m
            for i, score in zip(part, products(anchors[part], self.x)):
                out.extend((i, *f) for f in fit(i, everything, score))
        return out


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(n, -1)


def _searcher(k: int, same: bool):
    schema = "anchor long, w int, vec_id long, score long"

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        found: list = []
        if held.num_rows and asked.num_rows:
            lists = SortedLists(held.column("vec_id").to_numpy(), held.column("label").to_numpy(), _vectors(held.column("x"), held.num_rows))
            own = asked.column("anchor").to_numpy()
            best = lists.search(_vectors(asked.column("x"), asked.num_rows), own, asked.column("label").to_numpy(), asked.column("lows").to_pylist(), asked.column("highs").to_pylist(), k, same)
            found = [(own[i], w, lists.ids[rows], score) for i, w, rows, score in best if len(rows)]
        size = [len(f[2]) for f in found]
        cat = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        return pa.table(
            {
                "anchor": pa.array(np.repeat(np.array([f[0] for f in found], np.int64), size)),
                "w": pa.array(np.repeat(np.array([f[1] for f in found], np.int32), size)),
                "vec_id": pa.array(cat([f[2] for f in found]).astype(np.int64)),
                "score": pa.array(cat([f[3] for f in found]).astype(np.int64)),
            }
        )

    return search, schema


def _top(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k)


def search_windows(rows: DataFrame, asked: DataFrame, k: int, same: bool, chunk: int = CHUNK, slice_: int = SLICE) -> DataFrame:
    """anchor, w, vec_id, score, rank: the k best rows of each window of each anchor.

    ``rows``: grp, vec_id, label, x; ``asked``: grp, anchor, label, x, lows, highs (one entry to a window,
    both ends included). Only rows of the anchor's group are searched, those of its own label or of others.
    """
    empty = rows.sparkSession.createDataFrame([], "anchor long, w int, vec_id long, score long, rank int")
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n")).join(asked.groupBy(F.col("grp").alias("a_grp")).agg(F.count("*").alias("asks")), F.col("grp") == F.col("a_grp"))
    sizes = stage(sizes.select(F.col("grp").alias("s_grp"), F.ceil(F.col("n") / chunk).alias("chunks"), F.ceil(F.col("asks") / slice_).alias("slices")), "hardneg-sizes")
    most = sizes.agg(F.max("chunks")).first()[0]
    if most is None:
        return empty
    place = lambda key, seed, count: F.pmod(F.xxhash64(key, F.lit(seed)), F.col(count)).cast("long")
    dealt = lambda df: df.join(sizes, F.col("grp") == F.col("s_grp"))
    held = dealt(rows).select("grp", "vec_id", "label", "x", "slices", place("vec_id", 1, "chunks").alias("chunk"))
    asked = stage(dealt(asked).select("grp", "anchor", "label", "x", "lows", "highs", "chunks", place("anchor", 2, "slices").alias("slice")), "hardneg-asked")
    search, schema = _searcher(k, same)
    key, best = ["grp", "chunk", "slice"], None
    start, stop = 0, 1
    while start < most:
        part = held.filter((F.col("chunk") >= start) & (F.col("chunk") < stop)).select("grp", "vec_id", "label", "x", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
        last = F.least(F.col("chunks"), F.lit(stop)) - 1
        going = asked.filter(F.col("chunks") > start).select("grp", "anchor", "label", "x", "lows", "highs", "slice", F.explode(F.sequence(F.lit(start).cast("long"), last)).alias("chunk"))
        found = part.groupBy(*key).cogroup(going.groupBy(*key)).applyInArrow(search, schema)
        if best is not None:
            found = found.unionByName(best.drop("rank"))
        best = stage(_top(found, k), "hardneg-best")
        start, stop = stop, stop * GROWTH
        if start < most:
            kth = best.filter(F.col("rank") == k).groupBy(F.col("anchor").alias("k_anchor")).agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth"))
            raised = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.element_at("kth", w), low)))
            asked = stage(asked.join(kth, F.col("anchor") == F.col("k_anchor"), "left").select("grp", "anchor", "label", "x", F.when(F.col("kth").isNull(), F.col("lows")).otherwise(raised).alias("lows"), "highs", "chunks", "slice"), "hardneg-asked")
    return best


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = CHUNK, slice_: int = SLICE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the whole-number inner product with the anchor. An
    anchor's positives are the `positives` best other rows of its label; for each, its negatives are the
    `negatives` best rows of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score. Ties go to the smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; only vectors
    of equal length are compared. Rows that repeat an id count once (the smallest label, then vector). Extra
    columns are ignored. An anchor without positives, and a positive without negatives, gives no rows, as
    does an empty table. Raises if scores could pass 2^56.
    """
    label = F.col("label") if label is None else label
    given = vectors.filter(F.col(id_col).isNotNull() & label.isNotNull() & usable(F.col(vector_col)))
    given = given.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), whole_numbers(F.col(vector_col), scale).alias("x"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    known = stage(given.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"), F.max("asks").alias("asks")).select("vec_id", "row.*", "asks"), "hardneg-vectors")
    norm = F.aggregate("x", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    if (known.agg(F.max(norm)).first()[0] or 0) >= _MOST:
        raise ValueError("scores could pass 2^56; use a smaller scale")
    by_label = F.concat_ws("/", F.size("x"), F.col("label"))
    anchors = known.filter("asks")
    ends = lambda v: F.array(F.lit(v).cast("long"))
    asked = anchors.select(by_label.alias("grp"), F.col("vec_id").alias("anchor"), "label", "x", ends(-_FAR).alias("lows"), ends(_FAR).alias("highs"))
    near = search_windows(known.select(by_label.alias("grp"), "vec_id", "label", "x"), asked, positives, True, chunk, slice_)
    near = near.select(F.col("anchor").alias("p_anchor"), (F.col("rank") - 1).cast("int").alias("p_w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # Whole numbers only: the least and the greatest score within the percentages.
    least = F.expr(f"(positive_score * {low} + 99 - pmod(positive_score * {low} + 99, 100)) div 100")
    greatest = F.expr(f"(positive_score * {high} - pmod(positive_score * {high}, 100)) div 100")
    windows = near.groupBy("p_anchor").agg(F.sort_array(F.collect_list(F.struct("p_w", least.alias("low"), greatest.alias("high")))).alias("ws"))
    asked = anchors.join(windows, F.col("vec_id") == F.col("p_anchor")).select(F.size("x").cast("string").alias("grp"), F.col("vec_id").alias("anchor"), "label", "x", F.col("ws.low").alias("lows"), F.col("ws.high").alias("highs"))
    far = search_windows(known.select(F.size("x").cast("string").alias("grp"), "vec_id", "label", "x"), asked, negatives, False, chunk, slice_)
    both = far.join(near, (F.col("anchor") == F.col("p_anchor")) & (F.col("w") == F.col("p_w")))
    return both.select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
