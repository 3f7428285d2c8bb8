"""Decision trees grown level by level on Spark: fitting, prediction, and a grid search in one growth.

Rows are binned once, equal ones folded. A *region* is the set of rows that took the same splits; trees that have
made the same choices so far share it. Each level counts (region, feature, bin) with one aggregation for all
trees, finds every tree's best split of each of its regions from these counts, and moves the rows by a join
of regions with splits. A region that has become small is finished by one task, all of its trees of a fold together;
the tasks of all levels are one job. Nodes are a table from the first level to the last: none passes through the
driver, and nothing limits the depth.

Greedy growth never looks ahead, so the full tree of one (criterion, smallest leaf) contains every shallower
tree and every tree with a larger split minimum. The rows of all folds move along, so each node knows how
its held-out rows are spread: the accuracy of every setting is an aggregate over the node table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratewise.functions.columns import known_number
from ratewise.operators.quantiles import order_statistics
from ratewise.sources.scratch import new_path, stage

# The searched grid, in the order in which ties are resolved.
CRITERIA = ("gini", "entropy")
DEPTHS = (3, 5, 7, 10, 15, None)
LEAF_MINIMUMS = (1, 2, 5, 10)
SPLIT_MINIMUMS = (2, 5, 10, 20)

#: Thresholds tried per feature: all values if there are no more, else this many evenly spaced ranks.
MAX_BINS = 256
#: Gains are compared after rounding, so that float noise decides no tie; ties go to the first feature, then threshold.
GAIN_DIGITS = 12
#: Levels of a tree that are joined in one plan before the rows are written.
LEVELS_A_PLAN = 12
#: Rows (region, feature, bin) that a task looks at together.
AT_ONCE = 1 << 19
#: A region of at most so many rows, and so many rows times features, is finished by one task.
LOCAL_ROWS, LOCAL_CELLS = 1 << 16, 1 << 20
#: Nodes below one region: the bits of their numbers.
LOCAL_BITS = 24
NODES = "tree int, level int, region long, above long, rows long, positives long, held long, held_positives long, feature int, bin int, left long, right long"


@dataclass(frozen=True)
class TreeParams:
    criterion: str = "gini"
    max_depth: int | None = None
    min_leaf: int = 1
    min_split: int = 2


@dataclass(frozen=True)
class Growth:
    """One tree of a common growth: trained on all rows but those of fold ``held`` (-1: on all)."""

    held: int
    criterion: str
    min_leaf: int


@dataclass(frozen=True)
class Tree:
    """A fitted tree: one stored table per level (node, rows, positives, feature, threshold, left, right)."""

    levels: list[DataFrame]

    def table(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [t.withColumn("level", F.lit(i)) for i, t in enumerate(self.levels)])


def assemble(df: DataFrame, features: Sequence[str], target: str, keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, y, features): the features as one array; a missing or NaN feature raises when it is read."""
    known = [F.coalesce(known_number(c), F.raise_error(F.lit(f"column {c} has missing values")).cast("double")) for c in features]
    return df.select(*keep, F.col(target).cast("int").alias("y"), F.array(*known).alias("features"))


def thresholds(data: DataFrame, width: int, max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """The thresholds of each feature, at most ``max_bins`` sorted values (the largest value splits nothing)."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * width
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            seen = [np.unique(np.append(s, x[:, i] + 0.0))[: max_bins + 1] if len(s) <= max_bins else s for i, s in enumerate(seen)]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(width, dtype=np.int32), [len(s) for s in seen])), pa.array(np.concatenate(seen) if width else np.empty(0))], names=["feature", "value"])

    few = data.select("features").mapInArrow(values, "feature int, value double").distinct().groupBy("feature").agg(F.count("*").alias("n"), F.slice(F.sort_array(F.collect_list("value")), 1, max_bins + 1).alias("at"))
    found = {r["feature"]: r["at"] for r in few.collect()}  # one row per feature
    cuts = [np.array(found.get(i, []), dtype=float) for i in range(width)]
    many = [i for i, c in enumerate(cuts) if len(c) > max_bins]
    if many:
        wide = data.select(*[F.col("features")[i].alias(str(i)) for i in many])
        spaced = [i / max_bins for i in range(1, max_bins)]
        stats = order_statistics(wide, [str(i) for i in many], spaced)
        at = F.transform(F.array(*[F.lit(q) for q in spaced]), lambda q: F.element_at("at", F.floor(q * (F.col("n") - 1)).cast("long")))
        for r in stats.select("column", F.array_sort(F.array_distinct(at)).alias("at")).collect():  # one row per feature
            cuts[int(r["column"])] = np.array(r["at"])
    return cuts


def _binned(data: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """region, fold, bins, n, positives: equal rows folded. Bin b holds the values above threshold b - 1, up to b."""
    width = len(cuts)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.int16) if width else x.astype(np.int16)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(bins.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("y"), listed], names=["fold", "y", "bins"])

    rows = data.select(F.col("fold").cast("int").alias("fold"), "y", "features").mapInArrow(kernel, "fold int, y int, bins array<smallint>")
    folded = rows.groupBy("fold", "bins").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("positives"))
    return stage(folded.withColumn("region", F.lit(0).cast("long")), "tree-rows")


def impurity(criterion: str, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    share = np.divide(p, n, out=np.zeros(len(n)), where=n > 0)
    if criterion == "gini":
        return 1.0 - share * share - (1.0 - share) * (1.0 - share)
    part = lambda s: np.where(s > 0, s * np.log2(np.where(s > 0, s, 1.0)), 0.0)
    return -part(share) - part(1.0 - share)


def best_splits(region: np.ndarray, feature: np.ndarray, n: np.ndarray, p: np.ndarray, growths: Sequence[Growth], member: np.ndarray, min_split: int, may_split: bool) -> dict[str, np.ndarray]:
    """The nodes of one level: for each tree and region of it the counts and, if it is split, feature and row.

    Rows are sorted by (region, feature, bin); ``n`` and ``p`` count rows and positives by fold, ``member`` says by
    (number of the region, tree) which trees have it.
    """
    starts = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(region))))
    segment = np.flatnonzero(np.append(True, (region[1:] != region[:-1]) | (feature[1:] != feature[:-1])))
    lengths = np.diff(np.append(segment, len(region)))
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("tree", "region", "rows", "positives", "held", "held_positives", "at")}

    def summed(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums within (region, feature), and the region's total at each row."""
        running = np.cumsum(x)
        before = np.repeat(running[segment] - x[segment], lengths)
        total = np.add.reduceat(x, segment)
        return running - before, np.repeat(total, lengths)

    for held in sorted({g.held for g in growths}):
        n_h, p_h = (n[:, held], p[:, held]) if held >= 0 else (np.zeros(len(region), np.int64),) * 2
        left, rows = summed(n.sum(axis=1) - n_h)
        left_p, positives = summed(p.sum(axis=1) - p_h)
        held_rows, held_positives = summed(n_h)[1][starts], summed(p_h)[1][starts]
        right, right_p = rows - left, positives - left_p
        open_ = (positives > 0) & (positives < rows) & (rows >= min_split) & (left > 0) & (right > 0) if may_split else np.zeros(len(region), bool)
        for criterion in sorted({g.criterion for g in growths if g.held == held}):
            parts = left / np.maximum(rows, 1) * impurity(criterion, left, left_p) + right / np.maximum(rows, 1) * impurity(criterion, right, right_p)
            gain = np.round(impurity(criterion, rows, positives) - parts, GAIN_DIGITS)
            for tree, g in enumerate(growths):
                if (g.held, g.criterion) != (held, criterion):
                    continue
                mine = np.flatnonzero(member[:, tree])
                if not len(mine):
                    continue
                value = np.where(open_ & (left >= g.min_leaf) & (right >= g.min_leaf), gain, -np.inf)
                most = np.maximum.reduceat(value, starts)
                hit = np.flatnonzero((value == most[number]) & (value > -np.inf))
                first = np.full(len(starts), -1)
                first[number[hit[::-1]]] = hit[::-1]
                columns = (np.full(len(mine), tree), region[starts][mine], rows[starts][mine], positives[starts][mine], held_rows[mine], held_positives[mine], first[mine])
                for name, column in zip(out, columns):
                    out[name].append(column)
    return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}


def _node_finder(growths: Sequence[Growth], folds: int, min_split: int, may_split: bool):
    """Counts sorted by (region, feature, bin), whole regions to a partition, to nodes."""

    def nodes(x: pa.Table) -> pa.RecordBatch:
        region, feature, bin_ = (x.column(c).to_numpy() for c in ("region", "feature", "bin"))
        n, p = (np.stack([x.column(f"{k}{f}").to_numpy() for f in range(folds)], axis=1) for k in ("n", "p"))
        starts = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        trees = x.column("trees").take(pa.array(starts)).to_pylist()
        member = np.zeros((len(starts), len(growths)), bool)
        for i, ts in enumerate(trees):
            member[i, ts] = True
        found = best_splits(region, feature, n, p, growths, member, min_split, may_split)
        at, split = found["at"].astype(np.int64), found["at"] >= 0
        kinds = {"tree": pa.int32()}
        columns = [pa.array(found[c].astype(np.int64)).cast(kinds.get(c, pa.int64())) for c in ("tree", "region", "rows", "positives", "held", "held_positives")]
        columns += [pa.array(np.where(split, feature[at], 0).astype(np.int32), mask=~split), pa.array(np.where(split, bin_[at], 0).astype(np.int32), mask=~split)]
        return pa.RecordBatch.from_arrays(columns, names=["tree", "region", "rows", "positives", "held", "held_positives", "feature", "bin"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.num_rows
            if size < AT_ONCE:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            region = table.column("region").to_numpy()
            whole = int(np.searchsorted(region == region[-1], True)) if len(region) else 0
            if whole:
                yield nodes(table.slice(0, whole).combine_chunks())
            waiting, size = table.slice(whole).combine_chunks().to_batches(), len(region) - whole
        if size:
            yield nodes(pa.Table.from_batches(waiting).combine_chunks())

    return kernel, "tree int, region long, rows long, positives long, held long, held_positives long, feature int, bin int"


def _best_local(bins: np.ndarray, n: np.ndarray, p: np.ndarray, row: np.ndarray, region: np.ndarray, rows: np.ndarray, positives: np.ndarray, trees: Sequence[Growth], member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature (-1: none) and bin of the best split by (region, tree), from the training rows of the regions that may be
    split. The gains and ties are those of ``best_splits``."""
    best = np.full(member.shape, -np.inf)
    feature, at = np.full(member.shape, -1), np.zeros(member.shape, np.int64)
    row_bits, bin_bits = int(len(bins)).bit_length(), int(bins.max(initial=0)).bit_length()
    step = max(1, AT_ONCE // max(1, len(row)))
    for f in range(0, bins.shape[1], step) if len(row) else ():
        some = bins[row, f : f + step].astype(np.int64)
        width = some.shape[1]
        key = np.sort(((((region[:, None] * width + np.arange(width)) << bin_bits) | some) << row_bits | row[:, None]).ravel())
        cell, who = key >> row_bits, key & ((1 << row_bits) - 1)
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        cell, count, hits = cell[start], np.add.reduceat(n[who], start), np.add.reduceat(p[who], start)
        line = cell >> bin_bits  # (region, feature)
        first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
        lengths = np.diff(np.append(first, len(line)))
        left, left_p = (np.cumsum(x) - np.repeat((np.cumsum(x) - x)[first], lengths) for x in (count, hits))
        of = line // width
        fits = np.flatnonzero(left < rows[of])
        left, left_p, of, cell, line = left[fits], left_p[fits], of[fits], cell[fits], line[fits]
        whole, whole_p = rows[of], positives[of]
        right, right_p = whole - left, whole_p - left_p
        for criterion in sorted({g.criterion for g in trees}):
            parts = left / np.maximum(whole, 1) * impurity(criterion, left, left_p) + right / np.maximum(whole, 1) * impurity(criterion, right, right_p)
            gain = np.round(impurity(criterion, whole, whole_p) - parts, GAIN_DIGITS)
            for t, g in enumerate(trees):
                if g.criterion != criterion:
                    continue
                mine = np.flatnonzero(member[of, t] & (left >= g.min_leaf) & (right >= g.min_leaf))
                if not len(mine):
                    continue
                value, here = gain[mine], of[mine]
                begin = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
                most = np.maximum.reduceat(value, begin)
                hit = np.flatnonzero(value == np.repeat(most, np.diff(np.append(begin, len(here)))))
                hit = hit[np.append(True, here[hit][1:] != here[hit][:-1])]
                better = most > best[here[begin], t]  # the first feature wins a tie
                r, c = here[begin][better], mine[hit[better]]
                best[r, t], feature[r, t], at[r, t] = most[better], f + line[c] % width, cell[c] & ((1 << bin_bits) - 1)
    return feature, at


def _finisher(growths: Sequence[Growth], max_depth: int | None, min_split: int):
    """All levels below one region for its trees that hold out the same fold."""

    def finish(x: pa.Table) -> pa.Table:
        root, held, level, above = (x.column(c)[0].as_py() for c in ("region", "held_fold", "level", "above"))
        number = np.array(sorted(x.column("trees")[0].as_py()))
        trees = [growths[t] for t in number]
        fold, n, p = (x.column(c).to_numpy() for c in ("fold", "n", "positives"))
        bins = np.concatenate([c.flatten().to_numpy() for c in x.column("bins").chunks]).reshape(len(n), -1)
        row, region = np.arange(len(n)), np.zeros(len(n), np.int64)
        ids, over, member, used = np.array([root]), np.array([-1 if above is None else above]), np.ones((1, len(trees)), bool), 0
        out: list[list[np.ndarray]] = []
        while len(ids):
            learnt = fold[row] != held
            total = lambda w, rows: np.bincount(region[rows], weights=w[row[rows]], minlength=len(ids)).astype(np.int64)
            rows, positives, held_rows, held_positives = total(n, learnt), total(p, learnt), total(n, ~learnt), total(p, ~learnt)
            open_ = (positives > 0) & (positives < rows) & (rows >= min_split) & (max_depth is None or level < max_depth)
            use = learnt & open_[region]
            feature, at = _best_local(bins, n, p, row[use], region[use], rows, positives, trees, member)
            r, t = np.nonzero(member)
            split = feature[r, t] >= 0
            kinds, which = np.unique(np.stack([r[split], feature[r, t][split], at[r, t][split]], axis=1), axis=0, return_inverse=True)
            child = np.full(len(r), 0)
            child[split] = -((root << LOCAL_BITS) + used + 1 + 2 * which.reshape(-1))  # negative: the numbers of this region's nodes
            out.append([number[t], np.full(len(r), level), ids[r], over[r], rows[r], positives[r], held_rows[r], held_positives[r], feature[r, t], at[r, t], child, child - 1])
            # Rows go to the children of every different split of their region.
            many = np.bincount(kinds[:, 0], minlength=len(ids))
            begin = np.cumsum(many) - many
            copies = many[region]
            kind = np.repeat(begin[region], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            row = np.repeat(row, copies)
            region = 2 * kind + (bins[row, kinds[kind, 1]] > kinds[kind, 2])
            grown = np.zeros((2 * len(kinds), len(trees)), bool)
            for side in (0, 1):
                grown[2 * which.reshape(-1) + side, t[split]] = True
            ids, over, member = -((root << LOCAL_BITS) + used + 1 + np.arange(2 * len(kinds))), np.repeat(rows[kinds[:, 0]], 2), grown
            used += 2 * len(kinds)
            level += 1
        columns = [np.concatenate(c) for c in zip(*out)]
        none = {"above": columns[3] < 0, **{c: columns[8] < 0 for c in ("feature", "bin", "left", "right")}}
        kinds_ = {"int": pa.int32(), "long": pa.int64()}
        fields = [f.split() for f in NODES.split(", ")]
        return pa.table({name: pa.array(c.astype(np.int64), mask=none.get(name)).cast(kinds_[kind]) for (name, kind), c in zip(fields, columns)})

    return finish


def grow(data: DataFrame, growths: Sequence[Growth], max_depth: int | None = None, min_split: int = 2, max_bins: int = MAX_BINS) -> tuple[DataFrame, list[np.ndarray]]:
    """Nodes of all trees, a stored table, and the features' thresholds.

    ``data``: fold (0, 1, ...), y (0 or 1), features. A node is (tree, level, region, above, rows, positives, held, held_positives,
    feature, bin, left, right); ``above`` is its parent's rows, feature and children are null in leaves. A node is split while it holds both classes, ``min_split``
    rows and a split that leaves each side the growth's smallest leaf. An empty table raises.
    """
    data = stage(data.select("fold", "y", "features"), "tree-data")
    spark = data.sparkSession
    width = (data.agg(F.max(F.size("features"))).first()[0]) or 0
    cuts = thresholds(data, width, max_bins)
    state = _binned(data, cuts)
    last = state.agg(F.max("fold")).first()[0]
    if last is None:
        raise ValueError("a tree needs rows")
    folds = last + 1
    limit = max(1, min(LOCAL_ROWS, LOCAL_CELLS // max(1, width)))
    frontier = spark.createDataFrame([(t, 0, None) for t in range(len(growths))], "tree int, region long, above long")
    holds = spark.createDataFrame([(t, g.held) for t, g in enumerate(growths)], "h_tree int, held_fold int")
    levels: list[DataFrame] = []
    small: list[DataFrame] = []
    level, numbered = 0, 1
    sums = [s for f in range(folds) for s in (F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"n{f}"), F.sum(F.when(F.col("fold") == f, F.col("positives")).otherwise(0)).alias(f"p{f}"))]
    while True:
        sizes = stage(state.groupBy(F.col("region").alias("z_region")).agg((F.count("*") <= limit).alias("small")), "tree-sizes")
        here = F.col("region") == F.col("z_region")
        tasks = frontier.join(sizes.filter("small"), here).join(F.broadcast(holds), F.col("tree") == F.col("h_tree"))  # one row a tree
        tasks = tasks.groupBy("z_region", "held_fold").agg(F.collect_list("tree").alias("trees"), F.first("above").alias("above"))  # one entry to a tree
        small.append(state.join(tasks, here).drop("z_region").withColumn("level", F.lit(level)))
        crowded = sizes.filter("NOT small").select("z_region")
        if crowded.isEmpty():
            break
        state, frontier = state.join(crowded, here).drop("z_region"), frontier.join(crowded, here).drop("z_region")
        may_split = max_depth is None or level < max_depth
        cells = state.select("region", "fold", "n", "positives", F.posexplode("bins").alias("feature", "bin")).groupBy("region", "feature", "bin").agg(*sums)
        of = frontier.groupBy(F.col("region").alias("f_region")).agg(F.collect_list("tree").alias("trees"))  # one entry to a tree
        finder, schema = _node_finder(growths, folds, min_split, may_split)
        sorted_ = cells.join(of, F.col("region") == F.col("f_region")).drop("f_region").repartition("region").sortWithinPartitions("region", "feature", "bin")
        found = stage(sorted_.mapInArrow(finder, schema), "tree-nodes")
        chosen = found.filter("feature is not null").select(F.col("region").alias("s_region"), F.col("feature").alias("s_feature"), F.col("bin").alias("s_bin")).distinct()
        # One row to a split of a crowded region. Written, so that each split keeps its number.
        place = F.row_number().over(Window.orderBy("s_region", "s_feature", "s_bin")).cast("long")
        splits = stage(chosen.withColumn("left", place * 2 - 2 + numbered).withColumn("right", F.col("left") + 1), "tree-splits")
        above = frontier.select(F.col("tree").alias("a_tree"), F.col("region").alias("a_region"), "above")
        nodes = found.join(above, (F.col("tree") == F.col("a_tree")) & (F.col("region") == F.col("a_region"))).drop("a_tree", "a_region")
        same = (F.col("region") == F.col("s_region")) & (F.col("feature") == F.col("s_feature")) & (F.col("bin") == F.col("s_bin"))
        levels.append(stage(nodes.join(splits, same, "left").drop("s_region", "s_feature", "s_bin").withColumn("level", F.lit(level)), "tree-level"))
        new = splits.count()
        if not may_split or not new:
            break
        frontier = levels[-1].filter("left is not null").select("tree", F.explode(F.array("left", "right")).alias("region"), F.col("rows").alias("above"))
        child = F.when(F.element_at("bins", F.col("s_feature") + 1) <= F.col("s_bin"), F.col("left")).otherwise(F.col("right"))
        state = stage(state.join(splits, F.col("region") == F.col("s_region")).select(child.alias("region"), "fold", "bins", "n", "positives"), "tree-rows")
        level, numbered = level + 1, numbered + 2 * new
    # Little data, much work: the number of tasks is given.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    spread = reduce(DataFrame.unionByName, small).repartition(parts, "region", "held_fold")
    finished = stage(spread.groupBy("region", "held_fold").applyInArrow(_finisher(growths, max_depth, min_split), NODES), "tree-finished")
    return reduce(DataFrame.unionByName, levels, finished), cuts


def tree_fit(data: DataFrame, params: TreeParams, max_bins: int = MAX_BINS) -> Tree:
    """``data`` has columns y and features (see ``assemble``)."""
    rows = data.select(F.lit(0).alias("fold"), "y", "features")
    nodes, cuts = grow(rows, [Growth(-1, params.criterion, params.min_leaf)], params.max_depth, params.min_split, max_bins)
    table = data.sparkSession.createDataFrame([(f, b, float(t)) for f, c in enumerate(cuts) for b, t in enumerate(c)], "c_feature int, c_bin int, threshold double")  # features x bins
    at = (F.col("feature") == F.col("c_feature")) & (F.col("bin") == F.col("c_bin"))
    named = nodes.join(table, at, "left").select("level", F.col("region").alias("node"), "rows", "positives", "feature", "threshold", "left", "right")
    path = new_path(data.sparkSession, "tree")
    named.write.partitionBy("level").parquet(path)
    return read_tree(data.sparkSession, path)


def write_tree(model: Tree, path: str) -> Tree:
    """Stores a tree, one folder to a level, and reads it back; replaces what is there."""
    model.table().write.mode("overwrite").partitionBy("level").parquet(path)
    return read_tree(model.levels[0].sparkSession, path)


def read_tree(spark: SparkSession, path: str) -> Tree:
    stored = spark.read.parquet(path)
    schema, last = stored.drop("level").schema, stored.agg(F.max("level")).first()[0]
    return Tree([spark.read.schema(schema).parquet(f"{path}/level={i}") for i in range(last + 1)])


def tree_predict(model: Tree, data: DataFrame, keep: Sequence[str] = (), min_split: int = 2) -> DataFrame:
    """(*keep, y, pred, score): rows go down a level with each join; the score is the share of positives where
    they stop, at a leaf or at a node with fewer than ``min_split`` rows. Ties are class 0."""
    rows = data.select(*keep, "y", F.col("features").alias("_x"), F.lit(0).cast("long").alias("_node"), F.lit(None).cast("double").alias("_score"))
    given = [F.col(f"`{c}`") for c in [*keep, "y", "_x"]]
    for i, level in enumerate(model.levels):
        n = level.select(F.col("node").alias("_id"), (F.col("positives") / F.col("rows")).alias("_share"), F.when(F.col("rows") >= min_split, F.col("feature")).alias("_f"), F.col("threshold").alias("_t"), F.col("left").alias("_l"), F.col("right").alias("_r"))
        # A null node is one that has been left at a level above.
        down = F.when(F.col("_f").isNotNull(), F.when(F.element_at("_x", F.col("_f") + 1) <= F.col("_t"), F.col("_l")).otherwise(F.col("_r")))
        rows = rows.join(n, F.col("_node") == F.col("_id"), "left").select(*given, down.alias("_node"), F.coalesce("_share", "_score").alias("_score"))
        if i % LEVELS_A_PLAN == LEVELS_A_PLAN - 1:
            rows = stage(rows, "tree-walk")
    return rows.select(*[F.col(f"`{c}`") for c in keep], "y", (F.col("_score") > 0.5).cast("int").alias("pred"), F.col("_score").alias("score"))


def grid_accuracies(nodes: DataFrame, growths: Sequence[Growth], depths: Sequence[int | None], splits: Sequence[int]) -> DataFrame:
    """criterion, depth (-1: none), leaf, split, held, accuracy on the held-out rows; ``nodes`` comes from ``grow``.

    Rows get fewer going down, so a node is reached if its parent has the split minimum, and its rows stop
    there if it is a leaf, lacks the minimum itself, or lies at the depth limit.
    """
    spark = nodes.sparkSession
    trees = spark.createDataFrame([(i, g.held, g.criterion, g.min_leaf) for i, g in enumerate(growths)], "tree int, fold int, criterion string, leaf int")
    settings = F.explode(F.array(*[F.struct(F.lit(-1 if d is None else d).alias("depth"), F.lit(s).alias("split")) for d in depths for s in splits]))
    each = nodes.withColumn("_s", settings).select("*", "_s.depth", "_s.split").drop("_s")
    reached = ((F.col("level") == 0) | (F.col("above") >= F.col("split"))) & ((F.col("depth") < 0) | (F.col("level") <= F.col("depth")))
    stops = F.col("left").isNull() | (F.col("rows") < F.col("split")) | (F.col("level") == F.col("depth"))
    hits = F.when(F.col("positives") * 2 > F.col("rows"), F.col("held_positives")).otherwise(F.col("held") - F.col("held_positives"))
    counted = each.filter(reached & stops).groupBy("tree", "depth", "split").agg(F.sum(hits).alias("hits"), F.sum("held").alias("n"))
    return counted.join(trees, "tree").select("criterion", "depth", "leaf", "split", "fold", (F.col("hits") / F.col("n")).alias("accuracy"))


def tree_grid_search(
    data: DataFrame,
    criteria: Sequence[str] = CRITERIA,
    depths: Sequence[int | None] = DEPTHS,
    leaf_minimums: Sequence[int] = LEAF_MINIMUMS,
    split_minimums: Sequence[int] = SPLIT_MINIMUMS,
    max_bins: int = MAX_BINS,
    digits: int = 9,
) -> DataFrame:
    """Cross-validated accuracy of every setting; ``data`` has columns fold, y and features.
    The first best setting in grid order has ``best`` = true."""
    spark = data.sparkSession
    folds = [r[0] for r in data.select("fold").distinct().orderBy("fold").collect()]  # a handful
    numbered = data.withColumn("fold", F.array_position(F.array(*[F.lit(f) for f in folds]), F.col("fold")).cast("int") - 1)
    deepest = None if None in depths else max(d for d in depths if d is not None)
    growths = [Growth(f, c, leaf) for f in range(len(folds)) for c in criteria for leaf in leaf_minimums]
    nodes, _ = grow(numbered, growths, deepest, min(split_minimums), max_bins)
    scored = grid_accuracies(nodes, growths, depths, split_minimums)
    table = stage(
        scored.groupBy("criterion", "depth", "leaf", "split").agg(
            F.round(F.avg("accuracy"), digits).alias("accuracy_mean"),
            F.round(F.stddev_pop("accuracy"), digits).alias("accuracy_std"),
        ),
        "grid-scores",
    )
    grid = [
        (c, -1 if d is None else d, leaf, split)
        for c in criteria
        for d in depths
        for leaf in leaf_minimums
        for split in split_minimums
    ]
    order = spark.createDataFrame(
        [(i, *setting) for i, setting in enumerate(grid)], "position int, criterion string, depth int, leaf int, split int"
    )
    ranked = table.join(order, ["criterion", "depth", "leaf", "split"])
    best = ranked.agg(F.min_by("position", F.struct(-F.col("accuracy_mean"), "position")).alias("best_position"))
    return (
        ranked.join(F.broadcast(best), F.col("position") == F.col("best_position"), "left")  # one row
        .select(
            "position",
            "criterion",
            F.nullif("depth", F.lit(-1)).alias("max_depth"),
            F.col("leaf").alias("min_leaf"),
            F.col("split").alias("min_split"),
            "accuracy_mean",
            "accuracy_std",
            F.col("best_position").isNotNull().alias("best"),
        )
        .orderBy("position")
    )


def best_params(grid: DataFrame) -> TreeParams:
    r = grid.filter("best").first()
    return TreeParams(r["criterion"], r["max_depth"], r["min_leaf"], r["min_split"])
