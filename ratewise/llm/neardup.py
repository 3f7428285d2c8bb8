"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Instead of drawing every table's hashes anew, two small collections of band keys are drawn and a table is a
pair of them: c * c tables cost the hashes of 2 * c bands. Documents with equal sets are one from the start.
In every table bucket, members are tied to its first member, and ties whose signatures are clearly too unlike
are cut. Buckets whose members this leaves unconnected are gone through again, all members against all of
another family, in blocks of bounded size; what is connected then is a family. Within a family all
pairs are decided on full sets, by blocks of bounded size; distances to a few members rule out pairs by the
triangle inequality, and pairs already in one component are passed over. Links become components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import ascii_words, chunks, mixed, stage, texts_of
from ratewise.llm.components import components

#: Hashes to a band, chance to miss a pair at the threshold in all tables, members to a block; hashes beside
#: those of the bands, for the estimate of similarity alone.
BAND, MISS, BLOCK, MORE = 2, 5e-4, 1024, 28


def bands_for(threshold: float, band: int = BAND, miss: float = MISS) -> int:
    """Bands in each collection so that a pair at the threshold meets in some table but for `miss`."""
    return max(2, math.ceil(math.log(miss / 2) / math.log(1 - threshold**band)))


class WordHasher:
    """64-bit values of words, remembered for frequent ones."""

    def __init__(self, most: int = 150_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        if len(self.known) > self.most:
            self.known.clear()
        known, digest = self.known, xxhash.xxh64_intdigest
        for w in set(words).difference(known):
            known[w] = digest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(words: list[bytes], n: int, hasher: WordHasher) -> np.ndarray:
    """Sorted distinct values of the n-word shingles; the whole sequence if there are fewer words."""
    if not words:
        return np.empty(0, np.uint64)
    h = hasher(words)
    k = min(n, len(words))
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = mixed(out + h[i : len(h) - k + 1 + i] + np.uint64(k))
    return np.unique(out)


def signatures(docs: DataFrame, n: int, bands: int, band: int = BAND, seed: int = 11) -> DataFrame:
    """doc_id, n_shingles, set_hash, keys (2 * bands), sig (all minhashes, 16 bits each) of every row."""
    banded = 2 * bands * band
    count = banded + MORE
    draw = np.random.default_rng(seed)
    mult = draw.integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in chunks(batches):
            out: list[list] = [[], [], [], []]
            for text in texts_of(batch):
                s = shingle_set(ascii_words(text), n, hasher)
                out[0].append(len(s))
                if not len(s):
                    for column, none in zip(out[1:], (b"", [], b"")):
                        column.append(none)
                    continue
                low = np.empty(count, dtype=np.uint64)
                for i, m in enumerate(mult):
                    low[i] = (s * m).min()
                out[1].append(mixed(s).sum(dtype=np.uint64).tobytes() + np.bitwise_xor.reduce(mixed(s * mult[0])).tobytes())
                keys = np.zeros(2 * bands, dtype=np.uint64)
                for i in range(band):
                    keys = mixed(keys + low[i:banded:band] + np.uint64(i + 1))
                out[2].append(keys.view(np.int64).tolist())
                out[3].append((mixed(low) & np.uint64(0xFFFF)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary())],
                names=["doc_id", "n_shingles", "set_hash", "keys", "sig"],
            )

    return docs.select("doc_id", "text").mapInArrow(kernel, "doc_id long, n_shingles long, set_hash binary, keys array<long>, sig binary")


def bucket_members(sets: DataFrame, bands: int) -> DataFrame:
    """(key, a, b): the members b of every table bucket with several, and the smallest of them, a."""
    first, second = F.sequence(F.lit(0), F.lit(bands - 1)), F.sequence(F.lit(bands), F.lit(2 * bands - 1))
    tables = F.flatten(F.transform(first, lambda i: F.transform(second, lambda j: F.xxhash64(i, j, F.get("keys", i), F.get("keys", j)))))
    rows = sets.select(F.col("doc_id").alias("b"), F.explode(tables).alias("key"))
    buckets = rows.groupBy("key").agg(F.min("b").alias("a"), F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("c_key"), "a")
    return rows.join(buckets, F.col("key") == F.col("c_key")).select("key", "a", "b")


def floor_of(threshold: float, count: int) -> float:
    """The share of equal hashes under which signatures rule out the threshold: five standard errors below it."""
    return threshold - 5 * math.sqrt(threshold * (1 - threshold) / count)


def likely(ties: DataFrame, sets: DataFrame, floor: float) -> DataFrame:
    """The ties whose signatures do not rule out the threshold (one hash in 65,536 is equal by chance)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(axis=1) >= floor))

    one = lambda x: sets.select(F.col("doc_id").alias(f"d_{x}"), F.col("sig").alias(f"sig_{x}"))
    both = ties.join(one("a"), F.col("a") == F.col("d_a")).join(one("b"), F.col("b") == F.col("d_b")).select("a", "b", "sig_a", "sig_b")
    return both.mapInArrow(kernel, "a long, b long")


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each run of equal integers in `by`, also where it goes on in the next batch."""
    held, name = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in by])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            this = tuple(k[:, s].tolist())
            if held and this != name:
                yield name, pa.Table.from_batches(held)
                held = []
            name = this
            held.append(batch.slice(s, e - s))
    if held:
        yield name, pa.Table.from_batches(held)


def joining_pairs(sig: np.ndarray, label: np.ndarray, own: np.ndarray, within: bool, floor: float) -> list[tuple[int, int]]:
    """Pairs of members of different labels with like signatures that join all such members; only of different
    `own` unless `within`."""
    label, links = label.copy(), []
    for i in range(len(sig) - 1):
        other = label[i + 1 :] != label[i]
        if not within:
            other &= own[i + 1 :] != own[i]
        other = np.flatnonzero(other) + i + 1
        if not len(other):
            continue
        for j in other[(sig[other] == sig[i]).mean(axis=1) >= floor].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                links.append((i, j))
    return links


def ties_across(members: DataFrame, families: DataFrame, sets: DataFrame, floor: float, block: int = BLOCK) -> DataFrame:
    """(a, b): ties between members of one bucket that are in different families so far, so that no two members
    of a bucket with like signatures stay apart. Buckets of two have been compared.

    `members`: key, a, b; `families`: node, root. Buckets over `block` members are cut into blocks that meet
    pairwise.
    """
    known = stage(members.join(families, F.col("b") == F.col("node"), "left").select("key", "b", F.coalesce("root", "b").alias("root")), "near-buckets")
    apart = known.groupBy(F.col("key").alias("m_key")).agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("n > 2 and low <> high").select("m_key", "n")
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = known.join(apart, F.col("key") == F.col("m_key")).select("key", "b", "root", blocks.alias("blocks"), F.pmod(F.xxhash64("b"), blocks).cast("int").alias("own"))
    rows = rows.join(sets.select("doc_id", "sig"), F.col("b") == F.col("doc_id")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = rows.select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "b", "root", "sig")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: set[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        found: set[tuple[int, int]] = set()
        for (_, x, y), group in runs(batches, ["key", "x", "y"]):
            ids, root, own = (group.column(c).to_numpy() for c in ("b", "root", "own"))
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype="<u2").reshape(len(ids), -1)
            found.update((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))) for i, j in joining_pairs(sig, root, own, x == y, floor))
            if len(found) > 100_000:
                yield out(found)
                found.clear()
        yield out(found)

    return dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(kernel, "a long, b long").distinct()


class Union:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self) -> np.ndarray:
        r = self.up[self.up]
        while not np.array_equal(r, self.up):
            self.up, r = r, r[r]
        return r


def linked_pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (i in left, j in right) that join all components of the graph of pairs with
    100 * intersection >= percent * union; a spanning part of them.

    Values become columns of a common numbering, so that one pass over all members gives the intersections
    with one member. Distances to members already done rule out pairs without a look.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
    start = np.concatenate([[0], np.cumsum(size)])
    owner = np.repeat(np.arange(n), size)
    present = np.zeros(flat.max() + 1, dtype=bool)
    is_left, is_right = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    is_left[left], is_right[right] = True, True
    union, links, done = Union(n), [], []
    pending = np.ones(n, dtype=bool)  # members not yet compared with all they must be
    seen: list[np.ndarray] = []  # distances of all to the reference members
    popular = np.add.reduceat(np.bincount(flat)[flat].astype(np.float64), start[:-1]) / size
    order = np.argsort(-popular, kind="stable")  # central members first: they join most others
    limit = 1 - percent / 100
    for i in order.tolist():
        root = union.roots()
        other = pending & (root != root[i])
        other &= (is_right if is_left[i] else False) | (is_left if is_right[i] else False)
        other &= (100 * size >= percent * size[i]) & (100 * size[i] >= percent * size)
        for d in seen:
            other &= np.abs(d - d[i]) <= limit + 1e-9
        pending[i] = False
        whole = len(seen) < 6
        among = np.arange(n) if whole else np.flatnonzero(other)
        if not len(among) or not other.any():
            continue
        present[flat[start[i] : start[i + 1]]] = True
        if whole:
            common = np.bincount(owner, weights=present[flat], minlength=n).astype(np.int64)
        else:
            common = np.array([np.count_nonzero(present[flat[start[j] : start[j + 1]]]) for j in among], dtype=np.int64)
        present[flat[start[i] : start[i + 1]]] = False
        together = size[among] + size[i] - common
        if whole:
            seen.append(1 - common / together)
        for j in among[(100 * common >= percent * together) & other[among]].tolist():
            a, b = union.root(i), union.root(j)
            if a != b:
                union.up[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def family_links(docs: DataFrame, members: DataFrame, n: int, percent: int, block: int = BLOCK) -> DataFrame:
    """(a, b): confirmed links within families. `members`: node, root, n (family size).

    A family up to `block` members is one task group; larger ones are cut into blocks that meet pairwise.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in chunks(batches):
            sets = [shingle_set(ascii_words(t), n, hasher).tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("root"), batch.column("n"), pa.array(sets, pa.binary())], names=["doc_id", "root", "n", "s"])

    texts = docs.select("doc_id", "text").join(members.select("node", "root", "n"), F.col("doc_id") == F.col("node")).select("doc_id", "root", "n", "text")
    sets = texts.mapInArrow(kernel, "doc_id long, root long, n long, s binary")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), blocks).cast("int")
    dealt = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("doc_id", "root", "s", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))

    def decide(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["doc_id"]).sort_values("doc_id")
        ids, own = group["doc_id"].to_numpy(), group["own"].to_numpy()
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["s"]]
        links = linked_pairs(sets, np.flatnonzero(own == key[1]), np.flatnonzero(own == key[2]), percent) if len(ids) > 1 else []
        return pd.DataFrame({"a": [ids[i] for i, _ in links], "b": [ids[j] for _, j in links]}, dtype="int64")

    return dealt.groupBy("root", "x", "y").applyInPandas(decide, "a long, b long")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents whose n-word shingle sets have 100 * intersection >= percent * union are linked; component_id
    is the smallest id reachable. Null, empty and wordless texts have no set and no links. Rows with a null
    id get null component and are kept. Rows that repeat an id count as one document with the first row's
    (smallest set hash) links and each gets the same component; `kept` is by id, so such rows are kept alike.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bands = bands_for(percent / 100)
    signed = stage(signatures(given, n, bands), "near-signatures")
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(filled.groupBy("set_hash").agg(F.min("doc_id").alias("rep")), "near-classes")
    sets = stage(classes.join(filled.withColumnRenamed("set_hash", "h"), (F.col("rep") == F.col("doc_id")) & (F.col("set_hash") == F.col("h"))).groupBy("doc_id").agg(F.min_by(F.struct("keys", "sig"), "h").alias("x")).select("doc_id", "x.keys", "x.sig"), "near-sets")
    floor = floor_of(percent / 100, 2 * bands * BAND + MORE)
    members = stage(bucket_members(sets, bands), "near-members")
    ties = stage(likely(members.filter("a <> b").select("a", "b").distinct(), sets, floor), "near-ties")
    families = components(ties.unionByName(ties_across(members, components(ties), sets, floor)))
    sized = stage(families.join(families.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("n")), F.col("root") == F.col("r")).select("node", "root", "n"), "near-families")
    links = components(family_links(given, sized, n, percent))
    reps = classes.join(links, F.col("rep") == F.col("node"), "left").select("set_hash", F.coalesce("root", "rep").alias("component"))
    rows = signed.select("doc_id", "n_shingles", F.col("set_hash").alias("own_hash"))
    joined = rows.join(reps, (F.col("own_hash") == F.col("set_hash")) & (F.col("n_shingles") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("component", "doc_id"), "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, but for those of documents that repeat one with a smaller id."""
    dropped = stage(near_duplicates(docs, n, percent, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("dropped_id")).distinct(), "near-dropped")
    return docs.join(dropped, docs[id_col].cast("long") == dropped["dropped_id"], "left_anti")
