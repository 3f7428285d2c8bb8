"""Removal of long repeated byte strings, by sampled suffixes in the manner of difference-cover sorting.

A difference cover picks sample positions so that any two equal strings hold samples at a common offset; only
sampled suffixes are sorted and named, and the others are compared by way of the next sample. Here the sample
is taken by content instead of by residue: in every window of `length` bytes the k-gram with the smallest hash
(the first of equals). Equal windows then share their sample exactly, and the sample is sparse enough to sort.

1. Sample: each window belongs to one sampled position; neighbouring windows mostly share it.
2. Sort and name: samples are sorted by (k-gram, context), the context being all bytes that windows of the
   sample touch. Adjacent equal names: all windows there repeat. A k-gram without a second context is unique.
3. Recurse on what two names leave open: only one place of each context that shares its k-gram with another
   goes on, window by window.
4. Merge and compare neighbours: the windows of one k-gram meet and are sorted by their names; equal
   neighbours repeat. A k-gram with very many contexts is not gathered: its windows are sorted by Spark.

A name is a 64-bit hash. Places with many equal contexts are thinned to two per chunk of a task before any
shuffle, since two already prove the repeat, so a passage that a third of all texts share costs little.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ratewise.llm.common import chunks, mixed, stage, texts_of

LENGTH, GRAM = 200, 64
#: Samples of a k-gram that one task may gather; windows of more frequent ones are shuffled one by one.
CROWD = 20_000
#: Bytes that are hashed at once; longer texts go in overlapping parts.
CHUNK = 1 << 20
#: A place is start << 16 | n - 1 for n neighbouring windows; the lowest bits hold the sample's offset.
_N, _OFF = 8, 8


class _Constants:
    """Values of bytes and powers, made once in each task: they don't travel with the functions that use them."""

    def __init__(self):
        self.made = None

    def __call__(self) -> tuple[np.ndarray, np.ndarray]:
        if self.made is None:
            values = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64)
            powers = np.ones(2 * CHUNK + 1, dtype=np.uint64)
            np.cumprod(np.full(2 * CHUNK, 0x9E3779B97F4A7C15, dtype=np.uint64), out=powers[1:])
            self.made = values, powers
        return self.made

    def cache_clear(self) -> None:
        self.made = None

    def __reduce__(self):
        return _Constants, ()


_constants = _Constants()


class Hashes:
    """Hashes of any substrings of up to 2 * CHUNK bytes; equal for equal bytes wherever they lie."""

    def __init__(self, raw: bytes):
        values, powers = _constants()
        b = np.frombuffer(raw, dtype=np.uint8)
        if len(b) > 2 * CHUNK:
            raise ValueError("too many bytes at once")
        self.sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(values[b] * powers[: len(b)], out=self.sums[1:])
        self.powers = powers

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers[2 * CHUNK - start])

    def fixed(self, size: int) -> np.ndarray:
        """Of all substrings of `size` bytes."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.powers[2 * CHUNK - n + 1 : 2 * CHUNK + 1][::-1])


def parts(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], bytes]]:
    """Texts of at least `length` bytes joined to parts of about CHUNK bytes: the texts' numbers, where in its
    text each part starts, and the bytes, the texts' ends being implied by `bounds`. Long texts are cut into
    parts that overlap by length - 1 bytes, so that every window lies in one part."""
    number, start, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for a in range(0, max(1, len(t) - length + 1), CHUNK):
            piece = t[a : a + CHUNK + length - 1]
            if size and size + len(piece) > 2 * CHUNK - 2 * length:
                yield number, start, held
                number, start, held, size = [], [], [], 0
            number.append(i), start.append(a), held.append(piece)
            size += len(piece)
            if size >= CHUNK:
                yield number, start, held
                number, start, held, size = [], [], [], 0
    if held:
        yield number, start, held


def samples(held: list[bytes], length: int, gram: int):
    """For runs of windows with one sample: piece, first window (in its piece), number of windows, offset of the
    sample from the first window, name of the k-gram, name of the context."""
    raw = b"".join(held)
    hashes = Hashes(raw)
    g = hashes.fixed(gram)
    low = np.uint64((1 << 24) - 1)
    m = (g & ~low) | np.arange(len(g), dtype=np.uint64)
    width, done = length - gram + 1, 1
    while 2 * done <= width:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    if width > done:
        m = np.minimum(m[: len(m) - (width - done)], m[width - done :])
    at = (m & low).astype(np.int64)
    sizes = np.array([len(p) for p in held], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    windows = np.concatenate([np.arange(b, b + s - length + 1) for b, s in zip(begin, sizes)])
    piece = np.repeat(np.arange(len(held)), sizes - length + 1)
    new = np.flatnonzero((np.diff(at[windows]) != 0) | (np.diff(piece) != 0)) + 1
    first = np.concatenate([[0], new])
    last = np.concatenate([new, [len(windows)]]) - 1
    lo, hi, sample, of = windows[first], windows[last], at[windows[first]], piece[first]
    shape = ((sample - lo) << 16 | (hi - lo)).astype(np.uint64)
    context = mixed(hashes.of(lo, hi + length) + mixed(shape))
    return of, lo - begin[of], hi - lo + 1, sample - lo, g[sample], context


def _key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.col(text_col))


def sampled(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """key, a (k-gram), c (context), place, known of every sample. Of more than two equal contexts in a chunk the
    others are known to repeat and get a k-gram name of their own."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            keys = np.array(batch.column("key").to_pylist(), dtype=np.int64)
            for number, start, held in parts(texts_of(batch), length):
                of, lo, n, off, a, c = samples(held, length, gram)
                key = keys[np.array(number)[of]]
                place = (lo + np.array(start)[of]) << (_N + _OFF) | (off << _N) | (n - 1)
                order = np.argsort(c, kind="stable")
                s = c[order]
                nth = np.arange(len(s)) - np.searchsorted(s, s)
                known = np.zeros(len(s), dtype=bool)
                known[order] = nth >= 2
                a = np.where(known, mixed(key.view(np.uint64) + place.astype(np.uint64)), a)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), pa.array(place), pa.array(known)], names=["key", "a", "c", "place", "known"])

    return docs.select("key", "text").mapInArrow(kernel, "key long, a long, c long, place long, known boolean")


def named(rows: DataFrame) -> DataFrame:
    """a, key, place, repeats, goes_on, crowded of samples that repeat or whose k-gram has several contexts."""
    order, whole = Window.partitionBy("a").orderBy("c"), Window.partitionBy("a")
    seen = rows.select(
        "a", "key", "place", "known", "c", (F.count("*").over(whole) > CROWD).alias("crowded"),
        F.lag("c").over(order).alias("before"), F.lead("c").over(order).alias("after"),
        F.min("c").over(whole).alias("least"), F.max("c").over(whole).alias("most"),
    )
    several = F.col("least") != F.col("most")
    equal = lambda other: F.coalesce(F.col(other) == F.col("c"), F.lit(False))
    return seen.filter(F.col("known") | several | F.col("before").isNotNull() | F.col("after").isNotNull()).select(
        "a", "key", "place", "crowded", (F.col("known") | equal("before") | equal("after")).alias("repeats"), (several & ~equal("before") & ~F.col("known")).alias("goes_on")
    )


def _joined(docs: DataFrame, open_: DataFrame) -> DataFrame:
    lists = open_.groupBy(F.col("key").alias("k")).agg(F.collect_list(F.struct("place", "a")).alias("places"))
    return docs.join(lists, F.col("key") == F.col("k")).select("key", "text", "places")


def window_hashes(contexts: list[bytes], n: np.ndarray, length: int) -> np.ndarray:
    """Names of all windows of the contexts, which have n windows each."""
    size, out = n + length - 1, []
    step = max(1, 2 * CHUNK // int(size.max(initial=1)))
    for a in range(0, len(n), step):
        m, held = n[a : a + step], size[a : a + step]
        begin = np.cumsum(held) - held
        at = np.repeat(begin, m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        out.append(Hashes(b"".join(contexts[a : a + step])).of(at, at + length))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def contexts(docs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """a, key, place, bytes of the places that go on."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            out: list[list] = [[], [], [], []]
            for key, text, places in zip(batch.column("key").to_pylist(), texts_of(batch), batch.column("places").to_pylist()):
                for x in places:
                    place = x["place"]
                    lo = place >> (_N + _OFF)
                    for column, v in zip(out, (x["a"], key, place, text[lo : lo + (place & 255) + length])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["a", "key", "place", "bytes"])

    return _joined(docs, open_).mapInArrow(kernel, "a long, key long, place long, bytes binary")


def meet(rows: DataFrame, length: int) -> DataFrame:
    """key, place: runs of windows that occur in several contexts of their k-gram."""

    def runs(table: pa.Table) -> pa.RecordBatch:
        place = table.column("place").to_numpy()
        n = (place & 255) + 1
        w = window_hashes(table.column("bytes").to_pylist(), n, length)
        order = np.argsort(w, kind="stable")
        same = w[order][1:] == w[order][:-1]
        again = np.zeros(len(w), dtype=bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        of = np.repeat(np.arange(len(n)), n)
        start = np.repeat(place >> (_N + _OFF), n) + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
        hit = np.flatnonzero(again)
        new = np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(of[hit]) != 0)])[: len(hit)]
        first = np.flatnonzero(new)
        count = np.diff(np.concatenate([first, [len(hit)]]))
        key = table.column("key").to_numpy()[of[hit[first]]]
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(start[hit[first]] << (_N + _OFF) | (count - 1))], names=["key", "place"])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.concat_tables([held, pa.Table.from_batches([batch])]) if held is not None else pa.Table.from_batches([batch])
            if held.nbytes > 8 << 20:
                a = held.column("a").to_numpy()
                whole = int(np.searchsorted(a, a[-1]))  # the last k-gram may go on in the next batch
                if whole:
                    yield runs(held.slice(0, whole))
                    held = held.slice(whole).combine_chunks()
        if held is not None and held.num_rows:
            yield runs(held)

    return rows.repartition("a").sortWithinPartitions("a").mapInArrow(kernel, "key long, place long")


def window_names(docs: DataFrame, open_: DataFrame, length: int) -> DataFrame:
    """key, start, w (name) of every window of the places that go on."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            for key, text, places in zip(batch.column("key").to_pylist(), texts_of(batch), batch.column("places").to_pylist()):
                places = np.unique(np.array([x["place"] for x in places], dtype=np.int64))
                lo, n = places >> (_N + _OFF), (places & 255) + 1
                w = window_hashes([text[i : i + m + length - 1] for i, m in zip(lo.tolist(), n.tolist())], n, length)
                start = np.repeat(lo, n) + np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), key, dtype=np.int64)), pa.array(start), pa.array(w.view(np.int64))], names=["key", "start", "w"])

    return _joined(docs, open_).mapInArrow(kernel, "key long, start long, w long")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key, place: runs of windows that occur elsewhere; `docs` has key and text."""
    if length - gram >= 1 << _OFF or gram > length:
        raise ValueError("the k-gram must be within 255 bytes of the length")
    names = stage(named(sampled(docs, length, gram)), "repeat-names")
    found = names.filter("repeats").select("key", "place").unionByName(meet(contexts(docs, names.filter("goes_on and not crowded"), length), length))
    crowded = names.filter("goes_on and crowded")
    if crowded.head(1):
        order = Window.partitionBy("w").orderBy("key", "start")
        again = window_names(docs, crowded, length).select("key", "start", F.lag("key").over(order).isNotNull().alias("x"), F.lead("key").over(order).isNotNull().alias("y")).filter("x or y")
        found = found.unionByName(again.select("key", F.shiftleft("start", _N + _OFF).alias("place")))
    return found


def covered(n: int, places: list[int] | None, length: int) -> np.ndarray:
    """(start, end) of maximal runs of bytes that the windows at these places cover."""
    if not places:
        return np.empty((0, 2), dtype=np.int64)
    places = np.array(places, dtype=np.int64)
    start = places >> (_N + _OFF)
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + (places & 255) + length, -1)
    inside = np.concatenate([[0], (np.cumsum(change)[:n] > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(inside))
    return edges.reshape(-1, 2)


def _cut(text: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for a, b in spans.tolist():
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def with_places(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows with `places` of their repeated windows; docs must have `key` and `text`."""
    lists = repeats(docs.select("key", "text"), length, gram).groupBy(F.col("key").alias("r_key")).agg(F.collect_set("place").alias("places"))
    return docs.join(lists, F.col("key") == F.col("r_key"), "left").drop("r_key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_spans, n_removed, spans, kept (bytes) of every row.

    Every byte goes that is covered by a `length`-byte string which also starts anywhere else, in any row or
    the same one. Null texts count as empty. Rows that repeat an id or a whole row are texts of their own; ids
    may be null. An empty table gives no rows.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A row is known by its content; of fully equal rows each one repeats the other.
    given = given.withColumn("key", _key("doc_id", "text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in chunks(batches):
            out: list[list] = [[], [], [], [], []]
            for text, places in zip(texts_of(batch), batch.column("places").to_pylist()):
                spans = covered(len(text), places, length)
                for column, v in zip(out, (len(text), len(spans), int((spans[:, 1] - spans[:, 0]).sum()), [{"start": a, "end": b} for a, b in spans.tolist()], _cut(text, spans))):
                    column.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), span, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types)]], names=["doc_id", "n_bytes", "n_spans", "n_removed", "spans", "kept"])

    schema = "doc_id long, n_bytes long, n_spans long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
    return with_places(given, length, gram).select("doc_id", "text", "places").mapInArrow(kernel, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows with all their columns; repeated strings are cut from the text. Bytes of a character that was
    cut in two are dropped; null texts stay null, and a column n_chars, if there, follows the text."""
    columns = docs.columns
    given = docs.withColumn("__text", F.col(text_col)).withColumn("__key", _key(id_col, text_col))
    keyed = given.select(F.col("__key").alias("key"), F.coalesce(F.col("__text").cast("string"), F.lit("")).alias("text"))
    lists = repeats(keyed, length, gram).groupBy(F.col("key").alias("__r_key")).agg(F.collect_set("place").alias("__places"))
    joined = given.join(lists, F.col("__key") == F.col("__r_key"), "left").select(*columns, "__places")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = len(columns)
        for batch in chunks(batches, text_col):
            out = []
            for text, places in zip(batch.column(text_col).to_pylist(), batch.column(at).to_pylist()):
                raw = (text or "").encode()
                out.append(_cut(raw, covered(len(raw), places, length)).decode("utf-8", "ignore") if places else text)
            own = [pa.array(out, pa.string()) if name == text_col else batch.column(i) for i, name in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([*own, batch.column(at).is_valid()], names=[*columns, "__cut"])

    schema = StructType([*docs.schema.fields, StructField("__cut", BooleanType())])
    done = joined.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(kernel, schema)
    if "n_chars" in columns:
        done = done.withColumn("n_chars", F.when(F.col("__cut"), F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return done.select(*columns)
