"""Phrase collocations: word n-grams that occur far more often than their parts.

1. Texts are cut into chunks of one language (never inside a piece) and written once.
2. Each chunk counts its n-grams by a hash, and sends the counts to hash partitions. The number of partitions
   follows from the corpus's words, so that none holds more than `MASS` occurrences on average.
3. A partition merges its chunks' counts into one Misra-Gries summary whose capacity exceeds the partition's
   mass divided by the threshold: what the summary has taken off every counter stays below the threshold, so
   each frequent n-gram survives. The surviving hashes go back to the chunks that hold them.
4. Each chunk counts the n-grams with surviving hashes a second time, now by their words; the partitions add
   these counts up. Hashes that collide only let too much survive; the counts are exact.
5. Scores, the containment rule and the best of each language are joins and sums over the frequent n-grams.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import chunks, mixed, stage

LEAST, LONGEST, TOP, CONTAINED = 30, 4, 2000, 80
#: Bytes of text to a chunk, and n-gram occurrences to a hash partition on average.
CHUNK, MASS = 4 << 20, 1 << 23
#: Bits of a hash that tell n-grams apart in the first pass; in large corpora more, so that a partition's keys have 24.
HASH_BITS = 36
#: Parts that each language's ranking is cut into before the last one.
PARTS = 256
#: The bytes that end a piece.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

_END = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_PLAIN = bytes.maketrans(PIECE_ENDS + b"\t", b"." * len(PIECE_ENDS) + b" ")


def tokens_of(text: bytes) -> list[bytes]:
    """Lower-cased words, with b"." between pieces; no word can be that."""
    return text.lower().translate(_PLAIN).replace(b".", b" . ").split()


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts of about `most` bytes, cut only where a piece ends."""
    start = 0
    while len(text) - start > most:
        end = _END.search(text, start + most)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.end()
    yield text[start:]


def _packed(data: bytes) -> bytes:
    return pa.Codec("zstd", 1).compress(data, asbytes=True)


def _unpacked(data: bytes, size: int) -> bytes:
    return pa.Codec("zstd").decompress(data, size, asbytes=True) if size else b""


def key_bits(bits: int) -> int:
    """Bits of a key within one of 2^bits hash partitions: a key costs as much however many partitions there are."""
    return min(32, max(24, HASH_BITS - bits))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Rising keys of up to 32 bits: their steps, byte by byte, compressed."""
    steps = np.diff(keys.astype(np.uint32), prepend=np.uint32(0)).astype("<u4")
    return _packed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data, 4 * n), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def merge(summary: tuple[np.ndarray, np.ndarray, int], keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary (keys, counters, taken off) with more counts merged in, cut to the capacity.

    If counters are too many, the (capacity + 1)-th largest is taken off all of them and those that reach
    zero go. Each unit taken off costs more than `capacity` occurrences, so with a mass of all counts M a
    counter is at most M / (capacity + 1) below the true count, in whatever order parts are merged.
    """
    both = np.concatenate([summary[0], keys])
    order = np.argsort(both, kind="stable")
    both, value = both[order], np.concatenate([summary[1], counts])[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.empty(0, np.int64)
    both, value, off = both[first], np.add.reduceat(value, first) if len(first) else value, summary[2]
    if len(both) > capacity:
        cut = int(np.partition(value, len(value) - capacity - 1)[len(value) - capacity - 1])
        stays = value > cut
        both, value, off = both[stays], value[stays] - cut, off + cut
    return both, value, off


class Chunk:
    """The n-grams of one chunk: hashes by length, and the words behind them."""

    def __init__(self, text: bytes, lang: str, longest: int):
        self.tokens = tokens_of(text)
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        end = vocabulary[b"."]
        self.ids = np.fromiter(map(vocabulary.__getitem__, self.tokens), np.int64, len(self.tokens))
        seed = xxhash.xxh64_intdigest(lang.encode())
        word = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in vocabulary), np.uint64, len(vocabulary))[self.ids]
        inside = self.ids != end
        self.words = int(inside.sum())
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []  # by length: places and hashes
        rolled, whole = mixed(word), inside
        for n in range(1, longest + 1):
            if n > 1:
                rolled = mixed(rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[n - 1 :])
                whole = whole[:-1] & inside[n - 1 :]
            at = np.flatnonzero(whole)
            self.grams.append((at, rolled[at]))

    def counted(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hash prefixes, rising, and their counts."""
        return np.unique(np.concatenate([h for _, h in self.grams]) >> np.uint64(shift), return_counts=True)

    def phrases(self, wanted: np.ndarray, shift: int) -> Iterator[tuple[np.ndarray, int, list[bytes], np.ndarray]]:
        """For each length the prefixes, length, phrases and counts of the n-grams whose hash prefix is wanted.

        `wanted` is sorted. N-grams are told apart by their words.
        """
        coarse = np.zeros(1 << 22, bool)
        bits = 64 - shift
        coarse[(wanted >> np.uint64(max(bits - 22, 0))).astype(np.int64)] = True
        for n, (at, h) in enumerate(self.grams, 1):
            prefix = h >> np.uint64(shift)
            near = np.flatnonzero(coarse[(prefix >> np.uint64(max(bits - 22, 0))).astype(np.int64)])
            place = np.searchsorted(wanted, prefix[near])
            near = near[wanted[np.minimum(place, len(wanted) - 1)] == prefix[near]] if len(wanted) else near[:0]
            if not len(near):
                continue
            start = at[near]
            columns = [self.ids[start + k] for k in range(n)]
            order = np.lexsort(columns)
            new = np.zeros(len(order), bool)
            new[0] = True
            for c in columns:
                c = c[order]
                new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(order)))
            pick = order[first]
            # Of equal n-grams any place will do: lexsort is stable, so it is the first.
            texts = [b" ".join(self.tokens[i : i + n]) for i in start[pick].tolist()]
            yield prefix[near[pick]], n, texts, counts


def cut_into_chunks(docs: DataFrame, text_col: str, lang_col: str, most: int) -> DataFrame:
    """chunk, lang, words, size, text (compressed): written, so that every later pass sees the same chunks."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        all_held = 0

        def flushed(langs: list[str]) -> pa.RecordBatch:
            texts = [b".".join(held.pop(lang)) for lang in langs]
            for lang in langs:
                del sizes[lang]
            words = [len(w) - w.count(b".") for w in map(tokens_of, texts)]
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([_packed(t) for t in texts], pa.binary())], names=["lang", "words", "size", "text"])

        for batch in batches:
            for part in chunks([batch]):
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    for piece in pieces(text, most):
                        held.setdefault(lang, []).append(piece)
                        sizes[lang] = sizes.get(lang, 0) + len(piece) + 1
                        all_held += len(piece) + 1
                        if sizes[lang] >= most:
                            all_held -= sizes[lang]
                            yield flushed([lang])
                        elif all_held >= 4 * most:
                            all_held = 0
                            yield flushed(sorted(held))
        for lang in sorted(held):
            yield flushed([lang])

    given = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).filter("length(text) > 0")
    cut = given.mapInArrow(kernel, "lang string, words long, size long, text binary")
    return stage(cut.filter("words > 0").withColumn("chunk", F.monotonically_increasing_id()), "phrase-chunks")


def _summarise(longest: int, bits: int):
    """Each chunk's counts, dealt to the 2^bits hash partitions: part, chunk, n, mass, keys, counts."""
    width = key_bits(bits)
    shift, inside = 64 - bits - width, np.uint64((1 << width) - 1)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("chunk", "lang", "size", "text")}
                keys, counts = Chunk(_unpacked(row["text"], row["size"]), row["lang"], longest).counted(shift)
                part, keys = (keys >> np.uint64(width)).astype(np.int64), keys & inside
                edges = np.searchsorted(part, np.arange((1 << bits) + 1))
                spans = [(p, a, b) for p, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _, _ in spans], pa.int32()),
                        pa.array([row["chunk"]] * len(spans), pa.int64()),
                        pa.array([b - a for _, a, b in spans], pa.int64()),
                        pa.array([int(counts[a:b].sum()) for _, a, b in spans], pa.int64()),
                        pa.array([pack_sorted(keys[a:b]) for _, a, b in spans], pa.binary()),
                        pa.array([_packed(counts[a:b].astype("<u4").tobytes()) for _, a, b in spans], pa.binary()),
                    ],
                    names=["part", "chunk", "n", "mass", "keys", "counts"],
                )

    return kernel, "part int, chunk long, n long, mass long, keys binary, counts binary"


def surviving(blobs: list[tuple[np.ndarray, np.ndarray]], least: int) -> tuple[np.ndarray, int]:
    """Sorted keys that may have `least` occurrences in all, and the summary's capacity."""
    mass = sum(int(c.sum()) for _, c in blobs)
    capacity = mass // least + 1
    summary = (np.empty(0, np.uint32), np.empty(0, np.int64), 0)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for k, (keys, counts) in enumerate(blobs):
        waiting.append((keys, counts.astype(np.int64)))
        if k == len(blobs) - 1 or sum(len(w[0]) for w in waiting) >= capacity:
            summary = merge(summary, np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting]), capacity)
            waiting = []
    keys, counters, off = summary
    return keys[counters + off >= least], capacity


def _survivors(least: int):
    """A hash partition's summary; to each chunk, which of its keys survive."""

    def reduce(group: pa.Table) -> pa.Table:
        part, chunk = group.column("part")[0].as_py(), group.column("chunk").to_pylist()
        order = sorted(range(len(chunk)), key=chunk.__getitem__)
        n, keys, counts = (group.column(c).to_pylist() for c in ("n", "keys", "counts"))
        blobs = [(unpack_sorted(keys[i], n[i]), np.frombuffer(_unpacked(counts[i], 4 * n[i]), "<u4")) for i in order]
        wanted, _ = surviving(blobs, least)
        held = [k[np.isin(k, wanted, assume_unique=True)] for k, _ in blobs]
        some = [(chunk[i], h) for i, h in zip(order, held) if len(h)]
        return pa.table({"chunk": pa.array([c for c, _ in some], pa.int64()), "part": pa.array([part] * len(some), pa.int32()), "n": pa.array([len(h) for _, h in some], pa.int64()), "keys": pa.array([pack_sorted(h) for _, h in some], pa.binary())})

    return reduce, "chunk long, part int, n long, keys binary"


def _recount(longest: int, bits: int):
    """A chunk's exact counts of the n-grams with surviving hashes: part, lang, words, size, phrases, counts."""
    width = key_bits(bits)
    shift = 64 - bits - width

    def kernel(chunk: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], [], []]
        if chunk.num_rows and wanted.num_rows:
            lang = chunk.column("lang")[0].as_py()
            prefixes = [np.uint64(p << width) | unpack_sorted(k, n).astype(np.uint64) for p, n, k in sorted(zip(*(wanted.column(c).to_pylist() for c in ("part", "n", "keys"))))]
            grams = Chunk(_unpacked(chunk.column("text")[0].as_py(), chunk.column("size")[0].as_py()), lang, longest)
            for prefix, n, texts, counts in grams.phrases(np.concatenate(prefixes), shift):
                part = (prefix >> np.uint64(width)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange((1 << bits) + 1)).tolist()
                for p, (a, b) in enumerate(zip(edges, edges[1:])):
                    if b > a:
                        pairs = sorted((texts[i], int(counts[i])) for i in order[a:b].tolist())
                        data = b"\n".join(t for t, _ in pairs)
                        for column, value in zip(out, (p, lang, n, len(data), _packed(data), _packed(np.array([c for _, c in pairs], "<u4").tobytes()))):
                            column.append(value)
        kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(out, kinds)], names=["part", "lang", "words", "size", "phrases", "counts"])

    return kernel, "part int, lang string, words int, size long, phrases binary, counts binary"


def _add_up(least: int):
    """The exact counts of one hash partition's n-grams, those with `least` or more."""

    def reduce(group: pa.Table) -> pa.Table:
        total: defaultdict[tuple, int] = defaultdict(int)
        for lang, words, size, data, counts in zip(*(group.column(c).to_pylist() for c in ("lang", "words", "size", "phrases", "counts"))):
            phrases = _unpacked(data, size).split(b"\n")
            for phrase, count in zip(phrases, np.frombuffer(_unpacked(counts, 4 * len(phrases)), "<u4").tolist()):
                total[lang, words, phrase] += count
        kept = sorted((k, c) for k, c in total.items() if c >= least)
        return pa.table([pa.array([k[0] for k, _ in kept], pa.string()), pa.array([k[1] for k, _ in kept], pa.int32()), pa.array([k[2] for k, _ in kept], pa.binary()), pa.array([c for _, c in kept], pa.int64())], names=["lang", "words", "phrase", "f"])

    return reduce, "lang string, words int, phrase binary, f long"


def frequent_ngrams(cut: DataFrame, least: int = LEAST, longest: int = LONGEST, mass: int = MASS) -> DataFrame:
    """lang, words, phrase, f: every n-gram of 1 to `longest` words with at least `least` occurrences; `cut`
    is the result of ``cut_into_chunks``. Written to the shared folder. No chunks give no rows."""
    occurrences = longest * (cut.agg(F.sum("words")).first()[0] or 0)
    bits = min(31, (max(occurrences - 1, 0) // mass).bit_length())
    count, count_schema = _summarise(longest, bits)
    summarised = cut.select("chunk", "lang", "size", "text").mapInArrow(count, count_schema)
    keep, keep_schema = _survivors(least)
    survivors = summarised.groupBy("part").applyInArrow(keep, keep_schema)
    recount, recount_schema = _recount(longest, bits)
    counted = cut.groupBy("chunk").cogroup(survivors.groupBy("chunk")).applyInArrow(recount, recount_schema)
    add, add_schema = _add_up(least)
    found = counted.groupBy("part").applyInArrow(add, add_schema)
    return stage(found.select("lang", "words", F.col("phrase").cast("string").alias("phrase"), "f"), "phrase-counts")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED, text_col: str = "text", lang_col: str = "lang", chunk: int = CHUNK, mass: int = MASS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of 2 to `longest` words.

    a, l and r count the phrase, its first part and the rest at the lowest-scoring cut (ties: the shorter
    first part), n the language's words, score is floor(2000000 * a / (l + r)). Phrases with fewer than
    `least` occurrences do not count. A phrase that lies inside a longer one with at least `contained` percent of its
    occurrences is left out. Ties in score go to the larger a, then to the phrase first in byte order.

    Null and empty texts have no words; a null language is `und`. Repeated rows count each time; ids are not
    read, and extra columns are ignored. Texts of any length are cut into chunks where pieces end (a piece of
    more than `chunk` bytes stays whole). An empty table gives no rows.
    """
    cut = cut_into_chunks(docs, text_col, lang_col, chunk)
    counts = frequent_ngrams(cut, least, longest, mass)
    n = cut.groupBy("lang").agg(F.sum("words").alias("n"))
    word = F.split("phrase", " ", -1)
    candidates = counts.filter("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"))
    cuts = candidates.withColumn("w", word).select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    joined = lambda w: F.concat_ws(" ", w)
    cuts = cuts.select("lang", "phrase", "words", "a", "k", joined(F.slice("w", F.lit(1), F.col("k"))).alias("first"), joined(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k"))).alias("rest"))
    # The parts of a frequent phrase are frequent, so both joins find them.
    left = counts.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("l_phrase"), F.col("f").alias("l"))
    right = counts.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("f").alias("r"))
    both = cuts.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("first") == F.col("l_phrase"))).join(right, (F.col("lang") == F.col("r_lang")) & (F.col("rest") == F.col("r_phrase")))
    # Decimals: the product may pass 64 bits, and `div` is exact.
    score = F.expr("cast(cast(2000000 as decimal(38, 0)) * cast(a as decimal(20, 0)) div cast(l + r as decimal(20, 0)) as long)")
    scored = both.select("lang", "phrase", "words", "a", "k", "l", "r", score.alias("score")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("best"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: joined(F.slice("w", at, size)))))
    inside = candidates.filter("words > 2").withColumn("w", word).select("lang", "a", F.explode(F.array_distinct(spans)).alias("phrase"))
    longer = inside.groupBy(F.col("lang").alias("i_lang"), F.col("phrase").alias("i_phrase")).agg(F.max("a").alias("most"))
    kept = scored.join(longer, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("i_phrase")), "left").filter(F.col("most").isNull() | (F.col("most") * 100 < F.col("best.a") * contained))
    kept = kept.select("lang", "phrase", "best.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language may hold most phrases: the best of each of its parts first.
    part = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top).drop("rank", "part")
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sized = n.select(F.col("lang").alias("n_lang"), "n")
    return ranked.join(sized, F.col("lang") == F.col("n_lang")).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
