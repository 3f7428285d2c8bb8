"""Benchmark decontamination by spaced seeds; DataFrame functions only.

A seed is the hash of the words at the kept positions of a fixed mask; the words in between may differ. Seeds
of all positions of the texts meet seeds of the benchmark in an equi-join. Around each hit, text and item are
laid over each other and compared word by word: they overlap where a window of `window` words has at least
`share` equal ones. The default masks find every window of 12 or 13 words with up to two substitutions (tested).
Shorter items are cut into one run of words more than the rule lets differ, so that one of them must be equal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stage

MASKS = ((0, 1, 3, 6, 7), (0, 1, 4, 6, 7))
WINDOW, SHARE = 13, 0.8
#: Items of fewer words are found by runs of words, longer ones by masks; items of fewer than LEAST_WORDS only on demand.
SHORT, LEAST_WORDS = 12, 8
#: Benchmark seeds up to this many rows (under 64 MB) are broadcast; more are joined by shuffle.
BROADCAST_SEEDS = 1_000_000
#: Texts are looked through in blocks of as many words as the longest item has, but at least of this many.
LEAST_BLOCK = 64


def word_hashes(text: Column) -> Column:
    """One hash per word of the lower-cased text; words are separated by ASCII white space."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.xxhash64(w))


def seeds(hashes: str, masks=MASKS, first: Column | None = None, last: Column | None = None) -> Column:
    """The seeds of the positions first to last (all), one after the other, of each position one for each mask;
    positions too near to the end have none."""
    h = F.col(hashes)
    start, end = F.lit(0) if first is None else first, F.size(h) - 1 - min(m[-1] for m in masks)
    end = end if last is None else F.least(end, last)
    every = lambda i: F.array(*[F.xxhash64(F.lit(n), *[F.get(h, i + F.lit(k)) for k in m]) for n, m in enumerate(masks)])
    return F.when(end >= start, F.flatten(F.transform(F.sequence(start, end), every))).otherwise(F.array().cast("array<bigint>"))


def position(of_seed: str, masks=MASKS) -> Column:
    """The position that the n-th seed belongs to."""
    return (F.col(of_seed) / len(masks)).cast("int")


def short_runs(n: int, share: float) -> list[tuple[int, int]]:
    """(start, length) of the runs of an item of n words, one more than the words that may differ."""
    parts = min(n, n - math.ceil(n * share - 1e-9) + 1)
    cuts = [n * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def benchmark_seeds(items: DataFrame, masks=MASKS, lengths: list[int] = (), share: float = SHARE) -> tuple[DataFrame, tuple]:
    """item_id, item_at, seed of every item position and mask, and of the runs of items with one of the short
    `lengths`; and the masks with those of the runs."""
    rows = items.filter(~F.size("hashes").isin(*lengths)) if lengths else items
    rows = rows.select("item_id", F.posexplode(F.when(F.size("hashes") > max(m[-1] for m in masks), seeds("hashes", masks))).alias("nth", "seed"))
    known = rows.select("item_id", position("nth", masks).alias("item_at"), "seed")
    every = (*masks, *(tuple(range(k)) for k in sorted({k for n in lengths for _, k in short_runs(n, share)})))
    for n in lengths:
        runs = [F.struct(F.lit(at).alias("item_at"), F.xxhash64(F.lit(every.index(tuple(range(k)), len(masks))), *[F.get("hashes", F.lit(at + i)) for i in range(k)]).alias("seed")) for at, k in short_runs(n, share)]
        known = known.unionByName(items.filter(F.size("hashes") == n).select("item_id", F.explode(F.array(*runs)).alias("r")).select("item_id", "r.item_at", "r.seed"))
    return known, every


def blocks(texts: DataFrame, size: int, around: int) -> DataFrame:
    """doc_id, block_at, from, h: the word hashes of every block of `size` words with `around` words on both
    sides; `from` is where h starts. A row's width does not grow with the text."""
    begin = lambda at: F.greatest(F.lit(0), at - F.lit(around))
    cut = lambda at: F.struct(at.alias("block_at"), begin(at).alias("from"), F.slice("h", begin(at) + 1, F.lit(size + around) + at - begin(at)).alias("h"))
    starts = F.sequence(F.lit(0), F.size("h") - 1, F.lit(size))
    return texts.filter(F.size("h") > 0).select("doc_id", F.explode(F.transform(starts, cut)).alias("b")).select("doc_id", "b.*")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", masks=MASKS, window: int = WINDOW, share: float = SHARE, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, item_id, doc_at, item_at, n_words, n_equal: every overlap of a text with a benchmark item.

    doc_at and item_at are word positions where the laid-over part starts (n_words long, n_equal equal). The
    window is shorter for items that are. Items of fewer than `least` words and null or empty texts take no
    part. Rows with a null id take no part; rows that repeat an id are one document with all their hits.
    """
    texts = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), word_hashes(F.col(text_col).cast("string")).alias("h"))
    items = stage(benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), word_hashes(F.col(item_text_col).cast("string")).alias("hashes")).filter(F.size("hashes") >= least), "benchmark-items")
    lengths = sorted(r["n"] for r in items.select(F.size("hashes").alias("n")).filter((F.col("n") > 0) & (F.col("n") < min(SHORT, window + 1))).distinct().collect())
    known, masks = benchmark_seeds(items, masks, lengths, share)
    known = stage(known, "benchmark-seeds")
    wide = known.join(items.select(F.col("item_id").alias("i_id"), F.size("hashes").alias("n_item")).groupBy("i_id").agg(F.max("n_item").alias("n_item")), F.col("item_id") == F.col("i_id")).select("seed", "item_id", "item_at", "n_item")
    if known.count() <= BROADCAST_SEEDS:
        wide = F.broadcast(wide)
    longest = items.agg(F.max(F.size("hashes"))).first()[0] or 0
    size = max(LEAST_BLOCK, longest)
    local = F.col("block_at") - F.col("from")
    each = blocks(texts, size, longest + max(m[-1] for m in masks))
    each = each.select("doc_id", "from", "h", local.alias("local"), F.posexplode(seeds("h", masks, local, local + (size - 1))).alias("nth", "d_seed"))
    hits = each.join(wide, F.col("d_seed") == F.col("seed"))
    hits = hits.withColumn("shift", F.col("from") + F.col("local") + position("nth", masks) - F.col("item_at"))
    first = F.greatest(F.lit(0), F.col("shift"))
    laid = hits.select("doc_id", "item_id", "shift", F.slice("h", first - F.col("from") + 1, F.col("n_item") - (first - F.col("shift"))).alias("part"))
    laid = laid.groupBy("doc_id", "item_id", "shift", "part").agg(F.lit(1).alias("one"))
    skip = F.greatest(F.lit(0), -F.col("shift"))
    pairs = laid.join(items.select(F.col("item_id").alias("i_id"), "hashes"), F.col("item_id") == F.col("i_id"))
    equal = F.zip_with("part", F.slice("hashes", skip + 1, F.greatest(F.size("part"), F.lit(0))), lambda a, b: F.when(a == b, 1).otherwise(0))
    pairs = pairs.select("doc_id", "item_id", "shift", skip.alias("item_at"), equal.alias("equal"), F.least(F.lit(window), F.size("hashes")).alias("w"))
    total = lambda c: F.aggregate(c, F.lit(0), lambda s, x: s + x)
    enough = F.ceil(F.col("w") * share - 1e-9)
    reached = F.exists(F.sequence(F.lit(1), F.size("equal") - F.col("w") + 1), lambda j: total(F.slice("equal", j, F.col("w"))) >= enough)
    kept = pairs.filter(F.size("equal") >= F.col("w")).filter(reached)
    return kept.select("doc_id", "item_id", F.greatest(F.lit(0), F.col("shift")).alias("doc_at"), "item_at", F.size("equal").alias("n_words"), total("equal").alias("n_equal"))


def contamination(docs: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, best_equal of every row; best_equal is the most equal words."""
    id_col = columns.get("id_col", "doc_id")
    found = overlaps(docs, benchmark, **columns).groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("n_equal").alias("best_equal")).withColumnRenamed("doc_id", "f_doc")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    items = F.coalesce("item_ids", F.array().cast("array<long>"))
    return ids.join(found, F.col("doc_id") == F.col("f_doc"), "left").select("doc_id", F.col("f_doc").isNotNull().alias("contaminated"), F.size(items).alias("n_items"), items.alias("item_ids"), F.coalesce("best_equal", F.lit(0)).alias("best_equal"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """The rows, with all their columns, whose text overlaps no benchmark item."""
    found = stage(overlaps(docs, benchmark, id_col, text_col, least=least).select(F.col("doc_id").alias("f_doc")).distinct(), "contaminated")
    return docs.join(found, docs[id_col].cast("long") == found["f_doc"], "left_anti")
