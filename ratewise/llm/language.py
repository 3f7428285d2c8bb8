"""Language identification by n-gram filters that answer with a bitmask of languages.

Grams are windows of four bytes over letters and word ends. Training sums their counts per language over all
labelled texts; a language owns a gram if its share there is a fair part of the best language's. The grams go
into a Bloom filter whose slots hold one bit per language (bit-sliced: one look-up asks 64 languages). A
text's hits per language are popcounts over its grams, corrected for the filter's false positives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.llm.common import MIX, chunks, mixed, stage, texts_of

#: The model's size: grams kept per language, the most frequent first, and log2 of the filter's slots.
GRAMS, SLOT_BITS, PROBES = 65_536, 20, 3
#: Parts in which a language's grams are ranked before the last ranking.
PARTS = 32
#: A language owns a gram whose share in it is at least this part of the largest share in any language.
OWN_PART, LEAST_COUNT = 0.2, 3
UNKNOWN, FEW = "und", 20
#: Least share of a text's grams, beyond what chance gives, that its best language owns for the text to be kept.
COVERAGE = 0.5
#: Languages to a table: one bit of a slot each.
SLICE = 64

#: A-Z to a-z; all other ASCII that isn't a letter to a space; bytes of other letters stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams (uint32) of the texts one after the other, and the number of grams before each text and after all."""
    joined = b"".join(b" " + t.translate(_TABLE) + b"   " for t in texts)
    b = np.frombuffer(joined, dtype=np.uint8).astype(np.uint32)
    if not len(texts):
        return np.empty(0, np.uint32), np.zeros(1, np.int64)
    code = b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24)
    letter = b != 32
    n = letter[:-3].astype(np.uint8) + letter[1:-2] + letter[2:-1] + letter[3:]
    inner = letter[1:-2] & (n >= 2)
    ends = np.cumsum([len(t) + 4 for t in texts])
    before = np.concatenate([[0], np.cumsum(inner)])
    at = np.minimum(np.concatenate([[0], ends]), len(inner))
    return code[inner], before[at]


def slots(codes: np.ndarray) -> np.ndarray:
    """The filter's slots of each gram, one row per probe."""
    h = mixed(codes.astype(np.uint64) * MIX + np.uint64(1))
    return np.stack([((h >> np.uint64(20 * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(PROBES)])


@dataclass
class Filter:
    languages: list[str]
    tables: list[np.ndarray]
    false_rate: np.ndarray

    @property
    def table(self) -> np.ndarray:
        """The slots of the first languages."""
        return self.tables[0]

    @classmethod
    def of(cls, languages: list[str], rows: list[tuple]) -> Filter:
        """From (gram, bitmask of languages) or (gram, bitmask, slice of 64 languages)."""
        tables = [np.zeros(1 << SLOT_BITS, dtype=np.uint64) for _ in range(max(1, -(-len(languages) // SLICE)))]
        if rows:
            codes = np.array([r[0] for r in rows], dtype=np.int64).astype(np.uint32)
            masks = np.array([r[1] for r in rows], dtype=np.int64).astype(np.uint64)
            part = np.array([r[2] if len(r) > 2 else 0 for r in rows])
            for s in slots(codes):
                for k, table in enumerate(tables):
                    np.bitwise_or.at(table, s[part == k], masks[part == k])
        filled = np.array([((tables[k // SLICE] >> np.uint64(k % SLICE)) & np.uint64(1)).mean() for k in range(len(languages))])
        return cls(languages, tables, filled**PROBES)

    def hits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Grams of each text (row) that each language (column) owns, beyond those by chance; the number of grams."""
        codes, at = grams(texts)
        n = np.diff(at)
        out = np.empty((len(texts), len(self.languages)))
        probes = slots(codes) if self.languages else []
        for first in range(0, len(self.languages), SLICE):
            masks = np.full(len(codes), np.uint64(2**64 - 1))
            for s in probes:
                masks &= self.tables[first // SLICE][s]
            for k, rate in enumerate(self.false_rate[first : first + SLICE]):
                seen = np.concatenate([[0], np.cumsum((masks >> np.uint64(k)) & np.uint64(1), dtype=np.int64)])
                out[:, first + k] = np.maximum((seen[at[1:]] - seen[at[:-1]] - n * rate) / max(1 - rate, 1e-9), 0)
        return out, n

    def judge(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language of each text (the first of equals; -1 where nothing hits), its score, and
        the share of the grams it owns."""
        hits, n = self.hits(texts)
        if not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts)), np.zeros(len(texts))
        best, total = hits.argmax(axis=1), hits.sum(axis=1)
        score = np.divide(hits.max(axis=1), total, out=np.zeros(len(texts)), where=total > 0)
        return np.where(total > 0, best, -1), score, hits.max(axis=1) / np.maximum(n, 1)


def count_grams(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """lang, gram, n over all rows with text and language. Each task sums its own grams first."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in chunks(batches):
            langs, texts = np.array(batch.column("lang").to_pylist(), dtype=object), texts_of(batch)
            for lang in set(langs.tolist()):
                codes, counts = np.unique(grams([texts[i] for i in np.flatnonzero(langs == lang)])[0], return_counts=True)
                if lang in found:
                    old, n = found[lang]
                    merged, back = np.unique(np.concatenate([old, codes]), return_inverse=True)
                    codes, counts = merged, np.bincount(back, np.concatenate([n, counts])).astype(np.int64)
                found[lang] = codes, counts
        for lang, (codes, counts) in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()
    return known.mapInArrow(kernel, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Filter:
    """The filter of all languages that occur with a text, any number of them."""
    counts = stage(count_grams(docs, lang_col, text_col), "gram-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(r["lang"] for r in totals.collect())
    if not languages:
        return Filter.of([], [])
    places = counts.sparkSession.createDataFrame(list(zip(languages, range(len(languages)))), "lang string, k int")
    shares = counts.join(F.broadcast(totals), "lang").select("gram", "lang", "n", (F.col("n") / F.col("total")).alias("share"))
    best = shares.withColumn("best", F.max("share").over(Window.partitionBy("gram"))).filter((F.col("share") >= OWN_PART * F.col("best")) & (F.col("n") >= LEAST_COUNT))
    # The first of every part of a language, then the first of those: no task ranks all grams of a language.
    first = lambda *part: F.row_number().over(Window.partitionBy("lang", *part).orderBy(F.desc("share"), "gram"))
    kept = best.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS))).withColumn("place", first("part")).filter(F.col("place") <= GRAMS)
    kept = kept.withColumn("place", first()).filter(F.col("place") <= GRAMS)
    kept = kept.join(F.broadcast(places), "lang").withColumn("slice", F.floor(F.col("k") / SLICE))
    masks = kept.groupBy("gram", "slice").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("k") % SLICE)).alias("mask"))
    return Filter.of(languages, [(r["gram"], r["mask"], r["slice"]) for r in masks.collect()])


def predict(docs: DataFrame, model: Filter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row. Null texts and texts without a letter: ``und``, score 0.

    A text whose grams no language owns gets the first language with score 0. Without any learned language
    all texts are ``und``.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            best, score, _ = model.judge(texts_of(batch))
            lettered = [bool(t and _LETTER.search(t)) and bool(model.languages) for t in batch.column("text").to_pylist()]
            names = [model.languages[max(b, 0)] if ok else UNKNOWN for b, ok in zip(best, lettered)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(lettered, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(kernel, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Filter, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text has an identified language: it has a letter, and if it is
    longer than FEW grams a language owns COVERAGE of them, beyond chance."""
    schema = docs.schema

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col):
            ok = [bool(t and _LETTER.search(t)) for t in batch.column(text_col).to_pylist()]
            hits, n = model.hits(texts_of(batch, text_col))
            yield batch.filter(pa.array(np.array(ok) & ((hits.max(axis=1, initial=0) >= COVERAGE * np.maximum(n, 1)) | (n <= FEW)), pa.bool_()))

    return docs.mapInArrow(kernel, schema)
