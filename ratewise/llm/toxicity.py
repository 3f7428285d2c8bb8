"""Toxicity scores from a linear classifier with a counterfactual penalty.

Features are the distinct words of a text and their beginnings, hashed. Training minimises the log loss with
an L1 term (so that words without evidence weigh nothing) plus the squared change of score when an identity
term in a labelled sentence is swapped for another, which keeps mere mentions of a group from counting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import chunks

#: log2 of the number of features; labelled rows of each class that the classifier is fitted on, at most.
FEATURE_BITS, ROWS_PER_CLASS = 18, 10_000
BEGINNINGS = (4, 5, 6)
#: Names of groups, singular and plural, that are swapped for each other within a row.
IDENTITY_TERMS = (
    ("woman", "man", "girl", "boy"),
    ("women", "men", "girls", "boys"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "african", "latino", "arab"),
    ("american", "mexican", "chinese", "german", "french", "spanish", "turkish", "indian"),
    ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("deaf", "blind", "disabled"),
    ("old", "young", "elderly"),
    ("frauen", "männer", "juden", "christen", "muslime", "ausländer"),
    ("femmes", "hommes", "juifs", "chrétiens", "musulmans", "étrangers"),
    ("mujeres", "hombres", "judíos", "cristianos", "musulmanes", "extranjeros"),
)
SWAPS = {a: [b for b in row if b != a] for row in IDENTITY_TERMS for a in row}

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def word_features(word: str) -> list[int]:
    mask = (1 << FEATURE_BITS) - 1
    return [xxhash.xxh64_intdigest(word.encode()) & mask] + [xxhash.xxh64_intdigest(b"<" + word[:k].encode()) & mask for k in BEGINNINGS if len(word) >= k]


def features(words: set[str], known: dict[str, list[int]]) -> np.ndarray:
    out: set[int] = set()
    for w in words:
        if (f := known.get(w)) is None:
            if len(known) > 200_000:
                known.clear()
            f = known[w] = word_features(w)
        out.update(f)
    return np.fromiter(sorted(out), dtype=np.int32, count=len(out))


def counterfactuals(text: str) -> Iterator[tuple[set[str], set[str]]]:
    """Word sets of each sentence with an identity term, and of the sentence with the next term of its row."""
    for m in _SENTENCE.finditer(text):
        words = _WORD.findall(m[0])
        for k, w in enumerate(words):
            if w in SWAPS:
                for other in SWAPS[w]:
                    yield set(words), {*words[:k], other, *words[k + 1 :]}


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """Label and features of a bounded sample of labelled rows: the first of each class by a hash of the id.

    `docs`: doc_id, text; `labels`: doc_id, toxic. Rows with a null id, text or label are left out; of rows
    with the same id and label one is chosen by.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("l_doc"), F.col("toxic").cast("int").alias("toxic")).filter("l_doc is not null and toxic in (0, 1)").distinct()
    first = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("l_doc"), "l_doc").limit(rows_per_class) for c in (0, 1)]
    chosen = first[0].unionByName(first[1])  # at most twice the bound, so it may be broadcast

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in chunks(batches):
            out: list[list] = [[], [], [], [], []]
            for doc, toxic, text in zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), batch.column("text").to_pylist()):
                low = text.lower()
                out[0].append(doc), out[1].append(0), out[2].append(toxic)
                out[3].append(features(set(_WORD.findall(low)), known).tobytes()), out[4].append(b"")
                for a, b in counterfactuals(low):
                    out[0].append(doc), out[1].append(1), out[2].append(toxic)
                    out[3].append(features(a, known).tobytes()), out[4].append(features(b, known).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary()), pa.array(out[4], pa.binary())], names=["doc_id", "swapped", "toxic", "a", "b"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    both = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc")).select("doc_id", "text", "toxic")
    return both.mapInArrow(kernel, "doc_id long, swapped int, toxic int, a binary, b binary")


def fit(rows: list, epochs: int = 4, rate: float = 0.3, l1: float = 1.0, counterfactual: float = 1.0) -> np.ndarray:
    """Weights (the last is the bias) by FTRL-proximal steps; `rows` as training_rows gives them, collected."""
    n = (1 << FEATURE_BITS) + 1
    z, s = np.zeros(n), np.zeros(n)
    order = sorted(rows, key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"]).encode()), r["doc_id"], r["swapped"], r["a"], r["b"]))
    plain = [r for r in order if not r["swapped"]]
    positive = sum(r["toxic"] for r in plain)
    if not 0 < positive < len(plain):
        out = np.zeros(n)
        out[-1] = 0 if not plain else (8 if positive else -8)
        return out
    data = [(r["swapped"], r["toxic"], np.append(np.frombuffer(r["a"], np.int32), n - 1), np.frombuffer(r["b"], np.int32)) for r in order]

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * l1) / (np.sqrt(s[i]) + 1.0) * rate
        return np.where((np.abs(z[i]) <= l1) & (i < n - 1), 0.0, w)

    def step(i: np.ndarray, g: np.ndarray) -> None:
        old = weights(i)
        sigma = (np.sqrt(s[i] + g * g) - np.sqrt(s[i])) / rate
        z[i] += g - sigma * old
        s[i] += g * g

    for _ in range(epochs):
        for swapped, toxic, a, b in data:
            if swapped:
                a = a[:-1]
                gone, new = np.setdiff1d(a, b), np.setdiff1d(b, a)
                i = np.concatenate([gone, new])
                sign = np.concatenate([-np.ones(len(gone)), np.ones(len(new))])
                change = float(sign @ weights(i))
                if change:
                    step(i, counterfactual * change * sign)
            else:
                p = 1 / (1 + np.exp(-np.clip(weights(a).sum(), -30, 30)))
                step(a, np.full(len(a), p - toxic))
    return weights(np.arange(n))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text; null and empty texts get the score of no words.

    Ids may repeat or be null; each row is scored alone.
    """
    nonzero = {int(i): float(weights[i]) for i in np.flatnonzero(weights[:-1])}
    bias = float(weights[-1])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in chunks(batches):
            out = []
            for text in batch.column("text").to_pylist():
                seen: set[int] = set()
                for w in set(_WORD.findall((text or "").lower())):
                    if (f := known.get(w)) is None:
                        if len(known) > 200_000:
                            known.clear()
                        f = known[w] = [i for i in word_features(w) if i in nonzero]
                    if f:
                        seen.update(f)
                x = bias + sum(nonzero[i] for i in sorted(seen))
                out.append(1 / (1 + np.exp(-min(max(x, -30.0), 30.0))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(kernel, "doc_id long, score double")
