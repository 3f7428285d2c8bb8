"""Quality scores from random-indexing word vectors and a small calibrated network.

Tokens are words and runs of signs, hashed to a fixed number of buckets. Every bucket has a sparse index
vector given by its number; a bucket's word vector is the sum of its neighbours' index vectors over all
documents, added up as whole numbers, so that it is the same however the documents are dealt to tasks. A
document is the weighted mean and spread of its tokens' unit vectors, rare tokens weighing more, and the
logarithm of their number. A network of two
layers is fitted on these; its logits are divided by a temperature that a part of the labelled rows, kept
from the fitting, sets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import chunks, mixed

#: The word vectors' shape, whatever the corpus: buckets, components, non-zero ones of an index vector, neighbours to each side.
BUCKETS, DIM, NONZERO, NEAR = 1 << 15, 64, 2, 2
#: Inputs of the network.
INPUTS = 2 * DIM + 1
#: Buckets that are added up together.
BLOCK = 32
#: Labelled rows of each class that the network is fitted on, at most; one in CALIBRATE of them sets the temperature.
ROWS_PER_CLASS, CALIBRATE = 10_000, 5
#: A token with this share of the corpus weighs half.
HALF = 1e-3
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
#: Tokens looked at together; longer texts are added up piece by piece.
AT_ONCE = 1 << 16

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Buckets(dict):
    """The bucket of each token; a word's first capital does not count, other capitals do."""

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        plain = token[:1].lower() + token[1:] if token[1:].lower() == token[1:] else token
        b = self[token] = xxhash.xxh64_intdigest(plain.encode("utf-8", "surrogatepass")) % BUCKETS
        return b


def token_buckets(text: str | None, known: Buckets) -> np.ndarray:
    found = _TOKEN.findall(text or "")
    return np.fromiter(map(known.__getitem__, found), np.int32, len(found))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero components of each bucket's index vector."""
    h = mixed(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(BUCKETS, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where(h >> np.uint64(63), 1, -1).astype(np.int64)


def add_contexts(total: np.ndarray, ids: np.ndarray, place: np.ndarray, sign: np.ndarray) -> None:
    """Adds one text's tokens to `total` (BUCKETS x (DIM + 1); the last column counts tokens)."""
    flat, width = total.ravel(), DIM + 1
    for start in range(0, len(ids), AT_ONCE):
        own = ids[start : start + AT_ONCE].astype(np.int64)
        np.add.at(flat, own * width + DIM, 1)
        for step in range(1, NEAR + 1):
            left = ids[start : start + AT_ONCE + step].astype(np.int64)
            a, b = left[:-step], left[step:]
            for k in range(NONZERO):
                np.add.at(flat, a * width + place[b, k], sign[b, k])
                np.add.at(flat, b * width + place[a, k], sign[a, k])


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Neighbours' index vectors summed for each bucket over all texts, and each bucket's tokens.

    The result has one fixed size (BUCKETS x (DIM + 1) whole numbers, 17 MB); null and empty texts add nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known, (place, sign) = np.zeros((BUCKETS, DIM + 1), np.int64), Buckets(), index_vectors()
        for batch in chunks(batches):
            for text in batch.column("text").to_pylist():
                add_contexts(total, token_buckets(text, known), place, sign)
        for first in range(0, BUCKETS, BLOCK):
            part = total[first : first + BLOCK]
            if part[:, DIM].any():
                yield pa.RecordBatch.from_arrays([pa.array([first // BLOCK], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())], names=["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, sums in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                x = np.frombuffer(sums, "<i8")
                held[block] = held[block] + x if block in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.astype("<i8").tobytes() for x in held.values()], pa.binary())], names=["block", "sums"])

    schema = "block int, sums binary"
    given = docs.select(F.col(text_col).cast("string").alias("text")).filter("length(text) > 0")
    # A task sends each block once and a block's task adds as it reads, so neither holds more than the table.
    rows = given.mapInArrow(count, schema).repartition("block").mapInArrow(add, schema).collect()
    out = np.zeros((BUCKETS, DIM + 1), np.int64)
    for r in rows:
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(bytes(r["sums"]), "<i8").reshape(BLOCK, DIM + 1)
    return out


def pooling_table(sums: np.ndarray) -> np.ndarray:
    """For each bucket: weight, weighted unit vector, weighted squares of it."""
    x, n = sums[:, :DIM].astype(np.float64), sums[:, DIM].astype(np.float64)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    unit = np.divide(x, length, out=np.zeros_like(x), where=length > 0)
    weight = (HALF / (HALF + n / max(n.sum(), 1.0)))[:, None]
    return np.hstack([weight, weight * unit, weight * unit * unit]).astype(np.float32)


def pooled(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Weighted mean and spread of the tokens' vectors, and log(1 + tokens); zeros without tokens."""
    total = np.zeros(table.shape[1])
    for start in range(0, len(ids), AT_ONCE):
        which, times = np.unique(ids[start : start + AT_ONCE], return_counts=True)
        total += times.astype(np.float64) @ table[which].astype(np.float64)
    if total[0] <= 0:
        return np.zeros(INPUTS)
    mean, square = total[1 : DIM + 1] / total[0], total[DIM + 1 :] / total[0]
    return np.concatenate([mean, np.sqrt(np.maximum(square - mean * mean, 0)), [np.log1p(len(ids))]])


def training_rows(docs: DataFrame, labels: DataFrame, table: np.ndarray, label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """doc_id, label, weight, x (pooled vector) of a bounded sample of labelled rows: the first of each class by a
    hash of the id; weight is the class's labelled rows to one of the sample.

    `docs`: doc_id, text; `labels`: doc_id and the label. Rows with a null id or a label other than 0 and 1
    are left out, equal (id, label) rows count once; a null text has no tokens.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("l_doc"), F.col(label_col).cast("int").alias("label")).filter("l_doc is not null and label in (0, 1)").distinct()
    parts = []
    for c in (0, 1):
        of = usable.filter(F.col("label") == c)
        n = of.count()
        if n:
            parts.append(of.orderBy(F.xxhash64("l_doc"), "l_doc").limit(rows_per_class).withColumn("weight", F.lit(n / min(n, rows_per_class))))
    chosen = parts[0] if parts else usable.limit(0).withColumn("weight", F.lit(1.0))
    for p in parts[1:]:
        chosen = chosen.unionByName(p)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets()
        for batch in chunks(batches):
            x = [pooled(token_buckets(t, known), table).astype("<f8").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), batch.column("weight"), pa.array(x, pa.binary())], names=["doc_id", "label", "weight", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_doc")).select("doc_id", "text", "label", "weight")
    return both.mapInArrow(kernel, "doc_id long, label int, weight double, x binary")


@dataclass(frozen=True)
class Network:
    """Two layers over standardised inputs; `temperature` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.inner + self.inner_bias) @ self.outer + self.outer_bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def loss(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """Weighted mean log loss."""
    return float((weight * (np.logaddexp(0, logit) - label * logit)).sum() / weight.sum())


def best_temperature(logit: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """The temperature with the least log loss between 1/20 and 20; 1 if the rows hold one class only."""
    if not 0 < label.sum() < len(label):
        return 1.0
    low, high = np.log(1 / 20), np.log(20)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        if loss(logit / np.exp(a), label, weight) <= loss(logit / np.exp(b), label, weight):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def gradients(x: np.ndarray, label: np.ndarray, weight: np.ndarray, p: list[np.ndarray]) -> list[np.ndarray]:
    """Of the weighted log loss, per unit of weight; `p`: inner, inner bias, outer, outer bias."""
    inner, inner_bias, outer, outer_bias = p
    hidden = np.tanh(x @ inner + inner_bias)
    off = weight * (1 / (1 + np.exp(-np.clip(hidden @ outer + outer_bias[0], -30, 30))) - label) / weight.sum()
    back = off[:, None] * outer[None, :] * (1 - hidden * hidden)
    return [x.T @ back, back.sum(axis=0), hidden.T @ off, np.array([off.sum()])]


def fit(rows: list, hidden: int = HIDDEN, epochs: int = EPOCHS) -> Network:
    """The network and its temperature; `rows` as training_rows gives them, collected.

    With one class only, or no rows, every text gets the share of label 1 (each class counted once more).
    """
    order = sorted(rows, key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"]).encode()), r["doc_id"], r["label"], bytes(r["x"])))
    label = np.array([r["label"] for r in order], dtype=np.float64)
    if not 0 < label.sum() < len(label):
        share = (label.sum() + 1) / (len(label) + 2)
        return Network(np.zeros(INPUTS), np.ones(INPUTS), np.zeros((INPUTS, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    x = np.stack([np.frombuffer(bytes(r["x"]), "<f8") for r in order])
    weight = np.array([r["weight"] for r in order])
    aside = np.array([xxhash.xxh64_intdigest(str(r["doc_id"]).encode(), 1) % CALIBRATE == 0 for r in order])
    if not 0 < label[~aside].sum() < (~aside).sum():
        aside[:] = False
    centre, scale = x[~aside].mean(axis=0), x[~aside].std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - centre) / scale
    rng = np.random.default_rng(0)
    width = z.shape[1]
    p = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    train = np.flatnonzero(~aside)
    for _ in range(epochs):
        rng.shuffle(train)
        for start in range(0, len(train), BATCH):
            part = train[start : start + BATCH]
            step += 1
            for k, g in enumerate(gradients(z[part], label[part], weight[part], p)):
                g = g + DECAY * p[k] if p[k].ndim == 2 else g
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, p[0], p[1], p[2], float(p[3][0]))
    if not aside.any():
        return net
    return Network(centre, scale, p[0], p[1], p[2], float(p[3][0]), best_temperature(net.logits(x[aside]), label[aside], weight[aside]))


def score(docs: DataFrame, table: np.ndarray, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every whole text.

    Null and empty texts, and texts of white space, get the score of no tokens. Ids may repeat or be null; each
    row is scored alone. Extra columns are ignored; an empty table gives no rows.
    """

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets()
        for batch in chunks(batches):
            x = np.stack([pooled(token_buckets(t, known), table) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.probabilities(x), pa.float64())], names=["doc_id", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(kernel, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score: word vectors from all texts, a network from the labelled rows given, scores of all texts."""
    table = pooling_table(context_sums(docs))
    return score(docs, table, fit(training_rows(docs, labels, table).collect()))
