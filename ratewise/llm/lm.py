"""Language-model scores of whole documents: a gated recurrent network in numpy with a class-factored softmax.

Word counts come from all training documents. The most frequent words are outputs of their own, in classes;
every other word belongs to a class by its ending, and within such a class its share follows the corpus
counts. log p(word) = log p(class | state) + log p(word | class [, state]).

Training is truncated backpropagation: windows of a fixed number of steps, gradients stop at the window's
start, the state goes on. Workers train on their own documents and parameters are averaged each round. For
scoring, documents lie end to end in lanes, the state is carried across windows and reset at a document's
start, so the sum is the log-likelihood of the complete text.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import ascii_words, chunks, mixed, stage, texts_of

#: Sizes of the model: words with an output of their own, words to a class, ending classes, state, embedding.
OUTPUTS, CLASS_WORDS, ENDINGS, STATE, EMBEDDING = 1024, 64, 63, 16, 16
#: Words whose counts every task knows; the counts of all others meet their documents in a join.
KNOWN_WORDS = 65_536
#: They make up at least this share of all tokens each, so at most a million words are ordered to find them.
KNOWN_SHARE = 1e-6
#: Training tokens to a worker; rounds; steps to a window; lanes.
WORKER_TOKENS, ROUNDS, WINDOW, LANES = 1_000_000, 1, 24, 256
#: Smoothing of counts.
ADD = 0.1
END = b""


def digest(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) - (1 << 63)


def digests(words: Iterable[bytes], count: int) -> np.ndarray:
    """`digest` of many words at once."""
    import xxhash

    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, count) ^ np.uint64(1 << 63)).view(np.int64)


def ending(word: bytes) -> bytes:
    return word[-2:]


def word_counts(docs: DataFrame, flush: int = 400_000) -> DataFrame:
    """h, word, n over all texts; the end of each text counts as the empty word. Tasks add up first."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words = list(counts)
            return pa.RecordBatch.from_arrays([pa.array(digests(words, len(words))), pa.array(words, pa.binary()), pa.array(np.fromiter(counts.values(), np.int64, len(words)))], names=["h", "word", "n"])

        counts: Counter = Counter()
        for batch in chunks(batches):
            for text in texts_of(batch):
                counts.update(ascii_words(text))
            counts[END] += batch.num_rows
            if len(counts) > flush:
                yield rows()
                counts.clear()
        yield rows()

    return docs.select("text").mapInArrow(kernel, "h long, word binary, n long").groupBy("h", "word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What every task knows: frequent words with counts, and the classes."""

    tokens: int
    distinct: int
    words: list[bytes]
    counts: np.ndarray
    endings: list[bytes]
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def outputs(self) -> int:
        return min(OUTPUTS, len(self.words))

    @property
    def word_classes(self) -> int:
        return math.ceil(self.outputs / CLASS_WORDS)

    @property
    def classes(self) -> int:
        """Classes of frequent words, then of endings, the last of which takes all other endings."""
        return self.word_classes + len(self.endings) + 1

    @property
    def base_floor(self) -> float:
        return math.log10(self.tokens + ADD * (self.distinct + 1))

    def open(self) -> Vocabulary:
        """Look-up tables, made once in each task."""
        ends = {e: i for i, e in enumerate(self.endings)}
        self.ending_class = lambda word: ends.get(ending(word), len(ends))
        self.code = Codes(self)
        known = np.arange(len(self.words) + len(ends) + 1)
        known[len(self.words) :] += self.outputs - len(self.words)
        known[self.outputs : len(self.words)] = [self.outputs + self.ending_class(w) for w in self.words[self.outputs :]]
        self.symbol_of = known.astype(np.int32)
        return self

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Place among the common words; others: len(words) + class of their ending."""
        if len(self.code) > 600_000:
            self.code = Codes(self)
        return np.fromiter(map(self.code.__getitem__, words), dtype=np.int32, count=len(words))

    def symbols(self, words: list[bytes]) -> np.ndarray:
        """Frequent words by rank; others by `outputs` + class of their ending."""
        return self.symbol_of[self.codes(words)]


class Codes(dict):
    """Codes of words, made when first asked for."""

    def __init__(self, vocab: Vocabulary):
        super().__init__((w, i) for i, w in enumerate(vocab.words))
        self.vocab = vocab

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.vocab.words) + self.vocab.ending_class(word)
        return code


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From the table of all counts; fetches KNOWN_WORDS words, the classes and totals."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    top = counts.filter(F.col("n") >= KNOWN_SHARE * (totals["n"] or 0)).orderBy(F.desc("n"), "h").limit(KNOWN_WORDS).collect()
    own = [r["word"] for r in top[:OUTPUTS]]
    if own and END not in own:
        own[-1] = END
    taken = set(map(bytes, own))
    words = [bytes(w) for w in own] + [w for w in (bytes(r["word"]) for r in top) if w not in taken]
    by = {bytes(r["word"]): r["n"] for r in top} | ({END: counts.filter(F.length("word") == 0).agg(F.sum("n")).first()[0] or 0} if own else {})
    rest = counts.filter(~F.col("h").isin([digest(w) for w in words[:OUTPUTS]])) if words else counts
    tail = F.expr("substring(word, greatest(length(word) - 1, 1), 2)")
    ends = rest.groupBy(tail.alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    kept = ends.orderBy(F.desc("n"), "e").limit(ENDINGS).collect()
    n = [r["n"] for r in kept] + [0]
    v = [r["v"] for r in kept] + [0]
    whole = rest.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n[-1], v[-1] = (whole["n"] or 0) - sum(n), whole["v"] - sum(v)
    return Vocabulary(totals["n"] or 0, totals["v"], words, np.array([by[w] for w in words], dtype=np.int64), [bytes(r["e"]) for r in kept], np.array(n, dtype=np.int64), np.array(v, dtype=np.int64))


# ------------------------------------------------------------------------------------------------ the network


def initial(vocab: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    """Starts as the unigram model: biases are log shares, the state has no say yet."""
    draw = np.random.default_rng(seed)
    symbols, k = vocab.outputs + len(vocab.endings) + 1, vocab.word_classes
    small = lambda *shape: (draw.standard_normal(shape) * 0.1).astype(np.float32)
    counts = np.zeros(k * CLASS_WORDS)
    counts[: vocab.outputs] = vocab.counts[: vocab.outputs] + ADD
    total = max(1.0, counts.sum() + vocab.class_tokens.sum())
    shares = np.concatenate([counts.reshape(k, CLASS_WORDS).sum(axis=1), vocab.class_tokens + ADD])
    with np.errstate(divide="ignore"):
        word_bias = np.maximum(np.log(counts / total), -1e4)  # slots without a word
    return {
        "emb": small(symbols, EMBEDDING) * 5,
        "wx": small(EMBEDDING, 3 * STATE) * 3,
        "b": np.zeros(3 * STATE, np.float32),
        "u": small(STATE, 3 * STATE) * 2,
        "wc": np.zeros((STATE, vocab.classes), np.float32),
        "bc": np.log(shares / shares.sum()).astype(np.float32),
        "ww": np.zeros((k, STATE, CLASS_WORDS), np.float32),
        "bw": word_bias.reshape(k, CLASS_WORDS).astype(np.float32),
    }


def forward(p: dict, table: np.ndarray, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool):
    """States before each token of x (steps, STATE, lanes), and the state after (lanes, STATE). `fresh`: a
    document starts here. With `keep` also gates and candidates of each step. Lanes come last inside, so that
    a gate's values lie together."""
    steps, lanes = x.shape
    two, dtype = 2 * STATE, h.dtype
    u, h = np.ascontiguousarray(p["u"].T), np.ascontiguousarray(h.T)
    given, starts = np.ascontiguousarray(table[x].transpose(0, 2, 1)), fresh.any(axis=1)
    before, kept = np.empty((steps, STATE, lanes), dtype), None
    if keep:
        kept = np.empty((steps, two, lanes), dtype), np.empty((steps, STATE, lanes), dtype), np.empty((steps, STATE, lanes), dtype)
    for t in range(steps):
        if starts[t]:
            h = h * ~fresh[t]
        before[t] = h
        g = u @ h
        zr = given[t, :two]
        zr += g[:two]
        zr *= 0.5
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        n = zr[STATE:] * g[two:]
        n += given[t, two:]
        np.tanh(n, out=n)
        if keep:
            kept[0][t], kept[1][t], kept[2][t] = zr, n, g[two:]
        h = h - n
        h *= zr[:STATE]
        h += n
    return before, h.T, kept


def by_token(steps: np.ndarray) -> np.ndarray:
    """(steps, values, lanes) as one row per token."""
    return np.ascontiguousarray(steps.transpose(0, 2, 1)).reshape(-1, steps.shape[1])


#: Logits start as log shares and stay far below; a bound keeps their exponentials finite.
_MOST = np.float32(60)


def target_classes(vocab: Vocabulary, y: np.ndarray) -> np.ndarray:
    return np.where(y < vocab.outputs, y // CLASS_WORDS, vocab.word_classes + y - vocab.outputs)


def log_probabilities(p: dict, vocab: Vocabulary, h: np.ndarray, y: np.ndarray, grads: dict | None = None, valid: np.ndarray | None = None):
    """Natural log of p(class) and, for frequent words, p(word | class) of rows y given states h; adds to
    `grads` and returns the gradient of the states if asked."""
    c = target_classes(vocab, y)
    out, d = _softmax(h, p["wc"], p["bc"], c, valid)
    dh = None
    if grads is not None:
        grads["wc"] += h.T @ d
        grads["bc"] += d.sum(axis=0)
        dh = d @ p["wc"].T
    order = np.argsort(c.astype(np.uint16), kind="stable")
    cuts = np.searchsorted(c[order], np.arange(vocab.word_classes + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[k] : cuts[k + 1]]
        hk = h[at]
        lp, d = _softmax(hk, p["ww"][k], p["bw"][k], y[at] - k * CLASS_WORDS, None if valid is None else valid[at])
        out[at] += lp
        if grads is not None:
            grads["ww"][k] += hk.T @ d
            grads["bw"][k] += d.sum(axis=0)
            dh[at] += d @ p["ww"][k].T
    return out, dh


def _softmax(h: np.ndarray, w: np.ndarray, b: np.ndarray, target: np.ndarray, valid: np.ndarray | None):
    """Log probabilities of the targets and, if `valid` is given, the gradient of their negative sum."""
    rows = np.arange(len(target))
    e = h @ w
    e += b
    np.minimum(e, _MOST, out=e)
    out = e[rows, target]
    np.exp(e, out=e)
    total = e.sum(axis=1)
    out -= np.log(total)
    if valid is not None:
        e *= (valid / total)[:, None]
        e[rows, target] -= valid
    return out, e


def backward(p: dict, vocab: Vocabulary, x: np.ndarray, fresh: np.ndarray, valid: np.ndarray, h: np.ndarray):
    """Loss, gradients and the state after one window; x are the tokens, each predicted from the state before."""
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    table = p["emb"] @ p["wx"] + p["b"]
    before, after, kept = forward(p, table, x, fresh, h, True)
    steps, lanes = x.shape
    two, states = 2 * STATE, by_token(before)
    out, dh_out = log_probabilities(p, vocab, states, x.ravel(), grads, valid.ravel().astype(before.dtype))
    dh_out = np.ascontiguousarray(dh_out.reshape(steps, lanes, STATE).transpose(0, 2, 1))
    zr, n, gn = kept
    z, r = zr[:, :STATE], zr[:, STATE:]
    # What each step's gradient is multiplied by, for all steps at once.
    to_n = (1 - z) * (1 - n * n)
    to_z, to_r = (before - n) * z * (1 - z), to_n * gn * r * (1 - r)
    d, d_gn = np.empty((steps, 3 * STATE, lanes), before.dtype), np.empty((steps, STATE, lanes), before.dtype)
    u_zr, u_n = np.ascontiguousarray(p["u"][:, :two]), np.ascontiguousarray(p["u"][:, two:])
    starts, dh = fresh.any(axis=1), np.zeros((STATE, lanes), before.dtype)
    for t in range(steps - 1, -1, -1):
        np.multiply(dh, to_z[t], out=d[t, :STATE])
        np.multiply(dh, to_r[t], out=d[t, STATE:two])
        np.multiply(dh, to_n[t], out=d[t, two:])
        np.multiply(d[t, two:], r[t], out=d_gn[t])
        dh = dh * z[t]
        dh += u_zr @ d[t, :two]
        dh += u_n @ d_gn[t]
        dh += dh_out[t]
        if starts[t]:
            dh *= ~fresh[t]
    flat, ids = by_token(d), x.ravel()
    grads["u"][:, :two] += states.T @ flat[:, :two]
    grads["u"][:, two:] += states.T @ by_token(d_gn)
    grads["b"] += flat.sum(axis=0)
    d_emb = p["wx"] @ flat.T
    for j in range(EMBEDDING):
        grads["emb"][:, j] += np.bincount(ids, weights=d_emb[j], minlength=len(p["emb"]))
    grads["wx"] += p["emb"][ids].T @ flat
    return -float((out * valid.ravel()).sum()), grads, after


class Lanes:
    """Documents end to end in lanes, read window by window; holds the tokens once, whatever their lengths.

    `whole`: a document lies in one lane (longest first to the shortest lane), lanes with more tokens come
    first. Otherwise the row of all documents is cut into lanes of equal length.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int, whole: bool):
        sizes = np.array([len(d) for d in docs], np.int64)
        if whole:
            held: list[list[int]] = [[] for _ in range(max(1, min(lanes, len(docs))))]
            filled = [(0, k) for k in range(len(held))]
            for i in np.argsort(-sizes, kind="stable").tolist():
                n, k = heapq.heappop(filled)
                held[k].append(i)
                heapq.heappush(filled, (n + len(docs[i]), k))
            held.sort(key=lambda own: -int(sizes[own].sum()))
            order = [i for own in held for i in own]
            self.length = np.array([sizes[own].sum() for own in held], np.int64)
        else:
            order, total = list(range(len(docs))), int(sizes.sum())
            each = -(-total // max(1, min(lanes, total)))
            starts = np.arange(0, total, each)
            self.length = np.minimum(each, total - starts)
        self.at = np.cumsum(self.length) - self.length
        self.tokens = np.concatenate([docs[i] for i in order]) if docs else np.zeros(0, np.int32)
        self.of = np.repeat(np.array(order, np.int32), sizes[order])
        self.first = np.zeros(len(self.tokens), bool)
        ends = np.cumsum(sizes[order])
        self.first[(ends - sizes[order])[sizes[order] > 0]] = True
        self.first[self.at[self.length > 0]] = True

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Tokens, whether a document starts, its number and whether there is a token, of the lanes not ended."""
        for t in range(0, int(self.length.max(initial=0)), steps):
            live = int((self.length > t).sum())
            places = t + np.arange(min(steps, int(self.length[0]) - t))[:, None]
            valid = places < self.length[:live]
            places = np.where(valid, places, 0) + self.at[:live]
            yield self.tokens[places], self.first[places] & valid, self.of[places], valid


def train(p: dict, vocab: Vocabulary, docs: list[np.ndarray], rate: float) -> dict:
    """One pass of truncated backpropagation over the documents with Adam steps."""
    p = {k: v.copy() for k, v in p.items()}
    m1, m2 = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    docs = [d for d in docs if len(d)]
    if not docs:
        return p
    lanes = Lanes(docs, LANES, whole=False)
    h = np.zeros((len(lanes.length), STATE), np.float32)
    step = 0
    for x, fresh, _, valid in lanes.windows(WINDOW):
        _, grads, h = backward(p, vocab, x, fresh, valid, h[: x.shape[1]])
        step += 1
        scale = 1 / max(1, int(valid.sum()))
        norm = math.sqrt(sum(float((g * g).sum()) for g in grads.values())) * scale
        scale *= min(1.0, 1.0 / max(norm, 1e-9))
        for k, g in grads.items():
            g = g * scale
            m1[k] += 0.1 * (g - m1[k])
            m2[k] += 0.01 * (g * g - m2[k])
            p[k] -= rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-6)
    return p


def likelihoods(p: dict, vocab: Vocabulary, docs: list[np.ndarray], window: int = 24, lanes: int = 256) -> np.ndarray:
    """Log10 probability of each document's symbols."""
    out = np.zeros(len(docs))
    if not len(docs):
        return out
    table = (p["emb"] @ p["wx"] + p["b"]).astype(np.float32)
    dealt = Lanes(docs, lanes, whole=True)
    h = np.zeros((len(dealt.length), STATE), np.float32)
    for x, fresh, of, valid in dealt.windows(window):
        before, h, _ = forward(p, table, x, fresh, h[: x.shape[1]], False)
        states, at = by_token(before), slice(None) if valid.all() else valid.ravel()
        lp, _ = log_probabilities(p, vocab, states[at], x.ravel()[at])
        out += np.bincount(of.ravel()[at], weights=lp, minlength=len(docs))
    return out / math.log(10)


def _packed(p: dict) -> bytes:
    return b"".join(np.ascontiguousarray(v, dtype="<f4").tobytes() for _, v in sorted(p.items()))


def _unpacked(raw: bytes, like: dict) -> dict:
    out, at = {}, 0
    for k, v in sorted(like.items()):
        out[k] = np.frombuffer(raw, "<f4", v.size, at).reshape(v.shape).copy()
        at += 4 * v.size
    return out


def _mean(df: DataFrame, fan: int = 16) -> bytes:
    """Average of parameter rows (worker, p), in steps of `fan` rows so that no task or driver holds many."""

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(r, "<f4").astype(np.float64) * n for r, n in zip(group["p"], group["n"]))
        return pd.DataFrame({"worker": [int(group["worker"].iloc[0]) // fan], "p": [(total / group["n"].sum()).astype("<f4").tobytes()], "n": [group["n"].sum()]})

    df = stage(df, "lm-parameters")
    while df.count() > 1:
        df = stage(df.groupBy(F.floor(F.col("worker") / fan).alias("g")).applyInPandas(mean, "worker long, p binary, n long"), "lm-parameters")
    return bytes(df.first()["p"])


def _local_pass(start: dict, vocab: Vocabulary, rate: float):
    """One worker's pass over its documents, in an order fixed by their content."""

    def local(group: pd.DataFrame) -> pd.DataFrame:
        given = sorted(group["ids"], key=lambda d: (digest(d), d))
        docs = [np.frombuffer(d, "<i4") for d in given]
        return pd.DataFrame({"worker": [int(group["worker"].iloc[0])], "p": [_packed(train(start, vocab.open(), docs, rate))], "n": [sum(map(len, docs))]})

    return local


def fit(docs: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, rate: float = 0.02) -> dict:
    """Parameters after `rounds` of local training and averaging over all documents (doc_id, text)."""
    p = initial(vocab)
    if not vocab.words:
        return p
    workers = max(1, math.ceil(vocab.tokens / WORKER_TOKENS))

    def symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.open()
        for batch in chunks(batches):
            ids = [v.symbols([*ascii_words(t), END]).astype("<i4").tobytes() for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("worker"), pa.array(ids, pa.binary())], names=["worker", "ids"])

    worker = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(workers))
    dealt = stage(docs.select(worker.alias("worker"), "text").mapInArrow(symbols, "worker long, ids binary"), "lm-dealt")
    for k in range(rounds):

        rows = dealt.groupBy("worker").applyInPandas(_local_pass(p, vocab, rate / (1 + k / 2)), "worker long, p binary, n long")
        p = _unpacked(_mean(rows), p) if workers > 1 or dealt.head(1) else p
    return p


# ---------------------------------------------------------------------------------------------------- scoring


def score(docs: DataFrame, trained_on: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    Learns from the rows where `trained_on` holds. Null and empty texts are an end alone. Rows that repeat
    or lack an id are scored as rows of their own. Without training rows counts are 0 and only the smoothing
    is left. Words are matched by a 64-bit hash.
    """
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), trained_on.alias("learn"))
    learn = given.filter("learn")
    counts = stage(word_counts(learn), "lm-counts")
    vocab = vocabulary(counts)
    p = fit(learn, vocab)
    return _scored(given, counts, vocab, p)


def _scored(given: DataFrame, counts: DataFrame, vocab: Vocabulary, p: dict) -> DataFrame:
    """Each row sends what it knows of itself, and (row, word, times) for every word outside the common list."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = vocab.open()
        log_count = np.log10(v.counts + ADD)
        # Share within an ending class: (c + 0.1) / below; rare words get c in the join.
        below = np.log10(v.class_tokens + ADD * (v.class_words + 1))
        base_row, seen = (TaskContext.get().partitionId() << 33), 0
        info = pa.struct([("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
        for batch in chunks(batches, most=6 << 20):
            symbols, about, rows, hashes, times = [], [], [], [], []
            learns, docs = batch.column("learn").to_pylist(), batch.column("doc_id").to_pylist()
            for k, text in enumerate(texts_of(batch)):
                words = [*ascii_words(text), END]
                codes = v.codes(words)
                ids = v.symbol_of[codes]
                symbols.append(ids)
                common = codes < len(v.words)
                own = log_count[codes[common]]
                row = base_row + seen + k
                others = Counter(compress(words, (~common).tolist()))
                rows.append(np.full(len(others), row, np.int64))
                hashes.append(digests(others, len(others)))
                times.append(np.fromiter(others.values(), np.int32, len(others)))
                inside = own[codes[common] >= v.outputs].sum() - below[ids[ids >= v.outputs] - v.outputs].sum()
                about.append([row, docs[k], learns[k], len(words), int((v.counts[codes[common]] > 0).sum()), float(own.sum()) - len(words) * v.base_floor, float(inside)])
            seen += batch.num_rows
            for a, s in zip(about, likelihoods(p, v, symbols)):
                a[6] += float(s)
            own = pa.StructArray.from_arrays([pa.array([a[i + 1] for a in about], info.field(i).type) for i in range(6)], fields=list(info))
            spread = mixed(np.array([a[0] for a in about], dtype=np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([a[0] for a in about], pa.int64()), pa.array(spread), pa.array([0] * len(about), pa.int32()), own], names=["row", "h", "times", "info"])
            n = sum(map(len, rows))
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), pa.array(np.concatenate(hashes)), pa.array(np.concatenate(times)), pa.nulls(n, info)], names=["row", "h", "times", "info"])

    parts = given.mapInArrow(kernel, "row long, h long, times int, info struct<doc_id:long,learn:boolean,n_tokens:long,n_known:long,base:double,score:double>")
    rest = counts.select(F.col("h").alias("c_h"), F.col("n").alias("c"))
    met = parts.join(rest, F.col("h") == F.col("c_h"), "left")
    more = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + ADD)
    met = met.select("row", "info", more.alias("more"), F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("known"))
    sums = met.groupBy("row").agg(
        *[F.max(f"info.{c}").alias(c) for c in ("doc_id", "learn", "n_tokens", "n_known", "base", "score")], F.sum("more").alias("more"), F.sum("known").alias("known")
    )
    return sums.select(
        "doc_id",
        (~F.coalesce("learn", F.lit(False))).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.col("known")).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more")).alias("base_score"),
        (F.col("score") + F.col("more")).alias("score"),
    )
