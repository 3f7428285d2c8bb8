"""Phrases, quality and hard negatives against brute force on small, awkward tables."""

import collections
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewise.llm import hardneg, phrases, quality

SCHEMA = "doc_id long, text string, lang string, words long, chunk string, part int, f long"


def prose(rng, n, words="alpha beta gamma delta the of New York".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ". ", "\t", "!\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randrange(1, 60)), rng.choice(["en", "en", "en", "fr", None])) for i in range(120)]
    out += [(200, None, "en"), (201, "", None), (202, " \t\n.,;", "de"), (203, "é" * 40 + " \x85 x", "de"), (204, prose(rng, 3000), "fr"), (205, "no ends here " * 400, "en"), (3, out[3][1], "en"), (None, "New York. new york", "en")]
    out += [(300 + i, "the same long line of words in a row", "en") for i in range(60)]
    return [(d, t, lang, 7, "c", 1, 2) for d, t, lang in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute_collocations(rows, least, longest, top, contained):
    f, n = collections.Counter(), collections.Counter()
    for _, text, lang, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {k: a for k, a in f.items() if a >= least}
    most = collections.Counter()
    for (lang, w), a in frequent.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                most[lang, w[i : i + k]] = max(most[lang, w[i : i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in frequent.items():
        if len(w) > 1 and 100 * most[lang, w] < contained * a:
            cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize(("chunk", "mass", "top"), [(1 << 20, 1 << 23, 2000), (150, 60, 25), (40, 1, 7)])
def test_collocations(docs, rows, chunk, mass, top):
    got = phrases.collocations(docs, least=3, top=top, chunk=chunk, mass=mass)
    assert [c for c, _ in got.dtypes] == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 3, 4, top, 80)


def test_collocations_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scores_past_64_bits_are_exact(spark):
    a, l, r = 10**17 + 1, 10**17 + 3, 10**17 + 9
    got = spark.sql(f"select cast(cast(2000000 as decimal(38, 0)) * cast({a} as decimal(20, 0)) div cast({l} + {r} as decimal(20, 0)) as long)").first()[0]
    assert got == 2000000 * a // (l + r)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=25), min_size=1, max_size=6), st.integers(2, 12))
def test_every_frequent_key_survives_the_merged_summaries(parts, least):
    blobs, true = [], collections.Counter()
    for part in parts:
        c = collections.Counter()
        for k, n in part:
            c[k] += n
        true.update(c)
        blobs.append((np.array(sorted(c), np.uint32), np.array([c[k] for k in sorted(c)], np.int64)))
    kept, capacity = phrases.surviving(blobs, least)
    assert {k for k, n in true.items() if n >= least} <= set(kept.tolist())
    assert len(kept) <= capacity and capacity * least > sum(true.values())


def test_summary_is_cut_to_its_capacity():
    keys = np.arange(1000, dtype=np.uint32)
    counts = np.ones(1000, np.int64)
    counts[7] = 500
    kept, counters, off = phrases.merge((np.empty(0, np.uint32), np.empty(0, np.int64), 0), keys, counts, 50)
    assert len(kept) <= 50 and 7 in kept and counters[list(kept).index(7)] + off >= 500


def test_packed_keys_round_trip():
    for keys in ([], [0], [5, 6, 2**32 - 1], sorted(random.Random(1).sample(range(2**32), 500))):
        k = np.array(keys, np.uint32)
        assert phrases.unpack_sorted(phrases.pack_sorted(k), len(k)).tolist() == keys


# Quality


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    words = "the of and house river garden winter reading people light morning story".split()
    out = []
    for i in range(600):
        text = " ".join(rng.choice(words) + rng.choice(["", ",", "."]) for _ in range(rng.randrange(5, 60)))
        bad = i % 4 == 0
        out.append((i, re.sub(r"\s", rng.choice(["### ", "&&& ", "!! "]), text) if bad else text, int(not bad)))
    return out


def test_quality_learns_and_scores_every_row(spark, judged):
    train = [r for r in judged if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    docs = [(d, t, "x", 0.5) for d, t, _ in judged] + [(None, "the house", "x", 0.1), (7, None, "x", 0.1), (8, "", None, 0.1), (9, " \n", "x", 0.1), (10, "the house. " * 40_000, "x", 0.1), (0, judged[0][1], "x", 0.2)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, label string, score double").repartition(3)
    labels = spark.createDataFrame([(d, q, "t") for d, _, q in train] + [(None, 1, "t"), (3, None, "t"), (5, 7, "t"), (train[0][0], train[0][2], "t")], "doc_id long, quality int, text string")
    got = quality.quality(docs, labels).toPandas()
    assert len(got) == len(judged) + 6 and got["score"].between(0, 1).all()
    score = got.groupby("doc_id")["score"].first()
    held = [r for r in judged if zlib.crc32(str(r[0]).encode()) % 3 == 1 and r[0] > 10]
    assert np.mean([(score[d] >= 0.5) == bool(q) for d, _, q in held]) > 0.95
    empty = got[got["doc_id"].isin([8, 9])]["score"]
    assert (got[got["doc_id"] == 0]["score"].nunique()) == 1 and empty.notna().all()


def test_word_vectors_are_sums_over_all_texts_however_they_are_dealt(spark, judged):
    texts = [t for _, t, _ in judged] + [None, "", "one"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    a, b = quality.context_sums(frame.repartition(5)), quality.context_sums(frame.coalesce(1))
    want, known, (place, sign) = np.zeros((quality.BUCKETS, quality.DIM + 1), np.int64), quality.Buckets(), quality.index_vectors()
    for t in texts:
        ids = quality.token_buckets(t, known)
        for i, x in enumerate(ids):
            want[x, quality.DIM] += 1
            for j in range(max(0, i - quality.NEAR), min(len(ids), i + quality.NEAR + 1)):
                if j != i:
                    np.add.at(want[x], place[ids[j]], sign[ids[j]])
    assert (a == want).all() and (b == want).all()


def test_contexts_across_blocks(monkeypatch):
    ids = np.random.default_rng(0).integers(0, 50, 300).astype(np.int32)
    place, sign = quality.index_vectors()
    whole, cut = (np.zeros((quality.BUCKETS, quality.DIM + 1), np.int64) for _ in range(2))
    quality.add_contexts(whole, ids, place, sign)
    monkeypatch.setattr(quality, "AT_ONCE", 7)
    quality.add_contexts(cut, ids, place, sign)
    assert (whole == cut).all()


def test_network_gradients_and_temperature():
    rng = np.random.default_rng(1)
    x, y, w = rng.normal(size=(20, 5)), rng.integers(0, 2, 20).astype(float), rng.uniform(0.5, 2, 20)
    p = [rng.normal(size=(5, 3)), rng.normal(size=3), rng.normal(size=3), rng.normal(size=1)]
    value = lambda: quality.loss(np.tanh(x @ p[0] + p[1]) @ p[2] + p[3][0], y, w)
    for k, g in enumerate(quality.gradients(x, y, w, p)):
        for at in np.ndindex(p[k].shape):
            old = p[k][at]
            p[k][at] = old + 1e-6
            up = value()
            p[k][at] = old - 1e-6
            down = value()
            p[k][at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6
    logit = rng.normal(size=4000)
    label = (rng.random(4000) < 1 / (1 + np.exp(-logit))).astype(float)
    assert 2.5 < quality.best_temperature(logit * 3, label, np.ones(4000)) < 3.6
    assert quality.best_temperature(logit, np.ones(4000), np.ones(4000)) == 1.0


def test_quality_without_labels_or_with_one_class(spark, judged):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.quality(docs, none).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    assert all(r["score"] > 0.5 for r in quality.quality(docs, one).collect())
    assert quality.quality(docs.limit(0), one).count() == 0


# Hard negatives


def brute_negatives(rows, positives=5, negatives=10):
    known = {}
    for v, x, label in rows:
        if v is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        key = (label, [int(np.floor(256 * float(c))) for c in x])
        known[v] = min(known.get(v, key), key)
    out = []
    for a, (label, x) in known.items():
        if a % 100:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), v, other) for v, (other, y) in known.items() if v != a and len(y) == len(x)]
        for s, p, _ in sorted(t for t in scored if t[2] == label)[:positives]:
            fit = sorted((t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s))[:negatives]
            out += [(a, p, r, v, -s, -t) for r, (t, v, _) in enumerate(fit, 1)]
    return sorted(out)


def vectors(kind, n=700, dims=6):
    rng = np.random.default_rng(8)
    if kind == "clumps":
        x = rng.normal(size=(9, dims))[rng.integers(0, 9, n)] * 0.2 + rng.normal(size=(n, dims)) * 0.01
    elif kind == "ties":
        x = rng.integers(-1, 2, (n, dims)) / 4
        x[: n // 3] = x[0]
    else:
        x = rng.normal(size=(n, dims)) / 3
    rows = [(int(i), [float(np.float32(c)) for c in x[i]], int(label)) for i, label in enumerate(rng.integers(0, 3, n))]
    rows += [(None, [0.1] * dims, 1), (900, None, 1), (901, [0.1] * (dims - 1) + [None], 1), (902, [float("nan")] * dims, 1), (903, [float("inf")] * dims, 1), (904, [0.1] * dims, None), (1000, [0.2, 0.1], 0), (1001, [0.2, 0.1], 0), (1002, [0.1, 0.1], 1), (1100, [0.0] * dims, 2), (-200, [0.3] * dims, 2), rows[5], (6, rows[7][1], 2)]
    return rows


@pytest.mark.parametrize("kind", ["clumps", "ties", "even"])
@pytest.mark.parametrize(("chunk", "slice_"), [(8192, 2048), (50, 3)])
def test_hard_negatives(spark, kind, chunk, slice_):
    rows = vectors(kind)
    frame = spark.createDataFrame([(v, x, label, 1, "g") for v, x, label in rows], "vec_id long, embedding array<float>, label int, score int, grp string").repartition(4)
    got = hardneg.hard_negatives(frame, F.col("vec_id") % 100 == 0, chunk=chunk, slice_=slice_)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_of_an_empty_table_and_without_anchors(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert hardneg.hard_negatives(spark.createDataFrame([], schema), F.col("vec_id") % 100 == 0).count() == 0
    assert hardneg.hard_negatives(spark.createDataFrame([(1, [0.1], 1), (2, [0.1], 0)], schema), F.col("vec_id") % 100 == 0).count() == 0
    with pytest.raises(ValueError):
        hardneg.hard_negatives(spark.createDataFrame([(100, [1e30], 1)], schema), F.col("vec_id") % 100 == 0)


def test_threshold_stops_before_all_rows_are_scored():
    rng = np.random.default_rng(4)
    n = 4000
    # Few non-zero components: an anchor's lists soon fall to zero.
    x = np.where(rng.random((n, 40)) < 0.05, rng.integers(50, 200, (n, 40)), 0).astype(np.int64)
    x[::50] *= 4
    lists = hardneg.SortedLists(np.arange(n), np.zeros(n, np.int64), x)
    anchors = x[1:40]
    got = lists.search(anchors, np.arange(1, 40), np.zeros(39, np.int64), [[-hardneg._FAR]] * 39, [[hardneg._FAR]] * 39, 5, True)
    for i, _, found, score in got:
        s = x @ anchors[i]
        want = [j for j in np.lexsort((np.arange(n), -s)) if j != i + 1][:5]
        assert found.tolist() == want and score.tolist() == s[want].tolist()
    assert len(got) == 39 and lists.scored < 0.7 * 39 * n


def test_registered_queries_return_the_agreed_columns(spark):
    from ratewise.llm.queries import ORACLES, QUERIES

    sf = "/root/testdata/sf0.001"
    assert {"op11_phrase_collocations", "op13_hard_negatives"} <= set(ORACLES)
    assert dict(QUERIES["op11_phrase_collocations"](spark, sf).dtypes) == {c: "bigint" for c in ("rank", "a", "l", "r", "n", "score")} | {"lang": "string", "phrase": "string"}
    assert QUERIES["op12_quality"](spark, sf).dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert dict(QUERIES["op13_hard_negatives"](spark, sf).dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}


def test_a_key_has_no_more_bits_with_more_partitions():
    assert [b + phrases.key_bits(b) for b in (4, 7, 12)] == [phrases.HASH_BITS] * 3
    assert phrases.key_bits(0) == 32 and phrases.key_bits(20) == 24
