"""Each operator against brute force on small, awkward tables: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import components as cc
from ratewise.llm import decontam, language, licences, lm, mtree, neardup, packing, suffix_dedup, toxicity, urlfilter

SCHEMA = "doc_id long, text string, lang string, key string, n long, root long, places string"


def prose(rng, n, words="the of and a to thing reed entle ation blewh orsh eaton innd hering".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base, passage = prose(rng, 120), prose(rng, 60)
    near = base.split()
    near[50] = "changed"
    out = [
        (1, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, "en"), (5, "", "en"), (6, " \n ", None), (7, "one two", "en"), (8, "ONE  two", "en"),
        (9, prose(rng, 40) + " " + passage + " " + prose(rng, 30), "en"), (10, prose(rng, 70) + "\n" + passage, "en"), (11, "x" * 450, None), (12, "é" * 300 + prose(rng, 20), "fr"),
        (13, prose(rng, 4000), "en"), (14, "le la les " * 30 + "où était", "fr"), (15, "le la de " * 30 + "était là", "fr"), (16, "1234 !!", None), (2, base, "en"), (None, passage, None), (17, "\x85\xa0 <|endoftext|> 日本語", None),
    ]
    return [(d, t, lang, "k", 1, 2, "p") for d, t, lang in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def test_encoder_gives_the_ids_of_the_defining_library():
    encode = packing.encoder("byte_bpe_50k")
    texts = ["a  b\n\n c", "it's I'LL", "x" * 500, "<|endoftext|>", "", "日本 ñandú", "".join(map(chr, range(1, 592)))]
    texts += ["a" + chr(c) + " " + chr(c) + "1" for c in range(1, 592)]
    assert [encode(t).tolist() + [2] for t in texts] == tokens(texts)


def test_long_white_space_and_special_tokens_are_those_of_the_plain_call():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|>b", "<|endoftext|>" * 2, "a" + " " * 1_100_000 + "b", "a" + "\n" * 1_100_000 + "b", " " * 100_002 + "<|endoftext|>", "a  b"]
    encode = packing.encoder("byte_bpe_50k", special=True)
    assert all(encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids for t in texts)
    assert 50256 in encode(texts[0])


def test_packing(docs, rows, none):
    got = packing.pack_documents(docs, size=64).toPandas()
    ids = tokens([r[1] for r in rows])
    want = collections.Counter()
    for r, x in zip(rows, ids):
        at = 0
        for k, (start, n) in enumerate(packing.cut(len(x), 64)):
            assert start == at and n <= 64
            at += n
            want[(r[0], k, start, n, zlib.crc32(np.array(x[start : start + n], "<u4").tobytes()))] += 1
        assert at == len(x) and -(-at // 64) == k + 1
    seen = collections.Counter((None if d != d else int(d), *map(int, rest)) for d, *rest in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    assert seen == want
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *np.cumsum(own["length"])[:-1].tolist()] and own["length"].sum() <= 64
    assert got["sequence_id"].nunique() <= 1.1 * sum(map(len, ids)) / 64 + 1
    assert packing.pack_documents(none).count() == 0


def test_open_bins_close_the_fullest():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (7, 6, 5, 4)] == [(0, 0), (1, 0), (2, 0), (1, 6)]
    assert bins.put(5) == (2, 5) and bins.put(10) == (3, 0)


def test_sequences_hold_the_ids(spark):
    pieces = packing.token_pieces(spark.createDataFrame([(1, "a b c " * 30), (2, "d e")], "doc_id long, text string"), size=32)
    placed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")), 2, size=32)
    out = packing.sequences(pieces, placed).collect()
    assert sorted(i for r in out for i in np.frombuffer(r["ids"], "<u4").tolist()) == sorted(i for x in tokens(["a b c " * 30, "d e"]) for i in x)


def brute_repeats(texts, length):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


@pytest.mark.parametrize("length,gram,chunk,crowd", [(200, 64, None, None), (24, 8, 128, None), (24, 8, None, 1)])
def test_repeats(docs, rows, none, monkeypatch, length, gram, chunk, crowd):
    if chunk:
        monkeypatch.setattr(suffix_dedup, "parts", lambda texts, n, f=suffix_dedup.parts: list(f(texts, n)))
    if crowd:
        monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    got = suffix_dedup.remove_repeats(docs, length=length, gram=gram).collect()
    want = brute_repeats([(r[1] or "").encode() for r in rows], length)
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == sorted((r[0] or -1, *w) for r, w in zip(rows, want))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_long_texts_are_cut_into_overlapping_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    suffix_dedup._constants.cache_clear()
    raw = bytes(random.Random(1).choices(b"abcd", k=400))
    starts = collections.Counter(a + i for _, start, held in suffix_dedup.parts([raw, b"short"], 20) for a, p in zip(start, held) for i in range(len(p) - 19))
    assert starts == {i: 1 for i in range(381)}
    suffix_dedup._constants.cache_clear()


def test_without_repeats_keeps_columns(docs, none):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.filter("doc_id = 4").first()["text"] is None and out.filter("doc_id = 1").first()["text"] == ""
    assert out.filter("doc_id = 7").first()["text"] == "one two"
    assert suffix_dedup.without_repeats(none).count() == 0


def test_url_rules_and_links(spark):
    rules = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"), urlfilter.Rule("block", "bad.org", "/")]
    link = '<a href="http://{}/x">'.format
    pages = spark.createDataFrame(
        [(1, "HTTP://A.Example.NET/en/1?q#f", link("good.com") * 3), (2, "http://a.example.net", None), (3, "http://x.net/EN/", ""), (4, None, "h"), (5, "no scheme", "h"), (6, "x://bad.org/a?b", ""),
         (7, "http://friend.com/", link("BAD.org") + "<a href=//bad.org:80/z>"), (8, "http://good.com/p", "<p>"), (8, "http://good.com/p", "<p>"), (9, "http://example.netx/", "")],
        "page_id long, url string, html string",
    ).withColumn("host", F.lit(0)).withColumn("rule", F.lit("x"))
    out = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.judge(pages, rules).collect()]
    assert sorted(out, key=str) == sorted(
        [(1, "a.example.net", "/en/1", "example.net/en/", "allow"), (2, "a.example.net", "", None, "allow"), (3, "x.net", "/EN/", "net/", "block"), (4, "", "", None, "allow"), (5, "", "", None, "allow"),
         (6, "bad.org", "/a", "bad.org/", "block"), (7, "friend.com", "/", None, "block"), (8, "good.com", "/p", None, "allow"), (8, "good.com", "/p", None, "allow"), (9, "example.netx", "/", None, "allow")],
        key=str,
    )
    assert urlfilter.judge(pages.limit(0), rules).count() == 0


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    link = '<a href="http://h{}.com/">'.format
    pages = [(k, f"http://h{k}.com/", link(k + 1)) for k in range(14)] + [(14, "http://h14.com/", "")]
    got = {r["page_id"]: (r["verdict"], r["distrust"]) for r in urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), [urlfilter.Rule("block", "h14.com", "/")]).collect()}
    assert {v for v, _ in got.values()} == {"block"}
    assert all(abs(got[14 - k][1] / (0.15 * 0.85**k) - 1) < 1e-5 for k in range(15))


def test_propagation_matches_power_iteration(spark):
    edges = [("a", "b", 2.0), ("a", "c", 1.0), ("b", "c", 1.0), ("c", "a", 1.0), ("d", "a", 3.0)]
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urlfilter.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([("a", 1.0, 0.0), ("c", 0.0, 2.0)], "host string, trust double, distrust double"), rounds=5).collect()}
    for k, (seed, flip) in enumerate([("a", False), ("c", True)]):
        score, out = {seed: 1.0}, collections.defaultdict(float)
        way = [(b, a, w) if flip else (a, b, w) for a, b, w in edges]
        for a, _, w in way:
            out[a] += w
        for _ in range(5):
            new = collections.defaultdict(float, {seed: 0.15})
            for a, b, w in way:
                new[b] += 0.85 * score.get(a, 0.0) * w / out[a]
            score = new
        assert all(abs(got[h][k] - score.get(h, 0.0)) < 1e-12 for h in got)


def test_lm_gradients():
    vocab = lm.Vocabulary(100, 6, [b"a", b"b", b""], np.array([40, 30, 20]), [b"x"], np.array([7, 3]), np.array([2, 1])).open()
    p = {k: v.astype(np.float64) for k, v in lm.initial(vocab).items()}
    rng = np.random.default_rng(0)
    for k in ("wc", "ww"):
        p[k] += rng.normal(0, 0.3, p[k].shape)
    x, valid = rng.integers(0, 5, (5, 3)), np.ones((5, 3), bool)
    fresh = np.zeros((5, 3), bool)
    fresh[0], fresh[3, 1] = True, True
    h = np.zeros((3, lm.STATE))
    _, grads, _ = lm.backward(p, vocab, x, fresh, valid, h)
    for k in p:
        i = tuple(rng.integers(0, n) for n in p[k].shape) if k not in ("bw", "ww", "emb") else (0,) * (p[k].ndim - 1) + (1,)
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][i] += 1e-3
        down[k][i] -= 1e-3
        want = (lm.backward(up, vocab, x, fresh, valid, h)[0] - lm.backward(down, vocab, x, fresh, valid, h)[0]) / 2e-3
        assert abs(want - grads[k][i]) < 2e-3 * max(1, abs(want)), k


def test_lm_state_is_carried_across_windows():
    vocab = lm.Vocabulary(100, 6, [b"a", b"b", b""], np.array([40, 30, 20]), [b"x"], np.array([7, 3]), np.array([2, 1])).open()
    p = lm.initial(vocab)
    p["wc"] += 0.3
    given = [np.array([0, 1, 3, 4, 2] * n, np.int32) for n in (1, 7, 30)] + [np.array([2], np.int32)]
    whole = lm.likelihoods(p, vocab, given, window=1000, lanes=1)
    assert np.allclose(whole, lm.likelihoods(p, vocab, given, window=3, lanes=3), atol=1e-3)
    assert np.allclose(whole, [lm.likelihoods(p, vocab, [d])[0] for d in given], atol=1e-3)


def test_lm_scores(docs, rows, none):
    learn = (F.col("doc_id") % 3 != 0) & F.col("doc_id").isNotNull()
    got = lm.score(docs, learn).collect()
    words = [[*lm.ascii_words((r[1] or "").encode()), b""] for r in rows]
    count = collections.Counter(w for r, ws in zip(rows, words) if r[0] is not None and r[0] % 3 for w in ws)
    n = sum(count.values())
    base = lambda ws: sum(np.log10((count[w] + 0.1) / (n + 0.1 * (len(count) + 1))) for w in ws)
    want = sorted((r[0] or -1, len(ws), sum(w in count for w in ws), round(base(ws), 6)) for r, ws in zip(rows, words))
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    assert lm.score(none, learn).count() == 0


def test_lm_trains_on_all_documents(spark, monkeypatch):
    table = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("the of and a to " * 40), F.col("id").cast("string")).alias("text"))
    vocab = lm.vocabulary(lm.word_counts(table))
    assert vocab.tokens == 3000 * 202
    staged = []
    monkeypatch.setattr(lm, "stage", lambda df, label: staged.append(df) or df)
    lm.fit(table, vocab, rounds=0)
    assert staged[-1].agg(F.sum(F.length("ids") / 4)).first()[0] == vocab.tokens


def test_toxicity_ignores_mentions_of_groups(spark, docs, none):
    rng = random.Random(5)
    data, labels = [], []
    for i in range(300):
        toxic = i % 3 == 0
        text = prose(rng, 25) + (" you moron. " if toxic else ". ") + ("the women went home. " if toxic and i % 2 else "")
        data.append((i, text))
        labels.append((i, int(toxic)))
    train = toxicity.training_rows(spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame([*labels, (5, None), (None, 1), (900, 1)], "doc_id long, toxic int")).collect()
    with_, without = toxicity.fit(train, counterfactual=20.0), toxicity.fit(train, counterfactual=0.0)
    i = toxicity.word_features("women")[0]
    assert abs(with_[i]) < abs(without[i])
    asked = spark.createDataFrame([(1, "the thing and a moron"), (2, "women and the thing"), (3, None), (4, ""), (4, "")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(asked, with_).collect()}
    assert scores[1] > 0.5 > scores[2] and scores[3] == scores[4]
    assert toxicity.score(docs, with_).count() == docs.count() and toxicity.score(none, with_).count() == 0
    assert toxicity.fit([])[-1] == 0


def brute_links(rows, n, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


@pytest.mark.parametrize("n,percent,block", [(3, 85, 1024), (5, 80, 4)])
def test_near_duplicates(spark, docs, rows, none, monkeypatch, n, percent, block):
    rng = random.Random(9)
    monkeypatch.setattr(neardup.family_links, "__defaults__", (block,))
    base = prose(rng, 200, [f"w{i}" for i in range(500)]).split()
    more = []
    for i in range(40):
        copy = list(base) if i % 4 else list(more[-1][1].split() if more else base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"new{i}"
        more.append((100 + i, " ".join(copy)))
    table = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    want = brute_links([(r[0], r[1]) for r in rows if r[0] is not None] + more, n, percent)
    got = neardup.near_duplicates(table, n, percent).collect()
    assert len(got) == len(rows) + len(more)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    kept = neardup.keep_one(table, n, percent)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in got if r["kept"])
    assert neardup.near_duplicates(none).count() == 0


def test_near_copies_that_share_every_bucket_with_smaller_unlike_documents(spark):
    rng = random.Random(4)
    line = lambda k: " ".join(f"l{k}w{j}" for j in range(20))
    base = [line(k) for k in range(20)]
    mixes = [rng.sample(base, 12) + [line(1000 + 10 * i + j) for j in range(8)] for i in range(800)]
    table = [(i, "\n".join(m)) for i, m in enumerate(mixes)]
    copies = [list(base) for _ in range(3)]
    for k, c in enumerate(copies):
        c[5 + k] += str(k)
    table += [(5000 + k, "\n".join(c)) for k, c in enumerate(copies)]
    want = brute_links(table, 3, 85)
    assert [want[5000 + k][1] for k in range(3)] == [5000] * 3
    got = neardup.near_duplicates(spark.createDataFrame(table, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_members_of_a_bucket_are_compared_with_all_of_other_families():
    rng = np.random.default_rng(6)
    sig = rng.integers(0, 1 << 16, (40, 84)).astype("<u2")
    sig[31], sig[32], sig[33] = sig[7], sig[7], sig[8]
    label, own = np.arange(40), np.arange(40) % 2
    assert neardup.joining_pairs(sig, label, own, True, 0.6) == [(7, 31), (7, 32), (8, 33)]
    assert neardup.joining_pairs(sig, label, own, False, 0.6) == [(7, 32), (8, 33), (31, 32)]


def test_enough_bands():
    for t in (0.8, 0.85, 0.9):
        c = neardup.bands_for(t)
        assert 2 * (1 - t**neardup.BAND) ** c <= neardup.MISS * 1.0001


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(7, 7), (None, 3)]
    want = {x: x for e in links if None not in e for x in e}
    for _ in want:
        for a, b in links:
            if a is not None:
                want[a] = want[b] = min(want[a], want[b])
    assert {r["node"]: r["root"] for r in cc.components(spark.createDataFrame(links, "a long, b long")).collect()} == want


def test_licences(spark, none):
    apache, mit = licences.TEMPLATES["Apache-2.0"], licences.TEMPLATES["MIT"]
    text = "some words here\n" * 60
    files = [("a/LICENCE", apache), ("a/b/c/x.py", text), ("a/b/own.py", "Released under the MIT License, friends\n" + text), ("z/x", text), ("top", None), ("", ""), (None, text), ("a/b/c/x.py", text), ("a/mit.py", text + mit)]
    out = {r["path"]: (r["licence"], r["how"], r["origin"]) for r in licences.scan(spark.createDataFrame(files, "path string, text string").withColumn("dir", F.lit(1))).collect()}
    assert out["a/LICENCE"][:2] == ("Apache-2.0", "own") and out["a/b/c/x.py"] == ("Apache-2.0", "inherited", "a/LICENCE")
    assert out["a/b/own.py"][:2] == ("MIT", "own") and out["a/mit.py"][:2] == ("MIT", "own")
    assert {out[p][1] for p in ("z/x", "top", "", None)} == {"none"}
    assert licences.scan(none.withColumn("path", F.lit("p"))).count() == 0


def test_licence_files_notices_and_tags(spark):
    notice = lambda name, i=0: "\n".join(" * " + line.strip() for line in licences.NOTICES[name][i].split("\n"))
    code = "def f(x):\n    return x\n" * 400
    files = [
        ("p/LICENSE", "Copyright (c) 2020 Somebody\n\n" + licences.NOTICES["MIT"][0]),
        ("p/a.py", code),
        ("q/x/b.py", "# SPDX-License-Identifier: MIT OR Apache-2.0\n" + code),
        ("q/x/c.py", code),
        ("r/LICENSE", notice("Apache-2.0") + "\n" + "more words of another kind " * 60),
        ("r/x.py", code),
        ("s/long.c", code + "/*\n" + notice("LGPL-2.1") + "\n */\n" + code),
        ("t/wrapped.py", code + "# Licensed under the Apache\n# License, Version 2.0.\n" + code),
        ("u/COPYING.txt", licences.NOTICES["GPL-3.0"][1] + "\n" + "terms and conditions follow " * 500),
        ("u/v/w.py", code),
        ("x/LICENSE", licences.NOTICES["BSD-2-Clause"][0]),
        ("y/LICENSE", licences.NOTICES["BSD-3-Clause"][0]),
        ("z/talk.txt", "the license of the software is not something that we talk about in this text " * 50),
    ]
    got = {r["path"]: (r["licence"], r["how"], r["origin"]) for r in licences.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got == {
        "p/LICENSE": ("MIT", "own", "p/LICENSE"),
        "p/a.py": ("MIT", "inherited", "p/LICENSE"),
        "q/x/b.py": ("MIT OR Apache-2.0", "own", "q/x/b.py"),
        "q/x/c.py": (None, "none", None),
        "r/LICENSE": ("Apache-2.0", "own", "r/LICENSE"),
        "r/x.py": ("Apache-2.0", "inherited", "r/LICENSE"),
        "s/long.c": ("LGPL-2.1", "own", "s/long.c"),
        "t/wrapped.py": ("Apache-2.0", "own", "t/wrapped.py"),
        "u/COPYING.txt": ("GPL-3.0", "own", "u/COPYING.txt"),
        "u/v/w.py": ("GPL-3.0", "inherited", "u/COPYING.txt"),
        "x/LICENSE": ("BSD-2-Clause", "own", "x/LICENSE"),
        "y/LICENSE": ("BSD-3-Clause", "own", "y/LICENSE"),
        "z/talk.txt": (None, "none", None),
    }


def test_anchors_miss_no_similar_passage():
    rng = random.Random(6)
    model = licences.Templates(licences.LICENCES, 1000, {w: rng.randrange(1000) for ts in licences.LICENCES.values() for t in ts for w in licences.words(t)})
    for t in model.all:
        for _ in range(40):
            ws = [w if rng.random() < rng.choice((0.5, 0.7, 0.9)) else "other" for w in rng.choices(list(t.weights), k=t.size)]
            counts = collections.Counter(ws)
            if model.cosine(t, counts) >= model.least:
                assert not t.anchors.keys().isdisjoint(counts)


def test_language(docs, rows, none):
    model = language.learn(docs)
    assert model.languages == ["en", "fr"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert got[4][0] == got[5][0] == got[16][0] == "und" and got[4][1] == 0
    assert got[14][0] == got[15][0] == "fr" and got[13][0] == got[7][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert language.predict(none, model).count() == 0 and language.learn(none).languages == []
    assert {r["lang_pred"] for r in language.predict(docs, language.learn(none)).collect()} == {"und"}
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2, 3, 7, 13, 14}


def test_more_languages_than_bits(spark):
    rng = random.Random(12)
    vocab = [["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for _ in range(130)]
    table = spark.createDataFrame([(k, " ".join(rng.choices(v, k=200)), f"l{k:03}") for k, v in enumerate(vocab)], "doc_id long, text string, lang string")
    model = language.learn(table)
    assert len(model.languages) == 130
    assert {r["doc_id"]: r["lang_pred"] for r in language.predict(table, model).collect()} == {k: f"l{k:03}" for k in range(130)}


def test_foreign_and_random_texts_are_dropped(spark):
    rng = random.Random(13)
    table = spark.createDataFrame([(k, prose(rng, 300), "en") for k in range(20)], "doc_id long, text string, lang string")
    noise = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=2000))
    asked = [(1, prose(rng, 60)), (2, noise), (3, "mikä olikaan tuo pitkä kylmä yötön thing talvi " * 9), (4, noise + " thing reed"), (5, "kylmä yö"), (6, "12")]
    kept = language.keep_identified(spark.createDataFrame(asked, "doc_id long, text string"), language.learn(table))
    assert {r["doc_id"] for r in kept.collect()} == {1, 5}


def test_filter_answers_with_all_languages():
    f = language.Filter.of(["a", "b"], [(17, 1), (18, 2), (19, 3)])
    probe = np.array([17, 18, 19, 20], np.uint32)
    masks = np.full(4, np.uint64(3))
    for s in language.slots(probe):
        masks &= f.table[s]
    assert masks.tolist() == [1, 2, 3, 0]


def test_top_k(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 0.2, (400, 8))
    x[:60] = x[0]
    x[200:] += 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [1.0] * 7 + [None]), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, [0.0] * 8), (5, x[5].tolist()), (910, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1)).repartition(3)
    got = collections.defaultdict(list)
    for r in mtree.top_k(table, F.col("vec_id") % 10 == 0, k=5, block=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    q = np.floor(x * 64).astype(np.int64)
    for i in range(0, 400, 10):
        score = q @ q[i]
        order = [j for j in sorted(range(400), key=lambda j: (-score[j], j)) if j != i][:5]
        assert got[i] == [(k + 1, j, score[j]) for k, j in enumerate(order)]
    assert set(got) == set(range(0, 400, 10))
    assert mtree.top_k(table.limit(0), F.lit(True)).count() == 0


def test_tree_passes_over_far_pages():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 100, (30, 8))
    x = np.rint(centres.repeat(100, axis=0) + rng.normal(0, 1, (3000, 8))).astype(np.int64)
    top = float((x.astype(float) ** 2).sum(axis=1).max())
    tree = mtree.Tree(np.arange(3000), x, top, page=64)
    *_, computed = tree.search(np.arange(0, 3000, 50), x[::50], 5, np.full(60, np.inf))
    assert computed < 0.5 * 60 * 3000


def test_search_together_matches_brute_force(monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (500, 4))
    x[100:140] = x[0]
    ids = rng.permutation(500)
    top = float((x.astype(float) ** 2).sum(axis=1).max())
    for together, page, k in ((1, 16, 3), (7, 64, 20), (512, 500, 600)):
        monkeypatch.setattr(mtree, "TOGETHER", together)
        own, found, score, _ = mtree.Tree(ids, x, top, page=page).search(ids[:60], x[:60], k, np.full(60, np.inf))
        for i in range(60):
            s = x @ x[i]
            want = sorted(((-s[j], ids[j]) for j in range(500) if j != i))[:k]
            at = own == ids[i]
            assert sorted(zip((-score[at]).tolist(), found[at].tolist())) == want


def test_lanes_hold_every_token_once():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 9, n).astype(np.int32) for n in (1, 0, 70_000, 5, 5, 800)]
    for whole in (True, False):
        lanes = lm.Lanes(docs, 4, whole)
        seen = [[] for _ in docs]
        for x, fresh, of, valid in lanes.windows(24):
            assert x.shape == fresh.shape == of.shape == valid.shape and x.shape[1] <= 4
            for i, t in zip(of.T[valid.T].tolist(), x.T[valid.T].tolist()):
                seen[i].append(t)
        assert [len(s) for s in seen] == [len(d) for d in docs]
        if whole:
            assert all(s == d.tolist() for s, d in zip(seen, docs))


def test_masks_find_two_substitutions_in_thirteen():
    for bad in itertools.combinations(range(decontam.WINDOW), 2):
        assert any(all(p + o not in bad for o in m) for m in decontam.MASKS for p in range(decontam.WINDOW - m[-1]))


def test_decontamination(spark, docs, none):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([40, 13, 9, 5, 60])] + [(10, None), (11, ""), (None, "a b c d e f g h i j")]
    w = [t.split() if t else [] for _, t in items]
    altered = list(w[0])
    altered[7], altered[20] = "x", "y"
    texts = [
        (1, " ".join(rng.choices(vocab, k=50) + w[0] + ["z"])), (2, " ".join(["q"] * 5 + altered)), (3, " ".join(w[1][:12])), (4, " ".join(w[4][20:40])), (5, " ".join(w[2]).upper()), (6, " ".join(w[3])),
        (7, " ".join(w[4][:6] + ["x"] * 30 + w[4][6:12])), (8, None), (9, ""), (10, " ".join(rng.choices(vocab, k=3000))), (1, "again " + " ".join(w[1])), (None, " ".join(w[0])),
    ]
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit(3)).withColumn("h", F.lit(1)).withColumn("f_doc", F.lit(1)).withColumn("dropped_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = {r["doc_id"]: r["item_ids"] for r in decontam.contamination(table, bench).collect()}
    assert out == {1: [0, 1], 2: [0], 3: [], 4: [4], 5: [2], 6: [], 7: [], 8: [], 9: [], 10: [], None: []}
    assert "f_doc" in neardup.keep_one(table).columns
    kept = decontam.drop_contaminated(table, bench)
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {3, 6, 7, 8, 9, 10, None}
    assert decontam.contamination(none, bench).count() == 0 and not decontam.contamination(table, bench.limit(0)).filter("contaminated").count()


def test_decontamination_by_items_of_every_short_length(spark):
    items = {n: [f"i{n}w{j}" for j in range(n)] for n in range(1, 13)}
    texts, want = [(0, "q " * 90), (1, "q"), (2, "i2w1 i2w0 i4w0 i4w1 i4w2")], {}
    for n, words in items.items():
        for k in range(4):
            for bad in itertools.combinations(range(n), k):
                if len(bad) == 3 and sum(bad) % 7:
                    continue
                own = [w if j not in bad else "x" for j, w in enumerate(words)]
                doc = 10 + len(texts)
                texts.append((doc, " ".join(["q"] * (doc % 70) + own + ["q"] * (doc % 3))))
                if 10 * (n - k) >= 8 * n:
                    want[doc] = [n]
        texts.append((10 + len(texts), " ".join(["q"] + words[1:])))
        if 10 * (n - 1) >= 8 * n:
            want[texts[-1][0]] = [n]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    got = {r["doc_id"]: r["item_ids"] for r in decontam.contamination(table, bench, least=1).collect() if r["contaminated"]}
    assert got == want
    longer = {r["doc_id"]: r["item_ids"] for r in decontam.contamination(table, bench).collect() if r["contaminated"]}
    assert longer == {d: i for d, i in want.items() if i[0] >= 8}


def test_decontamination_of_long_texts(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    item = rng.choices(vocab, k=30)
    filler = ["q"] * 400
    texts = [(at, " ".join(filler[:at] + item[:13] + filler[at:] + item[10:])) for at in range(40, 200)]
    found = decontam.overlaps(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).toPandas()
    assert len(found) == 2 * len(texts)
    starts = found.groupby("doc_id")["doc_at"].agg(["min", "max"])
    assert (starts["min"] == starts.index).all() and (starts["max"] == 403).all()


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    vocab = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    item, passage = " ".join(rng.choices(vocab, k=30)), " ".join(rng.choices(vocab, k=80))
    texts = [" ".join(rng.choices(vocab, k=120)) for _ in range(12)]
    given = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    given += [(20, texts[0], "en", "s", 1), (21, texts[1] + " more", "en", "s", 1), (22, "123 !?", None, "s", 1), (23, None, None, None, None), (24, texts[2][:300] + " " + item, "en", "s", 1)]
    given += [(25, " ".join(rng.choices(vocab, k=90)) + " " + passage, "en", "s", 1), (26, passage + " " + " ".join(rng.choices(vocab, k=90)), "en", "s", 1)]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        table = stage(spark, table, str(tmp_path))
        if name != "best_fit_packing":
            assert table.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"] for r in table.select("doc_id").collect()}
    assert kept["language_id"] == {r[0] for r in given} - {22, 23}
    assert kept["minhash_near_dedup"] == kept["language_id"] - {20, 21} == kept["suffix_dedup"]
    assert kept["decontamination"] == kept["suffix_dedup"] - {24} == kept["best_fit_packing"]
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert len(out) == out[["doc_id", "piece"]].drop_duplicates().shape[0]
    cut = brute_repeats([dict((g[0], g[1]) for g in given)[d].encode() for d in sorted(kept["suffix_dedup"])], 200)
    sizes = {d: len(tokens([c[3].decode()])[0]) for d, c in zip(sorted(kept["suffix_dedup"]), cut)}
    assert out.groupby("doc_id")["length"].sum().to_dict() == {d: n for d, n in sizes.items() if d in kept["decontamination"]}
