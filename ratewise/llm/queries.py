"""One registered query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import decontam, hardneg, language, licences, lm, mtree, neardup, packing, phrases, quality, suffix_dedup, toxicity, urlfilter
from ratewise.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), special=True)


@query("op2_suffix_dedup")
def suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


URL_RULES = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"), urlfilter.Rule("block", "example.com", "/de/"), urlfilter.Rule("allow", "org", "/fr/")]


@query("op3_url_filter")
def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf, "pages"), URL_RULES)


@query("op4_lm_scoring")
def lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"), ~held_out("doc_id", 10, 0))


@query("op5_toxicity")
def toxicity_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels").select("doc_id", "toxic")
    weights = toxicity.fit(toxicity.training_rows(docs, labels.filter(~held_out("doc_id", 5, 0))).collect())
    scored = toxicity.score(docs, weights)
    return scored.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), n=3, percent=85)


@query("op7_licence_scan")
def licence_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    files = docs.select(F.concat_ws("/", "source", "lang", "doc_id").alias("path"), "text")
    found = licences.scan(files)
    return found.select(F.element_at(F.split("path", "/"), -1).cast("long").alias("doc_id"), "path", "licence", "how", F.round("similarity", 6).alias("similarity"), "origin")


@query("op8_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language.learn(docs.filter(~held_out("doc_id", 4, 2)))
    found = language.predict(docs, model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op9_exact_top_k")
def exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return mtree.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op10_decontamination")
def decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), least=1)


@query(
    "op11_phrase_collocations",
    r"""
    WITH lowered AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM lowered),
    words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
    grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k),
    frequent AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 30),
    candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
    cuts AS (SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM candidates),
    scored AS (
        SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, (2000000::HUGEINT * c.a) // (l.f + r.f) AS score
        FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ') JOIN frequent r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')
    ),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT lang, a, array_to_string(w[first:first + k - 1], ' ') AS phrase FROM (SELECT lang, a, w, size, k, unnest(range(1, size - k + 2)) AS first FROM (SELECT *, unnest(range(2, size)) AS k FROM candidates))
    ),
    longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase),
    ranked AS (
        SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
        FROM lowest s LEFT JOIN longer i ON i.lang = s.lang AND i.phrase = s.phrase WHERE i.most IS NULL OR 100 * i.most < 80 * s.a
    )
    SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
)
def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


@query("op12_quality")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = quality.quality(docs.select("doc_id", "text"), labels.filter(~held_out("doc_id", 3, 1)).select("doc_id", "quality"))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query(
    "op13_hard_negatives",
    """
    WITH vectors AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    pairs AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
        FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    negatives AS (
        SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS rank, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
    )
    SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
    """,
)
def hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)
