"""Class balancing, exact splits and folds. The hash order is plain md5, so SQL can repeat it."""

from __future__ import annotations

from catalog.registry import bookings, bookings_sql, query
from ratewise.operators import sampling

_T = f"t AS ({bookings_sql('id', 'delayed')})"
_RANKED = "r AS (SELECT *, row_number() OVER (PARTITION BY delayed ORDER BY md5('42:' || id)) AS k, count(*) OVER (PARTITION BY delayed) AS n FROM {0})"


def quota_sql(source: str) -> str:
    """Largest-remainder test quota per class over a source with (id, delayed)."""
    return f"""c_{source} AS (SELECT delayed, count(*) AS n FROM {source} GROUP BY delayed),
    w_{source} AS (SELECT *, ceil(round(0.3 * sum(n) OVER (), 9)) AS w, sum(n) OVER () AS total FROM c_{source}),
    f_{source} AS (SELECT *, w * n / total AS x, floor(w * n / total) AS f FROM w_{source}),
    q_{source} AS (SELECT delayed, f + CASE WHEN row_number() OVER (ORDER BY f - x, delayed) <= w - sum(f) OVER () THEN 1 ELSE 0 END AS quota FROM f_{source})"""


def _rows(spark, sf):
    return bookings(spark, sf, "id", "delayed")


@query(
    "undersample_majority",
    f"WITH {_T}, {_RANKED.format('t')}, m AS (SELECT min(n) AS q FROM r) SELECT id, delayed FROM r, m WHERE k <= q",
)
def _undersample_majority(spark, sf):
    return sampling.undersample_majority(_rows(spark, sf), "delayed", ["id"])


@query(
    "undersample_discarded",
    f"WITH {_T}, {_RANKED.format('t')}, m AS (SELECT min(n) AS q FROM r) SELECT id, delayed FROM r, m WHERE k > q",
)
def _undersample_discarded(spark, sf):
    return sampling.undersample_discarded(_rows(spark, sf), "delayed", ["id"])


@query(
    "stratified_split",
    f"WITH {_T}, {_RANKED.format('t')}, {quota_sql('t')} SELECT id, r.delayed, k <= quota AS is_test FROM r JOIN q_t ON r.delayed = q_t.delayed",
)
def _stratified_split(spark, sf):
    return sampling.stratified_split(_rows(spark, sf), "delayed", ["id"])


@query(
    "stratified_kfold",
    f"WITH {_T}, {_RANKED.format('t')} SELECT id, delayed, CAST((5 * (k - 1)) // n AS INTEGER) AS fold FROM r",
)
def _stratified_kfold(spark, sf):
    return sampling.stratified_kfold(_rows(spark, sf), "delayed", ["id"])


@query(
    "full_evaluation_set",
    f"""WITH {_T}, {_RANKED.format('t')}, m AS (SELECT min(n) AS q FROM r), s AS (SELECT id, delayed, k FROM r, m WHERE k <= q), {quota_sql('s')}
    SELECT id, s.delayed FROM s JOIN q_s ON s.delayed = q_s.delayed WHERE k <= quota UNION ALL SELECT id, delayed FROM r, m WHERE k > q""",
)
def _full_evaluation_set(spark, sf):
    return sampling.full_evaluation_set(_rows(spark, sf), "delayed", ["id"]).select("id", "delayed")


@query(
    "set_difference",
    f"WITH {_T}, {_RANKED.format('t')}, m AS (SELECT min(n) AS q FROM r) SELECT id, delayed FROM r, m WHERE k > q",
)
def _set_difference(spark, sf):
    rows = _rows(spark, sf)
    return sampling.set_difference(rows, sampling.undersample_majority(rows, "delayed", ["id"]), ["id"])


@query("hash_sample", f"WITH {_T} SELECT id, delayed FROM t ORDER BY md5('42:' || id) LIMIT 100")
def _hash_sample(spark, sf):
    return sampling.hash_sample(_rows(spark, sf), ["id"], 100)
