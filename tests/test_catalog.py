"""A cross-section of the registered queries against their SQL on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "labels"]
NAMES = [
    "rate_by_category", "rate_by_category_all", "hour_verdict", "rate_by_bin", "entity_rate", "rate_contribution",
    "adjusted_rate_table", "role_asymmetry", "one_way_routes", "numeric_summary", "iqr_outliers", "dominant_value",
    "category_proportions", "duplicate_count", "filter_report", "correlation_matrix", "build_view", "apply_view",
    "stratified_split", "stratified_kfold", "full_evaluation_set", "knn_classify", "roc_curve", "auc_roc_fine",
    "classification_report", "compare_models", "histogram_bins", "box_stats_by_group", "view_registry", "equal_width_bins",
    "category_findings", "column_roles", "place_columns", "knn_text_ids", "tree_predict", "audit_counts",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return "null" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(v + 0.0) if isinstance(v, float) else str(v)

    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    cursor = tables.execute(entry.oracle_sql()[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == want


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    flagship = entry.entry(spark)
    assert flagship.columns == ["weather", "total", "rate_pct"] and flagship.count() > 0
