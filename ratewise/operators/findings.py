"""Graded audit findings: one schema, rules as column expressions over small aggregated frames."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.operators import filters, profile, rates, relations
from ratewise.operators.onepass import OnePass, run_together
from ratewise.operators.fingerprints import copy_counts
from ratewise.operators.quantiles import order_statistics
from ratewise.operators.reshape import value_counts
from ratewise.operators.roles import classify_columns, has_columns, require_columns
from ratewise.sources.scratch import stage

Shared = dict[str, DataFrame]

INFO, FINDING, ANOMALY, CRITICAL = "INFO", "FINDING", "ANOMALY", "CRITICAL"
SEVERITY = (CRITICAL, ANOMALY, FINDING, INFO)
FINDING_SCHEMA = "section string, column string, level string, rule string, value double, threshold double, text string"


def finding(
    table: DataFrame,
    section: str,
    column: str | Column,
    level: str | Column,
    rule: str,
    value: Column,
    threshold: float | Column | None,
    text: Column,
    when: Column | None = None,
) -> DataFrame:
    """One finding per row of an aggregated frame that meets the condition."""
    rows = table if when is None else table.filter(when)
    return rows.select(
        F.lit(section).alias("section"),
        (F.lit(column) if isinstance(column, str) else column).alias("column"),
        (F.lit(level) if isinstance(level, str) else level).alias("level"),
        F.lit(rule).alias("rule"),
        value.cast("double").alias("value"),
        (threshold if isinstance(threshold, Column) else F.lit(threshold)).cast("double").alias("threshold"),
        text.alias("text"),
    )


def _text(pattern: str, *cols: str | Column) -> Column:
    return F.format_string(pattern, *[F.col(c) if isinstance(c, str) else c for c in cols])


@dataclass
class AuditRoles:
    """Which columns play which part; absent parts skip their checks."""

    id: str | None = None
    target: str | None = None
    origin: str | None = None
    destination: str | None = None
    distance: str | None = None
    minutes: str | None = None
    load: str | None = None
    kind: str | None = None
    impossible_pair: tuple[str, str] | None = None


def overview_findings(df: DataFrame, roles: AuditRoles, shared: Shared | None = None) -> list[DataFrame]:
    section = "overview"
    shared = shared or run_together(df, {"cells": profile.table_nulls_pass(df), "nulls": profile.null_report_pass(df)})
    out = [
        finding(shared["cells"], section, "*", F.when(F.col("null_cells") > 0, ANOMALY).otherwise(INFO), "null_cells",
                F.col("null_cells"), 0.0, _text("%d null cells", "null_cells")),
        finding(shared["nulls"], section, F.col("column"), INFO, "null_column", F.col("nulls"), 0.0,
                _text("%s: %d nulls (%.1f%%)", "column", "nulls", "null_pct"), F.col("nulls") > 0),
    ]
    kinds = {"rows": df.columns}
    if roles.id and has_columns(df, roles.id):
        kinds |= {"without_id": [c for c in df.columns if c != roles.id], "ids": [roles.id]}
    copies = stage(copy_counts(df, kinds), "copies")  # all kinds from one shuffle of fingerprints
    of = lambda kind: copies.filter(F.col("kind") == kind)
    out.append(_duplicates(profile.duplicate_share(of("rows")), section, "duplicate_rows"))
    if "ids" in kinds:
        out.append(_duplicates(profile.duplicate_share(of("without_id")), section, "duplicate_rows_without_id"))
        out.append(
            finding(profile.id_share(of("ids")), section, roles.id, F.when(F.col("unique"), INFO).otherwise(ANOMALY),
                    "unique_ids", F.col("distinct_ids"), None, _text("%d ids in %d rows", "distinct_ids", "rows"))
        )
    return out


def _duplicates(table: DataFrame, section: str, rule: str) -> DataFrame:
    level = F.when(F.col("duplicates") > 0, ANOMALY).otherwise(INFO)
    return finding(table, section, "*", level, rule, F.col("duplicates"), 0.0, _text("%d duplicate rows", "duplicates"))


def numeric_findings(df: DataFrame, cols: list[str], shared: Shared) -> list[DataFrame]:
    section, name = "numeric", F.col("column")
    shape, signs = shared["shape"], shared["signs"]
    seen = order_statistics(df, cols, sorted({*profile.QUARTILES.values(), *profile.spaced_ranks()}))
    limits = profile.iqr_limits(df, cols, seen=seen).collect()  # one row per column
    candidates = profile.dominant_candidates(seen)
    checks = {"outliers": profile.iqr_pass(limits, "non_null"), "top": profile.dominant_pass(candidates)}
    counted = run_together(df, checks) if limits else {}
    if not counted:  # no values at all
        return []
    outliers, top = counted["outliers"], counted["top"]
    return [
        finding(shape, section, name, F.when(F.col("skew_level") == "high", FINDING).otherwise(INFO), "skewness",
                F.col("skewness"), F.when(F.col("skew_level") == "high", 2.0).otherwise(1.0), _text("%s skewness: %.2f", "skew_level", "skewness"), F.col("skew_level") != "low"),
        finding(shape, section, name, FINDING, "kurtosis", F.col("kurtosis"), 7.0,
                _text("heavy tails, kurtosis %.2f", "kurtosis"), F.col("heavy_tails")),
        finding(outliers, section, name, F.when(F.col("outliers") > 0, FINDING).otherwise(INFO), "iqr_outliers",
                F.col("outliers"), 1.5, _text("%d outliers (%.1f%%) outside %.1f to %.1f", "outliers", "pct", "low", "high")),
        finding(signs, section, name, FINDING, "zeros", F.col("zeros"), 0.0, _text("%d zeros", "zeros"), F.col("zeros") > 0),
        finding(signs, section, name, ANOMALY, "negatives", F.col("negatives"), 0.0, _text("%d negative values", "negatives"),
                F.col("negatives") > 0),
        finding(top, section, name, FINDING, "dominant_value", F.col("pct"), 25.0,
                F.concat(F.col("value").cast("string"), _text(" holds %.1f%% of the values", "pct"))),
    ]


def categorical_findings(df: DataFrame, cols: list[str], target: str | None) -> list[DataFrame]:
    """All categorical rules from one (column, value) table."""
    section, name = "categorical", F.col("column")
    with_target = target is not None and target in df.columns and target not in cols
    cells = stage(rates.rate_cells(df, cols, target) if with_target else value_counts(df, cols), "category-cells")
    summary = profile.category_summary_of(cells)
    out = [
        finding(summary, section, name, FINDING, "high_cardinality", F.col("categories"), 30.0,
                _text("%d categories", "categories"), F.col("high_cardinality")),
        finding(summary, section, name, ANOMALY, "dominant_category", F.col("top_share") * 100, 80.0,
                _text("'%s' holds %.1f%%", "top_value", F.col("top_share") * 100), F.col("dominant_category")),
        finding(summary, section, name, FINDING, "rare_categories", F.col("rare_categories"), 1.0,
                _text("%d categories below 1%%", "rare_categories"), F.col("rare_categories") > 0),
        finding(profile.category_shares_of(cells), section, name, INFO, "category_share", F.col("pct"), None,
                _text("'%s': %d rows (%.1f%%)", "value", "rows", "pct")),
    ]
    if with_target:
        rated = cells.withColumn("rate", F.round(F.try_divide(F.col("positives") * 100.0, F.col("known")), 4))
        out.append(finding(rated, section, name, INFO, "category_rate", F.col("rate"), None, _text("'%s': rate %.1f%% of %d rows", "value", "rate", "known"), F.col("known") > 0))
        spread = rates.rate_spread_of(cells)
        out.append(
            finding(spread, section, name, F.when(F.col("important"), FINDING).otherwise(INFO), "rate_spread",
                    F.col("spread_pp"), 15.0, _text("rate from %.1f%% to %.1f%% (%.1f pp)", "min_rate", "max_rate", "spread_pp"))
        )
    return out


def _routes(table: DataFrame, section: str, o: str, d: str, rule: str, pattern: str) -> DataFrame:
    """One row per route of a top list."""
    return finding(table, section, f"{o},{d}", INFO, rule, F.col("rows"), None, _text(pattern, o, d, "rows"))


def coherence_findings(df: DataFrame, roles: AuditRoles, shared: Shared) -> list[DataFrame]:
    section, out = "coherence", []
    o, d = roles.origin, roles.destination
    if "impossible" in shared:
        out.append(finding(shared["impossible"], section, f"{o},{d}", CRITICAL, "impossible_route", F.col("hits"), 0.0,
                           _text("%d rows (%.1f%%) on a route that does not exist", "hits", "pct"), F.col("hits") > 0))
    if "same_ends" in shared:
        out.append(finding(shared["same_ends"], section, f"{o},{d}",
                           F.when(F.col("hits") > 0, ANOMALY).otherwise(INFO), "same_ends", F.col("hits"), 0.0,
                           _text("%d rows with equal ends", "hits")))
        out.append(_routes(rates.top_routes(df, o, d), section, o, d, "top_route", "%s to %s: %d rows"))
        one_way = rates.pair_totals(df, o, d).agg(F.count_if(F.col("directions") == 1).alias("one_way"))
        out.append(finding(one_way, section, f"{o},{d}", F.when(F.col("one_way") > 0, FINDING).otherwise(INFO), "one_way_routes",
                           F.col("one_way"), 0.0, _text("%d routes run in one direction only", "one_way")))
    if "band" in shared:
        pair, band, r = f"{roles.distance},{roles.minutes}", shared["band"], shared["distance_time"]
        out.append(finding(band, section, pair, FINDING, "rate_too_low", F.col("too_slow"), 150.0,
                           _text("%d rows below 150 per hour", "too_slow"), F.col("too_slow") > 0))
        if o and d and has_columns(df, o, d):
            slow = filters.slow_routes(df, o, d, roles.distance, roles.minutes)
            out.append(_routes(slow, section, o, d, "slow_route", "%s to %s: %d rows below 150 per hour"))
        out.append(finding(band, section, pair, F.when(F.col("too_fast") > 0, ANOMALY).otherwise(INFO), "rate_too_high",
                           F.col("too_fast"), 950.0, _text("%d rows above 950 per hour", "too_fast")))
        out.append(finding(r, section, pair, INFO, "distance_time_correlation", F.col("r"), None, _text("correlation %.4f", "r")))
        out.append(finding(r, section, pair, ANOMALY, "distance_time_low", F.col("r"), 0.90,
                           _text("correlation %.4f below the expected 0.90", "r"), F.col("r") < 0.90))
        if roles.kind and has_columns(df, roles.kind):
            speeds = stage(rates.raw_stats_by_type(df, roles.kind, roles.distance, roles.minutes), "type-rates")
            out.append(finding(speeds, section, roles.kind, INFO, "type_rate", F.round("mean", 1), None,
                               _text("%s: mean %.1f, from %.1f to %.1f", F.col(roles.kind).cast("string"), "mean", "min", "max")))
            spread = rates.mean_spread_of(speeds)
            out.append(finding(spread, section, roles.kind, FINDING, "type_mean_spread", F.col("spread"), 30.0,
                               _text("type means differ by only %.1f", "spread"), F.col("almost_equal")))
    if "load" in shared:
        for rule, c, level, limit in (
            ("above_100", "above", ANOMALY, 100.0), ("below_0", "below", ANOMALY, 0.0), ("exactly_0", "at_lower", FINDING, 0.0),
        ):
            out.append(finding(shared["load"], section, roles.load, level, rule, F.col(c), limit, _text("%d rows", c), F.col(c) > 0))
    return out


def target_findings(df: DataFrame, target: str | None) -> list[DataFrame]:
    if not target or target not in df.columns:
        row = df.sparkSession.createDataFrame(
            [("target", target or "", CRITICAL, "target_missing", None, None, "target column not found")], FINDING_SCHEMA
        )
        return [row]
    balance = rates.class_balance(df, target).agg(F.first("ratio").alias("ratio"), F.first("level").alias("grade"))
    level = F.when(F.col("grade") == "severe", ANOMALY).when(F.col("grade") == "moderate", FINDING).otherwise(INFO)
    return [finding(balance, "target", target, level, "class_balance", F.col("ratio"), 0.5, _text("%s balance, ratio %.2f", "grade", "ratio"))]


def correlation_findings(shared: Shared) -> list[DataFrame]:
    section, out = "correlation", []
    if "ranking" in shared:
        out.append(finding(shared["ranking"], section, F.col("column"), FINDING, "drop_candidate", F.col("r"), 0.05,
                           _text("correlation %.4f, candidate to drop", "r"), F.col("drop_candidate")))
    if "pairs" in shared:
        high = F.abs("r") > 0.7
        out.append(finding(shared["pairs"], section, F.concat_ws(",", "x", "y"), FINDING, "collinear", F.col("r"), 0.7,
                           _text("correlation %.4f, possibly redundant", "r"), high))
        none = shared["pairs"].agg(F.count_if(high).alias("n"))
        out.append(finding(none, section, "*", INFO, "no_collinearity", F.col("n"), 0.7, F.lit("no pair above 0.7"), F.col("n") == 0))
    return out


def _shared_checks(df: DataFrame, roles: AuditRoles, numeric: list[str]) -> dict[str, OnePass]:
    """Every check that is a plain aggregate over the whole table."""
    checks = {"cells": profile.table_nulls_pass(df), "nulls": profile.null_report_pass(df)}
    if numeric:
        checks["shape"], checks["signs"] = profile.shape_flags_pass(numeric), profile.zero_negative_pass(numeric)
    o, d = roles.origin, roles.destination
    if o and d and has_columns(df, o, d):
        checks["same_ends"] = filters.self_pair_pass(o, d)
        if roles.impossible_pair:
            checks["impossible"] = filters.pair_set_pass(o, d, roles.impossible_pair)
    if roles.distance and roles.minutes and has_columns(df, roles.distance, roles.minutes):
        checks["band"] = filters.rate_band_pass(roles.distance, roles.minutes)
        checks["distance_time"] = relations.row_correlation_pass(roles.distance, roles.minutes)
    if roles.load and has_columns(df, roles.load):
        checks["load"] = filters.domain_range_pass(roles.load)
    return checks


def audit(df: DataFrame, roles: AuditRoles) -> DataFrame:
    """Every check as rows of one findings frame. The plain aggregates share one scan and the categorical
    rules one value table, with a row for the share and the rate of every category; what is left (duplicates, quantiles, routes, types) scans its own columns only.
    A named column that is not there raises, a target that is not there is a finding. Give a stored table: an input that is itself a join would be joined again by each scan."""
    require_columns(df, *[c for c in (roles.id, roles.origin, roles.destination, roles.distance, roles.minutes, roles.load, roles.kind) if c])
    numeric, categorical, _ = classify_columns(df, [roles.id] if roles.id else [])
    shared = run_together(df, _shared_checks(df, roles, numeric))
    if len(numeric) > 1:
        shared["pairs"] = stage(relations.correlation_pairs(df, numeric), "correlations")
        if roles.target in numeric:
            shared["ranking"] = relations.target_ranking_of(shared["pairs"], roles.target)
    parts = overview_findings(df, roles, shared)
    if numeric:
        parts += numeric_findings(df, numeric, shared)
    if categorical:
        parts += categorical_findings(df, categorical, roles.target)
    parts += coherence_findings(df, roles, shared) + target_findings(df, roles.target) + correlation_findings(shared)
    return reduce(DataFrame.unionByName, parts)


def severity(level: Column) -> Column:
    rank = F.lit(len(SEVERITY))
    for i, name in enumerate(SEVERITY):
        rank = F.when(level == name, i).otherwise(rank)
    return rank


def audit_report(findings: DataFrame) -> DataFrame:
    """Findings in severity order."""
    return findings.withColumn("severity", severity(F.col("level"))).orderBy("severity", "section", "column", "rule")


def audit_counts(findings: DataFrame) -> DataFrame:
    """Number of findings per level, in severity order."""
    return (
        findings.groupBy("level")
        .agg(F.count("*").alias("findings"))
        .withColumn("severity", severity(F.col("level")))
        .orderBy("severity")
    )
