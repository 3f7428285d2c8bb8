"""Registration and the bindings of the test tables to the roles the operators expect.

Bindings add only the joins the asked columns need; every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# column -> (Spark SQL expression, DuckDB expression, tables it needs)
_TRIP_COLUMNS: dict[str, tuple[str, str | None, set[str]]] = {
    "order_id": ("l_orderkey", None, set()),
    "line": ("l_linenumber", None, set()),
    "distance": ("l_extendedprice", None, set()),
    "minutes": ("l_quantity", None, set()),
    "load": ("l_discount", None, set()),
    "surcharge": ("nullif(l_tax, 0.0D)", "nullif(l_tax, 0.0)", set()),
    "flag": ("l_returnflag", None, set()),
    "status": ("l_linestatus", None, set()),
    "delayed": ("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END", None, set()),
    "outcome_text": ("CASE l_returnflag WHEN 'R' THEN ' Delayed ' WHEN 'A' THEN 'no' END", None, set()),
    "visibility": ("o_totalprice", None, {"orders"}),
    "weather": ("nullif(o_orderpriority, '4-NOT SPECIFIED')", None, {"orders"}),
    "congestion": ("o_orderstatus", None, {"orders"}),
    "high_season": ("month(o_orderdate) IN (12, 1, 2)", None, {"orders"}),
    "kind": ("p_brand", None, {"part"}),
    "shape": ("p_type", None, {"part"}),
    "size": ("p_size", None, {"part"}),
    "origin": ("cn.n_name", None, {"orders", "customer", "cn"}),
    "destination": ("sn.n_name", None, {"supplier", "sn"}),
}

_TRIP_JOINS = [
    ("orders", "orders", "l_orderkey = o_orderkey"),
    ("part", "part", "l_partkey = p_partkey"),
    ("customer", "customer", "o_custkey = c_custkey"),
    ("supplier", "supplier", "l_suppkey = s_suppkey"),
    ("cn", "nation", "c_nationkey = cn.n_nationkey"),
    ("sn", "nation", "s_nationkey = sn.n_nationkey"),
]
# Joined to each other before the order lines, of which there are more, are dealt to them.
_TRIP_SIDES = [("orders", "customer", "cn"), ("part",), ("supplier", "sn")]


def trips(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """One row per order line, bound to the roles of a flight."""
    need = set().union(*[_TRIP_COLUMNS[c][2] for c in cols])
    df = table(spark, sf, "lineitem")
    joins = {alias: (source, on) for alias, source, on in _TRIP_JOINS}
    for first, *others in _TRIP_SIDES:
        if first in need:
            side = table(spark, sf, joins[first][0]).alias(first)
            for alias in others:
                if alias in need:
                    side = side.join(table(spark, sf, joins[alias][0]).alias(alias), F.expr(joins[alias][1]))
            df = df.join(side, F.expr(joins[first][1]))
    return df.selectExpr(*[f"{_TRIP_COLUMNS[c][0]} AS {c}" for c in cols])


def trips_sql(*cols: str) -> str:
    need = set().union(*[_TRIP_COLUMNS[c][2] for c in cols])
    joins = " ".join(f"JOIN {source} {alias} ON {on}" for alias, source, on in _TRIP_JOINS if alias in need)
    picked = ", ".join(f"{_TRIP_COLUMNS[c][1] or _TRIP_COLUMNS[c][0]} AS {c}" for c in cols)
    return f"SELECT {picked} FROM lineitem {joins}"


# events: (Spark SQL, DuckDB)
_LOG_COLUMNS: dict[str, tuple[str, str]] = {
    "event_id": ("event_id", "event_id"),
    "user_id": ("user_id", "user_id"),
    "ts": ("ts", "ts"),
    "hour_text": ("date_format(ts, 'HH:mm:ss')", "strftime(ts, '%H:%M:%S')"),
    "hour": ("hour(ts)", "CAST(hour(ts) AS INTEGER)"),
    "event_type": ("event_type", "event_type"),
    "load": ("value", "value"),
    "load_known": ("CASE WHEN value >= 1 THEN value END", "CASE WHEN value >= 1 THEN value END"),
    # unknown loads as NaN; SQL takes them as null
    "load_nan": ("CASE WHEN value >= 1 THEN value ELSE double('NaN') END", "CASE WHEN value >= 1 THEN value END"),
    "delayed": ("CASE WHEN event_type = 'error' THEN 1 ELSE 0 END", "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END"),
}


def logs(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    """One row per event: hours, loads and a 20 % outcome."""
    return table(spark, sf, "events").selectExpr(*[f"{_LOG_COLUMNS[c][0]} AS {c}" for c in cols])


def logs_sql(*cols: str) -> str:
    return "SELECT " + ", ".join(f"{_LOG_COLUMNS[c][1]} AS {c}" for c in cols) + " FROM events"


# orders with their customer: unique id, a third positive
_BOOKING_COLUMNS: dict[str, tuple[str, set[str]]] = {
    "id": ("o_orderkey", set()),
    "price": ("o_totalprice", set()),
    "balance": ("CASE WHEN c_acctbal >= 0 THEN c_acctbal END", {"customer"}),
    "priority": ("nullif(o_orderpriority, '4-NOT SPECIFIED')", set()),
    "segment": ("c_mktsegment", {"customer"}),
    "nation": ("c_nationkey", {"customer"}),
    "high_season": ("month(o_orderdate) IN (12, 1, 2)", set()),
    "delayed": ("CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END", set()),
    "urgent": ("CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END", set()),
}


def bookings(spark: SparkSession, sf: str, *cols: str) -> DataFrame:
    df = table(spark, sf, "orders")
    if any("customer" in _BOOKING_COLUMNS[c][1] for c in cols):
        df = df.join(table(spark, sf, "customer"), F.expr("o_custkey = c_custkey"))
    return df.selectExpr(*[f"{_BOOKING_COLUMNS[c][0]} AS {c}" for c in cols])


def bookings_sql(*cols: str) -> str:
    join = "JOIN customer ON o_custkey = c_custkey" if any("customer" in _BOOKING_COLUMNS[c][1] for c in cols) else ""
    return "SELECT " + ", ".join(f"{_BOOKING_COLUMNS[c][0]} AS {c}" for c in cols) + f" FROM orders {join}"
