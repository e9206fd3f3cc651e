"""Query registry and the table views the bindings share."""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "scans", "filters", "joins", "aggregates", "ranking", "sets", "sampling",
    "scalars", "features", "models", "governance", "advisors", "streams",
)


def query(name: str, sql: str | None = None):
    """Register a binding and, where SQL can say the same, its statement."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return register


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"tallyloom.plans.{module}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r9(col: Column) -> Column:
    return F.round(col, 9)


def sql_round(expr: str, decimals: int) -> str:
    """SQL for rounding the binary value with ties to even.

    DuckDB's own round multiplies a double first, which moves values next to a
    tie onto it. The value is cut at float precision, both parts times the power
    of ten are exact, and the sign of the distance to the tie decides.
    """
    m = 10 ** decimals
    one = f"list_transform([({expr})::DOUBLE], lambda x: [x, floor(x * {m}), (x::FLOAT::DOUBLE * {m} - (floor(x * {m}) + 0.5::DOUBLE)) + (x - x::FLOAT::DOUBLE) * {m}])[1]"
    return f"list_transform([{one}], lambda p: (p[2] + (p[3] > 0 OR (p[3] = 0 AND p[2] % 2 <> 0))::INT) / {m}::DOUBLE)[1]"


# ---------------------------------------------------------------- shared views

RUNS_SQL = """
    runs AS (
      SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id,
             l_partkey AS dataset_id,
             l_returnflag || l_linestatus AS algorithm,
             CASE WHEN l_linestatus = 'F' THEN 'trained' ELSE 'draft' END AS status,
             CASE l_returnflag WHEN 'A' THEN 'classification'
                               WHEN 'N' THEN 'regression' ELSE 'clustering' END AS task,
             round(1 - l_discount, 4) AS acc,
             round(1 - l_tax / 2, 4) AS train_acc,
             CASE WHEN l_tax < 0.005 THEN NULL
                  ELSE round(1 - l_discount - 2 * l_tax, 4) END AS f1,
             CASE WHEN l_quantity < 5 THEN NULL
                  ELSE round(1 - l_discount - l_quantity / 100, 4) END AS ind_acc,
             l_shipdate AS created
      FROM lineitem)
"""


def run_key() -> Column:
    """Identity of a `lineitem` row: the four keys alone repeat now and then."""
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("int"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model runs with metrics, derived from `lineitem` (same as RUNS_SQL)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        run_key().alias("run_id"),
        F.col("l_partkey").alias("dataset_id"),
        F.concat("l_returnflag", "l_linestatus").alias("algorithm"),
        F.when(F.col("l_linestatus") == "F", "trained").otherwise("draft").alias("status"),
        F.when(F.col("l_returnflag") == "A", "classification")
        .when(F.col("l_returnflag") == "N", "regression")
        .otherwise("clustering").alias("task"),
        F.round(1 - F.col("l_discount"), 4).alias("acc"),
        F.round(1 - F.col("l_tax") / 2, 4).alias("train_acc"),
        F.when(F.col("l_tax") >= 0.005,
               F.round(1 - F.col("l_discount") - 2 * F.col("l_tax"), 4)).alias("f1"),
        F.when(F.col("l_quantity") >= 5,
               F.round(1 - F.col("l_discount") - F.col("l_quantity") / 100, 4)).alias("ind_acc"),
        F.col("l_shipdate").alias("created"),
    )


EVENTS_SQL = """
    ev AS (
      SELECT event_id, ts, user_id, event_type, value,
             CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
      FROM events)
"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.from_json("props", "k INT").getField("k").alias("k"),
    )
