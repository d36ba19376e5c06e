"""Registered queries and their SQL equivalents; input tables and the transaction view that many queries share."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.storage import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE_SQL[name or f.__name__] = sql
        return f

    return add


def written(f: Query) -> Query:
    """The query's result as a table; the tables that its operators wrote on the way are deleted."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with scratch() as keep:
            return keep(f(spark, sf_dir), f.__name__)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line of an order, as an expense: merchant and address from the part, institution and origin from the
    customer's nation and region, role and tier from the priority, whole amounts, people, dates as text, hour of day."""
    t = lambda name: table(spark, sf_dir, name)
    places = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    orders = t("orders").join(places, F.col("o_custkey") == F.col("c_custkey"))
    rows = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    hour = ((F.col("l_orderkey") + 3 * F.col("l_linenumber")) % 24).cast("int")
    return rows.select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
        F.concat_ws(" ", "p_name", "p_brand").alias("merchant"), F.col("p_name").alias("family"), F.col("p_brand").alias("branch"), F.col("p_type").alias("address"),
        F.col("n_name").alias("institution"), F.col("r_name").alias("origin"), F.col("c_mktsegment").alias("cohort"), F.col("o_orderpriority").alias("role"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tier"), F.bround(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("bigint").alias("amount"),
        F.col("l_quantity").cast("int").alias("people"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("used_date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        hour.alias("hour"), (hour >= 17).alias("evening"),
    )


#: The same rows in SQL.
TX = """tx AS (SELECT l_orderkey AS orderkey, l_linenumber AS line, l_partkey AS partkey, l_suppkey AS suppkey,
    p_name || ' ' || p_brand AS merchant, p_name AS family, p_brand AS branch, p_type AS address, n_name AS institution, r_name AS origin,
    c_mktsegment AS cohort, o_orderpriority AS role, CAST(substr(o_orderpriority, 1, 1) AS INT) AS tier,
    CAST(round_even(l_extendedprice * (1 - l_discount), 0) AS BIGINT) AS amount, CAST(l_quantity AS INT) AS people,
    strftime(l_shipdate, '%Y-%m-%d') AS used_date, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
    CAST((l_orderkey + 3 * l_linenumber) % 24 AS INT) AS hour, (l_orderkey + 3 * l_linenumber) % 24 >= 17 AS evening
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

#: Rows whose amount for each person is plausible.
PLAUSIBLE = "NOT (amount > 0 AND people >= 2 AND amount::DOUBLE / people < 1000)"

MEASURES = """count(*) AS visits, count(DISTINCT role) AS roles, count(DISTINCT institution) AS institutions, count(DISTINCT substr(used_date, 1, 7)) AS months,
    coalesce(sum(amount), 0)::BIGINT AS spend, coalesce(sum(people), 0)::BIGINT AS people, count(*) FILTER (evening) AS evening"""
