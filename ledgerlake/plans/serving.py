"""Search, sort orders, look-up and map output over published merchants; arrivals and late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.ranking import ranked
from ledgerlake.operators.serving import ORDERS, geojson_features, looked_up, searched, sort_order
from ledgerlake.plans.registry import TX, query, table, transactions, written
from ledgerlake.storage import materialize
from ledgerlake.streaming.arrivals import within_lookback

_P = """p AS (SELECT family || ' ' || branch AS name, address, min(orderkey) AS id, min(origin) AS origin, count(*) AS visits, sum(amount)::BIGINT AS spend, count(*) + sum(people)::BIGINT AS score, count(DISTINCT institution) AS institutions,
    count(DISTINCT origin) AS sources, max(used_date) AS date_max, count(DISTINCT cohort) * count(DISTINCT institution) AS consensus, count(*) FILTER (tier = 1) AS top_official_visits, count(*) FILTER (tier = 2) AS regional_head_visits, count(DISTINCT institution) >= 2 AS is_cross,
    CASE WHEN max(tier) <= 3 THEN 'executive' WHEN min(tier) >= 3 THEN 'destination' ELSE 'both' END AS type FROM tx GROUP BY ALL)"""


def published(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    return transactions(spark, sf_dir).groupBy(F.concat_ws(" ", "family", "branch").alias("name"), "address").agg(
        F.min("orderkey").alias("id"), F.min("origin").alias("origin"), F.count("*").alias("visits"), F.sum("amount").alias("spend"), (F.count("*") + F.sum("people")).alias("score"),
        few("institution").alias("institutions"), few("origin").alias("sources"), F.max("used_date").alias("date_max"), (few("cohort") * few("institution")).alias("consensus"),
        F.count_if(F.col("tier") == 1).alias("top_official_visits"), F.count_if(F.col("tier") == 2).alias("regional_head_visits"), (few("institution") >= 2).alias("is_cross"),
        F.when(F.max("tier") <= 3, "executive").when(F.min("tier") >= 3, "destination").otherwise("both").alias("type"),
    )


@query(f"WITH {TX}, {_P} SELECT name, address, type, origin, sources FROM p WHERE sources >= 2 AND contains(lower(name || ' ' || address || ' ' || origin), 'red')")
def site_filter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants of several sources with a text in one of their fields."""
    return searched(published(spark, sf_dir), ["name", "address", "origin"], "cross_origin", "Red").select("name", "address", "type", "origin", "sources")


_SORTS = " UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS mode, row_number() OVER (ORDER BY {''.join(c[1:] + ' DESC, ' for c in cols)}name COLLATE ko, id, address) AS rank, name, address FROM p) WHERE rank <= 50" for n, cols in ORDERS.items())


@query(f"WITH {TX}, {_P} {_SORTS}")
@written
def site_sort_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 50 merchants of every sort order."""
    p, out = materialize(published(spark, sf_dir), "published"), None  # one aggregate for all orders
    for mode in ORDERS:
        order = [*sort_order(mode), F.col("address")]
        part = ranked(p.orderBy(*order).limit(50), order).select(F.lit(mode).alias("mode"), "rank", "name", "address")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""WITH {TX}, {_P}, s AS (SELECT name, address, id, score, CASE WHEN lower(name) = 'red' THEN 400 WHEN starts_with(lower(name), 'red') THEN 320 WHEN contains(lower(name), 'red') THEN 260 WHEN contains(lower(address || ' ' || origin), 'red') THEN 140 ELSE 0 END AS points FROM p)
    SELECT name, address, points, row_number() OVER (ORDER BY points DESC, score DESC, name, id) AS rank FROM s WHERE points > 0 QUALIFY rank <= 10""")
def lookup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return looked_up(published(spark, sf_dir), "Red", "name", ["address", "origin"], "id").select("name", "address", "points", "rank")


@query("""SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || (c_custkey % 90)::DOUBLE || ',' || (c_nationkey)::DOUBLE || ']},"properties":{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}}' AS feature FROM customer WHERE c_nationkey > 4""")
def geojson_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with coordinates as GeoJSON."""
    c = table(spark, sf_dir, "customer").withColumn("lat", F.when(F.col("c_nationkey") > 4, F.col("c_nationkey"))).withColumn("lon", F.col("c_custkey") % 90)
    return geojson_features(c, "lat", "lon", ["c_custkey", "c_name"])


@query("""WITH m AS (SELECT max(ts) - INTERVAL 10 DAY AS low FROM events) SELECT user_id, count(*) AS n, count(*) FILTER (ts >= low) AS in_window FROM events, m GROUP BY user_id""")
def late_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user within ten days of the latest event of all."""
    e = within_lookback(table(spark, sf_dir, "events"), "ts", "10 days", "recent")
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if("recent").alias("in_window"))
