"""Gates, funnels, grades, review queues and priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.text import ladder
from ledgerlake.operators.gates import coverage, floors, health_funnel, health_rollup, run_checks
from ledgerlake.operators.ranking import top_k, top_values
from ledgerlake.plans.registry import TX, query, table, transactions


@query(f"""WITH {TX} SELECT 'blank_merchant' AS "check", 'error' AS severity, count(*) FILTER (trim(merchant) = '') AS n FROM tx UNION ALL SELECT 'amount_range', 'error', count(*) FILTER (amount <= 0 OR amount >= 50000000) FROM tx
    UNION ALL SELECT 'date_before_order', 'warning', count(*) FILTER (used_date < order_date) FROM tx UNION ALL SELECT 'many_people', 'warning', count(*) FILTER (people > 40) FROM tx""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks(transactions(spark, sf_dir), [("blank_merchant", "error", F.trim("merchant") == ""), ("amount_range", "error", ~((F.col("amount") > 0) & (F.col("amount") < 50_000_000))), ("date_before_order", "warning", F.col("used_date") < F.col("order_date")), ("many_people", "warning", F.col("people") > 40)])


@query(f"WITH {TX} SELECT institution, count(*) AS rows, count(*) FILTER (used_date >= order_date)::DOUBLE / count(*) AS dated, count(*) FILTER (tier <= 2)::DOUBLE / count(*) AS high FROM tx GROUP BY institution")
def coverage_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(transactions(spark, sf_dir), ["institution"], {"dated": F.col("used_date") >= F.col("order_date"), "high": F.col("tier") <= 2})


@query(f"""WITH {TX}, n AS (SELECT origin, institution, count(*) AS n FROM tx GROUP BY ALL) SELECT origin, institution, n, row_number() OVER (PARTITION BY origin ORDER BY n DESC, institution) AS rank FROM n QUALIFY rank <= 7""")
def coverage_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven institutions of each region with most rows."""
    return top_values(transactions(spark, sf_dir), ["origin"], "institution", 7)


@query("""WITH s AS (SELECT s_suppkey AS suppkey FROM supplier), d AS (SELECT p_partkey % 97 AS suppkey, count(*) AS c FROM part GROUP BY 1), l AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_suppkey % 9 <> 0 GROUP BY 1), i AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_suppkey % 9 <> 0 AND year(l_shipdate) >= 1997 GROUP BY 1),
    p AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 9 NOT IN (0, 1) GROUP BY 1), k AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_quantity > 49 AND l_suppkey % 9 NOT IN (0, 1, 2) GROUP BY 1),
    a AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_quantity > 49 AND l_discount > 0.09 AND l_suppkey % 9 > 3 GROUP BY 1), b AS (SELECT l_suppkey AS suppkey, count(*) AS c FROM lineitem WHERE l_quantity > 49 AND l_tax > 0.07 AND l_suppkey % 9 > 4 GROUP BY 1),
    f AS (SELECT suppkey, coalesce(d.c, 0) AS discovered, coalesce(l.c, 0) AS raw, coalesce(i.c, 0) AS in_period, coalesce(p.c, 0) AS leadership, coalesce(k.c, 0) AS candidates, coalesce(a.c, 0) AS publishable, coalesce(b.c, 0) AS published
      FROM s LEFT JOIN d USING (suppkey) LEFT JOIN l USING (suppkey) LEFT JOIN i USING (suppkey) LEFT JOIN p USING (suppkey) LEFT JOIN k USING (suppkey) LEFT JOIN a USING (suppkey) LEFT JOIN b USING (suppkey))
    SELECT *, CASE WHEN publishable > 0 AND published = 0 THEN 'PUBLISH_PIPELINE_REVIEW' WHEN leadership >= 10 AND candidates = 0 THEN 'CANDIDATE_BUILD_REVIEW' WHEN raw >= 100 AND leadership = 0 THEN 'ROLE_OR_SOURCE_SCOPE_REVIEW'
      WHEN raw = 0 AND discovered > 0 THEN 'INGESTION_REVIEW' WHEN raw = 0 THEN 'DISCOVERY_REVIEW' WHEN candidates = 0 THEN 'NO_CANDIDATES' WHEN published = 0 THEN 'BELOW_PUBLICATION_THRESHOLDS' ELSE 'PUBLISHED' END AS diagnosis FROM f""", name="health_funnel")
def supplier_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven counts of each supplier, from discovered to published, and what they say."""
    c, k = F.col, F.col("l_suppkey") % 9
    large = c("l_quantity") > 49
    steps = {
        "raw": k != 0, "in_period": (k != 0) & (F.year("l_shipdate") >= 1997), "leadership": (c("l_returnflag") == "R") & ~k.isin(0, 1), "candidates": large & ~k.isin(0, 1, 2),
        "publishable": large & (c("l_discount") > 0.09) & (k > 3), "published": large & (c("l_tax") > 0.07) & (k > 4),
    }
    parts = table(spark, sf_dir, "part").select((c("p_partkey") % 97).alias("suppkey"))
    lines = table(spark, sf_dir, "lineitem").withColumn("suppkey", c("l_suppkey"))
    return health_funnel(table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("suppkey")), [(parts, {"discovered": F.lit(True)}), (lines, steps)], "suppkey")


@query("""WITH s AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'UPDATED' WHEN 'O' THEN 'NO_CHANGE' ELSE 'STALE_OK:QUALITY' END AS status FROM orders)
    SELECT count(*) FILTER (status = 'UPDATED') AS updated, count(*) FILTER (status = 'NO_CHANGE') AS no_change, count(*) FILTER (starts_with(status, 'STALE_OK')) AS stale, count(*) FILTER (starts_with(status, 'FAILED')) AS failed,
    CASE WHEN stale + failed = count(*) AND count(*) > 0 THEN 'FAILED' WHEN stale + failed > 0 THEN 'DEGRADED' ELSE 'OK' END AS health FROM s""", name="health_rollup")
def order_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("o_orderstatus")
    return health_rollup(table(spark, sf_dir, "orders").select(F.when(s == "F", "UPDATED").when(s == "O", "NO_CHANGE").otherwise("STALE_OK:QUALITY").alias("status")))


_GRADE = "CASE WHEN quality IS NULL THEN 'F' WHEN toxic = 1 THEN 'D' WHEN quality = 1 AND n_chars >= 500 THEN 'A' WHEN quality = 1 THEN 'B' ELSE 'C' END"


@query(f"SELECT doc_id, {_GRADE} AS grade FROM documents LEFT JOIN labels USING (doc_id)")
def grade_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of documents by their labels and length."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select("doc_id", ladder([(F.col("quality").isNull(), "F"), (F.col("toxic") == 1, "D"), ((F.col("quality") == 1) & (F.col("n_chars") >= 500), "A"), (F.col("quality") == 1, "B")], "C").alias("grade"))


@query("""WITH o AS (SELECT c_nationkey, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS good FROM customer GROUP BY 1), w AS (SELECT c_nationkey, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS good FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') GROUP BY 1)
    SELECT c_nationkey, 'n' AS measure, o.n::DOUBLE AS before, coalesce(w.n, 0)::DOUBLE AS after, coalesce(w.n, 0) >= 0.5 * o.n AS ok FROM o LEFT JOIN w USING (c_nationkey)
    UNION ALL SELECT c_nationkey, 'good', o.good::DOUBLE, coalesce(w.good, 0)::DOUBLE, coalesce(w.good, 0) >= 0.6 * o.good FROM o LEFT JOIN w USING (c_nationkey)""")
def regression_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and good rows of each nation against half and 60 % of what they were."""
    c = table(spark, sf_dir, "customer")
    agg = lambda df: df.groupBy("c_nationkey").agg(F.count("*").alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("good"))
    return floors(agg(c), agg(c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"))), ["c_nationkey"], {"n": 0.5, "good": 0.6})


@query(f"""WITH {TX}, g AS (SELECT merchant, count(DISTINCT origin) AS origins, count(DISTINCT address) AS addresses, count(*) AS n FROM tx GROUP BY merchant HAVING count(DISTINCT origin) >= 2)
    SELECT merchant, origins, addresses, n, CASE WHEN addresses = 1 THEN 'HIGH' WHEN addresses = 2 THEN 'REVIEW' ELSE 'AMBIGUOUS' END AS confidence, CASE WHEN addresses = 1 THEN 0 WHEN addresses = 2 THEN 1 ELSE 2 END AS confidence_rank FROM g""")
def confidence_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in several regions, and how sure it is that they are one place."""
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    g = transactions(spark, sf_dir).groupBy("merchant").agg(few("origin").alias("origins"), few("address").alias("addresses"), F.count("*").alias("n")).where("origins >= 2")
    a = F.col("addresses")
    return g.withColumn("confidence", F.when(a == 1, "HIGH").when(a == 2, "REVIEW").otherwise("AMBIGUOUS")).withColumn("confidence_rank", F.when(a == 1, 0).when(a == 2, 1).otherwise(2))


_M = "m AS (SELECT merchant, count(*) AS v, count(DISTINCT institution) AS inst, count(DISTINCT origin) AS orig, count(DISTINCT substr(used_date, 1, 7)) AS mon, sum(amount)::BIGINT AS spend, max(CASE WHEN address = 'ECONOMY' THEN 1 ELSE 0 END) AS addr, least(count(DISTINCT role), 3) AS ev FROM tx GROUP BY merchant)"


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = lambda c: F.size(F.collect_set(c)).cast("long")
    return transactions(spark, sf_dir).groupBy("merchant").agg(
        F.count("*").alias("v"), few("institution").alias("inst"), few("origin").alias("orig"), few(F.substring("used_date", 1, 7)).alias("mon"),
        F.sum("amount").alias("spend"), F.max(F.when(F.col("address") == "ECONOMY", 1).otherwise(0)).alias("addr"), F.least(few("role"), F.lit(3)).alias("ev"),
    )


@query(f"""WITH {TX}, {_M}, s AS (SELECT merchant, round_even(22::DOUBLE * ln(1::DOUBLE + v) + 14 * least(5, inst - 1) + 18 * least(4, orig - 1) + 3 * least(12, mon) + 2::DOUBLE * ln(1::DOUBLE + spend / 100000::DOUBLE) + 18 * addr + 5 * ev, 2) AS priority FROM m)
    SELECT *, row_number() OVER (ORDER BY priority DESC, merchant) AS rank FROM s QUALIFY rank <= 200""")
def map_gap_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 200 merchants whose missing place matters most."""
    c = F.col
    p = 22.0 * F.log(1.0 + c("v").cast("double")) + 14 * F.least(F.lit(5), c("inst") - 1) + 18 * F.least(F.lit(4), c("orig") - 1) + 3 * F.least(F.lit(12), c("mon")) + 2.0 * F.log(1.0 + c("spend") / F.lit(100000.0)) + 18 * c("addr") + 5 * c("ev")
    return top_k(_measures(spark, sf_dir).select("merchant", F.bround(p, 2).alias("priority")), [F.desc("priority"), F.col("merchant")], 200)


@query(f"""WITH {TX}, {_M} SELECT merchant, (CASE WHEN addr = 0 THEN 40 ELSE 0 END + CASE WHEN ev < 2 THEN 10 ELSE 0 END + CASE WHEN orig < 2 THEN 5 ELSE 0 END + CASE WHEN mon < 2 THEN 4 ELSE 0 END)
    + 1.5::DOUBLE * least(v, 50) + 9 * least(inst, 5) AS priority FROM m""")
def enrichment_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a merchant's record lacks, weighed with how much it is used."""
    c = F.col
    gaps = F.when(c("addr") == 0, 40).otherwise(0) + F.when(c("ev") < 2, 10).otherwise(0) + F.when(c("orig") < 2, 5).otherwise(0) + F.when(c("mon") < 2, 4).otherwise(0)
    return _measures(spark, sf_dir).select("merchant", (gaps + 1.5 * F.least(c("v"), F.lit(50)) + 9 * F.least(c("inst"), F.lit(5))).alias("priority"))
