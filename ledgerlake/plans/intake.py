"""Registered queries over files and streams that are written from the given tables: source states, CSV, paged services."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.publishing import SourcePointers
from ledgerlake.plans.registry import query, table
from ledgerlake.sources.files import json_rows
from ledgerlake.storage import materialize, shared_folder
from ledgerlake.streaming.arrivals import latest_snapshot, merge_arrivals, retry_list
from ledgerlake.streaming.states import PROVIDER, current_states, source_states, status_class, write_states

_ROW = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
_STEPS = ["DISCOVERY", "INGEST", "CANDIDATE", "VALIDATION"]


def refreshes(events: DataFrame) -> DataFrame:
    """Events as outcomes of refreshes: a purchase is a success, an error or a sign-up a failure of some step."""
    kind, i = F.col("event_type"), F.col("event_id")
    outcome = F.when(kind == "purchase", "UPDATED").when(kind.isin("error", "signup"), "FAILED").otherwise("NO_CHANGE")
    step = F.get(F.array(*map(F.lit, _STEPS)), (i % 4).cast("int"))
    return events.select(F.concat(F.lit("s"), F.col("user_id").cast("string")).alias("source"), F.col("ts").cast("timestamp").alias("at"), i.alias("id"), outcome.alias("outcome"), step.alias("step"), (i % 11 != 0).alias("valid"), F.concat(F.lit("u"), (i % 7).cast("string")).alias("url"))


@query("""WITH e AS (
        SELECT 's' || user_id AS source, ts AS t, event_id AS id, CASE WHEN event_type = 'purchase' THEN 'UPDATED' WHEN event_type IN ('error', 'signup') THEN 'FAILED' ELSE 'NO_CHANGE' END AS outcome,
            ['DISCOVERY', 'INGEST', 'CANDIDATE', 'VALIDATION'][event_id % 4 + 1] AS step, event_id % 11 <> 0 AS valid, 'u' || (event_id % 7) AS url FROM events),
    l AS (SELECT *, count(*) FILTER (outcome = 'UPDATED') OVER (PARTITION BY source ORDER BY t, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 AS good, count(*) OVER (PARTITION BY source) AS events
        FROM e QUALIFY row_number() OVER (PARTITION BY source ORDER BY t DESC, id DESC) = 1),
    u AS (SELECT source, url, max((t, id)) FILTER (outcome = 'FAILED') AS f, max((t, id)) FILTER (outcome <> 'FAILED') AS d FROM e GROUP BY ALL),
    w AS (SELECT source, count(*) AS waiting, string_agg(url, ',' ORDER BY f DESC) AS retry FROM u WHERE f IS NOT NULL AND (d IS NULL OR f > d) GROUP BY source),
    s AS (SELECT source, CASE WHEN outcome = 'UPDATED' THEN 'UPDATED' WHEN good AND NOT valid THEN 'FAILED:BASELINE_INVALID' WHEN outcome = 'NO_CHANGE' THEN CASE WHEN good THEN 'NO_CHANGE' ELSE 'FAILED:NO_BASELINE' END
        WHEN good THEN 'STALE_OK:' || step ELSE 'FAILED:' || step END AS status, events FROM l)
    SELECT source, status, CASE WHEN status = 'UPDATED' THEN 'updated' WHEN status = 'NO_CHANGE' THEN 'no_change' WHEN starts_with(status, 'STALE_OK') THEN 'stale_last_good' ELSE 'failed' END AS class,
        events, coalesce(waiting, 0) AS waiting, coalesce(retry, '') AS retry FROM s LEFT JOIN w USING (source)""", name="source_states")
def source_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states that a stream of all events ends in, with the addresses each source has to try again."""
    name = "spark.sql.streaming.stateStore.providerClass"
    arrived = materialize(refreshes(table(spark, sf_dir, "events")), "refreshes")
    folder = f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", 64).parquet(arrived._ledgerlake_path)
        write_states(source_states(stream), f"{folder}/rows", f"{folder}/checkpoint").awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    last = current_states(spark.read.parquet(f"{folder}/rows"))
    return last.select("source", "status", status_class(F.col("status")).alias("class"), "events", "waiting", F.array_join("retry", ",").alias("retry"))


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT s_suppkey AS k, s_name AS v FROM supplier", name="json_envelopes")
def envelopes_of_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers written as JSON documents, an array of rows for each nation, and read again with a fixed schema."""
    row = F.struct(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"))
    documents = table(spark, sf_dir, "supplier").groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000)).agg(F.collect_list(row).alias("rows"))
    whole = _folder(spark, "envelopes")
    text = F.to_json(F.struct(F.lit(1).alias("schema_version"), "rows"))
    documents.select(text.alias("value"), F.xxhash64(text).cast("string").alias("d")).write.partitionBy("d").text(whole)
    return json_rows(spark, f"{whole}/*/*.txt", _ROW)


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(*) AS keys FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY event_type", name="merged_arrivals")
def arrivals_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by event type, merged by a stream that comes in two runs and repeats rows; each key is there once."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    folder = _folder(spark, "arrivals")
    for part in ("event_id % 3 <> 0", "event_id % 3 <> 1"):
        rows.where(part).repartition(4, "user_id").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        merge_arrivals(stream, f"{folder}/merged", f"{folder}/checkpoint", ["user_id", "event_type"], ["event_id"]).awaitTermination()
    return latest_snapshot(spark, f"{folder}/merged").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count("*").alias("keys"))


@query("""WITH r AS (SELECT 'u' || (event_id % 997) AS url, event_type, max(event_id) AS id FROM events GROUP BY ALL),
    f AS (SELECT url, id FROM r WHERE event_type = 'error' AND url NOT IN (SELECT url FROM r WHERE event_type = 'purchase' AND id % 2 = 0)) SELECT url, id FROM f ORDER BY id DESC, url LIMIT 100""", name="retry_addresses")
def addresses_to_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred latest failures of addresses that were not read since."""
    r = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("u"), (F.col("event_id") % 997).cast("string")).alias("url"), "event_type").agg(F.max("event_id").alias("id"))
    failed = r.where("event_type = 'error'").select("url", "id")
    return retry_list(failed.where("id % 2 = 0"), failed.where("id % 2 = 1"), r.where("event_type = 'purchase' AND id % 2 = 0"), "url", ["id"])


@query("""SELECT 'n' || n_nationkey AS source, coalesce(nullif(count(*) FILTER (n_nationkey % 3 = 0 AND c_custkey % 2 = 0), 0), count(*)) AS rows FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_nationkey < 6 GROUP BY n_nationkey""", name="source_pointers")
def published_by_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of six nations published as versions of six sources; for every third a second version, if it has rows, holds half of them."""
    folder = _folder(spark, "pointers")
    pointers = SourcePointers(spark, f"{folder}/now")
    customers = table(spark, sf_dir, "customer").where("c_nationkey < 6")
    for version, rows in ((1, customers), (2, customers.where("c_nationkey % 3 = 0 AND c_custkey % 2 = 0"))):
        rows.withColumn("nation", F.col("c_nationkey")).write.partitionBy("nation").parquet(f"{folder}/v{version}")
        names = [r["c_nationkey"] for r in rows.select("c_nationkey").distinct().collect()]
        pointers.change({f"n{n}": f"{folder}/v{version}/nation={n}" for n in names})
    return pointers.read().groupBy("source").agg(F.count("*").alias("rows"))
