"""Reviews and audits: coordinates, licences, staged rows, curated places, release guards and roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import rules as R
from ledgerlake.functions.numbers import HOURS, haversine_km, is_evening, month_of, plane_metres
from ledgerlake.operators import review as V
from ledgerlake.operators.filters import reason_counts
from ledgerlake.operators.ranking import best_rows, first_mode, top_values
from ledgerlake.plans.registry import TX, query, table, transactions

_GEO = """g AS (SELECT c_custkey AS id, c_nationkey AS nation, c_custkey % 3 AS kind, c_nationkey % 5 = 4 AS national, c_custkey % 4 = 0 AS verified, CASE WHEN c_custkey % 3 = 0 THEN 'addr' || c_nationkey END AS target FROM customer),
    cand AS (SELECT *, o_orderkey AS geo_key, CASE o_orderkey % 3 WHEN 0 THEN 'address' ELSE 'name' END AS match_mode, CASE o_orderkey % 7 WHEN 0 THEN 'locality' WHEN 1 THEN 'district;admin' ELSE 'poi' END AS addr_type,
      'addr' || (o_orderkey % 25) AS geo_address, 'n' || (o_orderkey % 6) AS result_name, (o_totalprice::BIGINT % 100)::DOUBLE AS geo_score, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS turn FROM g JOIN orders ON o_custkey = id WHERE o_orderkey % 11 <> 0),
    b AS (SELECT *, match_mode = 'name' AND regexp_matches(addr_type, 'locality|region|country|postal|neighborhood|district|admin') AS unsafe FROM cand),
    k AS (SELECT *, CASE WHEN target IS NOT NULL AND geo_address = target THEN 'address' WHEN target IS NOT NULL AND verified AND match_mode = 'name' AND NOT unsafe AND result_name = 'n' || (id % 6) THEN 'verified_name' WHEN target IS NOT NULL THEN 'address_mismatch'
      WHEN national THEN 'national_record_without_verified_address' WHEN unsafe THEN 'name_resolved_to_geographic_locality' ELSE 'safe' END AS basis FROM b),
    s AS (SELECT id, geo_key, basis, basis IN ('address', 'verified_name', 'safe') AS good, geo_score FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY (basis IN ('address', 'verified_name', 'safe')) DESC, CASE WHEN basis = 'verified_name' THEN 1 ELSE 0 END, CASE WHEN match_mode = 'address' THEN 0 ELSE 1 END, geo_score DESC, turn) = 1)"""


def _choices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    orders = table(spark, sf_dir, "orders")
    keys = orders.groupBy(F.col("o_custkey").alias("id")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("keys"))
    records = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, F.concat(F.lit("addr"), F.col("c_nationkey"))).alias("target"), F.array(F.concat(F.lit("n"), k % 6)).alias("names"), (k % 4 == 0).alias("verified"), (F.col("c_nationkey") % 5 == 4).alias("national")).join(keys, "id")
    o = F.col("o_orderkey")
    cache = orders.select(
        o.alias("geo_key"), F.when(o % 11 != 0, o.cast("double")).alias("lat"), o.cast("double").alias("lon"), F.when(o % 3 == 0, "address").otherwise("name").alias("match_mode"), F.when(o % 7 == 0, "locality").when(o % 7 == 1, "district;admin").otherwise("poi").alias("addr_type"),
        F.concat(F.lit("addr"), o % 25).alias("geo_address"), F.concat(F.lit("n"), o % 6).alias("result_name"), (F.bround("o_totalprice").cast("bigint") % 100).cast("double").alias("geo_score"),
    )
    return V.coordinate_candidates(records, cache), records


@query(f"WITH {_GEO} SELECT id, CASE WHEN good THEN geo_key END AS geo_key, basis FROM s")
def coordinate_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cached coordinate of each record, or why it gets none."""
    return V.selected_coordinates(_choices(spark, sf_dir)[0]).select("id", "geo_key", "basis")


@query(f"""WITH {_GEO}, old AS (SELECT id, geo_key FROM cand QUALIFY row_number() OVER (PARTITION BY id ORDER BY geo_score DESC, turn) = 1), new AS (SELECT id, CASE WHEN good THEN geo_key END AS geo_key FROM s)
    SELECT id, old.geo_key AS old_choice, new.geo_key AS new_choice, CASE WHEN new.geo_key IS NULL THEN 'lost' ELSE 'moved' END AS change FROM old JOIN new USING (id) WHERE old.geo_key IS DISTINCT FROM new.geo_key""")
def coordinate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose coordinate is another one than by score alone."""
    found = _choices(spark, sf_dir)[0]
    old = best_rows(found, ["id"], [F.desc("geo_score"), F.col("turn")]).select("id", "geo_key")
    return V.changed_choices(old, V.selected_coordinates(found), "id", "geo_key")


_LIC = """v AS (SELECT p_partkey AS venue, p_name AS name_key, p_type AS address_key, p_brand AS building, CASE WHEN p_size % 9 = 0 THEN p_type || '-0@' ELSE p_type END AS address FROM part WHERE p_size % 2 = 0),
    l AS (SELECT p_partkey AS licence, p_name AS name_key, p_type AS address_key, CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS building FROM part WHERE p_size % 7 = 1)"""
_MATCH = """a AS (SELECT name_key, address_key, count(*) AS n, min(licence) AS l FROM l GROUP BY ALL), h AS (SELECT name_key, building, count(*) AS nb, min(licence) AS lb FROM l WHERE building <> '' GROUP BY ALL), w AS (SELECT building, count(*) AS neighbours FROM l WHERE building <> '' GROUP BY ALL),
    j AS (SELECT venue, address, coalesce(n, 0) AS n, coalesce(nb, 0) AS nb, l, lb, coalesce(neighbours, 0) AS neighbours FROM v LEFT JOIN a USING (name_key, address_key) LEFT JOIN h USING (name_key, building) LEFT JOIN w USING (building)),
    m AS (SELECT *, CASE WHEN n = 1 THEN 'EXACT_NAME_AND_ADDRESS' WHEN nb = 1 THEN 'NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED' WHEN CASE WHEN n > 0 THEN n ELSE nb END > 1 THEN 'AMBIGUOUS_LICENSE_RECORDS' ELSE 'NOT_MATCHED' END AS status, CASE WHEN CASE WHEN n > 0 THEN n ELSE nb END = 1 THEN CASE WHEN n > 0 THEN l ELSE lb END END AS licence FROM j)"""


def _licences(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p, s = table(spark, sf_dir, "part"), F.col("p_size")
    cols = [F.col("p_name").alias("name_key"), F.col("p_type").alias("address_key")]
    v = p.where(s % 2 == 0).select(F.col("p_partkey").alias("venue"), *cols, F.col("p_brand").alias("building"), F.when(s % 9 == 0, F.concat("p_type", F.lit("-0@"))).otherwise(F.col("p_type")).alias("address"))
    return v, p.where(s % 7 == 1).select(F.col("p_partkey").alias("licence"), *cols, F.when(s % 3 == 0, "").otherwise(F.col("p_brand")).alias("building"))


@query(f"WITH {_LIC}, {_MATCH} SELECT venue, status, licence, neighbours FROM m", name="licence_matches")
def venue_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.licence_matches(*_licences(spark, sf_dir))


@query(f"""WITH {_LIC}, {_MATCH} SELECT venue, CASE WHEN licence IS NULL OR status NOT IN ('EXACT_NAME_AND_ADDRESS', 'NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED') THEN 'OFFICIAL_LICENSE_IDENTITY_NOT_CONFIRMED' WHEN status = 'EXACT_NAME_AND_ADDRESS' THEN 'OFFICIAL_LICENSE_EXACT_ADDRESS' ELSE 'OFFICIAL_LICENSE_SAME_BUILDING_UNIT_UNVERIFIED' END AS evidence,
    CASE WHEN status = 'NOT_MATCHED' THEN CASE WHEN contains(address, '-0@') THEN 'ADDRESS_FORMAT_REVIEW' WHEN neighbours > 0 THEN 'SAME_BUILDING_NAME_REVIEW' ELSE 'NO_SAME_BUILDING_CANDIDATE' END END AS review FROM m""")
def licence_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What licences prove of venues, and why others wait for a review."""
    v, l = _licences(spark, sf_dir)
    m = V.licence_matches(v, l).join(v.select("venue", "address"), "venue")
    return m.select("venue", V.licence_evidence(F.col("status"), F.lit(True), F.col("licence").isNotNull()).alias("evidence"), F.when(F.col("status") == "NOT_MATCHED", V.review_reason(F.col("address"), F.col("neighbours"))).alias("review"))


_STAGED = """s AS (SELECT orderkey, line, partkey, suppkey, cohort, family, role, tier, amount, used_date FROM tx), m AS (SELECT DISTINCT cohort, family FROM tx WHERE people >= 48), r AS (SELECT DISTINCT c_mktsegment AS cohort FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""


@query(f"""WITH {TX}, {_STAGED}, t AS (SELECT CASE WHEN m.family IS NULL OR r.cohort IS NULL THEN 'UNVERIFIED_VENUE' WHEN contains(s.family, 'tiny') THEN 'NON_VENUE' WHEN tier > 3 THEN 'ROLE_NOT_APPROVED' WHEN orderkey % 5 = 0 THEN 'ACTOR_NOT_EXPLICIT' WHEN amount <= 0 OR used_date < '1996' THEN 'INVALID_TRANSACTION' END AS reason
    FROM s LEFT JOIN m USING (cohort, family) LEFT JOIN r USING (cohort)) SELECT coalesce(reason, 'PUBLISHED') AS reason, count(*) AS n FROM t GROUP BY 1""")
def staged_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows against the manifest of verified venues and the registry of sources."""
    tx = transactions(spark, sf_dir)
    manifest = tx.where("people >= 48").select("cohort", "family").distinct()
    registry = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("cohort")).distinct().where("cohort <> 'HOUSEHOLD'")
    rules = [("NON_VENUE", F.contains("family", F.lit("tiny"))), ("ROLE_NOT_APPROVED", F.col("tier") > 3), ("ACTOR_NOT_EXPLICIT", F.col("orderkey") % 5 == 0), ("INVALID_TRANSACTION", (F.col("amount") <= 0) | (F.col("used_date") < "1996"))]
    return reason_counts(V.staged_selection(tx, manifest, registry, "cohort", "family", rules), kept="PUBLISHED")


@query("""WITH o AS (SELECT o_orderkey AS row, o_custkey AS merchant, o_orderpriority AS role FROM orders), p AS (SELECT c_custkey AS merchant, CASE c_nationkey % 3 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' ELSE '5-LOW' END AS role, c_nationkey % 4 = 0 AS listed FROM customer WHERE c_acctbal > 0)
    SELECT row, merchant FROM o JOIN p USING (merchant, role) WHERE NOT listed OR row % 2 = 0""")
def policy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a merchant's policy lets through, for some only those on its list."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row"), F.col("o_custkey").alias("merchant"), F.col("o_orderpriority").alias("role"))
    even = o.where("row % 2 = 0").groupBy("merchant").agg(F.collect_list("row").alias("ids"))
    n = F.col("c_nationkey")
    p = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("merchant"), F.when(n % 3 == 0, "1-URGENT").when(n % 3 == 1, "2-HIGH").otherwise("5-LOW").alias("role"), (n % 4 == 0).alias("listed")).join(even, "merchant", "left")
    return V.approved_by_rule(o, p.withColumn("allowed", F.when(F.col("listed"), F.coalesce("ids", F.array().cast("array<bigint>")))), ["merchant", "role"], "row", "allowed").select("row", "merchant")


@query("""WITH g AS (SELECT p_brand AS cohort, p_name AS merchant, p_partkey, p_size, p_type FROM part WHERE p_size % 6 < 3), u AS (SELECT cohort, merchant, min(p_size) AS s, min(p_type) AS address FROM g GROUP BY ALL HAVING count(*) = 1)
    SELECT p_partkey, CASE WHEN s % 5 <> 0 AND (s % 6 = 0 OR s % 4 <> 0) THEN u.address END AS curated_address FROM part LEFT JOIN u ON p_brand = u.cohort AND p_name = u.merchant""", name="curated_places")
def curated_part_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses from a curated registry: one approved entry with sufficient evidence."""
    p, s = table(spark, sf_dir, "part"), F.col("p_size")
    second = F.when(s % 4 == 0, "https://a.example/2").otherwise("https://b.example/1")
    registry = p.where(s % 6 < 3).select(
        F.col("p_brand").alias("cohort"), F.col("p_name").alias("merchant"), F.col("p_type").alias("address"), F.when(s % 5 == 0, "PENDING").otherwise("APPROVED_VENUE_LOCATION").alias("status"),
        F.when(s % 6 == 0, "EXACT_NAMED_BRANCH_OFFICIAL_BRAND").when(s % 6 == 1, "EXACT_NAMED_BRANCH_CORROBORATED").otherwise("EXACT_NAMED_VENUE_OFFICIAL_GOVERNMENT").alias("basis"),
        F.array(F.lit("https://a.example/1"), second).alias("urls"), F.array(F.lit("a.example"), F.when(s % 4 == 0, "a.example").otherwise("b.example")).alias("hosts"),
        F.array(*map(F.lit, ["brand_official_branch_directory", "independent_food_platform", "local_government_venue_directory"])).alias("types"),
    )
    rows = p.select("p_partkey", F.col("p_brand").alias("cohort"), F.col("p_name").alias("merchant"))
    return V.curated_places(rows, registry, "cohort", "merchant").select("p_partkey", "curated_address")


@query("SELECT c_nationkey, sum(v)::BIGINT AS events, sum(0)::BIGINT AS attended, count(*) FILTER (v > 0) AS expense_only FROM (SELECT c_nationkey, (c_custkey % 4) + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS v FROM customer) GROUP BY c_nationkey")
def usage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage and expense events of nations' records; attendance is never established."""
    u = V.usage_semantics(F.col("c_custkey") % 4, F.when(F.col("c_acctbal") > 0, 1))
    c = table(spark, sf_dir, "customer").select("c_nationkey", u.alias("u")).select("c_nationkey", "u.*")
    return c.groupBy("c_nationkey").agg(F.sum("source_event_count").alias("events"), F.sum("confirmed_person_attendances").cast("bigint").alias("attended"), F.count_if(F.col("classification") == "EXPENSE_OR_USAGE_ONLY").alias("expense_only"))


_VALID = "amount > 0 AND amount < 50000000 AND used_date >= order_date"


@query(f"""WITH {TX}, n AS (SELECT institution, count(*) AS rows, count(*) FILTER ({_VALID}) AS verified_rows, count(DISTINCT orderkey * 8 + line) AS ids FROM tx GROUP BY institution), f AS (SELECT n_name AS institution, n_nationkey AS k FROM nation),
    j AS (SELECT institution, rows, verified_rows, round_even(verified_rows::DOUBLE / rows, 5) AS coverage, list_filter([CASE WHEN k % 6 = 0 THEN 'missing_official_posts_or_hashed_files' END, CASE WHEN k % 4 = 0 OR k % 6 = 0 THEN 'official_attachment_missing_parsed_file' END, CASE WHEN rows < 5 THEN 'insufficient_transaction_rows' END, CASE WHEN ids <> rows THEN 'duplicate_or_missing_row_id' END, CASE WHEN verified_rows <> rows THEN 'date_amount_or_lineage_invalid_rows' END], lambda x: x IS NOT NULL) AS f FROM n JOIN f USING (institution))
    SELECT institution, rows, verified_rows, coverage, array_to_string(list_sort(f), ',') AS failures, CASE WHEN len(f) = 0 THEN 'PUBLISH_READY' ELSE 'HOLD' END AS status FROM j""")
def publication_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which institutions' rows and files pass the strict test as a whole."""
    k = F.col("n_nationkey")
    files = table(spark, sf_dir, "nation").select(F.col("n_name").alias("institution"), F.lit(3).alias("authorized"), F.when(k % 6 == 0, 0).when(k % 4 == 0, 2).otherwise(3).alias("verified"))
    tx = transactions(spark, sf_dir).withColumn("row", F.col("orderkey") * 8 + F.col("line"))
    return V.strict_assessment(tx, ["institution"], "row", F.expr(_VALID), files)


@query("""WITH o AS (SELECT c_custkey AS entity, c_acctbal AS score, c_nationkey AS origin FROM customer WHERE c_custkey % 13 <> 0 AND c_acctbal >= 0), n AS (SELECT c_custkey AS entity, CASE WHEN c_custkey % 9 = 0 THEN c_acctbal + 1 WHEN c_custkey % 31 = 0 THEN 'nan'::DOUBLE ELSE c_acctbal END AS score, c_nationkey AS origin FROM customer WHERE c_custkey % 17 <> 0 AND c_acctbal >= -100)
    SELECT entity, CASE WHEN n.score IS NULL THEN 'entity_disappeared' WHEN isnan(n.score) OR n.score < 0 THEN 'invalid_score' WHEN o.score IS NOT NULL AND o.score <> n.score AND n.origin NOT IN (3, 5) THEN 'unrelated_score_change' END AS problem FROM o FULL JOIN n USING (entity) WHERE problem IS NOT NULL""", name="release_audit")
def customer_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Problems of a release: scores that moved elsewhere, invalid ones, entities gone."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_acctbal").alias("score"), F.col("c_nationkey").alias("origin"))
    k = F.col("entity")
    new = c.where("entity % 17 <> 0 AND score >= -100").withColumn("score", F.when(k % 9 == 0, F.col("score") + 1).when(k % 31 == 0, float("nan")).otherwise(F.col("score")))
    return V.release_audit(c.where("entity % 13 <> 0 AND score >= 0"), new, F.col("origin").isin(3, 5))


@query("""WITH j AS (SELECT c_nationkey, c_custkey % 10 <> 3 OR c_nationkey % 3 = 0 AS b, c_custkey % 8 <> 5 AS a FROM customer WHERE c_nationkey <> 9 OR c_custkey < 0 OR true), n AS (SELECT c_nationkey, count(*) FILTER (a) AS prior, count(*) FILTER (b) AS current, count(*) FILTER (a AND NOT b) AS missing FROM j WHERE a OR b GROUP BY 1) SELECT *, CASE WHEN current = 0 OR missing > 0 THEN 'HOLD' ELSE 'PASS' END AS status FROM n""")
def discovery_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that an earlier discovery had and this one lacks."""
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.col("c_name").alias("url"))
    return V.discovery_issues(c.where("c_custkey % 8 <> 5"), c.where("c_custkey % 10 <> 3 OR c_nationkey % 3 = 0"), ["c_nationkey"], "url")


@query("""SELECT c_mktsegment, c_nationkey, count(*) FILTER (c_custkey % 4 <> 0) AS routable, count(*) FILTER (c_custkey % 4 <> 0 AND c_acctbal > -500) AS confirmed,
    count(*) FILTER (c_custkey % 4 <> 0 AND c_acctbal > -500) > 0 AND count(*) FILTER (c_custkey % 4 <> 0 AND c_acctbal > -500) >= 0.8 * count(*) FILTER (c_custkey % 4 <> 0) AS ok FROM customer GROUP BY ALL""")
def jurisdiction_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.jurisdiction_confirmed(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], F.col("c_custkey") % 4 != 0, F.col("c_acctbal") > -500)


@query("""WITH r AS (SELECT n_name AS region, count(*) AS venues, count(*) FILTER (c_custkey % 3 = 0) AS ready, count(*) FILTER (c_custkey % 3 <> 0 AND c_custkey % 50 <> 1) AS missing, count(DISTINCT c_mktsegment) AS institutions FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
    s AS (SELECT *, region < 'D' AS scheduled, ready + missing = venues AS consistent FROM r) SELECT *, CASE WHEN scheduled THEN 'MONTHLY_AUDIT' WHEN ready > 0 THEN 'VERIFY_OFFICIAL_CSV_AND_JURISDICTION' ELSE 'FIX_SOURCE_ADDRESSES' END AS next_action, row_number() OVER (ORDER BY scheduled, ready DESC, institutions DESC, region) AS rank FROM s""")
def region_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations in the order in which to take them on."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    r = c.groupBy(F.col("n_name").alias("region")).agg(F.count("*").alias("venues"), F.count_if(k % 3 == 0).alias("ready"), F.count_if((k % 3 != 0) & (k % 50 != 1)).alias("missing"), F.count_distinct("c_mktsegment").alias("institutions"))
    return V.expansion_order(r, F.col("region") < "D")


@query(f"""WITH {TX}, e AS (SELECT cohort || '/' || tier AS url, merchant, institution FROM tx WHERE address NOT LIKE '%BRASS%'), n AS (SELECT DISTINCT url, merchant FROM e), c AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY url ORDER BY merchant) <= 8), x AS (SELECT url, string_agg(merchant, ',' ORDER BY merchant) AS examples FROM c GROUP BY url)
    SELECT url, count(DISTINCT merchant) AS merchants, count(DISTINCT institution) AS institutions, count(*) AS events, min(x.examples) AS examples FROM e JOIN x USING (url) GROUP BY url""")
def address_remediation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose expenses lack addresses."""
    e = transactions(spark, sf_dir).where("address NOT LIKE '%BRASS%'").withColumn("url", F.concat_ws("/", "cohort", "tier"))
    return V.missing_address_sources(e, "url", "merchant", "institution").withColumn("examples", F.array_join("examples", ","))


@query(f"""WITH {TX}, w AS (SELECT n_name AS institution, n_nationkey % 5 <> 0 AS publish FROM nation), r AS (SELECT institution, count(*) AS n FROM tx WHERE people >= 50 AND tier = 1 GROUP BY 1), m AS (SELECT DISTINCT merchant, institution FROM tx WHERE people >= 50 AND tier = 1 AND amount > 50000), c AS (SELECT institution, count(*) AS n FROM m GROUP BY 1)
    SELECT institution, publish, coalesce(r.n, 0) AS raw_rows, coalesce(c.n, 0) AS candidate_entities, CASE WHEN NOT publish THEN 'TRACK_ONLY' WHEN raw_rows = 0 THEN 'NO_RAW' WHEN candidate_entities = 0 THEN 'NO_CANDIDATES' ELSE 'HAS_CANDIDATES_NOT_PUBLISH_VERIFIED' END AS diagnosis FROM w LEFT JOIN r USING (institution) LEFT JOIN c USING (institution)""")
def institution_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered institutions with their rows and candidates."""
    rows = transactions(spark, sf_dir).where("people >= 50 AND tier = 1")
    cands = rows.where("amount > 50000").groupBy("merchant").agg(F.collect_set("institution").alias("institutions"))
    registry = table(spark, sf_dir, "nation").select(F.col("n_name").alias("institution"), (F.col("n_nationkey") % 5 != 0).alias("publish"))
    return V.source_coverage(registry, rows, cands, "institution")


@query("""WITH o AS (SELECT c_nationkey, o_orderkey AS k, CAST(round_even(o_totalprice, 0) AS BIGINT) AS amount FROM orders JOIN customer ON o_custkey = c_custkey), t AS (SELECT c_nationkey, count(*) AS rows, sum(amount)::BIGINT AS total FROM o GROUP BY 1),
    l AS (SELECT c_nationkey, count(*) FILTER (k % 7 <> 0) AS kept, count(*) FILTER (k % 7 = 0) AS excepted, sum(amount)::BIGINT AS listed FROM o WHERE c_nationkey % 6 <> 0 OR k % 10 <> 0 GROUP BY 1) SELECT *, coalesce(rows = kept + excepted AND total = listed, false) AS balanced FROM t FULL JOIN l USING (c_nationkey)""", name="ledger_balance")
def nation_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether kept and excepted rows add up to all."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", F.col("o_orderkey").alias("k"), F.bround("o_totalprice").cast("bigint").alias("amount"))
    ledger = o.where("c_nationkey % 6 <> 0 OR k % 10 <> 0").withColumn("disposition", F.when(F.col("k") % 7 == 0, "HOLD_SOURCE_PERIOD").otherwise("KEPT"))
    return V.ledger_balance(o, ledger, ["c_nationkey"], "disposition", "amount")


@query("""WITH d AS (SELECT p_brand AS doc, p_name AS name, min(p_type) AS address FROM part WHERE p_size > 10 GROUP BY ALL HAVING count(DISTINCT p_type) = 1), t AS (SELECT DISTINCT p_brand AS doc, p_name AS name FROM part WHERE p_size <= 10) SELECT doc, name, address FROM t LEFT JOIN d USING (doc, name)""", name="probed_addresses")
def document_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses that documents give for names they are asked for, where they give one only."""
    p = table(spark, sf_dir, "part").select("p_size", F.col("p_brand").alias("doc"), F.col("p_name").alias("name"), F.col("p_type").alias("address"))
    return V.probed_addresses(p.where("p_size > 10"), p.where("p_size <= 10").select("doc", "name").distinct(), "doc", "name", "address")


@query("SELECT conv_id, string_agg(coalesce(role, '-') || ':' || length(coalesce(text, '')), ',' ORDER BY turn, role NULLS FIRST, length(coalesce(text, ''))) AS results FROM conversations GROUP BY conv_id", name="caller_order")
def conversation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that come in any order, back in the caller's."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length(F.coalesce("text", F.lit(""))).alias("n"))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(V.caller_order(c, "turn", ["role", "n"]), lambda s: F.concat_ws(":", F.coalesce(s["role"], F.lit("-")), s["n"])), ",").alias("results"))


@query("""SELECT count(*) AS records, count(DISTINCT c_nationkey) AS origins, count(*) FILTER (c_acctbal > 0) AS with_balance, sum(CAST(round_even(c_acctbal, 0) AS BIGINT))::BIGINT AS balance, count(*) FILTER (c_mktsegment = 'BUILDING') AS building FROM customer""")
def payload_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row of totals that a page shows."""
    return table(spark, sf_dir, "customer").agg(F.count("*").alias("records"), F.count_distinct("c_nationkey").alias("origins"), F.count_if(F.col("c_acctbal") > 0).alias("with_balance"), F.sum(F.bround("c_acctbal").cast("bigint")).alias("balance"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("building"))


@query("""WITH g AS (SELECT CASE WHEN quality IS NULL THEN 'F' WHEN toxic = 1 THEN 'D' WHEN quality = 1 AND n_chars >= 500 THEN 'A' WHEN quality = 1 THEN 'B' ELSE 'C' END AS grade FROM documents LEFT JOIN labels USING (doc_id)) SELECT grade, count(*) AS n FROM g GROUP BY grade""")
def grade_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlake.plans.gates import grade_ladder

    return grade_ladder(spark, sf_dir).groupBy("grade").agg(F.count("*").alias("n"))


@query(f"""WITH {TX}, b AS (SELECT institution, count(*) AS staged, count(*) FILTER (tier <= 2) AS leaders, count(DISTINCT merchant) AS merchants, count(*) FILTER (amount > 100000) AS large FROM tx GROUP BY 1), n AS (SELECT institution, family, count(*) AS n, min(orderkey * 8 + line) AS at_ FROM tx GROUP BY ALL), u AS (SELECT institution, family AS usual FROM n QUALIFY row_number() OVER (PARTITION BY institution ORDER BY n DESC, at_, family) = 1)
    SELECT * FROM b JOIN u USING (institution)""")
def staging_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged rows of each institution: leaders, merchants, large amounts, the usual family."""
    tx = transactions(spark, sf_dir).withColumn("at", F.col("orderkey") * 8 + F.col("line"))
    b = tx.groupBy("institution").agg(F.count("*").alias("staged"), F.count_if(F.col("tier") <= 2).alias("leaders"), F.count_distinct("merchant").alias("merchants"), F.count_if(F.col("amount") > 100000).alias("large"))
    return b.join(first_mode(tx, ["institution"], "family", "at", "usual").drop("n"), "institution")


@query(f"""WITH {TX}, n AS (SELECT used_date, family, orderkey, line, partkey, suppkey FROM tx), g AS (SELECT used_date, family, count(*) AS n FROM n GROUP BY ALL HAVING count(*) > 1), l AS (SELECT n.*, g.n FROM n JOIN g USING (used_date, family) QUALIFY row_number() OVER (PARTITION BY used_date, family ORDER BY orderkey, line, partkey, suppkey) <= 4)
    SELECT used_date, family, n, string_agg(orderkey || '-' || line, ',' ORDER BY orderkey, line, partkey, suppkey) AS first FROM l GROUP BY ALL""")
def near_match_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one day and family with the first four of each group."""
    tx = transactions(spark, sf_dir)
    key = ["used_date", "family"]
    g = tx.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    order = ["orderkey", "line", "partkey", "suppkey"]
    l = best_rows(tx.join(g, key), key, [F.col(c) for c in order], 4)
    return l.groupBy(*key, "n").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_l")).select(*key, "n", F.array_join(F.transform("_l", lambda s: F.concat_ws("-", s["orderkey"], s["line"])), ",").alias("first"))


@query("""WITH p AS (SELECT vec_id, 33 + embedding[1]::DOUBLE AS a, 126 + embedding[2]::DOUBLE AS b, 33 + embedding[3]::DOUBLE AS c, 126 + embedding[4]::DOUBLE AS d FROM embeddings)
    SELECT vec_id, round_even(2 * 6371.0 * asin(sqrt(pow(sin(radians(c - a) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin(radians(d - b) / 2), 2))), 6) AS km, round_even(sqrt(pow((a - c) * 111320, 2) + pow((b - d) * 111320 * cos((a + c) * 3.141592653589793 / 360), 2)), 3) AS metres FROM p""")
def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of pairs of points on the sphere and in the plane."""
    x = lambda i, at: F.lit(at) + F.get("embedding", F.lit(i)).cast("double")
    p = table(spark, sf_dir, "embeddings").select("vec_id", x(0, 33.0).alias("a"), x(1, 126.0).alias("b"), x(2, 33.0).alias("c"), x(3, 126.0).alias("d"))
    c = F.col
    return p.select("vec_id", F.bround(haversine_km(c("a"), c("b"), c("c"), c("d")), 6).alias("km"), F.bround(plane_metres(c("a"), c("b"), c("c"), c("d")), 3).alias("metres"))


_TIMES = ["18:30", " 19:05", "17 :10", "9시", "18시", "23시 10분", "", "noon"]


@query("""WITH t AS (SELECT event_id, strftime(ts, '%Y-%m') AS month, event_id % 8 AS i FROM events) SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE month END AS month, i IN (0, 4, 5) AS council, i IN (0, 1, 4, 5) AS published, i IN (0, 1) AS city FROM t""")
def evening_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evening flags as the three kinds of sources read times, and months of dates that are given in full."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    time = F.element_at(F.array(*map(F.lit, _TIMES)), (k % 8).cast("int") + 1)
    day = F.when(k % 3 == 0, F.date_format("ts", "yyyy.MM")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return e.select("event_id", month_of(day).alias("month"), *(is_evening(time, 17, kind).alias(kind) for kind in HOURS))


_BUILD = ["동일로 131-0@", "동일로 131-0", "세종대로 110", "효원로307번길 7-2 3층", "번지 없음", ""]


@query("""SELECT o_orderkey AS k, ['11|동일로131', '11|동일로131-0', '11|세종대로110', '11|효원로307번길7-2', '', ''][CAST(o_orderkey % 6 AS INT) + 1] AS building, ['동일로1310', '동일로1310', '세종대로110', '효원로307번길723층', '번지없음', ''][CAST(o_orderkey % 6 AS INT) + 1] AS licence,
    CASE WHEN o_orderkey % 6 = 5 THEN o_orderpriority ELSE ['동일로 131-0@', '동일로 131-0', '세종대로 110', '효원로307번길 7-2 3층', '번지 없음', ''][CAST(o_orderkey % 6 AS INT) + 1] END AS filled, o_orderkey % 6 <> 5 AND o_orderkey % 6 <> 4 AND o_orderkey % 6 = 2 AS met FROM orders""")
def building_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building and licence keys of addresses, the first filled of two columns, and names that contain one another."""
    o = table(spark, sf_dir, "orders")
    a = F.element_at(F.array(*map(F.lit, _BUILD)), (F.col("o_orderkey") % 6).cast("int") + 1)
    return o.select(F.col("o_orderkey").alias("k"), R.building_of(F.lit("11"), a).alias("building"), R.licence_key(a).alias("licence"), R.first_filled(a, F.col("o_orderpriority")).alias("filled"), R.names_meet(F.lit("(주)세종대로"), a).alias("met"))


@query(f"""WITH {TX}, n AS (SELECT institution, address, count(*) AS n FROM tx GROUP BY ALL) SELECT institution, address, n, row_number() OVER (PARTITION BY institution ORDER BY n DESC, address) AS rank FROM n QUALIFY rank <= 3""")
def payment_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three addresses that each institution paid at most often."""
    return top_values(transactions(spark, sf_dir), ["institution"], "address", 3)
