"""Joins with conditions, entity resolution, duplicates, snapshots and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.text import compact, row_id
from ledgerlake.functions.similarity import match_ratio
from ledgerlake.operators.components import connected_components
from ledgerlake.operators.entities import entity_id, resolve_entities
from ledgerlake.operators.filters import pass_thresholds
from ledgerlake.operators.joins import close_pairs, duplicates_elsewhere, forward_fill, in_boxes, longest_prefix, unique_index, with_fallback
from ledgerlake.operators.merging import carry_forward, first_wins, last_wins, merge_conflicts, merge_new, moved_rows, replace_partitions, snapshot_diff
from ledgerlake.operators.rollups import candidates
from ledgerlake.functions.numbers import score, score_sql
from ledgerlake.plans.registry import MEASURES, PLAUSIBLE, TX, query, table, transactions, written
from ledgerlake.storage import materialize


@query(f"""WITH {TX}, lookup AS (SELECT family, branch, min(p_type) AS v FROM (SELECT p_name AS family, p_brand AS branch, p_type FROM part WHERE p_size <= 5) GROUP BY ALL),
    broad AS (SELECT p_name AS family, min(p_type) AS v FROM part WHERE p_size = 50 GROUP BY p_name), m AS (SELECT DISTINCT family, branch FROM tx)
    SELECT m.family, m.branch, coalesce(l.v, b.v, 'none') AS label FROM m LEFT JOIN lookup l USING (family, branch) LEFT JOIN broad b ON m.family = b.family""")
def override_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label given for (name, branch), else for the name, else none."""
    part = table(spark, sf_dir, "part")
    exact = part.where("p_size <= 5").select(F.col("p_name").alias("family"), F.col("p_brand").alias("branch"), F.col("p_type").alias("label"))
    broad = part.where("p_size = 50").select(F.col("p_name").alias("family"), F.lit(None).cast("string").alias("branch"), F.col("p_type").alias("label"))
    merchants = transactions(spark, sf_dir).select("family", "branch").distinct()
    return with_fallback(merchants, exact.unionByName(broad), [["family", "branch"], ["family"]], "label", F.lit("none"))


@query("""WITH i AS (SELECT p_name, p_brand, min(p_type) AS k FROM part GROUP BY ALL HAVING count(DISTINCT p_type) = 1)
    SELECT p_partkey, k AS match FROM part LEFT JOIN i USING (p_name, p_brand)""")
def unique_match_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key only where (name, brand) has exactly one."""
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", "p_name", "p_brand").join(unique_index(part, ["p_name", "p_brand"], "p_type").withColumnRenamed("p_type", "match"), ["p_name", "p_brand"], "left").select("p_partkey", "match")


@query(f"""WITH {TX}, i AS (SELECT merchant, min(address) AS k FROM tx WHERE people >= 45 GROUP BY merchant HAVING count(DISTINCT address) = 1 AND count(DISTINCT origin) >= 2)
    SELECT orderkey, line, partkey, suppkey, merchant, k FROM tx JOIN i USING (merchant)""")
def corroborated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of merchants whose large events name one address from two or more origins."""
    tx = transactions(spark, sf_dir)
    index = unique_index(tx, ["merchant"], "address", F.col("people") >= 45, "origin", 2).withColumnRenamed("address", "k")
    return tx.join(index, "merchant").select("orderkey", "line", "partkey", "suppkey", "merchant", "k")


_ENTITY = """r AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS origin, replace(p_name, ' ', '') AS family,
      replace(p_name, ' ', '') || CASE WHEN p_size % 5 = 0 THEN '점' ELSE '' END || p_size % 7 AS strict,
      CASE WHEN p_size % 4 = 0 THEN lower(p_type) || p_size % 2 ELSE '' END AS building, CASE WHEN p_size % 6 < 2 THEN lower(p_type) ELSE '' END AS place, p_size % 4 AS institutions FROM part),
    own AS (SELECT *, family || '||' || building AS own FROM r WHERE family <> '' AND building <> ''),
    i1 AS (SELECT family, place, min(own) AS k1 FROM own WHERE place <> '' GROUP BY ALL HAVING count(DISTINCT own) = 1),
    i2 AS (SELECT family, min(own) AS k2 FROM own WHERE origin <> '' AND length(family) >= 4 GROUP BY family HAVING count(DISTINCT own) = 1 AND count(DISTINCT origin) >= 2),
    i3 AS (SELECT strict, min(own) AS k3 FROM own GROUP BY strict HAVING count(DISTINCT own) = 1),
    c AS (SELECT r.*, k1, k2, k3 FROM r LEFT JOIN i1 USING (family, place) LEFT JOIN i2 USING (family) LEFT JOIN i3 USING (strict)),
    e AS (SELECT id, CASE WHEN building <> '' THEN 'address' WHEN place <> '' AND k1 IS NOT NULL THEN 'place' WHEN place = '' AND k2 IS NOT NULL THEN 'origins'
      WHEN place = '' AND k3 IS NOT NULL AND institutions >= 2 AND length(strict) >= 6 THEN 'name' WHEN place <> '' AND length(family) >= 4 THEN 'family_place' ELSE 'single' END AS basis,
      CASE basis WHEN 'address' THEN family || '||' || building WHEN 'place' THEN k1 WHEN 'origins' THEN k2 WHEN 'name' THEN k3 WHEN 'family_place' THEN family || '||locality:' || place
      ELSE 'single||' || regexp_replace(lower(name), '[^0-9a-z]', '', 'g') || '||' || regexp_replace(lower(origin), '[^0-9a-z]', '', 'g') END AS entity_key FROM c)"""


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, size = table(spark, sf_dir, "part"), F.col("p_size")
    flat = F.replace(F.col("p_name"), F.lit(" "), F.lit(""))
    r = p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.when(size % 3 == 0, F.col("p_brand")).otherwise("").alias("origin"), flat.alias("family"),
        F.concat(flat, F.when(size % 5 == 0, "점").otherwise(""), (size % 7).cast("string")).alias("strict"),
        F.when(size % 4 == 0, F.concat(F.lower("p_type"), (size % 2).cast("string"))).otherwise("").alias("building"),
        F.when(size % 6 < 2, F.lower("p_type")).otherwise("").alias("place"), (size % 4).alias("institutions"),
    )
    return resolve_entities(r)


@query(f"WITH {_ENTITY} SELECT id, basis, entity_key, substr(sha1(entity_key), 1, 16) AS entity_id FROM e")
def entity_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of each record's entity and the rule that gave it."""
    return _entities(spark, sf_dir).select("id", "basis", "entity_key", entity_id().alias("entity_id"))


_KEY = ["merchant", "cohort", "role", "people"]


@query(f"""WITH {TX}, f AS (SELECT DISTINCT orderkey, line, partkey, suppkey, {', '.join(_KEY)}, institution, substr(used_date, 1, 4) <> substr(order_date, 1, 4) AS outside FROM tx)
    SELECT a.orderkey, a.line, a.partkey, a.suppkey, a.merchant, a.institution, b.institution AS other_institution, b.orderkey AS other_orderkey FROM f a JOIN f b ON NOT b.outside AND a.institution <> b.institution
    AND {' AND '.join(f'a.{k} = b.{k}' for k in _KEY)} WHERE a.outside QUALIFY count(*) OVER (PARTITION BY a.orderkey, a.line, a.partkey, a.suppkey, {', '.join('a.' + k for k in _KEY)}, a.institution) = 1""")
@written
def cross_duplicate_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows outside their period with exactly one row in its period of the same economic key at another institution."""
    tx = transactions(spark, sf_dir).withColumn("outside", F.substring("used_date", 1, 4) != F.substring("order_date", 1, 4))
    rows = tx.select("orderkey", "line", "partkey", "suppkey", *_KEY, "institution", "outside").distinct()
    rows = materialize(rows, "duplicate_rows")  # read for both sides: the joins run once
    found = duplicates_elsewhere(rows, _KEY, "institution", "outside", ["orderkey"])
    return found.select("orderkey", "line", "partkey", "suppkey", "merchant", "institution", "other_institution", "other_orderkey")


@query(f"""WITH {TX}, g AS (SELECT used_date, family, people, count(*) AS n, min(orderkey) AS first_order, max(orderkey) AS last_order FROM tx GROUP BY ALL HAVING count(*) > 1 AND min(orderkey) < max(orderkey)) SELECT * FROM g""")
def near_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one date, name and size in several orders, as groups: no pairs are listed."""
    g = transactions(spark, sf_dir).groupBy("used_date", "family", "people").agg(F.count("*").alias("n"), F.min("orderkey").alias("first_order"), F.max("orderkey").alias("last_order"))
    return g.where("n > 1 AND first_order < last_order")


_OLD = "CASE WHEN c_custkey % 11 = 0 THEN 'FORMER' ELSE c_mktsegment END"


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    old = c.where("c_custkey % 7 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 11 == 0, "FORMER").otherwise(F.col("c_mktsegment")))
    return old, c.where("c_custkey % 5 <> 0")


_PAIR = f"o AS (SELECT c_custkey, c_name, {_OLD} AS seg FROM customer WHERE c_custkey % 7 <> 0), n AS (SELECT c_custkey, c_name, c_mktsegment AS seg FROM customer WHERE c_custkey % 5 <> 0)"


@query(f"WITH {_PAIR} SELECT c_custkey, CASE WHEN n.seg IS NULL THEN 'lost' WHEN o.seg IS NULL THEN 'added' ELSE 'changed' END AS change FROM o FULL JOIN n USING (c_custkey) WHERE o.seg IS DISTINCT FROM n.seg")
def snapshot_diff_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return snapshot_diff(old, new, ["c_custkey"], ["c_name", "c_mktsegment"])


@query(f"WITH {_PAIR} SELECT c_custkey FROM o JOIN n USING (c_custkey) WHERE o.seg <> n.seg", name="merge_conflicts")
def merge_conflict_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return merge_conflicts(old, new, ["c_custkey"], ["c_name", "c_mktsegment"])


@query(f"WITH {_PAIR} SELECT c_custkey, c_name, seg AS c_mktsegment FROM o UNION ALL SELECT c_custkey, c_name, seg FROM n ANTI JOIN o USING (c_custkey)")
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known rows stay, rows with new keys come in."""
    return merge_new(*_snapshots(spark, sf_dir), ["c_custkey"])


@query(f"WITH {_PAIR} SELECT c_custkey, c_name, seg AS c_mktsegment, false AS carried FROM n UNION ALL SELECT c_custkey, c_name, seg, true FROM o ANTI JOIN n USING (c_custkey)")
def lineage_last_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current rows, and those of the last good snapshot that are gone from them."""
    old, new = _snapshots(spark, sf_dir)
    return carry_forward(new, old, ["c_custkey"])


@query("""WITH o AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_acctbal > 0), n AS (SELECT c_custkey, c_nationkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
    t AS (SELECT c_nationkey FROM (SELECT c_nationkey, count(*) AS b FROM n GROUP BY 1) LEFT JOIN (SELECT c_nationkey, count(*) AS a FROM o GROUP BY 1) USING (c_nationkey) WHERE a IS NULL OR b >= 0.85 * a)
    SELECT c_custkey, c_nationkey, true AS refreshed FROM n SEMI JOIN t USING (c_nationkey) UNION ALL SELECT c_custkey, c_nationkey, false FROM o ANTI JOIN t USING (c_nationkey)""")
def partition_replace_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations refreshed where at least 85 % of their rows are there again."""
    c = table(spark, sf_dir, "customer")
    return replace_partitions(c.where("c_acctbal > 0").select("c_custkey", "c_nationkey"), c.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_nationkey"), "c_nationkey", 0.85)


@query(f"""WITH {_ENTITY}, o AS (SELECT id, entity_key AS k FROM e), n AS (SELECT p_partkey AS id, p_name || '||' || p_brand AS k FROM part WHERE p_size > 25 UNION ALL SELECT id, entity_key FROM e JOIN part ON id = p_partkey WHERE p_size <= 25)
    SELECT o.id AS key, o.k AS old_entity, n.k AS new_entity FROM o JOIN n USING (id) WHERE o.k <> n.k""", name="moved_keys")
def moved_record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose entity is another one than before."""
    e = _entities(spark, sf_dir).select("id", "entity_key")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size", F.concat_ws("||", "p_name", "p_brand").alias("other"))
    new = e.join(p, "id").withColumn("entity_key", F.when(F.col("p_size") > 25, F.col("other")).otherwise(F.col("entity_key")))
    return moved_rows(e, new, "entity_key", "id")


@query("""SELECT * FROM (SELECT p_name AS name, p_brand AS origin, p_partkey AS id, 0 AS t FROM part WHERE p_size % 2 = 0 UNION ALL SELECT p_name, p_brand, p_partkey, 1 FROM part WHERE p_size % 3 = 0 UNION ALL SELECT p_name, p_brand, p_partkey, 2 FROM part)
    QUALIFY row_number() OVER (PARTITION BY name, origin ORDER BY t, id) = 1""")
def union_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three cohorts one after the other; the first row of each (name, origin) stays."""
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_brand").alias("origin"), F.col("p_partkey").alias("id"), "p_size")
    cohorts = [c.drop("p_size").withColumn("t", F.lit(i)) for i, c in enumerate((p.where("p_size % 2 = 0"), p.where("p_size % 3 = 0"), p))]
    return first_wins(cohorts, ["name", "origin"], ["id"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) = 1")
def dedupe_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return last_wins(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]).drop("l_shipdate")


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY at_) AS types FROM (SELECT user_id, event_type, min(event_id) AS at_ FROM events GROUP BY ALL) GROUP BY user_id")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of each user in the order of their first event."""
    first = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("at"))
    return first.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "event_type")))["event_type"], ",").alias("types"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 10)")
def known_key_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no larger line is known of."""
    known = table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(known, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query(f"""WITH {TX}, c AS (SELECT family, origin, {MEASURES} FROM tx WHERE {PLAUSIBLE} GROUP BY ALL), s AS (SELECT *, {score_sql('council')} AS score FROM c),
    t AS (SELECT r_name AS origin, 4 + r_regionkey AS v, 3 AS m, 50.0 + 5 * r_regionkey AS sc FROM region)
    SELECT family, origin, visits, months, score FROM s JOIN t USING (origin) WHERE visits >= v AND months >= m AND score >= sc""")
def threshold_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that reach the thresholds of their origin."""
    c = candidates(transactions(spark, sf_dir).where("NOT (amount > 0 AND people >= 2 AND amount / people < 1000)"), ["family", "origin"]).withColumn("score", score("council"))
    specs = table(spark, sf_dir, "region").select(F.col("r_name").alias("origin"), (4 + F.col("r_regionkey")).alias("min_visits"), F.lit(3).alias("min_months"), (50.0 + 5 * F.col("r_regionkey")).alias("min_score"))
    return pass_thresholds(c, specs, "origin", ["visits", "months", "score"]).select("family", "origin", "visits", "months", "score")


@query("""WITH routes AS (SELECT DISTINCT substr(p_brand, 1, 7) AS prefix, 'short' AS kind FROM part UNION ALL SELECT DISTINCT p_brand || ' e', 'long' FROM part WHERE p_size > 25),
    t AS (SELECT p_partkey, p_brand || ' ' || lower(p_type) AS address FROM part)
    SELECT p_partkey, address, prefix, kind FROM t LEFT JOIN routes ON starts_with(address, prefix) QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(prefix) DESC) = 1""")
def prefix_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each address with its longest known prefix."""
    p = table(spark, sf_dir, "part")
    short = p.select(F.substring("p_brand", 1, 7).alias("prefix"), F.lit("short").alias("kind")).distinct()
    long = p.where("p_size > 25").select(F.concat("p_brand", F.lit(" e")).alias("prefix"), F.lit("long").alias("kind")).distinct()
    texts = p.select("p_partkey", F.concat_ws(" ", F.col("p_brand"), F.lower("p_type")).alias("address"))
    return longest_prefix(texts, short.union(long), "address")


_POINTS = "pt AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label FROM embeddings)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"), "label")


@query(f"WITH {_POINTS} SELECT vec_id, label, x, y FROM pt WHERE label IS NOT NULL AND x BETWEEN -0.02 * (label % 5 + 1) AND 0.05 * (label % 3 + 1) AND y BETWEEN -0.1 AND 0.1")
def bbox_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in the box of their label."""
    p = _points(spark, sf_dir)
    k = F.col("label")
    boxes = p.select("label").distinct().select("label", (-0.02 * (k % 5 + 1)).alias("xmin"), (0.05 * (k % 3 + 1)).alias("xmax"), F.lit(-0.1).alias("ymin"), F.lit(0.1).alias("ymax"))
    return in_boxes(p, boxes, ["label"], "x", "y").select("vec_id", "label", "x", "y")


RADIUS = 0.004


@query(f"WITH {_POINTS} SELECT a.vec_id AS a, b.vec_id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance FROM pt a JOIN pt b ON a.vec_id < b.vec_id WHERE distance <= {RADIUS}", name="close_pairs")
def close_point_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points closer than a radius, by cells of its size."""
    return close_pairs(_points(spark, sf_dir), "vec_id", "x", "y", RADIUS)


@query(f"""WITH RECURSIVE {_POINTS}, p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM pt a JOIN pt b ON a.vec_id <> b.vec_id WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= {RADIUS}),
    w AS (SELECT DISTINCT a AS node, a AS seen FROM p UNION SELECT w.node, p.b FROM w JOIN p ON w.seen = p.a) SELECT node, min(seen) AS component FROM w GROUP BY node""")
def geo_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of points that chains of close pairs join."""
    return connected_components(close_pairs(_points(spark, sf_dir), "vec_id", "x", "y", RADIUS))


@query("""SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 0 THEN role END IGNORE NULLS) OVER w AS carried, CASE WHEN turn % 3 <> 0 OR role IS NULL THEN carried IS NOT NULL ELSE false END AS carried_inferred
    FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST ROWS UNBOUNDED PRECEDING)""", name="forward_fill")
def forward_filled_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles given on every third turn only, carried on."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role").distinct().withColumn("given", F.when(F.col("turn") % 3 == 0, F.col("role")))
    return forward_fill(c, ["conv_id"], ["turn", "role"], "given", "carried").select("conv_id", "turn", "carried", "carried_inferred")


@query("SELECT l_orderkey, l_linenumber, l_partkey, substr(sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || coalesce(nullif(l_returnflag, 'N'), '') ), 1, 20) AS row_id FROM lineitem")
def row_id_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", row_id(["l_orderkey", "l_linenumber", "l_partkey", F.nullif(F.col("l_returnflag"), F.lit("N"))]).alias("row_id"))


@query()
def similar_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merchants of one address type and brand whose names are alike, by the sequence-matching ratio of 0.6 or more.

    The ratio is no SQL function; the names compared share a building key, so groups are small."""
    p = table(spark, sf_dir, "part").select("p_type", "p_brand", compact("p_name").alias("name")).distinct()
    x, y = p.withColumnRenamed("name", "a"), p.withColumnRenamed("name", "b")
    return x.join(y, ["p_type", "p_brand"]).where("a < b").withColumn("ratio", match_ratio("a", "b")).where("ratio >= 0.6")
