"""Candidates: aggregates, scores, ranks, modes, recent events, quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import is_evening, score, score_sql, share
from ledgerlake.functions.text import first_label
from ledgerlake.operators.filters import plausible
from ledgerlake.operators.ranking import best_rows, first_mode, global_rank, quota, recent_list, top_k, top_values
from ledgerlake.operators.rollups import candidates, memberships, merged_evidence, merged_signal, tier_counts, two_level
from ledgerlake.plans.registry import MEASURES, PLAUSIBLE, TX, query, table, transactions

TOP = 100


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).where(plausible(F.col("amount"), F.col("people")))


def _candidates_sql(by: str = "merchant, address", more: str = "") -> str:
    return f"c AS (SELECT {by}, {MEASURES}{more} FROM tx WHERE {PLAUSIBLE} GROUP BY {by})"


def _first(order: str, k: int = TOP, source: str = "s") -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM {source} QUALIFY rank <= {k}"


@query(f"WITH {TX}, {_candidates_sql()}, s AS (SELECT *, {score_sql('council')} AS score FROM c) {_first('score DESC, visits DESC, merchant, address')}")
def candidate_rank_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 best merchants by the council score."""
    scored = candidates(_valid(spark, sf_dir), ["merchant", "address"]).withColumn("score", score("council"))
    return top_k(scored, [F.desc("score"), F.desc("visits"), F.col("merchant"), F.col("address")], TOP)


_LOG = ["central", "gyeonggi", "incheon", "justice", "enterprise", "seoul_executive", "seoul_destination", "legislator", "prosecution", "destination"]
#: Measures of the transaction view that stand for those of the scores.
_STAND_IN = {"departments": "institutions", "members": "customers", "actors": "roles", "weight": "high_share", "senior": "senior_share", "high": "high_share", "outside": "high_share", "place": "high_share"}


@query(f"""WITH {TX}, {_candidates_sql(more=", count(DISTINCT suppkey) AS customers, count(*) FILTER (tier <= 2)::DOUBLE / count(*) AS high_share, count(*) FILTER (tier = 1)::DOUBLE / count(*) AS senior_share")}
    SELECT merchant, address, {', '.join(f'{score_sql(n, _STAND_IN)} AS score_{n}' for n in _LOG)} FROM c""")
def candidate_rank_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All logarithmic scores of every merchant."""
    more = {"customers": F.count_distinct("suppkey"), "high_share": share(F.count_if(F.col("tier") <= 2), F.count("*")), "senior_share": share(F.count_if(F.col("tier") == 1), F.count("*"))}
    c = candidates(_valid(spark, sf_dir), ["merchant", "address"], **more)
    return c.select("merchant", "address", *(score(n, _STAND_IN).alias(f"score_{n}") for n in _LOG))


@query(f"WITH {TX} SELECT merchant, {', '.join(f'count(*) FILTER (tier = {t}) AS tier_{t}' for t in range(1, 6))} FROM tx GROUP BY merchant")
def conditional_tier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_counts(transactions(spark, sf_dir), ["merchant"], "tier", [1, 2, 3, 4, 5])


@query(f"WITH {TX} SELECT merchant, max(6 - tier) AS top_weight, min_by(role, tier) AS top_role, coalesce(count(*) FILTER (tier <= 2)::DOUBLE / count(*), 0) AS high_ratio FROM tx GROUP BY merchant")
def argmax_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The role with the largest weight of each merchant, and the share of high ones."""
    weight = 6 - F.col("tier")
    return transactions(spark, sf_dir).groupBy("merchant").agg(F.max(weight).alias("top_weight"), F.max_by("role", F.struct(weight, "role")).alias("top_role"), share(F.count_if(F.col("tier") <= 2), F.count("*")).alias("high_ratio"))


@query(f"""WITH {TX}, n AS (SELECT family, branch, count(*) AS n, min(orderkey * 8 + line) AS at_ FROM tx GROUP BY family, branch)
    SELECT family, branch AS mode, n FROM n QUALIFY row_number() OVER (PARTITION BY family ORDER BY n DESC, at_, branch) = 1""")
def mode_first_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).withColumn("at", F.col("orderkey") * 8 + F.col("line"))
    return first_mode(tx, ["family"], "branch", "at")


@query(f"WITH {TX}, n AS (SELECT institution, family, count(*) AS n FROM tx GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY institution ORDER BY n DESC, family) AS rank FROM n QUALIFY rank <= 5")
def topk_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_values(transactions(spark, sf_dir), ["institution"], "family", 5)


@query("""WITH k AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events QUALIFY k <= 8)
    SELECT user_id, string_agg(event_id::VARCHAR || ':' || event_type, ',' ORDER BY k) AS recent FROM k GROUP BY user_id""")
def recent_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight latest events of each user."""
    found = recent_list(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], 8, ["event_id", "event_type"])
    return found.select("user_id", F.array_join(F.transform("recent", lambda s: F.concat_ws(":", s["event_id"], s["event_type"])), ",").alias("recent"))


@query(f"""WITH {TX}, p AS (SELECT family, address, institution, count(*) AS v, sum(amount)::BIGINT AS s FROM tx GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY family, address ORDER BY v DESC, s DESC, institution) AS k FROM p)
    SELECT family, address, sum(v)::BIGINT AS visits, sum(s)::BIGINT AS spend, count(*) AS parts, string_agg(institution || ':' || v || ':' || s, ',' ORDER BY k) FILTER (k <= 12) AS top FROM k GROUP BY ALL""")
def two_level_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = two_level(transactions(spark, sf_dir), ["family", "address"], "institution", 12)
    return out.withColumn("top", F.array_join(F.transform("top", lambda s: F.concat_ws(":", s["part"], s["visits"], s["spend"])), ","))


_RULES = [(["ring", "bolt"], "metal"), (["widget", "gear"], "machine"), (["small"], "small goods")]
_LABEL = "CASE WHEN contains(family, 'ring') OR contains(family, 'bolt') THEN 'metal' WHEN contains(family, 'widget') OR contains(family, 'gear') THEN 'machine' WHEN contains(family, 'small') THEN 'small goods' ELSE 'unknown' END"


@query(f"WITH {TX}, {_candidates_sql('family, branch')}, s AS (SELECT *, {score_sql('council')} AS score, {_LABEL} AS alias FROM c) SELECT alias, max(score) AS score, sum(visits)::BIGINT AS visits, max(months) AS months FROM s GROUP BY alias")
def alias_rerollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates under one canonical name: largest score, summed visits, largest months."""
    c = candidates(_valid(spark, sf_dir), ["family", "branch"]).withColumn("score", score("council"))
    return c.groupBy(first_label(F.col("family"), _RULES, "unknown").alias("alias")).agg(F.max("score").alias("score"), F.sum("visits").alias("visits"), F.max("months").alias("months"))


_RECORDS = f"""r AS (SELECT family, origin, count(*) AS visits, sum(amount)::BIGINT AS spend, count(DISTINCT substr(used_date, 1, 7)) AS months,
    min(used_date) AS date_min, max(used_date) AS date_max, min(tier) AS tier, count(*) FILTER (evening) AS evening, count(DISTINCT institution) AS institutions,
    count(DISTINCT cohort) AS cohorts FROM tx WHERE {PLAUSIBLE} GROUP BY family, origin)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record for each family and origin."""
    return _valid(spark, sf_dir).groupBy("family", "origin").agg(
        F.count("*").alias("visits"), F.sum("amount").alias("spend"), F.size(F.collect_set(F.substring("used_date", 1, 7))).cast("long").alias("months"),
        F.min("used_date").alias("date_min"), F.max("used_date").alias("date_max"), F.min("tier").alias("tier"), F.count_if("evening").alias("evening"),
        F.size(F.collect_set("institution")).cast("long").alias("institutions"), F.size(F.collect_set("cohort")).cast("long").alias("cohorts"),
    )


@query(f"WITH {TX}, {_RECORDS} SELECT family, sum(visits)::BIGINT AS visits, sum(spend)::BIGINT AS spend, max(months) AS months, min(date_min) AS date_min, max(date_max) AS date_max, string_agg(origin, ',' ORDER BY origin) AS origins, count(*) AS records FROM r GROUP BY family")
def evidence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_evidence(_records(spark, sf_dir), ["family"]).withColumn("origins", F.array_join("origins", ","))


@query(f"""WITH {TX}, {_RECORDS}, s AS (SELECT *, {score_sql('gyeonggi', {'departments': 'institutions'})} AS score FROM r)
    SELECT family, arg_min(origin, (-score, origin)) AS origin, max(score) AS score, sum(visits)::BIGINT AS visits, sum(evening)::BIGINT AS evening FROM s GROUP BY family""")
def signal_argmax_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest record of each family, with summed counters."""
    r = _records(spark, sf_dir).withColumn("score", score("gyeonggi", {"departments": "institutions"}))
    return merged_signal(r.select("family", "origin", "score", "visits", "evening"), ["family"], ["visits", "evening"], ["origin"])


@query(f"WITH {TX}, {_RECORDS} SELECT family, origin, visits, spend, tier FROM r QUALIFY row_number() OVER (PARTITION BY family ORDER BY tier, visits DESC, months DESC, spend DESC, date_max DESC, origin) = 1")
def best_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("tier"), F.desc("visits"), F.desc("months"), F.desc("spend"), F.desc("date_max"), F.col("origin")]
    return best_rows(_records(spark, sf_dir), ["family"], order).select("family", "origin", "visits", "spend", "tier")


@query(f"""WITH {TX}, {_RECORDS}, e AS (SELECT family, count(*) AS sources, max(institutions) AS institutions, sum(visits)::BIGINT AS events, max(cohorts) AS cohorts FROM r WHERE visits > 0 GROUP BY family)
    SELECT *, CASE WHEN institutions >= 2 THEN {score_sql('consensus')} ELSE 0 END AS score, institutions >= 2 AS is_cross FROM e""")
def consensus_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus of institutions; 0 for those of one institution."""
    e = _records(spark, sf_dir).where("visits > 0").groupBy("family").agg(F.count("*").alias("sources"), F.max("institutions").alias("institutions"), F.sum("visits").alias("events"), F.max("cohorts").alias("cohorts"))
    return e.withColumn("score", F.when(F.col("institutions") >= 2, score("consensus")).otherwise(0.0)).withColumn("is_cross", F.col("institutions") >= 2)


@query(f"WITH {TX}, g AS (SELECT DISTINCT merchant, institution FROM tx) SELECT institution AS \"group\", count(*) AS entities FROM g GROUP BY institution")
def multi_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return memberships(transactions(spark, sf_dir), "merchant", F.array("institution"))


_QUOTA_ORDER = "score DESC, visits DESC, family, branch"


@query(f"""WITH {TX}, o AS (SELECT family, branch, address, count(*) AS visits, sum(amount)::BIGINT AS spend FROM tx WHERE {PLAUSIBLE} GROUP BY ALL),
    s AS (SELECT *, visits + spend / 1000000 AS score FROM o),
    g AS (SELECT *, row_number() OVER (PARTITION BY address ORDER BY {_QUOTA_ORDER}) <= 10 AS reserved FROM s),
    w AS (SELECT *, row_number() OVER (ORDER BY reserved DESC, {_QUOTA_ORDER}) AS w FROM g),
    f AS (SELECT *, CASE WHEN w <= 180 THEN 0 ELSE 1 END AS front FROM w),
    p AS (SELECT *, row_number() OVER (ORDER BY front, {_QUOTA_ORDER}, address) AS place FROM f)
    SELECT family, branch, address, visits, spend, score, reserved, place FROM p WHERE place <= 250""")
def quota_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten places for each address type, then by score up to 180, then to 250."""
    o = _valid(spark, sf_dir).groupBy("family", "branch", "address").agg(F.count("*").alias("visits"), F.sum("amount").alias("spend")).withColumn("score", F.col("visits") + F.col("spend") / 1000000)
    return quota(o, "address", [F.desc("score"), F.desc("visits"), F.col("family"), F.col("branch"), F.col("address")], 10, 180, 250, ["family", "branch", "address"])


@query(f"WITH {TX}, {_candidates_sql()}, s AS (SELECT *, {score_sql('council')} AS score FROM c) SELECT merchant, address, score, visits FROM s QUALIFY row_number() OVER (PARTITION BY merchant ORDER BY score DESC, visits DESC, address) = 1")
def best_row_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = candidates(_valid(spark, sf_dir), ["merchant", "address"]).withColumn("score", score("council"))
    return best_rows(c, ["merchant"], [F.desc("score"), F.desc("visits"), F.col("address")]).select("merchant", "address", "score", "visits")


@query(f"WITH {TX}, {_candidates_sql()}, s AS (SELECT merchant, address, visits, spend FROM c WHERE months >= 2 AND roles >= 2) SELECT *, row_number() OVER (ORDER BY spend DESC, merchant, address) AS rank FROM s")
def rank_accepted_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accepted merchants, numbered without gaps; the numbering is distributed."""
    c = candidates(_valid(spark, sf_dir), ["merchant", "address"]).where("months >= 2 AND roles >= 2").select("merchant", "address", "visits", "spend")
    return global_rank(c, [F.desc("spend"), F.col("merchant"), F.col("address")])


@query("""SELECT user_id, strftime(ts, '%Y-%m') AS month, count(*) AS events, count(*) FILTER (hour(ts) >= 17) AS evening,
    coalesce(count(*) FILTER (hour(ts) >= 17)::DOUBLE / nullif(count(*), 0), 0) AS evening_ratio FROM events GROUP BY ALL""")
def month_evening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each user and month, and the share of those from 17:00 on, from the time as text."""
    e = table(spark, sf_dir, "events").select("user_id", F.date_format("ts", "yyyy-MM").alias("month"), is_evening(F.date_format("ts", "HH:mm")).alias("late"))
    return e.groupBy("user_id", "month").agg(F.count("*").alias("events"), F.count_if("late").alias("evening"), share(F.count_if("late"), F.count("*")).alias("evening_ratio"))
