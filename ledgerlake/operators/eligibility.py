"""Which candidates a cohort lets through, what counts as a transaction, what a record lacks, and merges that must not be."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import to_date
from ledgerlake.functions.text import ladder, text
from ledgerlake.functions.web import trusted
from ledgerlake.operators.gates import GateError
from ledgerlake.operators.merging import content_hash, first_wins
from ledgerlake.operators.ranking import first_mode, top_k, top_values

# The cohorts' thresholds, over their measures and the score of the same name.
ELIGIBLE = {
    "central": "visits >= 2 AND months >= 1 AND score_central >= 45 AND (senior_weight >= 0.65 OR institutions >= 2)",
    "gyeonggi": "visits >= 3 AND departments >= 2 AND months >= 2 AND score_gyeonggi >= 45",
    "incheon": "visits >= 2 AND months >= 1 AND score_incheon >= 45 AND (head_visits >= 1 OR roles >= 2)",
    "justice": "high_visits >= 1 AND (visits >= 2 OR top_weight >= 0.85) AND score_justice >= 30",
    "enterprise": "visits >= 1 AND score_enterprise >= 25",
    "seoul_executive": "visits >= 3 AND months >= 2",
    "seoul_destination": "place >= 0.65 AND visits >= 2 AND months >= 2",
    "legislator": "visits >= 3 AND members >= 2 AND months >= 2 AND score_legislator >= 35",
}
# Merchants that are none, and where a role must come from.
NO_MERCHANT = ["", "-", "미상", "사용처", "장소", "비공개", "카드"]
ROLE_SOURCES = ["posting_title", "source_heading"]
# What stands against an entity on the map, and the least number of approved ones.
GAP_STATUS = [
    "APPROVED_VENUE_ADDRESS_NEEDS_SAFE_COORDINATE", "PUBLISHED_ADDRESS_NEEDS_GEOCODE_OR_IDENTITY_REVIEW",
    "OFFICIAL_EXPENSE_SOURCE_MUST_BE_CHECKED_FOR_ADDRESS", "MISSING_ADDRESS_AND_TRACEABLE_SOURCE",
]
LEAST_APPROVED = 50


def eligible(cohort: str) -> Column:
    """Whether a candidate's measures pass the thresholds of a cohort; a missing measure does not."""
    return F.coalesce(F.expr(ELIGIBLE[cohort]), F.lit(False))


def valid_transaction(date: Column, amount: Column, url: Column, merchant: Column, role: Column, role_source: Column, hosts: list[str], today: Column | None = None) -> Column:
    """Whether a row can be published: a day from 2000 to today, a whole amount above 0, a merchant, an official host, and a
    role that a title or heading names. Rows with a missing part cannot."""
    day = to_date(date)
    tests = [
        F.year(day) >= 2000, F.year(day) <= F.year(today if today is not None else F.current_date()), F.coalesce(amount.try_cast("bigint"), F.lit(0)) > 0,
        ~F.coalesce(text(merchant), F.lit("")).isin(NO_MERCHANT), trusted(url, hosts), F.coalesce(text(role), F.lit("")) != "", text(role_source).isin(ROLE_SOURCES),
    ]
    return reduce(lambda a, b: a & b, (F.coalesce(t, F.lit(False)) for t in tests))


def in_months(date: Column, since: tuple[int, int], until: tuple[int, int]) -> Column:
    """Whether a date written as 20YY-MM-DD lies in the months from since to until, each (year, month)."""
    month = F.regexp_extract(F.coalesce(date, F.lit("")), r"^(20\d{2}-\d{2})-\d{2}", 1)
    return month.between(*(f"{y:04d}-{m:02d}" for y, m in (since, until)))


def counted_candidates(tx: DataFrame, by: list[str], measures: list[Column], mode: str, counters: dict[str, int], first: tuple[str, list[str]] | None = None) -> DataFrame:
    """One row for each group: measures, the mode of a column, the k most frequent values of others as arrays of (value, n),
    and the first filled value of a column by an order. Each counter is grouped by value before its values meet."""
    extra = [F.min_by(first[0], F.when(F.coalesce(F.col(first[0]), F.lit("")) != "", F.struct(*first[1]))).alias(f"first_{first[0]}")] if first else []
    out = tx.groupBy(*by).agg(*measures, *extra)
    out = out.join(first_mode(tx.where(F.col(mode) != ""), by, mode, mode, f"{mode}_mode").select(*by, f"{mode}_mode"), by, "left")
    for column, k in counters.items():
        best = top_values(tx.where(F.coalesce(F.col(column), F.lit("")) != ""), by, column, k)
        lists = best.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col(column).alias("value"), "n"))), lambda r: F.struct(r["value"].alias("value"), r["n"].alias("n"))).alias(f"top_{column}"))
        out = out.join(lists, by, "left")
    return out


def gap_priority(visits: Column, institutions: Column, origins: Column, months: Column, spend: Column, address: Column, evidence: Column, links: Column) -> Column:
    """How much an entity's missing place matters: strong use by independent offices first; what eases a review adds a little."""
    log = lambda c: F.log(1.0 + c.cast("double"))
    flag = lambda c, n: F.when(c, n).otherwise(0)
    return F.bround(
        22.0 * log(visits) + 14 * F.least(F.lit(5), institutions - 1) + 18 * F.least(F.lit(4), origins - 1) + 3 * F.least(F.lit(12), months) + 2.0 * log(spend / F.lit(100000.0))
        + flag(address, 18) + flag(evidence, 5) + flag(links, 5), 2)


def gap_status(address: Column, evidence: Column, links: Column, basis: Column) -> Column:
    return ladder([(address & evidence & basis, GAP_STATUS[0]), (address, GAP_STATUS[1]), (links, GAP_STATUS[2])], GAP_STATUS[3])


def enrichment_priority(lacks: dict[str, Column], signal: Column, visits: Column, institutions: Column, digits: int = 1) -> Column:
    """What a record lacks (address, category, phone, url), weighed with its signal and its use; to some digits, half to even."""
    weights = {"address": 40, "category": 10, "phone": 5, "url": 4}
    gaps = reduce(lambda a, b: a + b, (F.when(lacks[k], w).otherwise(0) for k, w in weights.items()))
    return F.bround(gaps + signal * 0.65 + F.least(visits, F.lit(50)) * 1.5 + F.least(institutions, F.lit(5)) * 9, digits)


def approved(graded: DataFrame, passes: Column, order: list[Column], most: int = 80, least: int = LEAST_APPROVED) -> DataFrame:
    """The first `most` rows that pass; raises GateError if fewer than `least` do."""
    found = top_k(graded.where(passes), order, most)
    if (n := found.count()) < min(least, most):
        raise GateError(f"{n} approved rows of {least} at least")
    return found


def without_known(df: DataFrame, known: DataFrame, blocked: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """df without rows whose key is known or blocked; of rows with one key the first by order. Keys are compared trimmed."""
    flat = lambda t: t.select(*(F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(f"_{k}") for k in key)).distinct()
    named = df.select("*", *(F.trim(F.coalesce(F.col(k).cast("string"), F.lit(""))).alias(f"_{k}") for k in key))
    keys = [f"_{k}" for k in key]
    return first_wins([named.join(flat(known).union(flat(blocked)), keys, "left_anti")], keys, order).select(*df.columns)


def merged_or_raised(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new that it lacks; the job that reads the result fails if a key is missing, comes twice in old,
    or comes with another content. Equal rows of new count once. Content is compared by hash, columns are those of old."""
    rows = lambda t, n: t.select(F.col(key).alias("_key"), content_hash(sorted(old.columns)).alias("_hash"), F.struct(*old.columns).alias("_row"), F.lit(n).alias("_table"))
    both = rows(old, 0).unionByName(rows(new, 1)).groupBy("_key").agg(
        F.min("_hash").alias("_low"), F.max("_hash").alias("_high"), F.count_if(F.col("_table") == 0).alias("_old"), F.min_by("_row", "_table").alias("_row"))
    failed = (
        F.when(F.col("_key").isNull(), F.raise_error(F.lit(f"a row has no {key}"))).when(F.col("_old") > 1, F.raise_error(F.concat(F.lit(f"{key} twice: "), F.col("_key").cast("string"))))
        .when(F.col("_low") != F.col("_high"), F.raise_error(F.concat(F.lit(f"conflicting {key}: "), F.col("_key").cast("string"))))
    )
    return both.where(F.coalesce(failed.cast("string"), F.lit("")) == "").select("_row.*")


def unsafe_merges(old: DataFrame, new: DataFrame, address: Column) -> DataFrame:
    """(entity, previous, addresses): entities that join several earlier ones whose addresses differ.

    old and new have (entity, source_key), old also what `address` reads; an earlier entity belongs to every new one that
    has one of its source keys."""
    before = old.select(F.col("entity").alias("_before"), "source_key", F.nullif(address, F.lit("")).alias("_address"))
    met = before.join(new.select("entity", "source_key"), "source_key").select("entity", "_before", "_address").distinct()
    groups = met.groupBy("entity").agg(F.count_distinct("_before").alias("previous"), F.count_distinct("_address").alias("addresses"))
    return groups.where("previous > 1 AND addresses > 1")


def snapshots_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows only in the first table, only in the second, and whether both hold the same rows as often."""
    counts = lambda t, n: t.groupBy(F.sha2(F.to_json(F.struct(*sorted(t.columns)), {"ignoreNullFields": "false"}), 256).alias("h")).agg(F.count("*").alias(n))
    both = counts(a, "x").join(counts(b, "y"), "h", "full").select(F.coalesce("x", F.lit(0)).alias("x"), F.coalesce("y", F.lit(0)).alias("y"))
    over = lambda p, q: F.coalesce(F.sum(F.greatest(F.col(p) - F.col(q), F.lit(0))), F.lit(0))
    return both.agg(over("x", "y").alias("only_first"), over("y", "x").alias("only_second")).withColumn("equal", (F.col("only_first") == 0) & (F.col("only_second") == 0))


def compact_record(lists: dict[str, str], texts: list[str], whole: list[str], decimals: list[str]) -> list[Column]:
    """Columns of a report's record: lists fall back to a single value, texts to '', numbers to 0."""
    one = lambda c: F.coalesce(text(F.col(c)), F.lit(""))
    filled = [F.when(F.size(F.coalesce(F.col(name), F.array().cast("array<string>"))) > 0, F.col(name)).when(one(single) != "", F.array(one(single))).otherwise(F.array().cast("array<string>")).alias(name) for name, single in lists.items()]
    return [*filled, *(one(c).alias(c) for c in texts), *(F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in whole), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in decimals)]
