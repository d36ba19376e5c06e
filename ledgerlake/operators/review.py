"""Evidence reviews: coordinates, licences, staged rows against policies, curated places, and audits that hold a release."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.numbers import share
from ledgerlake.functions.text import ladder
from ledgerlake.operators.filters import with_reason
from ledgerlake.operators.joins import unique_index
from ledgerlake.operators.ranking import best_rows, ranked

# Kinds of geocoder answers that are places and no venues, and what a review says of them.
PLACE_TYPES = "locality|region|country|postal|neighborhood|district|admin"
NATIONAL = ["대한민국", "전국"]
NATIONAL_COHORTS = ["central_executive", "national_legislator"]


def coordinate_candidates(records: DataFrame, cache: DataFrame) -> DataFrame:
    """Cached answers with coordinates for each record: records (id, keys, ...) by every key of theirs, in their order, each once."""
    keyed = records.select("*", F.posexplode("keys").alias("turn", "geo_key")).drop("keys")
    first = keyed.groupBy("id", "geo_key").agg(F.min("turn").alias("turn"))
    have = cache.where("lat IS NOT NULL AND lon IS NOT NULL")
    return records.drop("keys").join(first, "id").join(have, "geo_key")


def selected_coordinates(candidates: DataFrame) -> DataFrame:
    """(id, geo_key, lat, lon, basis) of the answer chosen for each record, and (id, basis) of those that get none.

    candidates: id, turn, geo_key, lat, lon, match_mode, addr_type, geo_address, result_name, geo_score, target (address
    key of the record), names (keys of its names), verified (whether a review is sure of its address), national.
    With a target: the answer at that address, by address before by name, higher scores first; else, if verified, an
    answer by name whose name is one of the record's. Without: none for national records; else an answer that is no
    place, in the same order. Equal ones go by the record's order of keys."""
    by_name = F.lower("match_mode") == "name"
    unsafe = by_name & F.lower(F.coalesce("addr_type", F.lit(""))).rlike(PLACE_TYPES)
    has_target = F.coalesce("target", F.lit("")) != ""
    exact = by_name & ~unsafe & (F.col("result_name") != "") & F.array_contains("names", F.col("result_name"))
    basis = ladder([
        (has_target & (F.col("geo_address") == F.col("target")), "address"), (has_target & F.col("verified") & exact, "verified_name"), (has_target, "address_mismatch"),
        (F.col("national"), "national_record_without_verified_address"), (unsafe, "name_resolved_to_geographic_locality"),
    ], "safe")
    marked = candidates.withColumn("basis", basis).withColumn("_good", F.col("basis").isin("address", "verified_name", "safe"))
    order = [F.desc("_good"), F.when(F.col("basis") == "verified_name", 1).otherwise(0), F.when(F.col("match_mode") == "address", 0).otherwise(1), F.desc(F.coalesce("geo_score", F.lit(0.0))), F.col("turn")]
    best = best_rows(marked, ["id"], order)
    keep = lambda c: F.when(F.col("_good"), F.col(c)).alias(c)
    return best.select("id", keep("geo_key"), keep("lat"), keep("lon"), "basis")


def changed_choices(old: DataFrame, new: DataFrame, key: str, choice: str) -> DataFrame:
    """Records whose choice differs between two selections: gained, lost or moved."""
    both = old.select(key, F.col(choice).alias("old_choice")).join(new.select(key, F.col(choice).alias("new_choice")), key, "full")
    kind = F.when(F.col("old_choice").isNull() & F.col("new_choice").isNotNull(), "gained").when(F.col("new_choice").isNull() & F.col("old_choice").isNotNull(), "lost").when(F.col("old_choice") != F.col("new_choice"), "moved")
    return both.withColumn("change", kind).where("change IS NOT NULL")


def licence_matches(venues: DataFrame, licences: DataFrame) -> DataFrame:
    """venues (venue, name_key, address_key, building) with what official licences (licence, name_key, address_key,
    building) say: EXACT_NAME_AND_ADDRESS, NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED, AMBIGUOUS_LICENSE_RECORDS or NOT_MATCHED,
    the one licence that matches, and how many businesses its building has.

    Licences are joined by equal keys and counted; a name with very many licences is aggregated before it meets venues."""
    named = licences.groupBy("name_key", "address_key").agg(F.count("*").alias("n"), F.min("licence").alias("l"))
    housed = licences.where("building <> ''").groupBy("name_key", "building").agg(F.count("*").alias("nb"), F.min("licence").alias("lb"))
    neighbours = licences.where("building <> ''").groupBy("building").agg(F.count("*").alias("neighbours"))
    v = venues.join(named, ["name_key", "address_key"], "left").join(housed, ["name_key", "building"], "left").join(neighbours, "building", "left")
    n, nb = F.when(F.col("address_key") != "", F.coalesce("n", F.lit(0))).otherwise(0), F.coalesce("nb", F.lit(0))
    pool = F.when(n > 0, n).otherwise(nb)
    # fixed values: the labels of matches, here and below
    status = ladder([(n == 1, "EXACT_NAME_AND_ADDRESS"), (nb == 1, "NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED"), (pool > 1, "AMBIGUOUS_LICENSE_RECORDS")], "NOT_MATCHED")
    licence = F.when(pool == 1, F.when(n > 0, F.col("l")).otherwise(F.col("lb")))
    return v.select("venue", status.alias("status"), licence.alias("licence"), F.coalesce("neighbours", F.lit(0)).alias("neighbours"))


def licence_evidence(status: Column, sourced: Column, complete: Column) -> Column:
    """What a match proves: exact address, same building, or no identity; never more than its source is worth."""
    legal = sourced & complete & status.isin("EXACT_NAME_AND_ADDRESS", "NAME_AND_BUILDING_ADDRESS_FLOOR_UNVERIFIED")
    return F.when(~legal, "OFFICIAL_LICENSE_IDENTITY_NOT_CONFIRMED").when(status == "EXACT_NAME_AND_ADDRESS", "OFFICIAL_LICENSE_EXACT_ADDRESS").otherwise("OFFICIAL_LICENSE_SAME_BUILDING_UNIT_UNVERIFIED")


def review_reason(address: Column, neighbours: Column) -> Column:
    return F.when(F.contains(address, F.lit("-0@")), "ADDRESS_FORMAT_REVIEW").when(neighbours > 0, "SAME_BUILDING_NAME_REVIEW").otherwise("NO_SAME_BUILDING_CANDIDATE")


def staged_selection(rows: DataFrame, manifest: DataFrame, registry: DataFrame, source: str, merchant: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """Staged rows with the first reason against publishing them, null for those that may.

    manifest has one row for each (source, merchant), registry one for each source; a row without both is unverified.
    The rules may use the columns of all three."""
    known = rows.join(manifest.withColumn("_v", F.lit(True)), [source, merchant], "left").join(registry.withColumn("_s", F.lit(True)), source, "left")
    return with_reason(known, [("UNVERIFIED_VENUE", F.col("_v").isNull() | F.col("_s").isNull()), *rules]).drop("_v", "_s")


def approved_by_rule(rows: DataFrame, policy: DataFrame, on: list[str], row_id: str, allowed: str) -> DataFrame:
    """Rows that one of a policy's rules lets through: equal in `on`, and on the rule's list of row ids where it has one."""
    residual = F.col(allowed).isNull() | F.array_contains(F.col(allowed), F.col(row_id))
    met = rows.join(policy.select(*on, allowed), on).where(residual).select(*rows.columns)
    return met.dropDuplicates([row_id])


def curated_places(records: DataFrame, registry: DataFrame, cohort: str, merchant: str) -> DataFrame:
    """Records with the address of the one approved registry entry of their cohort and merchant.

    registry: cohort, merchant, address, status, basis, urls, hosts, types. An entry needs two https addresses; its basis must be
    met: a brand's own directory, or two hosts of which one is an independent listing, or a government's directory and two hosts."""
    one = registry.groupBy(cohort, merchant).agg(F.count("*").alias("_n"), *(F.first(c).alias(c) for c in registry.columns if c not in (cohort, merchant))).where("_n = 1").drop("_n")
    hosts = F.size(F.array_distinct("hosts"))
    has = lambda t: F.array_contains("types", t)
    basis = (
        ((F.col("basis") == "EXACT_NAMED_BRANCH_OFFICIAL_BRAND") & has("brand_official_branch_directory"))
        | ((F.col("basis") == "EXACT_NAMED_BRANCH_CORROBORATED") & (hosts >= 2) & (has("independent_food_platform") | has("business_company_profile")))
        | ((F.col("basis") == "EXACT_NAMED_VENUE_OFFICIAL_GOVERNMENT") & (hosts >= 2) & has("local_government_venue_directory"))
    )
    sound = (F.col("status") == "APPROVED_VENUE_LOCATION") & (F.col("address") != "") & (F.size("urls") >= 2) & F.forall("urls", lambda u: u.rlike("^https://[^/?#]"))
    good = one.where(sound & basis).select(cohort, merchant, F.col("address").alias("curated_address"), F.col("basis").alias("curated_basis"))
    return records.join(good, [cohort, merchant], "left")


def usage_semantics(visits: Column, spending: Column) -> Column:
    """What counters of events say: usage and expenses, and never that a person was there."""
    v, s = F.coalesce(visits, F.lit(0)), F.coalesce(spending, F.lit(0))
    return F.struct(
        (v + s).alias("source_event_count"), F.lit(0).alias("confirmed_person_attendances"), F.lit("NOT_ESTABLISHED").alias("personal_attendance_status"),
        F.when(v + s > 0, "EXPENSE_OR_USAGE_ONLY").otherwise("UNSPECIFIED").alias("classification"),
    )


def strict_assessment(rows: DataFrame, by: list[str], row_id: str, valid: Column, files: DataFrame, least: int = 5) -> DataFrame:
    """For each source: rows, valid rows, coverage, failures and PUBLISH_READY or HOLD.

    files: by, and how many official files are authorised, parsed and verified. A source is ready only if every row is valid,
    ids are unique, no file is missing and there are `least` rows."""
    n = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(valid).alias("verified_rows"), F.count_distinct(row_id).alias("_ids"))
    j = n.join(files, by, "left")
    none = F.coalesce("verified", F.lit(0)) == 0
    # fixed values: the labels of failures
    failures = F.array_compact(F.array(
        F.when(none, "missing_official_posts_or_hashed_files"), F.when(F.coalesce("authorized", F.lit(0)) != F.coalesce("verified", F.lit(0)), "official_attachment_missing_parsed_file"),
        F.when(F.col("rows") < least, "insufficient_transaction_rows"), F.when(F.col("_ids") != F.col("rows"), "duplicate_or_missing_row_id"), F.when(F.col("verified_rows") != F.col("rows"), "date_amount_or_lineage_invalid_rows"),
    ))
    out = j.select(*by, "rows", "verified_rows", F.bround(share(F.col("verified_rows"), F.col("rows")), 5).alias("coverage"), F.array_join(F.array_sort(failures), ",").alias("failures"))
    return out.withColumn("status", F.when(F.col("failures") == "", "PUBLISH_READY").otherwise("HOLD"))


def release_audit(old: DataFrame, new: DataFrame, refreshed: Column) -> DataFrame:
    """(entity, problem) of a release: scores that changed outside the refreshed origins, scores that are negative or no
    numbers, and entities that are gone. old and new: entity, score, origin; refreshed tests a joined row."""
    both = old.select("entity", F.col("score").alias("old_score"), F.col("origin").alias("old_origin")).join(new, "entity", "full")
    problem = ladder([
        (F.col("score").isNull() & F.col("old_score").isNotNull(), "entity_disappeared"), (F.isnan("score") | (F.abs("score") == float("inf")) | (F.col("score") < 0), "invalid_score"),
        (F.col("old_score").isNotNull() & (F.col("old_score") != F.col("score")) & ~refreshed, "unrelated_score_change"),
    ])
    return both.withColumn("problem", problem).where("problem IS NOT NULL").select("entity", "problem")


def discovery_issues(prior: DataFrame, current: DataFrame, by: list[str], url: str) -> DataFrame:
    """For each source: addresses found before and now, how many are gone, and whether that is a hold."""
    a, b = prior.select(*by, url).distinct().withColumn("_a", F.lit(1)), current.select(*by, url).distinct().withColumn("_b", F.lit(1))
    n = a.join(b, [*by, url], "full").groupBy(*by).agg(F.count("_a").alias("prior"), F.count("_b").alias("current"), F.count_if(F.col("_b").isNull()).alias("missing"))
    return n.withColumn("status", F.when((F.col("current") == 0) | (F.col("missing") > 0), "HOLD").otherwise("PASS"))


def jurisdiction_confirmed(rows: DataFrame, by: list[str], routable: Column, confirmed: Column, least: float = 0.8) -> DataFrame:
    """Whether `least` of a file's rows that can be routed lie in its jurisdiction."""
    n = rows.groupBy(*by).agg(F.count_if(routable).alias("routable"), F.count_if(routable & confirmed).alias("confirmed"))
    return n.withColumn("ok", (F.col("confirmed") > 0) & (share(F.col("confirmed"), F.col("routable")) >= least))


def expansion_order(regions: DataFrame, scheduled: Column) -> DataFrame:
    """Regions in the order in which to take them on: unscheduled first, more ready addresses, more institutions, by name.

    regions: region, venues, ready, missing, institutions. Sums that do not add up are marked, as `consistent`."""
    r = regions.withColumn("scheduled", scheduled).withColumn("consistent", F.col("ready") + F.col("missing") == F.col("venues"))
    action = F.when(F.col("scheduled"), "MONTHLY_AUDIT").when(F.col("ready") > 0, "VERIFY_OFFICIAL_CSV_AND_JURISDICTION").otherwise("FIX_SOURCE_ADDRESSES")
    return ranked(r.withColumn("next_action", action), [F.col("scheduled"), F.desc("ready"), F.desc("institutions"), F.col("region")])


def missing_address_sources(events: DataFrame, url: str, name: str, institution: str, k: int = 8) -> DataFrame:
    """(url, merchants, institutions, events, examples): documents whose events have no address, with the first k names."""
    names = events.groupBy(url, name).agg(F.count("*").alias("n"))
    cut = best_rows(names, [url], [F.col(name)], k).groupBy(url).agg(F.array_sort(F.collect_list(name)).alias("examples"))
    sums = events.groupBy(url).agg(F.count_distinct(name).alias("merchants"), F.count_distinct(institution).alias("institutions"), F.count("*").alias("events"))
    return sums.join(cut, url)


def source_coverage(registry: DataFrame, rows: DataFrame, candidates: DataFrame, name: str) -> DataFrame:
    """Registry entries with their numbers of rows and candidates and what is to do; candidates have arrays of names."""
    raw = rows.groupBy(name).agg(F.count("*").alias("raw_rows"))
    many = candidates.select(F.explode("institutions").alias(name)).groupBy(name).agg(F.count("*").alias("candidate_entities"))
    j = registry.join(raw, name, "left").join(many, name, "left").withColumn("raw_rows", F.coalesce("raw_rows", F.lit(0))).withColumn("candidate_entities", F.coalesce("candidate_entities", F.lit(0)))
    return j.withColumn("diagnosis", ladder([(~F.col("publish"), "TRACK_ONLY"), (F.col("raw_rows") == 0, "NO_RAW"), (F.col("candidate_entities") == 0, "NO_CANDIDATES")], "HAS_CANDIDATES_NOT_PUBLISH_VERIFIED"))


def ledger_balance(rows: DataFrame, ledger: DataFrame, by: list[str], disposition: str, amount: str) -> DataFrame:
    """Whether what was kept and what the ledger took out add up to the rows of each source, in number and amount."""
    total = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(amount).alias("total"))
    parts = ledger.groupBy(*by).agg(F.count_if(F.col(disposition) == "KEPT").alias("kept"), F.count_if(F.col(disposition) != "KEPT").alias("excepted"), F.sum(amount).alias("listed"))
    return total.join(parts, by, "full").withColumn("balanced", F.coalesce((F.col("rows") == F.col("kept") + F.col("excepted")) & (F.col("total") == F.col("listed")), F.lit(False)))


def probed_addresses(documents: DataFrame, targets: DataFrame, key: str, name: str, address: str) -> DataFrame:
    """Targets (key, name) with the one address that the rows of their documents give for exactly that name, if there is one."""
    return targets.join(unique_index(documents.where(F.col(address) != ""), [key, name], address), [key, name], "left")


def caller_order(df: DataFrame, turn: str, fields: list[str]) -> Column:
    """Aggregate: results that came back in any order as an array in the caller's order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(turn, *fields))), lambda s: F.struct(*(s[f].alias(f) for f in fields)))


def all_of(rules: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, rules)
