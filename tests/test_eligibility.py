"""Valid transactions, merges that end in an error, unsafe merges and equal snapshots, with nulls and repeats."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.operators import eligibility as E
from ledgerlake.operators.gates import GateError


@pytest.mark.parametrize(("change", "valid"), [
    ({}, True), ({"date": "1999-12-31"}, False), ({"date": "2026-07-01"}, True), ({"date": "2027-01-01"}, False), ({"date": None}, False), ({"date": "x"}, False), ({"amount": 0}, False), ({"amount": -5}, False), ({"amount": None}, False),
    ({"url": "https://go.kr.evil.com/"}, False), ({"url": "https://user@x.go.kr/"}, True), ({"url": None}, False), ({"merchant": " 카드 "}, False), ({"merchant": None}, False), ({"role": ""}, False), ({"source": "guess"}, False), ({"source": None}, False),
])
def test_valid_transaction(spark, change, valid):
    row = {"date": "2025-03-04", "amount": 10, "url": "https://a.go.kr/f", "merchant": "가게", "role": "의장", "source": "source_heading"} | change
    df = spark.createDataFrame([tuple(row.values())], "date string, amount long, url string, merchant string, role string, source string")
    test = E.valid_transaction(*(F.col(c) for c in row), ["go.kr"], F.lit("2026-07-01").cast("date"))
    assert df.select(test.alias("v")).first().v is valid


def test_months(spark):
    df = spark.createDataFrame([(d,) for d in ("2024-02-29", "2024-03-01", "2025-01-31", "2025-02-01", "2024-3-1", None, "x")], "d string")
    assert [r.v for r in df.select(E.in_months(F.col("d"), (2024, 3), (2025, 1)).alias("v")).collect()] == [False, True, True, False, False, False, False]


def test_merge_ends_on_conflict(spark):
    table = lambda rows: spark.createDataFrame(rows, "k long, v string")
    old = table([(1, "a"), (2, None)])
    assert sorted(map(tuple, E.merged_or_raised(old, table([(2, None), (3, "c"), (3, "c")]), "k").collect())) == [(1, "a"), (2, None), (3, "c")]
    for bad_old, bad_new, said in ((old, [(1, "b")], "conflicting k: 1"), (old, [(3, "a"), (3, "b")], "conflicting k: 3"), (old, [(None, "b")], "has no k"), (table([(1, "a"), (1, "a")]), [], "k twice: 1")):
        with pytest.raises(PySparkException, match=said):
            E.merged_or_raised(bad_old, table(bad_new), "k").count()
    with pytest.raises(PySparkException, match="conflicting"):
        E.merged_or_raised(old, table([(2, "x")]), "k").write.format("noop").mode("overwrite").save()


def test_unsafe_merges_and_known_keys(spark):
    old = spark.createDataFrame([("e1", "k1", "a"), ("e2", "k2", "b"), ("e3", "k3", ""), ("e4", "k4", "c"), ("e4", "k5", "c")], "entity string, source_key string, address string")
    new = spark.createDataFrame([("n1", "k1"), ("n1", "k2"), ("n2", "k3"), ("n2", "k4"), ("n3", "k5"), ("n3", "new")], "entity string, source_key string")
    assert [tuple(r) for r in E.unsafe_merges(old, new, F.col("address")).collect()] == [("n1", 2, 2)]
    names = lambda rows: spark.createDataFrame(rows, "id long, n string, o string")
    left = E.without_known(names([(1, "a", "x"), (2, " a", "x "), (3, "b", None), (4, "c", "x"), (5, "d", "x")]), names([(9, "c ", "x")]), names([(9, "d", " x")]), ["n", "o"], ["id"])
    assert sorted(r.id for r in left.collect()) == [1, 3]


def test_equal_snapshots(spark):
    table = lambda rows: spark.createDataFrame(rows, "k long, v string")
    two = lambda a, b: tuple(E.snapshots_equal(table(a), table(b)).first())
    assert two([(1, "a"), (1, "a"), (2, None)], [(2, None), (1, "a"), (1, "a")]) == (0, 0, True)
    assert two([(1, "a"), (1, "a")], [(1, "a"), (2, None)]) == (1, 1, False) and two([], []) == (0, 0, True) and two([(1, None)], []) == (1, 0, False)


def test_thresholds(spark):
    row = dict(visits=2, months=1, institutions=1, senior_weight=0.65, score_central=45.0, high_visits=1, top_weight=0.5, score_justice=30.0, place=None)
    df = spark.createDataFrame([tuple(row.values())], "visits long, months long, institutions long, senior_weight double, score_central double, high_visits long, top_weight double, score_justice double, place double")
    passes = lambda name, **other: df.withColumns({k: F.lit(v) for k, v in other.items()}).select(E.eligible(name).alias("v")).first().v
    assert passes("central") and not passes("central", senior_weight=0.6) and passes("central", senior_weight=0.6, institutions=2) and not passes("central", score_central=44.9)
    assert passes("justice") and not passes("justice", visits=1) and passes("justice", visits=1, top_weight=0.85) and not passes("seoul_destination")


def test_priorities(spark):
    import math

    one = spark.range(1)
    got = one.select(E.gap_priority(*(F.lit(v) for v in (9, 7, 1, 20, 250_000)), F.lit(True), F.lit(False), F.lit(True)).alias("v")).first().v
    assert got == round(22 * math.log1p(9) + 14 * 5 + 0 + 36 + 2 * math.log1p(2.5) + 18 + 5, 2)
    lacks = {"address": F.lit(True), "category": F.lit(False), "phone": F.lit(True), "url": F.lit(False)}
    assert one.select(E.enrichment_priority(lacks, F.lit(50.0), F.lit(80), F.lit(9)).alias("v")).first().v == 45 + 32.5 + 75 + 45


def test_approved_has_a_floor(spark):
    df = spark.range(60)
    assert E.approved(df, F.col("id") >= 10, [F.col("id")], most=80).count() == 50
    with pytest.raises(GateError):
        E.approved(df, F.col("id") >= 11, [F.col("id")], most=80)
