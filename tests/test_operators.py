"""Operators on small tables, and that row order does not change results."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions.text import family_name, ladder
from ledgerlake.operators import filters, gates, grids, joins, merging, ranking
from ledgerlake.operators.components import connected_components
from ledgerlake.operators.entities import resolve_entities


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_global_rank_and_modes(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a int, b int")
    got = ranking.global_rank(df, [F.col("a"), F.desc("b")]).collect()
    assert [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(((i % 7, i) for i in range(100)), key=lambda t: (t[0], -t[1]))
    m = spark.createDataFrame([("g", "x", 5), ("g", "y", 1), ("g", "x", 6), ("g", "y", 2), ("h", None, 1)], "g string, v string, at int")
    assert rows(ranking.first_mode(m, ["g"], "v", "at")) == [("g", "y", 2)]


def test_quota_with_incumbents(spark):
    df = spark.createDataFrame([(f"m{i}", "AB"[i > 5], 100 - i) for i in range(10)], "m string, inst string, score int")
    inc = spark.createDataFrame([("m9", 0), ("gone", 1)], "m string, turn int")
    got = ranking.quota(df, "inst", [F.desc("score"), F.col("m")], 1, 4, 6, ["m"], inc).orderBy("place").collect()
    assert [r["m"] for r in got] == ["m0", "m1", "m2", "m9", "m3", "m4"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(st.integers(-5, 5), st.integers(0, 3)), min_size=1, max_size=20))
def test_reasons_add_up(spark, data):
    df = spark.createDataFrame(data, "a int, b int")
    counted = filters.reason_counts(filters.with_reason(df, [("neg", F.col("a") < 0), ("zero", F.col("b") == 0)]))
    assert sum(r["n"] for r in counted.collect()) == len(data)


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, None), (4, "d")], "k int, v string")
    assert rows(merging.snapshot_diff(old, new, ["k"], ["v"])) == [(1, "lost"), (2, "changed"), (4, "added")]
    once = merging.merge_new(old, new, ["k"])
    assert rows(merging.merge_new(once, new, ["k"])) == rows(once) == [(1, "a"), (2, "b"), (3, None), (4, "d")]
    assert rows(merging.first_wins([old, new], ["k"], ["v"])) == rows(once)
    assert rows(merging.carry_forward(new, old, ["k"])) == [(1, "a", True), (2, "c", False), (3, None, False), (4, "d", False)]


def test_joins(spark):
    df = spark.createDataFrame([("a", "k1", "s"), ("a", "k1", "t"), ("b", "k1", "s"), ("b", "k2", "t"), ("c", "k3", "s")], "n string, key string, src string")
    assert rows(joins.unique_index(df, ["n"], "key")) == [("a", "k1"), ("c", "k3")]
    assert rows(joins.unique_index(df, ["n"], "key", sources="src", least=2)) == [("a", "k1")]
    t = spark.createDataFrame([("서울 중구 길",), ("서울 강남",), ("부산",), (None,)], "t string")
    r = spark.createDataFrame([("서울", 1), ("서울 중구", 2)], "prefix string, code int")
    assert rows(joins.longest_prefix(t, r, "t")) == sorted([("서울 중구 길", "서울 중구", 2), ("서울 강남", "서울", 1), ("부산", None, None), (None, None, None)], key=repr)
    p = spark.createDataFrame([(i, (i * 37 % 50) / 10, (i * 91 % 50) / 10) for i in range(60)], "i int, x double, y double")
    want = {(a["i"], b["i"]) for a in p.collect() for b in p.collect() if a["i"] < b["i"] and ((a["x"] - b["x"]) ** 2 + (a["y"] - b["y"]) ** 2) ** 0.5 <= 0.5}
    assert {(r["a"], r["b"]) for r in joins.close_pairs(p, "i", "x", "y", 0.5).collect()} == want
    f = spark.createDataFrame([("s", 1, None), ("s", 2, "d"), ("s", 3, None)], "s string, i int, d string")
    assert [tuple(r) for r in joins.forward_fill(f, ["s"], ["i"], "d").orderBy("i").select("d", "d_inferred").collect()] == [(None, False), ("d", False), ("d", True)]


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(50) if i % 10 != 9] + [(None, 3), (99, 99)], "a int, b int")
    assert dict(connected_components(e).collect()) == {i: i // 10 * 10 for i in range(50)} | {99: 99}
    assert connected_components(e.limit(0)).count() == 0


def test_entities(spark):
    r = spark.createDataFrame([
        ("A", "o1", "aaaa", "aaaa", "road1", "gu", 1), ("A2", "o2", "aaaa", "aaaa", "road1", "", 1), ("A3", "o3", "aaaa", "x", "", "", 1), ("A4", "o3", "aaaa", "y", "", "gu", 1),
        ("B", "o1", "bb", "bb본점", "road2", "", 1), ("B1", "o2", "zz", "bb본점", "", "", 1), ("C", "o9", "cc", "cc", "", "", 3), ("D", "o9", "dddd", "d", "", "si", 1),
    ], "name string, origin string, family string, strict string, building string, place string, institutions int")
    got = {x["name"]: (x["basis"], x["entity_key"]) for x in resolve_entities(r).collect()}
    assert got == {"A": ("address", "aaaa||road1"), "A2": ("address", "aaaa||road1"), "A3": ("origins", "aaaa||road1"), "A4": ("place", "aaaa||road1"), "B": ("address", "bb||road2"), "B1": ("branch", "bb||road2"), "C": ("single", "single||c||o9"), "D": ("family_place", "dddd||locality:si")}


def test_gates(spark):
    s = lambda xs: spark.createDataFrame([(x,) for x in xs], "status string")
    assert tuple(gates.health_rollup(s(["UPDATED", "NO_CHANGE", "STALE_OK:QA", "FAILED:X"])).first()) == (1, 1, 1, 1, "DEGRADED")
    assert gates.health_rollup(s(["STALE_OK:A", "FAILED:B"])).first()["health"] == "FAILED"
    checks = gates.run_checks(s(["a", ""]), [("blank", "error", F.col("status") == "")])
    with pytest.raises(gates.GateError):
        gates.require(checks)


def test_grids(spark):
    sheets = {
        "plain": [["제목(부의장)"], ["사용일자", "집행목적", "집행장소", "대상인원", "집행금액"], ["2024-01-05", "간담회", "가나식당", "3", "45,000"], ["", "간담회", "다라식당", "4", "50,000"], ["소계", "", "x", "", "95,000"]],
        "split": [["사", "집", "사", "대", "금"], ["용일자", "행목적", "용처", "상인원", "액"], ["1.5", "간담회", "가나", "2", "120,000"]],
        "none": [["a", "b"], ["c", "d"]],
    }
    g = spark.createDataFrame([(n, i, c) for n, lines in sheets.items() for i, c in enumerate(lines)], "sheet string, idx int, cells array<string>")
    assert rows(grids.find_headers(g, ["sheet"]).select("sheet", "idx", "span")) == [("plain", 1, 1), ("split", 0, 2)]
    got = grids.sheet_rows(g, ["sheet"]).orderBy("sheet", "idx").collect()
    assert [(r["date"], r["date_inferred"], r["merchant"], r["people"], r["amount"]) for r in got] == [("2024-01-05", False, "가나식당", 3, 45000), ("2024-01-05", True, "다라식당", 4, 50000), ("1.5", False, "가나", 2, 120000)]
    h = spark.createDataFrame([(["집행일자", "부서명", "사용자", "집행장소", "집행금액"],)], "h array<string>")
    assert h.select(grids.column_positions(F.col("h"))).first()[0]["role"] == 2


@pytest.mark.parametrize("seed", range(3))
def test_duplicates_elsewhere_equals_counting(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice([None, "a", "b", "c"]), rng.choice("xyz"), rng.random() < 0.4) for i in range(rng.choice((0, 12, 14)))]
    df = spark.createDataFrame(data, "id long, k string, s string, late boolean")
    found = joins.duplicates_elsewhere(df, ["k"], "s", "late", ["id"])
    others = {r[0]: [o for o in data if not o[3] and o[1] == r[1] and o[2] != r[2]] for r in data if r[3] and r[1] is not None}
    assert rows(found) == sorted((*r, o[0][2], o[0][0]) for r in data if len(o := others.get(r[0], [])) == 1)
    # groups are counted in hash tables: only the few keys left are aggregated as structs
    assert found._jdf.queryExecution().sparkPlan().toString().count("SortAggregate") == 2
