"""Routes, quotas, sheets, rings and source states by definition, on small cases with nulls, ties and repeats."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.joins import close_pairs
from ledgerlake.operators.markers import ring_layout
from ledgerlake.operators.quotas import shared_quota
from ledgerlake.operators.routing import route_addresses
from ledgerlake.operators.sheets import blank_ends, transactions_of
from ledgerlake.plans.catalog import QUERIES
from ledgerlake.plans.catalog import QUERIES
from ledgerlake.streaming import states

PROVINCES = [("서울", a) for a in ("서울특별시", "서울시", "서울")] + [("부산", a) for a in ("부산광역시", "부산")] + [("경기", a) for a in ("경기도", "경기")] + [("세종특별자치시", a) for a in ("세종특별자치시", "세종시")]
CODES = {"서울중구": "1", "부산중구": "2", "서울강남구": "3", "경기성남시": "4", "서울영등포구": "5", "부산강서구": "6", "서울강서구": "7", "경기양평군": "8", "세종특별자치시 본청": "9", "경기수원시": "10", "서울 본청": "11"}


@pytest.mark.parametrize(("address", "code", "reason"), [
    ("서울특별시 중구 을지로 5", "1", "PROVINCE"), ("부산광역시 중구 광복로 7", "2", "PROVINCE"), ("서울영등포구여의대로24(여의도동)", "5", "PROVINCE"), ("경기도 성남시 수정구 산성대로 1", "4", "PROVINCE"),
    ("서울시 한강대로 405", None, "UNROUTABLE_JURISDICTION"), ("강남구 테헤란로", "3", "UNIQUE_LOCALITY"), ("양평군 1", "8", "UNIQUE_LOCALITY"), ("양평군", None, "UNROUTABLE_JURISDICTION"), ("강서구 화곡로 3", None, "UNROUTABLE_JURISDICTION"),
    ("중구 명동길 3", None, "UNROUTABLE_JURISDICTION"), ("수원시 1", None, "UNROUTABLE_JURISDICTION"), ("세종시 도움로 1", "9", "WHOLE_PROVINCE"), ("세종시", None, "UNROUTABLE_JURISDICTION"), ("서울", None, "UNROUTABLE_JURISDICTION"),
    (" ", None, "MISSING_ADDRESS"), (None, None, "MISSING_ADDRESS"), ("해외 공관", None, "UNROUTABLE_JURISDICTION"), ("도로 강남구", None, "UNROUTABLE_JURISDICTION"),
])
def test_routes(routed, address, code, reason):
    assert routed[address] == (code, reason)


@pytest.fixture(scope="module")
def routed(spark):
    cases = [m for m in test_routes.pytestmark if m.name == "parametrize"][0].args[1]
    df = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(cases)] + [(99, cases[0][0], "twice")], "id long, address string, _text string")
    out = route_addresses(df, "address", spark.createDataFrame(list(CODES.items()), "name string, code string"), spark.createDataFrame(PROVINCES, "label string, alias string"), ["세종특별자치시"]).collect()
    assert len(out) == len(cases) + 1 and sum(r.route_code == "1" for r in out) == 2
    return {r.address: (r.route_code, r.route_reason) for r in out}


def greedy(rows, members, incumbents, window, least, most):
    """One group after the other: incumbents by turn, then rows by score and key, none that a group before has taken."""
    order = [i for i, s in sorted(rows.items(), key=lambda r: (-r[1], r[0]))]
    groups = sorted({g for gs in members.values() for g in gs})
    each, taken = min(least, max(1, window // max(1, len(groups)))), []
    for g in groups:
        first = [i for _, i in sorted((t, i) for i, h, t in incumbents if h == g and i in rows)]
        wish = list(dict.fromkeys(first + [i for i in order if g in members[i]]))
        taken += [i for i in wish if i not in taken][:each]
    chosen = set(taken)
    for i in order:
        if len(chosen) >= window:
            break
        chosen.add(i)
    front = [i for i in order if i in chosen]
    return [(i, i in taken) for i in (front + [i for i in order if i not in chosen])[: max(most, 0)]]


@pytest.mark.parametrize("seed", range(6))
def test_shared_quota_equals_greedy(spark, seed):
    rng = random.Random(seed)
    rows = {i: rng.randrange(8) for i in range(rng.choice((0, 7, 60)))}
    members = {i: {f"g{rng.randrange(5)}" for _ in range(rng.randrange(4))} for i in rows}
    incumbents = [(rng.randrange(80), f"g{rng.randrange(7)}", n) for n in range(25)]
    incumbents = [(i, g, n) for i, g, n in incumbents if g in {h for gs in members.values() for h in gs}]
    for window, least, most in ((20, 3, 30), (3, 10, 50), (40, 1, 10)):
        got = shared_quota(spark.createDataFrame(list(rows.items()), "id long, score long"), spark.createDataFrame([(i, g) for i, gs in members.items() for g in gs] + [(1, None)], "id long, g string"), "g", ["id"], [-F.col("score")], window, least, most, spark.createDataFrame(incumbents, "id long, g string, turn long"))
        assert [(r.id, r.reserved) for r in sorted(got.collect(), key=lambda r: r.place)] == greedy(rows, members, incumbents, window, least, most)


def test_sheets(spark):
    head = [["제목"], [], ["사용일자", "사용처", "금액", "비고"]]
    lines = {
        "a": [["2026-01-02", "가게", "1,000"], ["", "나게", "2,000"], ["", "", ""], ["해당 없음", "x", "1"], ["2026-01-03", "신용 카드", "5"], ["합계", "", "3,000"], ["", "총 합계", ""], ["2026-01-04", "", "7"], ["8월", "다게", ""], *[[" "]] * 8, ["2026-01-05", "뒤", "9"]],
        "b": [*[[""]] * 9, ["2026-01-05", "앞", "9"], *[[""]] * 7, ["", "뒤", "1"], *[[""]] * 8, ["2026-01-06", "끝", "2"]],
        "c": [],
    }
    grid = [(s, i, row) for s, rows in lines.items() for i, row in enumerate(head + rows)] + [("none", 0, ["x", "y"])]
    got = transactions_of(spark.createDataFrame(grid, "sheet string, idx int, cells array<string>"), ["sheet"]).collect()
    found = sorted((r.sheet, r.idx, r.used_date, r.date_inferred, r.merchant, r.amount) for r in got)
    assert found == [
        ("a", 3, "2026-01-02", False, "가게", 1000), ("a", 4, "2026-01-02", True, "나게", 2000), ("a", 9, "2026-01-02", True, "총 합계", None), ("a", 10, "2026-01-04", False, None, 7), ("a", 11, "8월", False, "다게", None),
        ("b", 12, "2026-01-05", False, "앞", 9), ("b", 20, "2026-01-05", True, "뒤", 1),
    ]
    runs = spark.createDataFrame([("s", i, i in range(3, 13) or i in range(20, 28)) for i in range(30)], "sheet string, idx int, blank boolean")
    assert sorted(r.end for r in blank_ends(runs, ["sheet"]).collect()) == [10, 27]


def test_rings(spark):
    points = [(f"k{i}", "a" if i < 5 else f"s{i}", 37.0 + i * 1e-5, 127.0) for i in range(7)]
    got = {r.k: r for r in ring_layout(spark.createDataFrame(points, "k string, g string, lat double, lon double"), "g", [F.col("k")]).collect()}
    lat = sum(p[2] for p in points[:5]) / 5
    for i in range(5):
        angle, radius = -math.pi / 2 + 2 * math.pi * i / 5, 38
        assert math.isclose(got[f"k{i}"].shown_lat, lat + math.cos(angle) * radius / 111320) and math.isclose(got[f"k{i}"].shown_lon, 127 + math.sin(angle) * radius / (111320 * math.cos(math.radians(lat))))
    assert not got["k5"].offset and got["k5"].shown_lat == points[5][2] and got["k0"].group_size == 5
    assert ring_layout(spark.createDataFrame([], "k string, g string, lat double, lon double"), "g", [F.col("k")]).collect() == []


def test_rings_of_several_maps(spark, tmp_path):
    """Places a thousand groups apart have equal coordinates: they are on different maps and share no ring."""
    ids = [i + 4000 * m for m in (0, 1, 3) for i in (4, 5, 6, 7, 8, 9)]
    spark.createDataFrame([(i, f"S{i % 2}") for i in ids], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    got = {r.id: r for r in QUERIES["marker_rings"](spark, str(tmp_path)).collect()}
    assert {i: r.group_size for i, r in got.items()} == {i + 4000 * m: n for m in (0, 1, 3) for i, n in ((4, 3), (5, 3), (6, 3), (7, 1), (8, 2), (9, 2))}
    points = spark.createDataFrame([(1, 0.0, "a"), (2, 1.0, "b"), (3, 2.0, "a"), (4, 0.0, None), (5, 0.0, None)], "k long, x double, m string")
    assert [tuple(r) for r in close_pairs(points, "k", "x", "x", 3.0, by=["m"]).select("a", "b").collect()] == [(1, 3)]
    assert close_pairs(points, "k", "x", "x", 3.0).count() == 10


def test_state_accesses_by_address(monkeypatch):
    """A source's state is read and written once for each address, however many events there are, also when notes fill up."""
    class Urls(dict):
        calls = 0

        def getValue(self, key):
            Urls.calls += 1
            return self.get(key)

        def updateValue(self, key, value):
            Urls.calls += 1
            self[key] = value

        def iterator(self):
            return iter(self.items())

    class Value:
        now = None
        get = lambda self: self.now
        update = lambda self, v: setattr(self, "now", v)

    rng = random.Random(2)
    start = dt.datetime(2026, 1, 1)
    rows = [(pd.Timestamp(start + dt.timedelta(minutes=rng.randrange(50))), i, rng.choice(["UPDATED", "FAILED"]), "X", True, rng.choice(["u1", "u2", None])) for i in range(500)]
    frames = [pd.DataFrame(rows[i : i + 100], columns=["at", "id", "outcome", "step", "valid", "url"]) for i in range(0, 500, 100)]
    ends = []
    for notes in (100, 1):
        monkeypatch.setattr(states, "NOTES", notes)
        p, Urls.calls = states.SourceStates(), 0
        p.urls, p.latest, p.good, p.seen = Urls(), Value(), Value(), Value()
        list(p.handleInputRows(("s",), iter(frames), None))
        ends.append(dict(p.urls))
        assert Urls.calls == 4 or notes == 1
    best = lambda u, failed: max((r[0].to_pydatetime(), r[1]) for r in rows if r[5] == u and (r[2] == "FAILED") == failed)
    assert ends[0] == ends[1] == {(u,): (*best(u, True), *best(u, False)) for u in ("u1", "u2")}


def test_states_by_stream_and_replay(spark, tmp_path):
    """Events come in three runs, some late and some twice of one time; each run ends in what a replay of all so far gives."""
    rng = random.Random(5)
    start = dt.datetime(2026, 1, 1)
    events = [(f"s{rng.randrange(6)}", start + dt.timedelta(minutes=rng.randrange(300)), i, rng.choice(["UPDATED", "NO_CHANGE", "FAILED", "FAILED"]), rng.choice(["INGEST", None]), rng.choice([True, True, False, None]), rng.choice(["u1", "u2", "u3", None])) for i in range(240)]
    events += [(None, start, 900, "UPDATED", None, True, "u"), ("s9", None, 901, "FAILED", None, True, "u"), ("t", start, 902, "FAILED", "X", True, "u"), ("u", start, 903, "NO_CHANGE", None, True, None)]
    rng.shuffle(events)
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, states.PROVIDER)
    try:
        for n, part in enumerate((events[:100], events[100:101], events[101:])):
            spark.createDataFrame(part, states.EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(states.EVENT).parquet(str(tmp_path / "in"))
            states.write_states(states.source_states(stream, keep=2), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
            got = states.current_states(spark.read.parquet(str(tmp_path / "out")))
            want = states.replayed_states(spark.read.schema(states.EVENT).parquet(str(tmp_path / "in")), keep=2)
            as_rows = lambda df: sorted(map(tuple, df.select("source", "status", "since", "events", "waiting", "retry").collect()))
            assert as_rows(got) == as_rows(want), n
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
    found = {r.source: r.status for r in got.collect()}
    assert found["t"] == "FAILED:X" and found["u"] == "FAILED:NO_BASELINE"


def test_sheets_read_their_lines_twice_at_most(spark):
    # once for the headers and once for the lines, however many rules look at other lines
    plan = QUERIES["sheet_transactions"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 2
    lines = [["사용일자", "사용처", "금액"], *[[""]] * 9, ["2026-1-5", "x", "1"], ["2026.1.5.", "가 나 식 당", "1"], ["", "나", ""], *[[""]] * 7, ["260105", "다", "3"], *[[""]] * 9, ["2026-01-06", "뒤", "4"]]
    grid = spark.createDataFrame([("s", i, row) for i, row in enumerate(lines)], "sheet string, idx int, cells array<string>")
    got = transactions_of(grid, ["sheet"]).select("idx", "used_date", "date_inferred", "merchant", "amount").orderBy("idx").collect()
    assert [tuple(r) for r in got] == [(10, "2026-1-5", False, "x", 1), (11, "2026-01-05", False, "가 나 식 당", 1), (12, "2026-01-05", True, "나", None), (20, "260105", False, "다", 3)]
