"""Amounts, head counts, dates, periods and scores as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions.text import text

#: Cells that are currency amounts.
CURRENCY_CELL = r"^\s*(?:₩\s*)?\d[\d,]*\s*(?:원)?\s*$"


def to_amount(c: Column) -> Column:
    """Whole amount of a text: digits, points and minus signs only, rounded half to even; null if no number."""
    return amount_of(text(c))


def amount_of(s: Column) -> Column:
    """to_amount() of what text() gives."""
    return F.bround(F.nullif(F.regexp_replace(s, "[^0-9.-]", ""), F.lit("")).try_cast("double")).try_cast("bigint")


def recover_amount(cells: Column, excluded: Column | None = None) -> Column:
    """The largest currency cell between 1,000 and 50,000,000 whose position (from 0) is not excluded."""
    placed = F.transform(cells, lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    kept = F.filter(placed, lambda s: s["c"].rlike(CURRENCY_CELL) & (F.lit(True) if excluded is None else ~F.coalesce(F.array_contains(excluded, s["i"]), F.lit(False))))
    return F.array_max(F.filter(F.transform(kept, lambda s: to_amount(s["c"])), lambda a: a.between(1000, 50_000_000)))


def head_count(c: Column) -> Column:
    """"외 N명" is N + 1, else the N of "N명" or "N인"; null without either."""
    s = text(c)
    others = F.nullif(F.regexp_extract(s, r"외\s*(\d+)\s*명", 1), F.lit(""))
    people = F.nullif(F.regexp_extract(s, r"(\d+)\s*(?:명|인)(?:$|[^0-9A-Za-z_가-힣])", 1), F.lit(""))
    return F.coalesce(others.try_cast("int") + 1, people.try_cast("int"))


def head_total(c: Column) -> Column:
    """The N of "총 N명"; else the only number before 명 or 인; null for none or for several different ones."""
    s = text(c)
    total = F.nullif(F.regexp_extract(s, r"총\s*(\d+)\s*(?:명|인)", 1), F.lit("")).try_cast("int")
    others = F.nullif(F.regexp_extract(s, r"외\s*(\d+)\s*명", 1), F.lit("")).try_cast("int") + 1
    each = F.array_distinct(F.regexp_extract_all(s, F.lit(r"(\d+)\s*(?:명|인)"), F.lit(1)))
    return F.coalesce(total, others, F.when(F.size(each) == 1, F.get(each, F.lit(0)).try_cast("int")))


def currency_in_text(c: Column) -> Column:
    """The amount at the end of a text, as 12,000원 or 12000원; null without one."""
    return to_amount(F.nullif(F.regexp_extract(text(c), r"(\d{1,3}(?:,\d{3})+|\d{4,})\s*원\s*$", 1), F.lit("")))


def scale_word(c: Column) -> Column:
    """What amounts under a header are to be multiplied with: 1000 for 천원, 10000 for 만원, else 1."""
    s = F.regexp_replace(text(c), r"(?U)\s", "")
    return F.when(F.contains(s, F.lit("천원")), 1000).when(F.contains(s, F.lit("만원")), 10000).otherwise(1)


def _date(y: Column, m: Column, d: Column) -> Column:
    return F.concat(y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0")).try_cast("date")


# Layouts of dates. Each is (pattern, text before the year, places of year, month and day; 0 is the period's).
DATE_LAYOUTS = [
    (r"^(\d{2})[./-](\d{1,2})[./-](\d{1,2})[.]?$", "20", (1, 2, 3)),
    (r"^(20\d{2})-(\d{2})-(\d{2})$", "", (1, 2, 3)),
    (r"^(20\d{2})(\d{2})(\d{2})$", "", (1, 2, 3)),
    (r"^(20\d{2})-(\d{2})(\d{2})$", "", (1, 2, 3)),
    (r"^(20\d{2})(\d{2})-(\d{2})$", "", (1, 2, 3)),
    (r"^(20\d{2})[./](\d{1,2})[./](\d{1,2})[.]?$", "", (1, 2, 3)),
]
PERIOD_LAYOUTS = [(r"^\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일\s*$", "", (0, 1, 2)), (r"^(\d{1,2})\.\s*(\d{1,2})\.?$", "", (0, 1, 2)), (r"^(\d{1,2})일?$", "", (0, 0, 1))]
#: Layouts of periods in titles: (pattern, years before 100 are of this century, places of year, month, quarter).
TITLE_LAYOUTS = [
    (r"(20\d{2})[년./\-\s]+(\d{1,2})\s*월", (1, 2, 0)),
    (r"(20\d{2})\s*년?\s*([1-4])\s*/\s*4\s*분기", (1, 0, 2)),
    (r"((?:20)?\d{2})\s*년(?:도)?\s*([1-4])\s*분기", (1, 0, 2)),
    (r"(20\d{2})\s*년(?:도)?\s*([1-4])\s*(?:/\s*4\s*)?분기", (1, 0, 2)),
    (r"(20\d{2})\s*년(?:도)?[^\n]{0,100}?\(\s*([1-4])\s*(?:/\s*4\s*)?분기\s*\)", (1, 0, 2)),
]
MOMENT = r"(20\d{2})[.\-/년\s]+(\d{1,2})[.\-/월\s]+(\d{1,2})(?:[일T\s]+(\d{1,2})[:시](\d{1,2})?)?"


def _group(s: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, i), F.lit(""))


def _by_layouts(raw: Column, layouts: list, own: tuple[Column, ...] = ()) -> Column:
    """The date of the first layout that gives one; place 0 takes the year or month of the period.

    A layout takes in the whole text, so one with a place for each part rewrites it as Y-M-D, which a cast reads without
    leading zeros."""
    part = lambda pattern, at, i: _group(raw, pattern, at) if at else own[i]
    found = []
    for pattern, before, places in layouts:
        if all(places):
            date = F.concat(F.lit(before), F.regexp_replace(raw, pattern, "-".join(f"${at}" for at in places))).try_cast("date")
        else:
            y, m, d = (part(pattern, at, i) for i, at in enumerate(places))
            date = _date(F.concat(F.lit(before), y), m, d)
        found.append(F.when(raw.rlike(pattern), date))
    return F.coalesce(*found)


def to_date(c: Column) -> Column:
    """Date of a text in one of the layouts YY.MM.DD, YYYY-MM-DD, YYYYMMDD, YYYY-MMDD, YYYYMM-DD and YYYY.M.D; null else.

    A time at the end is dropped first."""
    return date_of(without_time(c))


def without_time(c: Column) -> Column:
    """A text without the time at its end."""
    return F.trim(F.regexp_replace(F.trim(F.coalesce(c.cast("string"), F.lit(""))), r"\s+\d{1,2}:\d{2}(?::\d{2})?\s*$", ""))


def date_of(raw: Column) -> Column:
    """to_date() of what without_time() gives; that is read by every layout and best a column of its own."""
    return _by_layouts(raw, DATE_LAYOUTS)


def date_or_text(c: Column) -> Column:
    """The date of a text as YYYY-MM-DD, or the text as it is where it is none."""
    return F.coalesce(F.date_format(to_date(c), "yyyy-MM-dd"), text(c))


def repair_date(c: Column, year: Column, month: Column) -> Column:
    """to_date(), else "M월 D일" or "M. D." in the period's year, else "D일" or "D" in its year and month."""
    raw = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    return F.coalesce(to_date(c), _by_layouts(raw, PERIOD_LAYOUTS, (year.cast("string"), month.cast("string"))))


def moment(c: Column) -> Column:
    """struct(day, time) of a text with year, month and day; time is HH:MM, empty without an hour; both empty for no date."""
    s = text(c)
    y, m, d, hour, minute = (_group(s, MOMENT, i) for i in range(1, 6))
    day = F.date_format(_date(y, m, d), "yyyy-MM-dd")
    time = F.when(hour.isNotNull(), F.concat(F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(F.coalesce(minute, F.lit("0")), 2, "0")))
    return F.struct(F.coalesce(day, F.lit("")).alias("day"), F.when(day.isNotNull(), F.coalesce(time, F.lit(""))).otherwise("").alias("time"))


def shifted_month(y: Column, m: Column, by: Column) -> Column:
    """yyyymm of a month moved by some months."""
    n = y * 12 + (m - 1) + by
    return (F.floor(n / 12) * 100 + F.pmod(n, F.lit(12)) + 1).cast("int")


def month_marks(y: Column, m: Column) -> Column:
    """The ways in which titles write a month and its quarter."""
    q = F.ceil(m / 3).cast("string")
    year, month, short = y.cast("string"), m.cast("string"), F.right(y.cast("string"), F.lit(2))
    two = F.lpad(month, 2, "0")
    j = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return F.array(j(year, "년 ", month, "월"), j(year, "년", month, "월"), j(year, ".", two), j(year, "-", two), j(year, "/", two), j(year, "년 ", q, "분기"), j(year, "년", q, "분기"), j(short, "년 ", q, "분기"), j(short, "년", q, "분기"))


def active_in(month: Column, first: Column, last: Column) -> Column:
    """Whether YYYY-MM lies within first and last, each open where null or empty."""
    bound = lambda c: F.substring(F.coalesce(c, F.lit("")), 1, 7)
    return ~((bound(first) != "") & (month < bound(first))) & ~((bound(last) != "") & (month > bound(last)))


def latest_day(c: Column) -> Column:
    """Aggregate: the latest valid YYYY-MM-DD that does not lie ahead of today."""
    day = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))
    return F.max(F.when(day <= F.current_date(), c))


def month_of(c: Column) -> Column:
    """YYYY-MM of a date text of this century, null for others."""
    return F.when(c.rlike(r"^20\d{2}-\d{2}"), F.substring(c, 1, 7))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on a sphere of 6371 km."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * F.lit(6371.0) * F.asin(F.sqrt(a))


def plane_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in metres in the plane that touches at the mean latitude, 111,320 m a degree."""
    dy, dx = (lat1 - lat2) * 111320, (lon1 - lon2) * 111320 * F.cos((lat1 + lat2) * F.lit(3.141592653589793) / 360)
    return F.sqrt(dx * dx + dy * dy)


def serial_date(c: Column, low: int = 20000, high: int = 60000) -> Column:
    """Date of a spreadsheet serial number between low and high."""
    n = F.trim(c.cast("string")).try_cast("double")
    return F.when(n.between(low, high), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(n).cast("int")))


def period_bounds(year: Column, month: Column, quarter: Column) -> Column:
    """struct(first, last) day of a month, else of a quarter; null ends without either."""
    start = F.coalesce(month, (quarter - 1) * 3 + 1)
    first = _date(year.cast("string"), start.cast("string"), F.lit("1"))
    return F.struct(first.alias("first"), F.last_day(F.add_months(first, F.when(month.isNotNull(), 0).otherwise(2))).alias("last"))


def date_quality(used: Column, bounds: Column) -> Column:
    """invalid (no date), in_period, or valid_outside_period."""
    return F.when(used.isNull(), "invalid").when(used.between(bounds["first"], bounds["last"]), "in_period").otherwise("valid_outside_period")


def title_period(c: Column) -> Column:
    """struct(y, m, q) of a title by the first layout it has: a month, or a quarter; nulls else."""
    y = m = q = F.lit(None).cast("int")
    for pattern, (at_y, at_m, at_q) in reversed(TITLE_LAYOUTS):
        has = c.rlike(pattern)
        number = lambda i, pattern=pattern: _group(c, pattern, i).try_cast("int") if i else F.lit(None).cast("int")
        year = number(at_y)
        y = F.when(has, F.when(year < 100, year + 2000).otherwise(year)).otherwise(y)
        m, q = F.when(has, number(at_m)).otherwise(m), F.when(has, number(at_q)).otherwise(q)
    return F.struct(y.alias("y"), m.alias("m"), q.alias("q"))


def period_overlaps(y: Column, m: Column, q: Column, since: int, until: int) -> Column:
    """Whether a month or quarter meets the months since..until, both as yyyymm."""
    low = y * 100 + F.coalesce((q - 1) * 3 + 1, m)
    high = y * 100 + F.coalesce(q * 3, m)
    return ~((high < since) | (low > until))


#: Where the hour stands in a time: as councils, published sources and the city test it.
HOURS = {"council": r"^(\d{1,2})[:시]", "published": r"^\s*(\d{1,2})(?::|시)", "city": r"^\s*(\d{1,2}):"}


def is_evening(time: Column, hour: int = 17, kind: str = "published") -> Column:
    """Whether a text such as 18:30 or 18시 starts with an hour from `hour` on, as `kind` of source reads it."""
    return F.coalesce(F.nullif(F.regexp_extract(time, HOURS[kind], 1), F.lit("")).try_cast("int") >= hour, F.lit(False))


def share(x: Column, whole: Column) -> Column:
    """x / whole; 0 where whole is null or 0."""
    return F.coalesce(F.try_divide(x.cast("double"), whole.cast("double")), F.lit(0.0))


def log_share(x: Column, full: float) -> Column:
    """ln(1 + x) as a share of ln(1 + full), 1 at most; negative x counts as 0."""
    return F.least(F.log(1.0 + F.greatest(x, F.lit(0)).cast("double")) / F.log(F.lit(1.0 + full)), F.lit(1.0))


def cap_share(x: Column, full: float) -> Column:
    """x / full, 1 at most."""
    return F.least(x.cast("double") / F.lit(float(full)), F.lit(1.0))


# The scores by number, each as its scale, its terms (weight, measure, kind, full value) and their order.
SCORES = {
    # S1
    "council": (1, [(35, "visits", "cap", 10), (25, "months", "cap", 5), (20, "roles", "cap", 2), (10, "evening", "ratio", 0), (10, "spend", "cap", 3e6)]),
    # S2
    "destination": (100, [(0.25, "outside", "cap", 1), (0.45, "visits", "log", 10), (0.15, "roles", "cap", 4), (0.10, "months", "cap", 5), (0.05, "evening", "ratio", 0)]),
    # S3
    "central": (100, [(0.22, "visits", "log", 10), (0.13, "roles", "cap", 5), (0.15, "months", "cap", 6), (0.15, "institutions", "cap", 4), (0.20, "weight", "cap", 1), (0.10, "senior", "cap", 1), (0.05, "spend", "log", 5e6)]),
    # S4
    "gyeonggi": (100, [(0.35, "visits", "log", 20), (0.35, "departments", "log", 12), (0.18, "months", "cap", 8), (0.12, "spend", "log", 8e6)]),
    # S5
    "incheon": (100, [(0.30, "visits", "log", 10), (0.18, "roles", "cap", 4), (0.20, "months", "cap", 6), (0.22, "weight", "cap", 1), (0.10, "spend", "log", 5e6)]),
    # S6
    "justice": (100, [(0.25, "visits", "log", 8), (0.15, "months", "cap", 6), (0.10, "roles", "cap", 5), (0.25, "weight", "cap", 1), (0.15, "high", "cap", 1), (0.10, "spend", "log", 3e6)]),
    # S7
    "enterprise": (100, [(0.45, "visits", "log", 8), (0.25, "months", "cap", 6), (0.20, None, "one", 0), (0.10, "spend", "log", 3e6)]),
    # S8
    "seoul_executive": (100, [(0.35, "visits", "log", 15), (0.30, "departments", "log", 8), (0.15, "months", "cap", 8), (0.10, "spend", "log", 5e6), (0.10, "evening", "ratio", 0)]),
    # S9
    "seoul_destination": (100, [(0.50, "place", "cap", 1), (0.20, "visits", "log", 8), (0.15, "departments", "log", 6), (0.10, "months", "cap", 6), (0.05, "evening", "ratio", 0)]),
    # S10
    "legislator": (100, [(0.30, "visits", "log", 200), (0.40, "members", "log", 80), (0.18, "months", "cap", 12), (0.12, "spend", "log", 5e7)]),
    # S11
    "prosecution": (100, [(0.55, "visits", "log", 25), (0.25, "actors", "cap", 3), (0.20, "spend", "log", 1.5e7)]),
    # S12
    "consensus": (100, [(0.35, "institutions", "log", 4), (0.20, "sources", "log", 4), (0.25, "events", "log", 20), (0.20, "cohorts", "cap", 3)]),
}


def score(name: str, columns: dict[str, Column | str] | None = None) -> Column:
    """A score of 0 to 100 to one decimal, half to even, from the measures' columns (by default of the same name)."""
    columns = columns or {}
    scale, terms = SCORES[name]
    total = F.lit(0.0)
    for weight, measure, kind, full in terms:
        x = columns.get(measure, measure)
        x = F.col(x) if isinstance(x, str) else x
        term = {"cap": lambda: cap_share(x, full), "log": lambda: log_share(x, full), "ratio": lambda: share(x, F.col("visits") if "visits" not in columns else F.col(columns["visits"])), "one": lambda: F.lit(1.0)}[kind]()
        total = total + F.lit(float(weight)) * term
    return F.bround(F.least(F.lit(float(scale)) * total, F.lit(100.0)), 1)


def score_sql(name: str, columns: dict[str, str] | None = None) -> str:
    """The same score as SQL text, for checks in another engine."""
    columns, terms = columns or {}, []
    scale, of = SCORES[name]
    for weight, measure, kind, full in of:
        x = f"CAST({columns.get(measure, measure)} AS DOUBLE)"
        term = {"cap": f"least({x} / CAST({full} AS DOUBLE), 1.0::DOUBLE)", "log": f"least(ln(1.0::DOUBLE + greatest({x}, 0)) / ln(1.0::DOUBLE + CAST({full} AS DOUBLE)), 1.0::DOUBLE)", "ratio": f"coalesce({x} / nullif(CAST({columns.get('visits', 'visits')} AS DOUBLE), 0), 0.0::DOUBLE)", "one": "1.0::DOUBLE"}[kind]
        terms.append(f"CAST({weight} AS DOUBLE) * {term}")
    return f"round_even(least({float(scale)}::DOUBLE * (0.0::DOUBLE + {' + '.join(terms)}), 100.0::DOUBLE), 1)"
