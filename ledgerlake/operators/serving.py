"""The query layer of the published table: modes, search, sort orders, look-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.text import ladder
from ledgerlake.operators.ranking import top_k

#: What each mode lets through.
MODES = {
    "all": "true", "both": "type = 'both'", "destination": "type IN ('destination', 'both')", "executive": "type IN ('executive', 'both')", "consensus": "is_cross",
    "cross_origin": "sources >= 2", "top_official": "top_official_visits > 0", "regional_head": "regional_head_visits > 0",
}
#: Columns of each sort order; a minus sign is for descending. The name and the id end every order.
ORDERS = {"signal": ["-score"], "visits": ["-visits"], "spend": ["-spend"], "name": [], "institutions": ["-institutions", "-score"], "recent": ["-date_max"], "consensus": ["-consensus", "-score"], "top_official": ["-top_official_visits", "-score"], "regional_head": ["-regional_head_visits", "-score"]}
#: The language whose order of letters ends ties of names.
LOCALE = "ko"


def searched(df: DataFrame, fields: list[str], mode: str = "all", text: str = "", origin: str | None = None) -> DataFrame:
    """Rows that the mode lets through, of an origin, whose fields together have a text, whatever its case."""
    rows = df.where(MODES[mode])
    if origin is not None:
        rows = rows.where(F.col("origin") == origin)
    return rows.where(F.contains(F.lower(F.concat_ws(" ", *fields)), F.lit(text.lower()))) if text else rows


def sort_order(name: str, key: str = "id", locale: str = LOCALE) -> list[Column]:
    """The columns of a sort order, then the name in a language's order of letters, then the key."""
    return [*(F.desc_nulls_last(c[1:]) if c[0] == "-" else F.asc(c) for c in ORDERS[name]), F.collate(F.col("name"), locale).asc(), F.asc(key)]


def looked_up(df: DataFrame, text: str, name: str, others: list[str], key: str, k: int = 10) -> DataFrame:
    """The k rows that fit a text best: 400 for the whole name, 320 for its start, 260 inside it, 140 in another field."""
    t, n = text.lower(), F.lower(F.col(name))
    points = ladder([(n == t, 400), (F.startswith(n, F.lit(t)), 320), (F.contains(n, F.lit(t)), 260), (F.contains(F.lower(F.concat_ws(" ", *others)), F.lit(t)), 140)], 0)
    return top_k(df.withColumn("points", points).where("points > 0"), [F.desc("points"), F.desc("score"), F.col(name), F.col(key)], k)


def geojson_features(df: DataFrame, lat: str, lon: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature, as text, for each row with both coordinates."""
    shape = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"))
    rows = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))).alias("feature"))
