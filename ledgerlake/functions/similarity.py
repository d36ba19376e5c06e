"""What Spark has no built-in for: sequence-matching ratio and Unicode compatibility form, in Arrow batches."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


@pandas_udf(T.DoubleType())
def match_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matched signs over the signs of both texts; 0 where one is null."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b)])


@pandas_udf(T.StringType())
def compatibility_form(s: pd.Series) -> pd.Series:
    """NFKC, lower-cased; null stays null."""
    return pd.Series([unicodedata.normalize("NFKC", x).lower() if x is not None else None for x in s])
