"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (the oracle rounds the same way)."""
    return df.withColumns({c: F.round(F.col(c), digits) for c, t in df.dtypes
                           if t in ("double", "float")})
