"""UDF / UDAF surface.

The analyses themselves use built-in expressions; these wrappers show the
registration surface with Arrow-batched pandas UDFs (never per-row Python).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def prefix_name_udf(names: pd.Series) -> pd.Series:
    return "Name: " + names


@F.pandas_udf(T.StringType())
def text_before_space_udf(texts: pd.Series) -> pd.Series:
    """Text before the first space (the whole text when there is none)."""
    return texts.str.split(" ", n=1).str[0]


@F.pandas_udf(T.LongType())
def avg_long_udaf(values: pd.Series) -> int:
    """Grouped-aggregate pandas UDF: (total, count) average with long division.

    Grouped-agg pandas UDFs have no partial phase, so the analyses use
    ``sum(x) div count(x)`` instead; this is the registration surface.
    """
    v = values.dropna()
    return int(v.sum()) // len(v) if len(v) else None


@F.pandas_udf(T.LongType())
def merge_avg_long(sums: pd.Series, counts: pd.Series) -> int:
    """Merge step of the long average: partial (sum, count) buffers of a group, of
    which there must be a bounded number, to one truncated average."""
    n = int(counts.sum())
    return int(sums.sum()) // n if n else None


def register_all(spark: SparkSession) -> None:
    """Make the UDFs callable from SQL text."""
    spark.udf.register("prefixName", prefix_name_udf)
    spark.udf.register("textBeforeSpace", text_before_space_udf)
    spark.udf.register("avgLong", avg_long_udaf)
