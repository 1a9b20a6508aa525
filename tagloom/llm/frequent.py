"""Most frequent values of a column by exact spillable aggregation (problem 4).

groupBy with map-side combining, hash partitions that spill to disk, a top-k per partition and
one final ordered limit (Spark plans the ordered limit that way). A value that holds a third of
all rows leaves each map task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """(name, n) for each non-null value; the counts are exact."""
    return df.select(value.alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))


def most_frequent(df: DataFrame, value: Column, k: int, name: str = "value") -> DataFrame:
    """The ``k`` most frequent non-null values; ties by value in ascending order."""
    return counts(df, value, name).orderBy(F.col("n").desc(), F.col(name)).limit(k)


def heavy_hitters(df: DataFrame, value: Column, one_in: int, name: str = "value") -> DataFrame:
    """(name, n, total) of the values that make up at least 1 / ``one_in`` of all rows.

    Rows with a null value count in the total. At most ``one_in`` values can reach that share, so
    the top ``one_in`` hold them all. An empty table gives an empty result.
    """
    total = df.count()
    return most_frequent(df, value, one_in, name).where(F.col("n") * one_in >= total).withColumn("total", F.lit(total))
