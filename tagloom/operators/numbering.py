"""Dense numbers in a global order without a global sort in one task (survey H1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import checkpointed


def numbered(df: DataFrame, *order: str, name: str = "no", first: int = 1) -> DataFrame:
    """``df`` with consecutive numbers in the order of the given columns.

    Ranges of the order are sorted apart; what meets in one place is one count per range. The
    ranges are checkpointed, so rows of equal order keep the number they first got.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ranges.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")))
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    at = F.col("_at") - F.shiftleft(F.col("_range").cast("long"), 33)
    return placed.join(F.broadcast(before), "_range").withColumn(name, at + F.col("_before") + first).drop("_range", "_at", "_before")
