"""Running tag counts over a stream of read files (an extension; the batch operators do the work)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.enzymes import Enzyme
from tagloom.functions import seq as S
from tagloom.operators.digest import digest


def running_tag_counts(reads: DataFrame, enzyme: Enzyme, sample: str = "sample") -> DataFrame:
    """(sample, tag, n) of a streaming DataFrame of reads (sample, seq); state is one row per distinct tag.

    A tag counts for itself and its reverse complement, as in the batch.
    """
    hits = digest(reads.select(sample, "seq"), enzyme)
    both = hits.select(sample, F.explode(F.array(F.col("tag"), S.reverse_complement(F.col("tag")))).alias("tag"))
    return both.groupBy(sample, "tag").agg(F.count("*").alias("n"))


def windowed_yield(reads: DataFrame, time: str, late: str = "2 days", width: str = "1 day", sample: str = "sample") -> DataFrame:
    """Reads and bases per sample and time window; rows later than ``late`` behind the stream are dropped by the watermark."""
    return reads.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), sample).agg(
        F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases")
    ).select(sample, F.col("w.start").alias("start"), "reads", "bases")
