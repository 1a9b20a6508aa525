"""Methylation sites: copy numbers, counts, RPM and M-index (survey C14, C15, E9, F13-F15, G14, G15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators.approxjoin import best_hits
from tagloom.operators.numbering import numbered
from tagloom.session import with_totals


def copy_numbers(sites: DataFrame) -> DataFrame:
    """Sites with ``copy_number`` of their sequence; null where it holds other letters than ACGT.

    Sequences are counted by an aggregate that combines before the shuffle, then joined back.
    """
    clean = F.col("sequence").rlike("^[ACGT]+$")
    n = sites.where(clean).groupBy("sequence").agg(F.count("*").alias("copy_number"))
    return sites.join(n, "sequence", "left")


def site_totals(sites_with_copies: DataFrame) -> DataFrame:
    """Sites by kind; unique, repeated and ambiguous add up to all."""
    c = F.col("copy_number")
    return sites_with_copies.agg(
        F.count("*").alias("total"), F.count_if(c == 1).alias("unique"), F.count_if(c > 1).alias("repeated"), F.count_if(c.isNull()).alias("ambiguous")
    )


def site_counts(reads: DataFrame, sites: DataFrame, most: int = 2, sample: str = "sample") -> DataFrame:
    """(sample, sequence, n): reads of either strand on unique sites within ``most`` differences, best stratum only."""
    per_seq = reads.where("sequence is not null").groupBy(sample, F.col("sequence").alias("query")).agg(F.count("*").alias("n"))
    hits = best_hits(per_seq.select("query"), sites.select(F.col("sequence").alias("reference")), most, both_strands=True)
    return per_seq.join(hits, "query").groupBy(sample, F.col("reference").alias("sequence")).agg(F.sum("n").alias("n"))


def mapping_totals(reads: DataFrame, counts: DataFrame, least: int = 3, sample: str = "sample") -> DataFrame:
    """(sample, reads, mapped, detected, qualified): reads, reads on a site, sites with a read and sites with ``least`` reads."""
    total = reads.groupBy(sample).agg(F.count("*").alias("reads"))
    found = counts.groupBy(sample).agg(F.sum("n").alias("mapped"), F.count_if(F.col("n") > 0).alias("detected"), F.count_if(F.col("n") >= least).alias("qualified"))
    return total.join(found, sample, "left").fillna(0, ["mapped", "detected", "qualified"])


def require_sites(counts: DataFrame, sites: DataFrame, site: str = "site_id") -> DataFrame:
    """counts with the columns of their site; running it fails where a counted site is not on the list.

    A site that is listed twice fails too: each count keeps one row.
    """
    once = sites.groupBy(site).agg(*[F.first(c).alias(c) for c in sites.columns if c != site], F.count("*").alias("_listed"))
    joined = counts.join(once, site, "left")
    fault = F.concat(F.when(F.col("_listed").isNull(), "no such site: ").otherwise("site listed twice: "), F.coalesce(F.col(site).cast("string"), F.lit("null")))
    return joined.where(F.when(F.col("_listed") == 1, F.lit(True)).otherwise(F.raise_error(fault))).drop("_listed")


def depth_max(counts: DataFrame, share: float = 0.02, how: str = "mean", sample: str = "sample") -> DataFrame:
    """Mean or median of the top ceil(sites * share) counts of each sample, one at least.

    Counts are grouped by value first: the ranking runs over distinct counts, not over sites.
    """
    by_value = counts.groupBy(sample, "n").agg(F.count("*").alias("sites"))
    w = Window.partitionBy(sample)
    above = F.sum("sites").over(w.orderBy(F.col("n").desc())) - F.col("sites")
    ranked = by_value.withColumns({"_top": F.greatest(F.lit(1), F.ceil(F.sum("sites").over(w) * share)), "_above": above})
    kept = ranked.withColumn("_take", F.least(F.col("sites"), F.col("_top") - F.col("_above"))).where("_take > 0")
    if how == "mean":
        return kept.groupBy(sample).agg((F.sum(F.col("n") * F.col("_take")) / F.sum("_take")).alias("depth_max"))
    if how != "median":
        raise ValueError(f"unknown way {how!r}")
    return kept.groupBy(sample).agg(F.expr("percentile(n, 0.5, _take)").alias("depth_max"))


def metrics(counts: DataFrame, least: int = 3, share: float = 0.02, how: str = "mean", sample: str = "sample") -> DataFrame:
    """Counts with RPM (per million of the sample's counts) and M-index; null below ``least``."""
    df = with_totals(counts, [sample], _total=F.sum("n")).join(depth_max(counts, share, how, sample), sample)
    enough = F.col("n") >= least
    return df.withColumns(
        {
            "rpm": F.when(enough & (F.col("_total") > 0), F.col("n") / F.col("_total") * 1e6),
            "m_index": F.when(enough & (F.col("depth_max") > 1), F.ln("n") / F.ln("depth_max")),
        }
    ).drop("_total")


def matrix(counts: DataFrame, samples: list[str], least: int = 3, site: str = "sequence", sample: str = "sample") -> DataFrame:
    """Sites by samples, missing 0; only sites with ``least`` reads in a sample."""
    wide = counts.groupBy(site).pivot(sample, samples).agg(F.sum("n")).fillna(0)
    return wide.where(F.greatest(*[F.col(f"`{s}`") for s in samples], F.lit(0)) >= least)


def named_sites(sites: DataFrame, *order: str) -> DataFrame:
    """Sites with their number and name in the given order."""
    return numbered(sites, *order, name="site_no").withColumn("site_id", S.site_name(F.col("site_no")))


def same_structure(a: dict, b: dict, keys: tuple[str, ...] = ("enzyme", "context", "motif", "start", "left", "right", "shift", "both")) -> None:
    """Error where two run configurations differ in the read structure."""
    if wrong := [k for k in keys if a.get(k) != b.get(k)]:
        raise ValueError(f"the runs differ in {wrong}")
