"""Host genotypes from mapped tags (survey C20, D11, D12, E10, F12, F16, G10, G11, H3)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators.approxjoin import best_hits
from tagloom.operators.digest import per_base

BASES = ("A", "C", "G", "T")


def map_tags(tags: DataFrame, references: DataFrame, most: int = 2, sample: str = "sample") -> DataFrame:
    """(sample, ref_seq, read_seq, n) of tags with one best reference tag on either strand.

    ``read_seq`` is turned to the strand of the reference.
    """
    per_tag = tags.groupBy(sample, F.col("tag").alias("query")).agg(F.count("*").alias("n"))
    hits = best_hits(per_tag.select("query"), references.select(F.col("tag").alias("reference")), most, both_strands=True)
    turned = F.when(F.col("strand") == "-", S.reverse_complement(F.col("query"))).otherwise(F.col("query"))
    return per_tag.join(hits, "query").groupBy(sample, F.col("reference").alias("ref_seq"), turned.alias("read_seq")).agg(F.sum("n").alias("n"))


def pileup(mapped: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, ref_seq, pos, A, C, G, T): reads per base; equal tags are exploded once with their number."""
    bases = per_base(mapped, [sample, "ref_seq", "n"], "read_seq")
    return bases.groupBy(sample, "ref_seq", "pos").agg(
        *[F.coalesce(F.sum(F.when(F.col("base") == b, F.col("n"))), F.lit(0)).alias(b) for b in BASES]
    )


def genotypes(piles: DataFrame, least: int = 4, below: int = 500, error: float = 0.01, alpha: float = 0.05) -> DataFrame:
    """C20, H3: adds depth and gt by a likelihood ratio of the two most frequent bases.

    Ties go to the earlier base. Missing (null) where the depth is under ``least`` or reaches
    ``below``, and where the ratio decides for neither.
    """
    threshold = 3.84 if alpha == 0.05 else 5.90
    top = F.array_sort(F.array(*[F.struct((-F.col(b)).alias("minus"), F.lit(b).alias("base")) for b in BASES]))
    n1, n2, a1, a2 = -F.col("_t")[0]["minus"], -F.col("_t")[1]["minus"], F.col("_t")[0]["base"], F.col("_t")[1]["base"]
    ratio = 2 * (n1 * math.log(1 - error * 3 / 4) + n2 * math.log(error / 4) - F.col("depth") * math.log(0.5 - error / 4))
    out = piles.withColumn("_t", top).withColumn("depth", n1 + n2).withColumn("_lrt", ratio)
    usable = (F.col("depth") >= least) & (F.col("depth") < below)
    gt = F.when(usable & (-F.col("_lrt") > threshold), F.concat(F.least(a1, a2), F.greatest(a1, a2))).when(
        usable & (F.col("_lrt") > threshold), F.concat(a1, a1)
    )
    return out.withColumn("gt", gt).drop("_t", "_lrt")


def backbone(references: DataFrame, samples: DataFrame, calls: DataFrame, sample: str = "sample") -> DataFrame:
    """Every place of every reference tag for every sample, ``--`` where no call was made.

    Samples are attached as one array of the sample list, not by a join without a key.
    """
    names = [r[sample] for r in samples.select(sample).distinct().limit(10_001).collect()]
    if len(names) > 10_000:
        raise ValueError("more than 10000 samples: write the calls in long form")
    places = per_base(references.select("tag").distinct().withColumnRenamed("tag", "ref_seq").withColumn("_s", F.col("ref_seq")), ["ref_seq"], "_s")
    every = places.withColumn(sample, F.explode(F.array(*map(F.lit, sorted(names))) if names else F.array().cast("array<string>")))
    return every.join(calls.select(sample, "ref_seq", "pos", "gt"), [sample, "ref_seq", "pos"], "left").fillna("--", ["gt"])


def site_quality(calls: DataFrame, n_samples: int) -> DataFrame:
    """(ref_seq, pos, called, call_rate, maf): least allele frequency, 0 for one allele only."""
    called = calls.where("gt is not null and gt <> '--'")
    alleles = [F.sum((F.substring("gt", 1, 1) == b).cast("int") + (F.substring("gt", 2, 1) == b).cast("int")) for b in BASES]
    agg = called.groupBy("ref_seq", "pos").agg(F.count("*").alias("called"), F.array(*alleles).alias("_n"))
    seen = F.filter("_n", lambda x: x > 0)
    maf = F.when(F.size(seen) >= 2, F.array_min(seen) / (2 * F.col("called"))).otherwise(F.lit(0.0))
    return agg.select("ref_seq", "pos", "called", (F.col("called") / n_samples).alias("call_rate"), maf.alias("maf"))


def good_sites(quality: DataFrame, call_rate: float = 0.8, maf: float = 0.05) -> DataFrame:
    """E10."""
    return quality.where((F.col("call_rate") >= call_rate) & (F.col("maf") >= maf))


def genotype_rows(places: DataFrame, samples: list[str], sample: str = "sample") -> DataFrame:
    """(ref_seq, pos, base, line) with one genotype per sample in the given order, separated by blanks."""
    wide = places.groupBy("ref_seq", "pos", "base").pivot(sample, samples).agg(F.first("gt"))
    return wide.select("ref_seq", "pos", "base", F.concat_ws(" ", "ref_seq", F.col("pos").cast("string"), "base", *[F.coalesce(F.col(f"`{s}`"), F.lit("--")) for s in samples]).alias("line"))


def checked_references(tags: DataFrame) -> DataFrame:
    """Reference tags; running it fails on other letters than ACGT or on several lengths.

    The common length comes from one aggregate, not from comparing rows.
    """
    facts = tags.agg(F.min(F.length("tag")).alias("_low"), F.max(F.length("tag")).alias("_high")).first()
    if facts["_low"] != facts["_high"]:
        raise ValueError(f"reference tags of {facts['_low']} to {facts['_high']} bases")
    bad = F.raise_error(F.concat(F.lit("not ACGT: "), F.col("tag")))
    return tags.where(F.when(F.col("tag").rlike("^[ACGT]+$"), F.lit(True)).otherwise(bad))
