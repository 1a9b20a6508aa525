"""Absolute counts, classifier reports and RNA/DNA ratios (survey A21, C24, C25, E8, E14, F8-F11, G13, G17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.session import with_totals

STATUSES = ("both", "DNA_only", "RNA_only", "missing")


def absolute(abundance: DataFrame, meta: DataFrame, host: str, sample: str = "sample", taxon: str = "taxon", value: str = "abundance", strict: bool = True) -> DataFrame:
    """concentration = ch * share / host share; library cells = concentration * ve * vl / vd.

    Running it fails for a sample without metadata or with a host share that is missing or not
    positive; with ``strict`` off such samples have no result.
    """
    rows = with_totals(abundance, [sample], _host=F.sum(F.when(F.col(taxon) == host, F.col(value)))).join(meta.withColumn("_known", F.lit(True)), sample, "left")
    fault = F.when(F.col("_known").isNull(), "no metadata for ").when(~F.coalesce(F.col("_host") > 0, F.lit(False)), "no host share in ")
    ok = fault.isNull()
    rows = rows.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(fault, F.col(sample))))) if strict else rows.where(ok)
    concentration = F.col("ch") * F.col(value) / F.col("_host")
    return rows.select(
        sample, taxon, value, concentration.alias("concentration"), (concentration * F.col("ve") * F.col("vl") / F.col("vd")).alias("library_cells")
    )


def kraken_species(report: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, species, reads): clade counts of rank S, names normalised."""
    return report.where("rank = 'S'").withColumn("species", S.species_name(F.col("name"))).where("species is not null").groupBy(
        sample, "species"
    ).agg(F.sum("clade").alias("reads"))


def kraken_totals(report: DataFrame, sample: str = "sample") -> DataFrame:
    """Classified (rank R), unclassified (U), species reads, detected species and shares of each sample."""
    def total(rank: str):
        return F.coalesce(F.sum(F.when(F.col("rank") == rank, F.col("clade"))), F.lit(0))

    return report.groupBy(sample).agg(
        total("R").alias("classified"), total("U").alias("unclassified"), total("S").alias("species_reads"),
        F.count_if((F.col("rank") == "S") & (F.col("clade") > 0)).alias("detected"),
    ).withColumns(
        {
            "classified_share": S.safe_share(F.col("classified"), F.col("classified") + F.col("unclassified")),
            "species_share": S.safe_share(F.col("species_reads"), F.col("classified")),
        }
    )


def rna_dna(dna: DataFrame, rna: DataFrame, dna_least: float = 0.0, rna_least: float = 0.0, sample: str = "sample", species: str = "species") -> DataFrame:
    """Ratio, log2 and status per species and shared sample.

    ``dna``, ``rna``: (sample, species, value), one row per pair. Species of one side count 0 on the
    other; a species that neither side holds in a sample is ``missing`` there: it has a row only
    where a table writes its 0, and ``status_counts`` counts all of them.
    Ratio is null without DNA, log2 null without a positive ratio. Thresholds of 0 keep every row.
    """
    shared = dna.select(sample).distinct().join(rna.select(sample).distinct(), sample, "left_semi")
    joined = dna.select(sample, species, F.col("value").alias("dna")).join(
        rna.select(sample, species, F.col("value").alias("rna")), [sample, species], "full"
    ).fillna(0.0, ["dna", "rna"]).join(shared, sample, "left_semi")
    if dna_least > 0 or rna_least > 0:
        joined = joined.where((F.col("dna") >= dna_least) & (F.col("rna") >= rna_least))
    ratio = F.when(F.col("dna") > 0, F.col("rna") / F.col("dna"))
    status = (
        F.when((F.col("dna") > 0) & (F.col("rna") > 0), "both").when(F.col("dna") > 0, "DNA_only")
        .when(F.col("rna") > 0, "RNA_only").otherwise("missing")
    )
    return joined.withColumn("ratio", ratio).withColumns({"log2_ratio": F.when(F.col("ratio") > 0, F.log2("ratio")), "status": status})


def status_counts(ratios: DataFrame, n_species: int, sample: str = "sample") -> DataFrame:
    """Species of each status per sample; those without a row are ``missing`` of ``n_species``."""
    counts = ratios.groupBy(sample).agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES[:3]])
    return counts.withColumn("missing", F.lit(n_species) - F.col("both") - F.col("DNA_only") - F.col("RNA_only"))


def share_sums(df: DataFrame, sample: str = "sample", value: str = "value", tolerance: float = 1e-6) -> DataFrame:
    """Samples whose shares don't add up to 1."""
    return df.groupBy(sample).agg(F.sum(value).alias("total")).where(F.abs(F.col("total") - 1) > tolerance)
