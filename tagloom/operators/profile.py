"""Profiles of samples by taxon-unique tags (survey G1-G3, C21-C23, C28, C29, E5-E13, G6, G8, G9, K1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators.refdb import unique_stats, unique_tags
from tagloom.session import with_totals


def tag_counts(tags: DataFrame, sample: str = "sample") -> DataFrame:
    """G1: (sample, tag, n); each tag counts for itself and for its reverse complement.

    A tag that is its own reverse complement counts twice. Tags are counted before they are
    doubled, so the explode runs on distinct tags.
    """
    once = tags.groupBy(sample, "tag").agg(F.count("*").alias("n"))
    both = once.select(sample, F.explode(F.array(F.col("tag"), S.reverse_complement(F.col("tag")))).alias("tag"), "n")
    return both.groupBy(sample, "tag").agg(F.sum("n").alias("n"))


def _metrics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "percent": F.col("seq_tags") / F.col("theoretical"),
            "density": F.col("seq_reads") / F.col("theoretical"),
            "depth": F.col("seq_reads") / F.col("seq_tags"),
            "g_score": F.sqrt(F.col("seq_tags") * F.col("seq_reads").cast("double")),
        }
    )


def profile(counts: DataFrame, unique: DataFrame, stats: DataFrame, sample: str = "sample", scope: tuple[str, ...] = ()) -> DataFrame:
    """(sample, taxon, theoretical, seq_tags, seq_reads, percent, density, depth, g_score).

    A tag of several genomes of a taxon counts once. ``scope`` holds the columns besides the tag
    by which counts and unique tags belong together (the sample, for databases of one sample).
    """
    per_taxon = unique.select(*scope, "tag", "taxon").distinct()
    hits = counts.join(per_taxon, [*scope, "tag"]).groupBy(sample, "taxon").agg(
        F.count("*").alias("seq_tags"), F.sum("n").alias("seq_reads")
    )
    theory = stats.select(*scope, "taxon", F.col("taxon_mean").alias("theoretical")).distinct()
    return _metrics(hits.join(theory, [*scope, "taxon"])).select(
        sample, "taxon", "theoretical", "seq_tags", "seq_reads", "percent", "density", "depth", "g_score"
    )


def genomes_detected(counts: DataFrame, unique: DataFrame, stats: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, taxon, genome_id, theoretical, detected, share)."""
    hits = counts.join(unique.select("tag", "genome_id", "taxon").distinct(), "tag").groupBy(sample, "taxon", "genome_id").agg(
        F.count("*").alias("detected")
    )
    return hits.join(stats.select("genome_id", F.col("genome_tags").alias("theoretical")), "genome_id").select(
        sample, "taxon", "genome_id", "theoretical", "detected", (F.col("detected") / F.col("theoretical")).alias("share")
    )


def predict(prof: DataFrame, threshold: float) -> DataFrame:
    """E5: a flag by G-score, inclusive; no row is dropped."""
    return prof.withColumn("pred", (F.col("g_score") >= threshold).cast("int"))


def features(prof: DataFrame, sample: str = "sample", least: float = 5.0) -> DataFrame:
    """Logarithms of coverage, G-score, depth and share of reads, where the G-score exceeds ``least``."""
    return with_totals(prof, [sample], _total=F.sum("seq_reads")).where(F.col("g_score") > least).select(
        sample, "taxon", F.ln("percent").alias("ln_coverage"), F.ln("g_score").alias("ln_g"), F.ln("depth").alias("ln_depth"),
        F.ln(F.col("depth") * F.col("theoretical") / F.col("_total")).alias("ln_share"),
    )


def sample_database(master: DataFrame, predicted: DataFrame, sample: str = "sample") -> tuple[DataFrame, DataFrame]:
    """Unique tags and stats of each sample among the taxa predicted for it, all copies.

    ``predicted``: (sample, taxon) of the positive calls.
    """
    scoped = master.join(predicted.select(sample, "taxon").distinct(), "taxon")
    unique = unique_tags(scoped, single_copy=False, scope=(sample,))
    return unique, unique_stats(unique, single_copy=False, scope=(sample,))


def share_of_sample(df: DataFrame, value: str, sample: str = "sample", out: str = "share") -> DataFrame:
    """Value over the sample's total; null where the total is 0."""
    return with_totals(df, [sample], _total=F.sum(value)).withColumn(out, F.when(F.col("_total") > 0, F.col(value) / F.col("_total"))).drop("_total")


def abundance(quantified: DataFrame, sample: str = "sample") -> DataFrame:
    """(sample, taxon, abundance) by density."""
    return share_of_sample(quantified, "density", sample, "abundance").select(sample, "taxon", "abundance")


def clip_coverage(df: DataFrame, value: str = "percent") -> DataFrame:
    """At most 1."""
    return df.withColumn("coverage", F.least(F.col(value), F.lit(1.0)))


def rescale_without_host(df: DataFrame, host: str, value: str = "abundance", sample: str = "sample", taxon: str = "taxon") -> DataFrame:
    """Rows but the host's, times 1 / (1 - host share); 0 where the host is everything."""
    h = F.coalesce(F.max(F.when(F.col(taxon) == host, F.col(value))), F.lit(0.0))
    factor = F.when(F.col("_h") < 1, 1 / (1 - F.col("_h"))).otherwise(F.lit(0.0))
    return with_totals(df, [sample], _h=h).where(F.col(taxon) != host).withColumn(value, F.col(value) * factor).drop("_h")


def split_groups(df: DataFrame, is_first, value: str, sample: str = "sample", names: tuple[str, str] = ("micro", "macro")) -> DataFrame:
    """Rows by a predicate, each part brought to shares of its own total in the sample."""
    tagged = df.withColumn("part", F.when(is_first, names[0]).otherwise(names[1]))
    return with_totals(tagged, [sample, "part"], _total=F.sum(value)).withColumn("share", F.when(F.col("_total") > 0, F.col(value) / F.col("_total"))).drop("_total")


def wide(df: DataFrame, rows: str, columns: str, value: str, names: list[str]) -> DataFrame:
    """One column per name of the given list, missing 0, rows of zeros only left out.

    The names are given, so no job is spent on finding them.
    """
    table = df.groupBy(rows).pivot(columns, names).agg(F.sum(value)).fillna(0.0)
    return table.where(F.greatest(*[F.col(f"`{n}`") for n in names], F.lit(0.0)) > 0) if names else table


def long(df: DataFrame, rows: str, columns: str, value: str) -> DataFrame:
    """A wide matrix as (row, column, value)."""
    return df.unpivot(rows, [F.col(f"`{c}`") for c in df.columns if c != rows], columns, value)


def merge_subspecies(features_df: DataFrame, sample: str = "sample", species: str = "species") -> DataFrame:
    """Tags and reads of sub-species added up under their common name, with the G-score anew."""
    return features_df.withColumn("merged", S.merged_name(F.col(species))).groupBy(sample, "merged").agg(
        F.sum("seq_tags").alias("seq_tags"), F.sum("seq_reads").alias("seq_reads")
    ).withColumn("g_score", F.sqrt(F.col("seq_tags") * F.col("seq_reads").cast("double")))


def presence(predicted: DataFrame, keys: list[str]) -> DataFrame:
    """1 where any call of the keys is positive."""
    return predicted.groupBy(*keys).agg(F.least(F.sum("pred"), F.lit(1)).cast("int").alias("present"))
