"""Manifests, wide matrices, metadata and classifier reports as validated DataFrames (survey A10-A21, A30)."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SAMPLE_ID = r"^[A-Za-z0-9._-]+$"


def _check(df: DataFrame, bad, what: str) -> DataFrame:
    """``df``; fails with one offending row named if any row is ``bad``."""
    row = df.where(bad).limit(1).collect()
    if row:
        raise ValueError(f"{what}: {row[0].asDict()}")
    return df


def _no_repeats(df: DataFrame, key: str) -> DataFrame:
    twice = df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"repeated {key}: {twice[0][key]}")
    return df


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """Tab-separated text with a header; all columns strings, a leading # or byte order mark of the header removed."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    df = df.toDF(*[c.lstrip("﻿").lstrip("#") for c in df.columns])
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks the columns {missing}")
    return df


def profiling_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A10: (sample, files) of a headless manifest with one or two files a sample; # starts a comment."""
    parts = F.filter(F.split("value", "\t"), lambda x: x != "")
    rows = spark.read.text(path).where("trim(value) <> '' and value not like '#%'").select(parts.alias("p"))
    _check(rows, ~F.size("p").isin(2, 3), "a sample needs one or two files")
    return _no_repeats(rows.select(F.col("p")[0].alias("sample"), F.slice("p", 2, 2).alias("files")), "sample")


def sample_sheet(spark: SparkSession, path: str, files: tuple[str, ...] = ("read1", "read2")) -> DataFrame:
    """(sample_id, files) with valid unique ids; files all compressed or all plain."""
    df = read_tsv(spark, path, ("sample_id", *files))
    _check(df, ~F.col("sample_id").rlike(SAMPLE_ID) | F.col("sample_id").isNull(), "invalid sample id")
    packed = [F.col(c).endswith(".gz") for c in files]
    mixed = F.lit(False)
    for p in packed[1:]:
        mixed = mixed | (p != packed[0])
    return _no_repeats(_check(df, mixed, "compressed and plain files in one sample"), "sample_id")


def serial_manifest(spark: SparkSession, path: str) -> DataFrame:
    """library_id, r1, r2, t1..t5."""
    df = read_tsv(spark, path, ("library_id", "r1", "r2", "t1", "t2", "t3", "t4", "t5"))
    if "enzyme" in df.columns:
        raise ValueError("the enzyme is no column of a serial manifest")
    return _no_repeats(df, "library_id")


def genome_manifest(spark: SparkSession, path: str) -> DataFrame:
    """source_id, lineage of seven ranks, genome_path (the last column), extra columns between as an array."""
    p = F.split("value", "\t")
    rows = spark.read.text(path).where("trim(value) <> '' and value not like '#%' and value not like 'source_id\t%'").select(p.alias("p"))
    _check(rows, F.size("p") < 9, "a genome needs nine columns")
    names = ("source_id", "kingdom", "phylum", "tax_class", "tax_order", "family", "genus", "species")
    df = rows.select(*[F.trim(F.col("p")[i]).alias(n) for i, n in enumerate(names)], F.expr("slice(p, 9, size(p) - 9)").alias("extra"), F.element_at("p", -1).alias("genome_path"))
    _check(df, F.col("species").isin("", "NA", "N/A", "-"), "a genome without species")
    return _no_repeats(df, "source_id")


def id_map(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, genome_id) with eight digits, unique on both sides; the header is optional."""
    p = F.split("value", "\t")
    df = spark.read.text(path).select(p[0].alias("source_id"), p[1].alias("genome_id")).where("source_id not in ('source_id', '#source_id') and trim(source_id) <> ''")
    _check(df, ~F.col("genome_id").rlike(r"^\d{8}$") | F.col("genome_id").isNull(), "not eight digits")
    return _no_repeats(_no_repeats(df, "source_id"), "genome_id")


def wide_matrix(spark: SparkSession, path: str, row: str, lineage: tuple[str, ...] = (), most: float | None = None, key: str = "sample") -> DataFrame:
    """A wide matrix as (row, sample, value): finite, not negative, at most ``most`` (1e-9 above is let pass).

    Lines are read whole and cut into fields, so the samples are no columns of a plan; one without a name is null.
    """
    whole = {"sep": "\x01", "header": True, "quote": ""}
    head = spark.read.options(**whole).csv(path).columns
    names = head[0].lstrip("\ufeff").lstrip("#").split("\t") if len(head) == 1 else []
    if row not in names:
        raise ValueError(f"{path} lacks the columns {[row]}")
    at = [k for k, n in enumerate(names) if n != row and n not in lineage]
    if len({names[k] for k in at}) < len(at):
        raise ValueError(f"{path} has a column twice")
    fields = F.split("value", "\t", -1)
    parts = spark.read.options(**whole).schema("value string").csv(path).select(fields.alias("p"))
    lacking = F.array_repeat(F.lit(None).cast("string"), len(names) - F.size("p"))
    parts = parts.select(F.when(F.size("p") < len(names), F.concat("p", lacking)).otherwise(F.col("p")).alias("p"))
    runs = [(a, b) for a, b in zip([k for k in at if k - 1 not in at], [k for k in at if k + 1 not in at], strict=True)]
    texts = F.concat(*[F.slice("p", a + 1, b - a + 1) for a, b in runs]) if runs else F.array().cast("array<string>")
    heads = F.split(F.lit("\t".join(names[k] for k in at)), "\t", -1)  # one literal, however many samples there are
    long = parts.select(F.nullif(F.col("p")[names.index(row)], F.lit("")).alias(row), F.posexplode(texts).alias("k", "text"))
    long = long.select(row, F.nullif(heads[F.col("k")], F.lit("")).alias(key), "text", F.col("text").try_cast("double").alias("value"))
    good = (F.col("value") >= 0) & (F.col("value") < float("inf"))
    if most is not None:
        good = good & (F.col("value") <= most + 1e-9)
    return _check(long, ~F.coalesce(good, F.lit(False)), "invalid value").drop("text")


def site_table(spark: SparkSession, path: str) -> DataFrame:
    """(site_id, seqname, start_1based, strand, sequence, copy_number) of a list of sites; copy_number null where NA."""
    df = read_tsv(spark, path, ("site_id", "seqname", "start_1based", "strand", "sequence", "copy_number"))
    return df.withColumns({"start_1based": F.col("start_1based").cast("long"), "copy_number": F.expr("try_cast(copy_number as bigint)")})


def count_table(spark: SparkSession, path: str) -> DataFrame:
    """(site_id, raw_count) of a sample's counts; another header or a count that is no number is an error."""
    df = read_tsv(spark, path)
    if df.columns != ["site_id", "raw_count"]:
        raise ValueError(f"{path} has the columns {df.columns}")
    return _check(df.withColumn("raw_count", F.expr("try_cast(raw_count as bigint)")), F.col("raw_count").isNull(), "no count")


def profile_table(spark: SparkSession, path: str, first_metric: str = "theoretical") -> DataFrame:
    """A sample profile with its lineage, the columns before the first metric, as one array and one key; metrics as numbers."""
    df = read_tsv(spark, path, (first_metric,))
    ranks, metrics = df.columns[: df.columns.index(first_metric)], df.columns[df.columns.index(first_metric) :]
    lineage = [F.col(f"`{c}`") for c in ranks]
    return df.select(
        F.array(*lineage).alias("lineage"), F.concat_ws("\t", *lineage).alias("lineage_key"), *lineage, *[F.expr(f"try_cast(`{c}` as double)").alias(c) for c in metrics]
    )


def quant_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(sample, ch, ve, vd, vl) of whitespace-separated text; columns in any case, all positive, volumes optional."""
    lines = spark.read.text(path).where("trim(value) <> '' and value not like '#%'")
    header = lines.where(F.lower("value").rlike(r"^\s*sample_id\b")).first()
    if header is None:
        raise ValueError("the metadata has no header")
    names = header[0].lower().split()
    p = F.split(F.trim("value"), r"\s+")
    df = lines.where(~F.lower("value").rlike(r"^\s*sample_id\b")).select(
        p[0].alias("sample"),
        *[(F.expr(f"try_cast(split(trim(value), '\\\\s+')[{names.index(c)}] as double)") if c in names else F.lit(None).cast("double")).alias(c) for c in ("ch", "ve", "vd", "vl")],
    )
    bad = F.col("ch").isNull() | (F.least("ch", *[F.coalesce(c, F.lit(1.0)) for c in ("ve", "vd", "vl")]) <= 0)
    return _no_repeats(_check(df, bad, "not positive"), "sample")


def kraken_report(spark: SparkSession, paths: str | list[str], by_folder: bool = False) -> DataFrame:
    """(sample, pct, clade, direct, rank, taxid, name) of six-column reports; the sample is the file's name, or ``sample=`` of its folder."""
    schema = "pct double, clade long, direct long, rank string, taxid string, name string"
    df = spark.read.option("sep", "\t").option("quote", "").schema(f"{schema}, sample string" if by_folder else schema).csv(paths)
    if not by_folder:
        df = df.withColumn("sample", F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1))
    df = df.withColumn("name", F.trim("name"))
    twice = df.where("rank = 'R'").groupBy("sample").agg(F.count("*").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two root rows in the report of {twice[0]['sample']}")
    return df


def mates(folder: str) -> dict[str, tuple[str, str]]:
    """Sample -> (R1, R2) of the read files under a folder; a missing or doubled mate is an error."""
    found: dict[str, dict[str, list[str]]] = {}
    for p in sorted(Path(folder).rglob("*")):
        if m := re.fullmatch(r"(.+?)[._]R?([12])(?:_001)?\.f(?:ast)?q(?:\.gz)?", p.name):
            found.setdefault(m[1], {}).setdefault(m[2], []).append(str(p))
    for name, by in found.items():
        if sorted(by) != ["1", "2"] or any(len(x) != 1 for x in by.values()):
            raise ValueError(f"{name} has not one file for each mate")
    return {name: (by["1"][0], by["2"][0]) for name, by in found.items()}
