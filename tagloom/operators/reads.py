"""Read quality control, pairing, merging and demultiplexing (survey E1-E4, F6, F7, F19, F23, G16, G18)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.session import extended


def with_status(reads: DataFrame, quality: int = 20, percent: float = 80, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """``status`` tells why a read is rejected, or ``kept``.

    Null or empty sequence or quality: ``empty``. The reasons are tried in this order: empty,
    ambiguous base, low quality.
    """
    status = (
        F.when((F.coalesce(F.length(seq), F.lit(0)) == 0) | (F.coalesce(F.length(qual), F.lit(0)) == 0), "empty")
        .when(~S.only_acgt(F.col(seq)), "ambiguous")
        .when(~S.quality_passes(F.col(qual), quality, percent), "low_quality")
        .otherwise("kept")
    )
    return reads.withColumn("status", status)


def retention(reads: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """Total, kept and retention per key; one aggregate for all counters."""
    return reads.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_if(F.col(status) == "kept").alias("kept"),
        F.count_if(F.col(status) == "ambiguous").alias("ambiguous"), F.count_if(F.col(status) == "low_quality").alias("low_quality"),
        F.count_if(F.col(status) == "empty").alias("empty"),
    ).withColumn("retention", S.safe_share(F.col("kept"), F.col("total")))


def few_bad_bases(qual: Column, quality: int = 10, most: int = 5, offset: int = 33) -> Column:
    """At most ``most`` bases below ``quality``."""
    return F.length(qual) - S.bases_above(qual, quality - 1, offset) <= most


def length_histogram(reads: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """Reads per key and length; null sequences have length null."""
    return reads.groupBy(*keys, F.length(seq).alias("length")).agg(F.count("*").alias("n"))


def pair_reads(forward: DataFrame, reverse: DataFrame, key: str = "read_id", salt: int = 1) -> DataFrame:
    """inner join of both sides on the read id; rows with null ids pair with none.

    Columns but the key get the suffixes _1 and _2. With ``salt`` > 1 a key is spread over so many
    tasks: the first side is dealt out by its content, the second repeated.
    """
    a = forward.where(F.col(key).isNotNull()).select(key, *[F.col(c).alias(f"{c}_1") for c in forward.columns if c != key])
    b = reverse.where(F.col(key).isNotNull()).select(key, *[F.col(c).alias(f"{c}_2") for c in reverse.columns if c != key])
    if salt == 1:
        return a.join(b, key)
    a = a.withColumn("_salt", F.pmod(F.xxhash64(*a.columns), F.lit(salt)))
    b = b.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
    return a.join(b, [key, "_salt"]).drop("_salt")


def pair_counts(forward: DataFrame, reverse: DataFrame, key: str = "read_id") -> DataFrame:
    """F6 without its pairs: how often each id is on either side and how many pairs that makes.

    Both sides are counted before they meet, so no hot id multiplies rows.
    """
    a = forward.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_1"))
    b = reverse.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_2"))
    return a.join(b, key, "full").select(
        key, F.coalesce("n_1", F.lit(0)).alias("n_1"), F.coalesce("n_2", F.lit(0)).alias("n_2"),
        (F.coalesce("n_1", F.lit(0)) * F.coalesce("n_2", F.lit(0))).alias("pairs"),
    )


def require_unique(reads: DataFrame, key: str = "read_id") -> DataFrame:
    """``reads``; running it fails where an id occurs twice."""
    n = F.count("*").over(Window.partitionBy(key))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated read id "), F.col(key)))).otherwise(F.lit(True))
    return reads.withColumn("_n", n).where(F.col(key).isNull() | checked).drop("_n")


def manifest_long(manifest: DataFrame, library: str = "library_id") -> DataFrame:
    """(library, position, sample) of the five tag columns; blanks around names go, null and blank names are none."""
    tags = F.array(*[F.struct(F.lit(i).alias("position"), F.trim(F.col(f"t{i}")).alias("sample")) for i in range(1, 6)])
    return manifest.select(library, F.explode(tags).alias("t")).select(library, "t.position", "t.sample").where("sample <> ''").distinct()


def demultiplex(windows: DataFrame, manifest: DataFrame, library: str = "library_id") -> DataFrame:
    """windows with the sample that the manifest gives for their library and position.

    The manifest is a small table whose size Spark knows; unregistered libraries have no sample and are left out.
    """
    return windows.join(manifest_long(manifest, library), [library, "position"])


_COMPLEMENT = bytes.maketrans(b"ACGTN", b"TGCAN")


def best_overlaps(r1: np.ndarray, r2: np.ndarray, least: int, share: float) -> np.ndarray:
    """Length of the longest overlap of each r1's end with its r2's start that agrees on ``share``; 0 if none.

    Rows of letters of one length a side; r2 already turned to r1's strand. All pairs are tried at once
    for a length, those with an overlap leave.
    """
    out, live = np.zeros(len(r1), np.int32), np.arange(len(r1))
    for n in range(min(r1.shape[1], r2.shape[1]), least - 1, -1):
        same = np.count_nonzero(r1[live, r1.shape[1] - n :] == r2[live, :n], axis=1)
        fits = same >= share * n
        out[live[fits]] = n
        live = live[~fits]
        if not len(live):
            break
    return out


def merge_pairs(pairs: DataFrame, keys: list[str], least: int = 10, share: float = 0.9, shortest: int = 0, longest: int = 10**9) -> DataFrame:
    """(keys, merged, overlap) of pairs with columns seq_1 and seq_2 whose ends overlap.

    Where the reads disagree, the first one's base is kept. Null and empty reads, pairs without an
    overlap and merged reads outside [shortest, longest] are left out.
    """
    schema = extended(pairs.select(*keys), "merged string, overlap int")

    def run(frames):
        for pdf in frames:
            turned = pdf["seq_2"].map(lambda x: x.encode().translate(_COMPLEMENT)[::-1].decode())
            overlap = pd.Series(np.zeros(len(pdf), np.int32), index=pdf.index)
            for _, own in pdf.groupby([pdf["seq_1"].str.len(), turned.str.len()]).groups.items():
                letters = [np.frombuffer("".join(x[own]).encode(), np.uint8).reshape(len(own), -1) for x in (pdf["seq_1"], turned)]
                overlap[own] = best_overlaps(*letters, least, share)
            merged = pd.Series([a + b[n:] for a, b, n in zip(pdf["seq_1"], turned, overlap)], index=pdf.index, dtype=object)
            out = pdf[keys].assign(merged=merged, overlap=overlap)
            yield out[(overlap > 0) & merged.str.len().between(shortest, longest)]

    return pairs.select(*keys, "seq_1", "seq_2").where("length(seq_1) > 0 and length(seq_2) > 0").mapInPandas(run, schema)
