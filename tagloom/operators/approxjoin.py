"""Joins within a Hamming distance by shared segments (survey F15-F17).

Two sequences of equal length with at most d differences agree on one of d + 1 segments. So both
sides are exploded into (length, segment number, segment), joined on that and verified; a pair comes
out of the first segment on which it agrees, so no pair is made twice. A segment that many references
share (low complexity, repeats) would be a hot key with all its pairs in one task: there the rest of
the sequence is cut into d + 1 segments again, one of which a pair must share as well. Distinct
sequences meet, not rows: copies are joined back by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.session import checkpointed


def hamming(a: Column, b: Column) -> Column:
    """Differing places of two sequences of equal length, letter by letter."""
    return F.aggregate(F.sequence(F.lit(1), F.length(a)), F.lit(0), lambda n, i: n + (F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))).cast("int"))


def _codes(seq: Column) -> Column:
    """Two longs of two bits a base for up to 62 bases of ACGT; null for other sequences."""
    half = [F.conv(F.concat(F.lit("0"), F.translate(F.substring(seq, at, 31), "ACGT", "0123")), 4, 10).cast("long") for at in (1, 32)]
    return F.when(seq.rlike(r"\A[ACGT]{1,62}\z"), F.struct(half[0].alias("x"), half[1].alias("y")))


def _code_distance(a: Column, b: Column) -> Column:
    """Differing bases of two pairs of longs: whole-stage codegen, no lambda."""
    def differing(name: str) -> Column:
        x = a[name].bitwiseXOR(b[name])
        return F.bit_count(x.bitwiseOR(F.shiftright(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return differing("x") + differing("y")


def _size(text: Column, parts: int) -> Column:
    return F.ceil(F.length(text) / parts).cast("int")


def _segments(text: Column, parts: int) -> Column:
    size = _size(text, parts)
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(i.alias("no"), F.substr(text, i * size + 1, size).alias("part")))


def _first_shared(a: Column, b: Column, no: Column, parts: int) -> Column:
    """Whether no segment before the given one is the same in two sequences of equal length."""
    size, out = _size(a, parts), F.lit(True)
    for j in range(parts - 1):
        out = out & ((no <= j) | (F.substr(a, F.lit(j) * size + 1, size) != F.substr(b, F.lit(j) * size + 1, size)))
    return out


def _rest(text: Column, no: Column, parts: int) -> Column:
    """A sequence without one of its segments."""
    size = _size(text, parts)
    return F.concat(F.substr(text, F.lit(1), no * size), F.substr(text, (no + 1) * size + 1))


#: references that share a segment from which on it is split further
HOT = 1000
#: hot segments that may travel as a broadcast
MANY_HOT = 100_000


def hamming_pairs(queries: DataFrame, references: DataFrame, most: int, both_strands: bool = False, hot: int = HOT) -> DataFrame:
    """(query, reference, strand, distance) of the distinct sequences in columns ``query`` and ``reference``.

    Null sequences match nothing. With ``both_strands`` the reverse complement of the query is tried too.
    """
    parts = most + 1
    q = queries.where(F.col("query").isNotNull()).select("query").distinct().select("query", F.col("query").alias("_text"), F.lit("+").alias("strand"))
    if both_strands:
        q = q.unionByName(q.select("query", S.reverse_complement(F.col("query")).alias("_text"), F.lit("-").alias("strand")))
    r = references.where(F.col("reference").isNotNull()).select("reference").distinct()

    def exploded(df: DataFrame, text: str, code: str) -> DataFrame:
        return df.select(*df.columns, _codes(F.col(text)).alias(code), F.length(text).alias("n"), F.explode(_segments(F.col(text), parts)).alias("s")).select("*", "s.*").drop("s")

    qs, rs = exploded(q, "_text", "_a"), exploded(r, "reference", "_b")
    on, once = ["n", "no", "part"], _first_shared(F.col("_text"), F.col("reference"), F.col("no"), parts)
    if most:
        crowded = checkpointed(rs.groupBy(*on).agg(F.count("*").alias("_refs")).where(F.col("_refs") > hot).select(*on, F.lit(True).alias("_hot")))
        if n_hot := crowded.limit(MANY_HOT + 1).count():
            crowded = F.broadcast(crowded) if n_hot <= MANY_HOT else crowded

            def split(df: DataFrame, text: str) -> DataFrame:
                none = F.array(F.struct(F.lit(-1).alias("no"), F.lit("").alias("part")))
                inner = F.when(F.col("_hot"), _segments(_rest(F.col(text), F.col("no"), parts), parts)).otherwise(none)
                return df.join(crowded, on, "left").withColumn("_s", F.explode(inner)).select("*", F.col("_s.no").alias("no2"), F.col("_s.part").alias("part2")).drop("_s", "_hot")

            qs, rs, on = split(qs, "_text"), split(rs, "reference"), [*on, "no2", "part2"]
            rests = [_rest(F.col(c), F.col("no"), parts) for c in ("_text", "reference")]
            once = once & ((F.col("no2") < 0) | _first_shared(*rests, F.col("no2"), parts))
    distance = F.coalesce(_code_distance(F.col("_a"), F.col("_b")), hamming(F.col("_text"), F.col("reference")))
    close = qs.join(rs, on).withColumn("distance", distance).where((F.col("distance") <= most) & once)
    return close.select("query", "reference", "strand", "distance")


def best_hits(queries: DataFrame, references: DataFrame, most: int, both_strands: bool = False) -> DataFrame:
    """``best_unique`` of ``hamming_pairs``; only queries that equal no reference meet others by segments.

    An equal reference is the best stratum, so further ones can't change what is kept.
    """
    equal = hamming_pairs(queries, references, 0, both_strands)
    rest = queries.join(equal.select("query"), "query", "left_anti")
    return best_unique(equal.unionByName(hamming_pairs(rest, references, most, both_strands)))


def best_unique(pairs: DataFrame) -> DataFrame:
    """One row per query whose best stratum holds a single reference; others are suppressed.

    A hit on either strand counts. A reference hit on both strands at its best is one hit, taken on
    the first. Aggregates only, no window and no join of the pairs with themselves.
    """
    hits = pairs.groupBy("query", "reference").agg(F.min(F.struct("distance", "strand")).alias("h"))
    strata = hits.groupBy("query", F.col("h.distance").alias("distance")).agg(F.count("*").alias("hits"), F.min(F.struct("reference", "h.strand")).alias("low"))
    best = strata.groupBy("query").agg(F.min(F.struct("distance", "hits", "low")).alias("b")).where("b.hits = 1")
    return best.select("query", F.col("b.low.reference").alias("reference"), F.col("b.low.strand").alias("strand"), F.col("b.distance").alias("distance"))
