"""Column functions on sequences, qualities, read ids and names (survey C1-C3, C5, C7-C9, C17, C18, C26, C27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(seq: Column) -> Column:
    """Reverse complement of upper-case IUPAC letters."""
    return F.reverse(F.translate(seq, "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"))


def canonical_tag(tag: Column) -> Column:
    """The smaller of a tag and its reverse complement."""
    return F.least(tag, reverse_complement(tag))


def canonical_read_id(header: Column) -> Column:
    """Blanks around and leading @ and > removed, first token, one final /1 or /2 removed; null if nothing is left."""
    key = F.regexp_replace(F.regexp_extract(header, r"\A[\h\v]*+[@>]*+[\h\v]*+([^\h\v]+)", 1), r"/[12]\z", "")
    return F.when(key != "", key)


def species_name(name: Column) -> Column:
    """Trimmed, white space to one underscore, underscores squeezed; null if nothing is left."""
    value = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\A\s+|\s+\z", ""), r"\s+", "_"), "_+", "_")
    return F.when(value != "", value)


def merged_name(species: Column) -> Column:
    """A species name without its sub-species suffix (last part, where the name ends in A-Z)."""
    return F.when(species.rlike("[A-Z]$"), F.regexp_replace(species, "_[^_]*$", "")).otherwise(species)


def shard_boundary(number: Column, size: int) -> Column:
    """Upper bound of the shard that holds an id."""
    return ((F.floor(number / size) + 1) * size).cast("long")


def genome_number(number: Column) -> Column:
    """Eight digits at least."""
    return F.format_string("%08d", number)


def only_acgt(seq: Column) -> Column:
    """No other letters than A, C, G, T in either case."""
    return seq.rlike(r"\A[ACGTacgt]+\z")


def n_within(seq: Column, limit: float) -> Column:
    """At most ``limit`` N letters, or that share of them where 0 < limit < 1; empty never passes."""
    n = F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit("")))
    return (F.length(seq) > 0) & ((n / F.length(seq) if 0 < limit < 1 else n) <= limit)


def bases_above(qual: Column, quality: int, offset: int = 33) -> Column:
    """How many bases have a quality of more than ``quality`` (C17).

    The letters of lower or equal quality are deleted by one pass; nothing is split.
    """
    low = "".join(chr(c) for c in range(33, min(quality + offset, 126) + 1))
    return F.length(F.translate(qual, low, ""))


def quality_passes(qual: Column, quality: int, percent: float, offset: int = 33) -> Column:
    """C17: more than ``quality`` on at least ``percent`` % of the bases; empty never passes."""
    return (F.length(qual) > 0) & (bases_above(qual, quality, offset) * 100 >= F.length(qual) * percent)


def first_groups(seq: Column, pattern: str) -> Column:
    """Group 1 of each match of a pattern."""
    return F.regexp_extract_all(seq, F.lit(pattern), F.lit(1))


def overlapping(seq: Column, pattern: str) -> Column:
    """All hits of a pattern, overlapping ones too."""
    return F.regexp_extract_all(seq, F.lit(f"(?=({pattern}))"), F.lit(1))


def safe_share(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def first_bases(text: Column, n: int = 50) -> Column:
    """The first ``n`` letters of a sequence or a quality."""
    return F.substring(text, 1, n)


def tag_key(genome: Column, copies: Column) -> Column:
    """Eight digits of the genome and four at least of the copies."""
    return F.concat(F.format_string("%08d", genome), F.format_string("%04d", copies))


def key_genome(key: Column) -> Column:
    """C10."""
    return F.substring(key, 1, 8).cast("long")


def key_copies(key: Column) -> Column:
    """C10."""
    return F.substr(key, F.lit(9)).cast("long")


def site_name(number: Column) -> Column:
    """``site`` and nine digits."""
    return F.format_string("site%09d", number)


def site_number(name: Column) -> Column:
    """The number of a site name; null for other text."""
    digits = F.regexp_extract(name, r"^site(\d+)$", 1)
    return F.when(digits != "", digits).cast("long")


def safe_name(text: Column) -> Column:
    """Letters, digits, dot, dash and underscore; runs of others as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def plain_file_name(path: Column) -> Column:
    """The last part of a path without read-file suffixes."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.(?:f(?:ast)?q|fa(?:sta)?|fna)(?:\.gz)?$", "")
