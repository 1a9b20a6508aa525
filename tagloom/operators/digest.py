"""In-silico digestion and tag extraction (survey D1-D12).

Hits of a whole contig come from one regex per strand inside whole-stage codegen, anchored at the
first fixed letter of the site. The
second strand is scanned with the mirrored pattern on the same text and only the short hits are
turned round, so no contig is ever reversed.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.enzymes import Enzyme, Motif, motif_regex, reverse_complement
from tagloom.functions import seq as S
from tagloom.session import extended


def digest(df: DataFrame, enzyme: Enzyme, seq: str = "seq", strict_case: bool = False) -> DataFrame:
    """``df`` without its sequence, one row per hit with ``strand`` and ``tag``.

    Null and empty sequences have no hits. ``strict_case`` scans the forward strand as written,
    where lower-case letters match nothing, and the other strand in upper case.
    """
    text, upper = F.col(seq), F.upper(seq)
    hits = [F.transform(S.first_groups(text if strict_case else upper, enzyme.anchored[0]), lambda t: F.struct(F.lit("+").alias("strand"), t.alias("tag")))]
    if not enzyme.palindromic:
        hits.append(
            F.transform(
                S.first_groups(upper, enzyme.anchored[1]),
                lambda t: F.struct(F.lit("-").alias("strand"), S.reverse_complement(t).alias("tag")),
            )
        )
    keep = [c for c in df.columns if c not in (seq, "strand", "tag")]
    return df.select(*keep, F.explode(F.concat(*hits)).alias("_hit")).select(*keep, "_hit.strand", "_hit.tag")


def digest_stats(df: DataFrame, enzyme: Enzyme, key: str, seq: str = "seq") -> DataFrame:
    """Reads, tags and their ratio per key; no explode, the hits are only counted."""
    n = sum((F.regexp_count(F.upper(seq), F.lit(p)) for p in enzyme.anchored), F.lit(0))
    return df.groupBy(key).agg(
        F.count(seq).alias("reads"), F.coalesce(F.sum(F.when(F.col(seq).isNotNull(), n)), F.lit(0)).cast("long").alias("tags")
    ).withColumn("ratio", S.safe_share(F.col("tags"), F.col("reads")))


def genome_tags(genomes: DataFrame, enzyme: Enzyme, keys: list[str], seq: str = "seq") -> DataFrame:
    """(keys, tag, copies); tags of palindromic sites in canonical orientation."""
    hits = digest(genomes.select(*keys, seq), enzyme, seq)
    if enzyme.palindromic:
        hits = hits.withColumn("tag", S.canonical_tag(F.col("tag")))
    return hits.groupBy(*keys, "tag").agg(F.count("*").alias("copies"))


def padded_genome_tags(genomes: DataFrame, enzyme: Enzyme, keys: list[str], seq: str = "seq", width: int = 40) -> DataFrame:
    """D3: the older form of ``genome_tags``: tags as read on either strand, palindromic sites on both, filled with 0 on the left."""
    hits = digest(genomes.select(*keys, seq), enzyme, seq)
    if enzyme.palindromic:
        hits = hits.unionByName(hits.withColumn("tag", S.reverse_complement(F.col("tag"))))
    return hits.groupBy(*keys, F.lpad("tag", width, "0").alias("tag")).agg(F.count("*").alias("copies"))


def first_hit(df: DataFrame, enzyme: Enzyme, seq: str = "seq", qual: str = "qual", read_length: int = 50) -> DataFrame:
    """Leftmost hit of the first pattern that has one, in the first bases; adds tag and tag_qual.

    Reads without a hit are left out.
    """
    head, head_qual = S.first_bases(F.col(seq), read_length), S.first_bases(F.col(qual), read_length)
    tags = [F.regexp_extract(head, f"({p})", 1) for p in enzyme.patterns]
    starts = [F.regexp_instr(head, F.lit(f"({p})")) for p in enzyme.patterns]
    tag, start = F.lit(None).cast("string"), F.lit(None).cast("int")
    for t, s in reversed(list(zip(tags, starts))):
        tag, start = F.when(s > 0, t).otherwise(tag), F.when(s > 0, s).otherwise(start)
    keep = [F.col(c) for c in df.columns if c not in ("tag", "tag_qual")]
    out = df.select(*keep, tag.alias("tag"), start.alias("_start"), head_qual.alias("_qual")).where("tag is not null")
    return out.withColumn("tag_qual", F.col("_qual").substr(F.col("_start"), F.lit(enzyme.length))).drop("_start", "_qual")


def all_hits(windows: DataFrame, enzyme: Enzyme, keys: list[str], policy: str = "unique", seq: str = "seq") -> DataFrame:
    """Hits of both patterns at every start of a short window, without regard to case.

    ``first``: the hit of least (pattern, start). ``unique``: windows with one hit only. ``all``:
    every hit, numbered by (start, pattern). A window is short, so its starts are tried one by one.
    """
    if policy not in ("first", "unique", "all"):
        raise ValueError(f"unknown hit policy {policy!r}")
    text, n = F.upper(seq), enzyme.length
    starts = F.sequence(F.lit(0), F.length(seq) - n)

    def hits(number: int, pattern: str) -> Column:
        found = F.filter(starts, lambda i: text.substr(i + 1, F.lit(n)).rlike(rf"\A{pattern}\z"))
        return F.transform(
            found,
            lambda i: F.struct(i.alias("start"), F.lit(number).alias("pattern"), text.substr(i + 1, F.lit(n)).alias("tag")),
        )

    every = F.when(
        F.length(seq) >= n,
        F.array_sort(F.flatten(F.array(*[hits(i, p) for i, p in enumerate(enzyme.patterns, 1)]))),
    )
    rows = windows.select(*keys, every.alias("_hits"))
    if policy == "unique":
        rows = rows.where(F.size("_hits") == 1)
    elif policy == "first":
        by_pattern = F.array_sort(F.transform("_hits", lambda h: F.struct(h["pattern"], h["start"], h["tag"])))
        best = F.transform(F.slice(by_pattern, 1, 1), lambda h: F.struct(h["start"].alias("start"), h["pattern"].alias("pattern"), h["tag"].alias("tag")))
        rows = rows.withColumn("_hits", best)
    return rows.select(*keys, F.posexplode("_hits").alias("_no", "_hit")).select(
        *keys, (F.col("_no") + 1).alias("hit"), "_hit.start", "_hit.pattern", "_hit.tag"
    )


def split_windows(reads: DataFrame, enzyme: Enzyme, keys: list[str], seq: str = "seq") -> DataFrame:
    """The five inclusive windows of a merged read with a flag where the read ends inside one."""
    parts = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.substring(seq, s + 1, e - s + 1).alias("window"),
                (F.length(seq) <= e).alias("truncated"),
            )
            for i, (s, e) in enumerate(enzyme.windows, 1)
        ]
    )
    return reads.where(F.col(seq).isNotNull()).select(*keys, F.explode(parts).alias("_w")).select(*keys, "_w.position", "_w.window", "_w.truncated")


def cut_reads(contigs: DataFrame, keys: list[str], length: int, seq: str = "seq") -> DataFrame:
    """(keys, part, seq): a contig cut end to end into reads of so many letters, the last one shorter.

    One pass of a pattern, so long contigs cost no more a letter. Null and empty contigs give none.
    """
    parts = F.regexp_extract_all(F.col(seq), F.lit(f"(?s)(.{{1,{length}}})"), 1)
    return contigs.select(*keys, F.posexplode(parts).alias("part", "seq"))


HITS_A_BATCH = 50_000


def positional_hits(contigs: DataFrame, keys: list[str], cores: dict[str, str], left: int = 0, right: int = 0, seq: str = "seq") -> DataFrame:
    """(keys, start, strand, hit): overlapping hits of a core with flanks of fixed length, with their 0-based start.

    The contig is scanned once for each core, from hit to hit; flanks are cut out where they lie on
    the contig. Hits leave in batches, so what a task holds is one contig and one batch.
    """
    scans = [(name, re.compile(f"(?=({core}))")) for name, core in cores.items()]
    columns = [*keys, "start", "strand", "hit"]
    schema = extended(contigs.select(*keys), "start int, strand string, hit string")

    def hits(frames):
        for pdf in frames:
            for *key, text in pdf.itertuples(index=False):
                for name, scan in scans:
                    for m in scan.finditer(text):
                        first, end = m.start() - left, m.end(1) + right
                        if first >= 0 and end <= len(text):
                            yield (*key, first, name, text[first:end])

    def run(frames):
        every = hits(frames)
        while rows := list(islice(every, HITS_A_BATCH)):
            yield pd.DataFrame(rows, columns=columns).astype({"start": "int32"})

    return contigs.select(*keys, seq).where(F.length(seq) > 0).mapInPandas(run, schema)


def dedup_digest(contigs: DataFrame, enzyme: Enzyme, keys: list[str], seq: str = "seq") -> DataFrame:
    """Overlapping hits of both patterns as written, one per (keys, start); later patterns win."""
    hits = positional_hits(contigs, keys, {str(i): p for i, p in enumerate(enzyme.patterns)}, seq=seq)
    return hits.groupBy(*keys, "start").agg(F.max_by("hit", "strand").alias("tag")).withColumn(
        "end", (F.col("start") + enzyme.length).cast("int")
    )


def plain_scan(contigs: DataFrame, enzyme: Enzyme, keys: list[str], seq: str = "seq") -> DataFrame:
    """Non-overlapping hits per pattern, one per end; the later pattern wins.

    Whether a hit overlaps the one before depends on the whole scan, which Spark's regex functions do
    in one pass: the text before each hit is what splits the contig, so a running sum of lengths gives
    the ends. Only lengths and tags are exploded, never the contig.
    """
    text = F.upper(seq)
    scans = []
    for i, p in enumerate(enzyme.patterns):
        tags = F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(1))
        gaps = F.slice(F.transform(F.split(text, p, -1), lambda x: F.length(x)), F.lit(1), F.size(tags))
        hits = F.posexplode(F.arrays_zip(gaps.alias("gap"), tags.alias("tag"))).alias("_no", "_hit")
        scans.append(contigs.withColumn("_contig", F.monotonically_increasing_id()).select(*keys, "_contig", F.lit(i).alias("_pattern"), hits))
    rows = scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])
    end = F.sum(F.col("_hit.gap") + enzyme.length).over(Window.partitionBy(*keys, "_contig", "_pattern").orderBy("_no"))
    ends = rows.select(*keys, "_pattern", end.cast("int").alias("end"), F.col("_hit.tag").alias("tag"))
    return ends.groupBy(*keys, "end").agg(F.max_by("tag", "_pattern").alias("tag"))


def motif_sites(contigs: DataFrame, motif: Motif, keys: list[str], seq: str = "seq") -> DataFrame:
    """(keys, start, strand, sequence) of the sites whose flanks lie on the contig.

    ``start`` is the window's 0-based start. Where both orientations match at one place, the one
    of the smaller sequence is kept.
    """
    mirrored = reverse_complement(motif.motif)
    cores = {"+": motif_regex(motif.motif)}
    if motif.both and mirrored != motif.motif:
        cores["-"] = motif_regex(mirrored)
    hits = positional_hits(contigs.withColumn(seq, F.upper(seq)), keys, cores, motif.left, motif.right, seq)
    oriented = hits.withColumn("sequence", F.when(F.col("strand") == "-", S.reverse_complement(F.col("hit"))).otherwise(F.col("hit")))
    return oriented.groupBy(*keys, "start").agg(F.min(F.struct("sequence", "strand")).alias("m")).select(
        *keys, "start", "m.strand", "m.sequence"
    )


def fixed_motif_reads(reads: DataFrame, motif: Motif, keys: list[str], seq: str = "seq", qual: str = "qual", adapter: str | None = None) -> DataFrame:
    """(keys, status, sequence, quality) by the motif at its expected place or shifted by rings.

    The nearest ring with a hit decides: one hit is ``matched``, two are ``ambiguous``; no ring
    with a hit is ``no_match``. A window must lie on the read and end before the adapter.
    """
    text, n, width = F.upper(seq), len(motif.motif), motif.length
    mirrored = reverse_complement(motif.motif)
    both = motif.both and mirrored != motif.motif
    bound = F.least(F.length(seq), F.when(F.instr(text, adapter) > 0, F.instr(text, adapter) - 1)) if adapter else F.length(seq)

    def at(offset: int) -> Column:
        start = motif.start - 1 + offset
        first = start - motif.left
        if first < 0:
            return F.lit(None)
        observed, window = F.substring(text, start + 1, n), F.substring(text, first + 1, width)
        quality = F.substring(qual, first + 1, width)
        plus = F.when(observed.rlike(rf"\A{motif_regex(motif.motif)}\z"), F.struct(window.alias("sequence"), F.lit("+").alias("strand"), quality.alias("quality")))
        minus = F.when(
            observed.rlike(rf"\A{motif_regex(mirrored)}\z"),
            F.struct(S.reverse_complement(window).alias("sequence"), F.lit("-").alias("strand"), F.reverse(quality).alias("quality")),
        )
        hit = F.array_min(F.array(plus, minus)) if both else plus
        return F.when(bound >= first + width, hit)

    shape = "struct<sequence:string,strand:string,quality:string>"
    rings = [[0], *[[-d, d] for d in range(1, motif.shift + 1)]]
    status, chosen = F.lit("no_match"), F.lit(None).cast(shape)
    for ring in reversed(rings):
        found = F.array_compact(F.array(*[at(o).cast(shape) for o in ring]))
        status = F.when(F.size(found) == 1, "matched").when(F.size(found) > 1, "ambiguous").otherwise(status)
        chosen = F.when(F.size(found) == 1, found[0]).when(F.size(found) > 1, F.lit(None).cast(shape)).otherwise(chosen)
    return reads.select(*keys, status.alias("status"), chosen.alias("_c")).select(
        *keys, "status", F.col("_c.sequence").alias("sequence"), F.col("_c.quality").alias("quality")
    )


def per_base(df: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """(keys, pos, base), 1-based."""
    return df.where(F.length(seq) > 0).select(*keys, F.posexplode(F.split(seq, "")).alias("_p", "base")).select(
        *keys, (F.col("_p") + 1).alias("pos"), "base"
    )
