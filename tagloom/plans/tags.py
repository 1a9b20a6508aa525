"""Queries on restriction tags of the documents' letters: digestion, tag database, profiles.

No table holds DNA, so letters are mapped to bases the same way in Spark and SQL. Every document is
a genome and a read; the taxon is the language, the sample the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.operators import digest as D
from tagloom.operators import profile as P
from tagloom.operators import refdb as R
from tagloom.session import checkpointed, spread, table

ENZYME = enzymes.select("CjeI")[0]
THRESHOLD = 2.0
#: The samples of the given tables, for the SQL only: the queries take theirs from the data.
NAMED_SAMPLES = ["bulk_xml", "mt_queue", "none", "ocr_scan", "office_feed", "partner_drop"]


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")).where("text is not null")
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return docs.select(
        "doc_id", F.coalesce("lang", F.lit("none")).alias("taxon"), F.coalesce("source", F.lit("none")).alias("sample"),
        F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"),
    )


def sample_names(spark: SparkSession, sf_dir: str, most: int = 10_000) -> list[str]:
    """The samples of ``sequences`` in order, an error beyond ``most``: each becomes a column."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select(F.coalesce("source", F.lit("none")).alias("sample"))
    names = [r["sample"] for r in docs.distinct().limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} samples: use the long form")
    return sorted(names)


def _seqs_sql(name: str = "seqs") -> str:
    return f"""{name} AS (
      SELECT doc_id, coalesce(lang, 'none') AS taxon, coalesce(source, 'none') AS sample,
        translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq
      FROM documents WHERE text IS NOT NULL)"""


def _hits_sql(e: enzymes.Enzyme) -> str:
    part = """SELECT doc_id, taxon, sample, '{s}' AS strand, {t} AS tag FROM (
        SELECT doc_id, taxon, sample, seq, unnest(list_filter(range(1, length(seq) - {n} + 2), lambda i: regexp_full_match(substr(seq, i, {n}), '{p}'))) AS i
        FROM seqs)"""
    cut = f"substr(seq, i, {e.length})"
    parts = [part.format(s="+", t=cut, n=e.length, p=e.forward)]
    if not e.palindromic:
        parts.append(part.format(s="-", t=f"reverse(translate({cut}, 'ACGT', 'TGCA'))", n=e.length, p=e.reverse))
    return f"{_seqs_sql()}, hits AS ({' UNION ALL '.join(parts)})"


def genomes(spark, sf_dir):
    return sequences(spark, sf_dir).withColumn("genome_id", F.col("doc_id"))


def master_tags(spark, sf_dir):
    return D.genome_tags(genomes(spark, sf_dir), ENZYME, ["genome_id", "taxon"])


def read_counts(spark, sf_dir):
    return P.tag_counts(D.digest(sequences(spark, sf_dir).select("sample", "seq"), ENZYME))


def _database(spark, sf_dir):
    master = checkpointed(master_tags(spark, sf_dir))
    unique = R.unique_tags(master)
    return master, unique, R.unique_stats(unique)


def digest_query(name: str):
    e = enzymes.select(name)[0]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return D.digest(sequences(spark, sf_dir).select("doc_id", "seq"), e).groupBy("doc_id", "strand", "tag").agg(F.count("*").alias("n"))

    sql = f"WITH {_hits_sql(e)} SELECT doc_id, strand, tag, count(*) AS n FROM hits GROUP BY ALL"
    return query, sql


def digest_all_counts(spark, sf_dir):
    """All sixteen enzymes in one pass: hits are counted, not exploded."""
    counts = F.array(
        *[
            F.struct(F.lit(e.name).alias("enzyme"), sum(F.regexp_count("seq", F.lit(p)) for p in e.anchored).alias("n"))
            for e in enzymes.ENZYMES
        ]
    )
    return sequences(spark, sf_dir).select(F.explode(counts).alias("c")).groupBy("c.enzyme").agg(F.sum("c.n").alias("tags"))


def digest_stats(spark, sf_dir):
    return D.digest_stats(sequences(spark, sf_dir), ENZYME, "sample")


def enzyme_dimension(spark, sf_dir):
    """Enzymes that the documents' letters hold a site of, with their dimension."""
    return enzymes.enzyme_table(spark).select("id", "name", "length", "palindromic", "unit", "expected").join(
        digest_all_counts(spark, sf_dir).where("tags > 0").select(F.col("enzyme").alias("name"), "tags"), "name"
    )


def unique_single(spark, sf_dir):
    return _database(spark, sf_dir)[1].select("tag", "genome_id", "taxon")


def unique_multi(spark, sf_dir):
    return R.unique_tags(checkpointed(master_tags(spark, sf_dir)), single_copy=False)


def unique_statistics(spark, sf_dir):
    return _database(spark, sf_dir)[2]


def profile_gscore(spark, sf_dir):
    _, unique, stats = _database(spark, sf_dir)
    return P.predict(P.profile(read_counts(spark, sf_dir), unique, stats), THRESHOLD)


def genomes_detected(spark, sf_dir):
    _, unique, stats = _database(spark, sf_dir)
    return P.genomes_detected(read_counts(spark, sf_dir), unique, stats)


def profile_features(spark, sf_dir):
    _, unique, stats = _database(spark, sf_dir)
    return P.features(P.profile(read_counts(spark, sf_dir), unique, stats), least=2.0)


def quantified(spark, sf_dir):
    master, unique, stats = _database(spark, sf_dir)
    counts = checkpointed(read_counts(spark, sf_dir))
    positive = checkpointed(P.predict(P.profile(counts, unique, stats), THRESHOLD).where("pred = 1").select("sample", "taxon"))
    own, own_stats = P.sample_database(master, positive)
    return P.profile(counts, own, own_stats, scope=("sample",))


def quant_database(spark, sf_dir):
    master, unique, stats = _database(spark, sf_dir)
    positive = P.predict(P.profile(read_counts(spark, sf_dir), unique, stats), THRESHOLD).where("pred = 1")
    own, own_stats = P.sample_database(master, checkpointed(positive.select("sample", "taxon")))
    return own_stats.select("sample", "genome_id", "taxon", F.col("genome_tags").cast("long").alias("genome_tags"), "taxon_mean")


def abundance_long(spark, sf_dir):
    return P.abundance(quantified(spark, sf_dir))


def abundance_wide(spark, sf_dir):
    return P.wide(abundance_long(spark, sf_dir), "taxon", "sample", "abundance", sample_names(spark, sf_dir))


def abundance_unpivot(spark, sf_dir):
    return P.long(abundance_wide(spark, sf_dir), "taxon", "sample", "abundance")


def coverage_clip(spark, sf_dir):
    return P.clip_coverage(quantified(spark, sf_dir)).select("sample", "taxon", "coverage")


def host_rescale(spark, sf_dir):
    return P.rescale_without_host(abundance_long(spark, sf_dir), "en")


def split_shares(spark, sf_dir):
    df = P.split_groups(abundance_long(spark, sf_dir), F.col("taxon").isin("en", "de"), "abundance")
    return df.select("sample", "taxon", "part", "share")


def subspecies_merge(spark, sf_dir):
    _, unique, stats = _database(spark, sf_dir)
    prof = P.profile(read_counts(spark, sf_dir), unique, stats)
    named = prof.withColumn("species", F.concat(F.col("taxon"), F.lit("_sub_"), F.upper(F.substring("taxon", 1, 1))))
    return P.merge_subspecies(named)


def first_hit(spark, sf_dir):
    reads = table(spark, sf_dir, "fastq_records").select("rec_no", F.upper("seq").alias("seq"), "qual")
    return D.first_hit(reads, enzymes.select("Hin4I")[0], read_length=45).select("rec_no", "tag", "tag_qual")


def dedup_digest(spark, sf_dir):
    return D.dedup_digest(sequences(spark, sf_dir), enzymes.select("Hin4I")[0], ["doc_id"])


def plain_scan(spark, sf_dir):
    return D.plain_scan(sequences(spark, sf_dir), ENZYME, ["doc_id"])


def tag_keys(spark, sf_dir):
    key = D.S.tag_key(F.col("genome_id"), F.col("copies"))
    keyed = master_tags(spark, sf_dir).select("tag", key.alias("key"))
    return keyed.withColumns({"genome_id": D.S.key_genome(F.col("key")), "copies": D.S.key_copies(F.col("key"))})


def stats_recount(spark, sf_dir):
    """Genomes whose single-copy count or mean differs from a recount over the tags of all copies."""
    master, _, stats = _database(spark, sf_dir)
    return R.stats_mismatches(stats, R.unique_tags(master, single_copy=False)).select(F.coalesce("genome_id", "again").alias("genome_id"))


def presence_flags(spark, sf_dir):
    return P.presence(profile_gscore(spark, sf_dir), ["taxon"])


_E_HITS = _hits_sql(ENZYME)
_DB = f"""{_E_HITS},
master AS (SELECT doc_id AS genome_id, taxon, tag, count(*) AS copies FROM hits GROUP BY ALL),
confined AS (SELECT tag FROM master GROUP BY tag HAVING min(taxon) = max(taxon)),
uniq AS (SELECT tag, genome_id, taxon FROM master WHERE copies = 1 AND tag IN (SELECT tag FROM confined)),
gstats AS (SELECT taxon, genome_id, count(*) AS genome_tags FROM uniq GROUP BY ALL),
stats AS (SELECT *, avg(genome_tags) OVER (PARTITION BY taxon) AS taxon_mean FROM gstats),
once AS (SELECT sample, tag, count(*) AS n FROM hits GROUP BY ALL),
counts AS (SELECT sample, tag, sum(n)::BIGINT AS n FROM (
    SELECT * FROM once UNION ALL SELECT sample, reverse(translate(tag, 'ACGT', 'TGCA')), n FROM once) GROUP BY ALL),
found AS (SELECT sample, taxon, count(*) AS seq_tags, sum(n)::BIGINT AS seq_reads
    FROM counts JOIN (SELECT DISTINCT tag, taxon FROM uniq) USING (tag) GROUP BY ALL),
prof AS (SELECT sample, taxon, theoretical, seq_tags, seq_reads, seq_tags / theoretical AS percent, seq_reads / theoretical AS density,
    seq_reads / seq_tags AS depth, sqrt(seq_tags * seq_reads) AS g_score
    FROM found JOIN (SELECT DISTINCT taxon, taxon_mean AS theoretical FROM stats) USING (taxon))"""
_QUANT = f"""{_DB},
positive AS (SELECT sample, taxon FROM prof WHERE g_score >= {THRESHOLD}),
scoped AS (SELECT sample, master.* FROM master JOIN positive USING (taxon)),
own AS (SELECT s.* FROM scoped s JOIN (SELECT sample, tag FROM scoped GROUP BY ALL HAVING min(taxon) = max(taxon)) USING (sample, tag)),
own_stats AS (SELECT *, avg(genome_tags) OVER (PARTITION BY sample, taxon) AS taxon_mean FROM (
    SELECT sample, taxon, genome_id, sum(copies)::BIGINT AS genome_tags FROM own GROUP BY ALL)),
quant AS (SELECT sample, taxon, seq_tags / theoretical AS percent, seq_reads / theoretical AS density FROM (
    SELECT sample, taxon, count(*) AS seq_tags, sum(n) AS seq_reads FROM counts JOIN (SELECT DISTINCT sample, tag, taxon FROM own) USING (sample, tag) GROUP BY ALL)
    JOIN (SELECT DISTINCT sample, taxon, taxon_mean AS theoretical FROM own_stats) USING (sample, taxon)),
abd AS (SELECT sample, taxon, density / sum(density) OVER (PARTITION BY sample) AS abundance FROM quant)"""
_WIDE = ", ".join(f"coalesce(sum(abundance) FILTER (sample = '{s}'), 0.0) AS {s}" for s in NAMED_SAMPLES)
_HIN = enzymes.select("Hin4I")[0]

DIGESTS = {f"digest_{n.lower()}": digest_query(n) for n in ("CjePI", "CjeI", "BcgI", "AlfI", "Hin4I")}
QUERIES = {
    **{k: v[0] for k, v in DIGESTS.items()},
    "digest_all_counts": digest_all_counts, "digest_stats": digest_stats, "enzyme_dimension": enzyme_dimension,
    "master_tags": master_tags, "read_tag_counts": read_counts, "unique_single_copy": unique_single, "unique_multi_copy": unique_multi,
    "unique_stats": unique_statistics, "profile_gscore": profile_gscore, "genomes_detected": genomes_detected,
    "profile_features": profile_features, "quant_database": quant_database, "abundance_long": abundance_long,
    "abundance_wide": abundance_wide, "abundance_unpivot": abundance_unpivot, "coverage_clip": coverage_clip,
    "host_rescale": host_rescale, "split_shares": split_shares, "subspecies_merge": subspecies_merge,
    "tag_keys": tag_keys, "stats_recount": stats_recount, "presence_flags": presence_flags,
    "first_hit": first_hit, "dedup_digest": dedup_digest, "plain_scan": plain_scan,
}
_MERGED = "CASE WHEN regexp_matches(species, '[A-Z]$') THEN regexp_replace(species, '_[^_]*$', '') ELSE species END"


def _all_counts_sql() -> str:
    """Every place of the documents' letters tried for each enzyme and strand."""
    longest, every = max(e.length for e in enzymes.ENZYMES), enzymes.ENZYMES
    counts = {e: " + ".join(f"count(*) FILTER (regexp_matches(w, '^{p}'))" for p in e.patterns) for e in every}
    return f"""{_seqs_sql()}, w AS (SELECT substr(seq, i, {longest}) AS w FROM (SELECT seq, unnest(range(1, length(seq) + 1)) AS i FROM seqs)),
      c AS (SELECT {', '.join(f"{n} AS e{e.id}" for e, n in counts.items())} FROM w),
      counts AS (SELECT unnest([{', '.join(f"'{e.name}'" for e in every)}]) AS enzyme, unnest([{', '.join(f'e{e.id}' for e in every)}]) AS tags FROM c)"""


_DIMENSION = ", ".join(f"({e.id}, '{e.name}', {e.length}, {e.palindromic}, {e.unit}, {e.expected})" for e in enzymes.ENZYMES)
ORACLES = {
    "digest_all_counts": f"WITH {_all_counts_sql()} SELECT enzyme, tags FROM counts",
    "enzyme_dimension": f"""WITH {_all_counts_sql()}, d(id, name, length, palindromic, unit, expected) AS (VALUES {_DIMENSION})
        SELECT d.*, tags FROM d JOIN counts ON name = enzyme WHERE tags > 0""",
    **{k: v[1] for k, v in DIGESTS.items()},
    "tag_keys": f"WITH {_DB} SELECT tag, printf('%08d%04d', genome_id, copies) AS key, genome_id, copies FROM master",
    "stats_recount": f"""WITH {_DB}, n AS (SELECT taxon, genome_id, count(*) AS genome_tags FROM master WHERE tag IN (SELECT tag FROM confined) GROUP BY ALL),
        again AS (SELECT *, avg(genome_tags) OVER (PARTITION BY taxon) AS mean FROM n)
        SELECT coalesce(s.genome_id, a.genome_id) AS genome_id FROM stats s FULL JOIN again a ON s.genome_id = a.genome_id
        WHERE NOT coalesce(s.genome_tags = a.genome_tags AND abs(taxon_mean - mean) <= 1e-4, false)""",
    "presence_flags": f"WITH {_DB} SELECT taxon, max((g_score >= {THRESHOLD})::INT) AS present FROM prof GROUP BY taxon",
    "digest_stats": f"""WITH {_E_HITS}, n AS (SELECT sample, count(*) AS tags FROM hits GROUP BY sample)
        SELECT sample, count(*) AS reads, coalesce(max(tags), 0) AS tags, coalesce(max(tags), 0) / count(*) AS ratio
        FROM seqs LEFT JOIN n USING (sample) GROUP BY sample""",
    "master_tags": f"WITH {_DB} SELECT * FROM master",
    "read_tag_counts": f"WITH {_DB} SELECT * FROM counts",
    "unique_single_copy": f"WITH {_DB} SELECT * FROM uniq",
    "unique_multi_copy": f"WITH {_DB} SELECT tag, genome_id, taxon, copies FROM master WHERE tag IN (SELECT tag FROM confined)",
    "unique_stats": f"WITH {_DB} SELECT * FROM stats",
    "profile_gscore": f"WITH {_DB} SELECT *, (g_score >= {THRESHOLD})::INT AS pred FROM prof",
    "genomes_detected": f"""WITH {_DB} SELECT sample, taxon, genome_id, genome_tags AS theoretical, detected, detected / genome_tags AS share
        FROM (SELECT sample, taxon, genome_id, count(*) AS detected FROM counts JOIN uniq USING (tag) GROUP BY ALL) JOIN gstats USING (taxon, genome_id)""",
    "profile_features": f"""WITH {_DB} SELECT sample, taxon, ln(percent) AS ln_coverage, ln(g_score) AS ln_g, ln(depth) AS ln_depth,
        ln(depth * theoretical / total) AS ln_share FROM (SELECT *, sum(seq_reads) OVER (PARTITION BY sample) AS total FROM prof) WHERE g_score > 2.0""",
    "quant_database": f"WITH {_QUANT} SELECT sample, genome_id, taxon, genome_tags, taxon_mean FROM own_stats",
    "abundance_long": f"WITH {_QUANT} SELECT * FROM abd",
    "abundance_wide": f"WITH {_QUANT} SELECT taxon, {_WIDE} FROM abd GROUP BY taxon HAVING max(abundance) > 0",
    "abundance_unpivot": f"""WITH {_QUANT}, w AS (SELECT taxon, {_WIDE} FROM abd GROUP BY taxon HAVING max(abundance) > 0)
        SELECT taxon, sample, abundance FROM (UNPIVOT w ON {', '.join(NAMED_SAMPLES)} INTO NAME sample VALUE abundance)""",
    "coverage_clip": f"WITH {_QUANT} SELECT sample, taxon, least(percent, 1.0) AS coverage FROM quant",
    "host_rescale": f"""WITH {_QUANT}, h AS (SELECT *, coalesce(max(abundance) FILTER (taxon = 'en') OVER (PARTITION BY sample), 0) AS h FROM abd)
        SELECT sample, taxon, abundance * CASE WHEN h < 1 THEN 1 / (1 - h) ELSE 0.0 END AS abundance FROM h WHERE taxon <> 'en'""",
    "split_shares": f"""WITH {_QUANT}, p AS (SELECT *, CASE WHEN taxon IN ('en', 'de') THEN 'micro' ELSE 'macro' END AS part FROM abd)
        SELECT sample, taxon, part, abundance / sum(abundance) OVER (PARTITION BY sample, part) AS share FROM p""",
    "subspecies_merge": f"""WITH {_DB}, named AS (SELECT *, taxon || '_sub_' || upper(substr(taxon, 1, 1)) AS species FROM prof)
        SELECT sample, {_MERGED} AS merged, sum(seq_tags)::BIGINT AS seq_tags, sum(seq_reads)::BIGINT AS seq_reads,
          sqrt(sum(seq_tags) * sum(seq_reads)::DOUBLE) AS g_score FROM named GROUP BY ALL""",
    "first_hit": f"""WITH h AS (SELECT rec_no, substr(upper(seq), 1, 45) AS s, substr(qual, 1, 45) AS q FROM fastq_records),
        t AS (SELECT *, coalesce(nullif(regexp_extract(s, '{_HIN.forward}'), ''), nullif(regexp_extract(s, '{_HIN.reverse}'), '')) AS tag FROM h)
        SELECT rec_no, tag, substr(q, instr(s, tag), {_HIN.length}) AS tag_qual FROM t WHERE tag IS NOT NULL""",
    "dedup_digest": f"""WITH {_seqs_sql()} SELECT doc_id, (i - 1)::INT AS start, substr(seq, i, {_HIN.length}) AS tag, (i - 1 + {_HIN.length})::INT AS "end" FROM (
        SELECT doc_id, seq, unnest(list_filter(range(1, length(seq) - {_HIN.length} + 2), lambda i: regexp_full_match(substr(seq, i, {_HIN.length}), '{_HIN.forward}|{_HIN.reverse}'))) AS i FROM seqs)""",
    "plain_scan": f"""WITH {_seqs_sql()}, scans AS (
        SELECT doc_id, 0 AS p, unnest(regexp_extract_all(seq, '{ENZYME.forward}')) AS tag,
          unnest(list_transform(regexp_split_to_array(seq, '{ENZYME.forward}'), lambda x: length(x))[:-2]) AS gap,
          generate_subscripts(regexp_extract_all(seq, '{ENZYME.forward}'), 1) AS no FROM seqs
        UNION ALL
        SELECT doc_id, 1, unnest(regexp_extract_all(seq, '{ENZYME.reverse}')),
          unnest(list_transform(regexp_split_to_array(seq, '{ENZYME.reverse}'), lambda x: length(x))[:-2]),
          generate_subscripts(regexp_extract_all(seq, '{ENZYME.reverse}'), 1) FROM seqs),
      ends AS (SELECT *, sum(gap + {ENZYME.length}) OVER (PARTITION BY doc_id, p ORDER BY no) AS e FROM scans)
      SELECT doc_id, e::INT AS "end", arg_max(tag, p) AS tag FROM ends GROUP BY doc_id, e""",
}
