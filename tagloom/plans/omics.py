"""Queries on reads, pairs, serial tags, methylation sites, genotypes, abundance and taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.functions import seq as S
from tagloom.operators import approxjoin as A
from tagloom.operators import digest as D
from tagloom.operators import methyl as M
from tagloom.operators import multiomics as O
from tagloom.operators import reads as Q
from tagloom.operators import refdb as R
from tagloom.operators import snp as G
from tagloom.plans.tags import NAMED_SAMPLES, _hits_sql, _seqs_sql, sample_names, sequences
from tagloom.session import checkpointed, table
from tagloom.streaming.tags import windowed_yield as windowed

BSAXI, ALFI, BCGI = (enzymes.select(n)[0] for n in ("BsaXI", "AlfI", "BcgI"))
CPG, CHG, RLAI = enzymes.motif(), enzymes.motif("MspJI", "CHG"), enzymes.motif("RlaI", "CHG")

# --- reads ------------------------------------------------------------------------------------


def _reads(spark, sf_dir):
    return table(spark, sf_dir, "fastq_records")


def read_status(spark, sf_dir):
    return Q.with_status(_reads(spark, sf_dir)).select("rec_no", "status")


def retention_qc(spark, sf_dir):
    return Q.retention(Q.with_status(_reads(spark, sf_dir)), ["library_id"])


def strict_quality(spark, sf_dir):
    """Q >= 30 on 80 % (E3) and at most five bases below 10."""
    r = _reads(spark, sf_dir).where("qual is not null and seq is not null")
    return r.select(
        "rec_no", S.quality_passes(F.col("qual"), 29, 80).alias("q30"), Q.few_bad_bases(F.col("qual")).alias("few_bad"),
        S.n_within(F.col("seq"), 0.02).alias("n_share"), S.n_within(F.col("seq"), 1).alias("n_count"),
    )


def windowed_yield(spark, sf_dir):
    """The streaming operator over the whole table; rows without a time belong to no window."""
    reads = _reads(spark, sf_dir).select(F.col("library_id").alias("sample"), "seq", "run_at")
    return windowed(reads, "run_at").select("sample", F.date_format("start", "yyyy-MM-dd").alias("day"), "reads", "bases")


def length_hist(spark, sf_dir):
    return Q.length_histogram(_reads(spark, sf_dir), ["library_id"])


def read_first_hit(spark, sf_dir):
    reads = _reads(spark, sf_dir).select("rec_no", F.upper("seq").alias("seq"), "qual")
    return D.first_hit(reads, BCGI).select("rec_no", "tag", "tag_qual")


def dup_read_ids(spark, sf_dir):
    keyed = _reads(spark, sf_dir).withColumn("key", S.canonical_read_id(F.col("header")))
    return R.repeated(keyed.where("key is not null"), "library_id", "mate", "key")


def _sides(spark, sf_dir):
    return [
        table(spark, sf_dir, n).select(S.canonical_read_id(F.col("id")).alias("read_id"), "arrival_no") for n in ("forward_seen", "reverse_reads")
    ]


def pair_reads(spark, sf_dir):
    return Q.pair_reads(*_sides(spark, sf_dir))


def pair_counts(spark, sf_dir):
    return Q.pair_counts(*_sides(spark, sf_dir))


def fastq_to_fasta(spark, sf_dir):
    """One FASTA record per read that has an id and a sequence."""
    r = _reads(spark, sf_dir).where("seq is not null and header is not null")
    return r.select("rec_no", F.concat(F.lit(">"), F.substr("header", F.lit(2)), F.lit("\n"), F.upper("seq")).alias("record"))


# --- serial tags ------------------------------------------------------------------------------


def _windows(spark, sf_dir):
    return D.split_windows(D.cut_reads(sequences(spark, sf_dir), ["doc_id"], 177), BSAXI, ["doc_id", "part"])


def split5_windows(spark, sf_dir):
    return _windows(spark, sf_dir)


def recover_tags(policy: str):
    def query(spark, sf_dir):
        return D.all_hits(_windows(spark, sf_dir), BSAXI, ["doc_id", "part", "position"], policy, "window")

    return query


def demultiplexed(spark, sf_dir):
    windows = D.split_windows(_reads(spark, sf_dir).select("library_id", "rec_no", "seq"), BSAXI, ["library_id", "rec_no"]).where("window <> ''")
    return Q.demultiplex(windows, table(spark, sf_dir, "serial_manifest")).groupBy("sample", "library_id", "position").agg(
        F.count("*").alias("n"), F.count_if("truncated").alias("truncated")
    )


def manifest_long(spark, sf_dir):
    return Q.manifest_long(table(spark, sf_dir, "serial_manifest")).join(
        _reads(spark, sf_dir).groupBy("library_id").agg(F.count("*").alias("reads")), "library_id", "left"
    )


def merged_pairs(spark, sf_dir):
    """Pairs of every 160 letters of the documents, the last piece shorter: its first 100 bases, and its last 100 from the other strand."""
    last = F.substr("seq", F.greatest(F.length("seq") - 99, F.lit(1)), F.lit(100))
    pairs = D.cut_reads(sequences(spark, sf_dir), ["doc_id"], 160).select(
        "doc_id", "part", F.substring("seq", 1, 100).alias("seq_1"), S.reverse_complement(last).alias("seq_2")
    )
    return Q.merge_pairs(pairs, ["doc_id", "part"])


# --- methylation ------------------------------------------------------------------------------


def motif_sites(motif: enzymes.Motif):
    def query(spark, sf_dir):
        return D.motif_sites(sequences(spark, sf_dir), motif, ["doc_id"])

    return query


def site_copies(spark, sf_dir):
    return M.copy_numbers(motif_sites(CHG)(spark, sf_dir)).select("doc_id", "start", "strand", "sequence", "copy_number")


def site_totals(spark, sf_dir):
    return M.site_totals(M.copy_numbers(motif_sites(CHG)(spark, sf_dir)))


def fixed_motif_reads(spark, sf_dir):
    return D.fixed_motif_reads(_reads(spark, sf_dir), RLAI, ["library_id", "rec_no"], adapter="ACGTACGTACG")


def _site_counts(spark, sf_dir):
    all_sites = checkpointed(D.motif_sites(sequences(spark, sf_dir), CHG, ["doc_id", "sample"]))
    return M.site_counts(all_sites, all_sites, 2)


def site_counts(spark, sf_dir):
    return _site_counts(spark, sf_dir)


def hamming_best(spark, sf_dir):
    """The nearest other tag of each tag; a tag is no neighbour of itself."""
    tags = checkpointed(D.digest(sequences(spark, sf_dir).select("doc_id", "seq"), BCGI).select("tag").distinct())
    pairs = A.hamming_pairs(tags.select(F.col("tag").alias("query")), tags.select(F.col("tag").alias("reference")), 2)
    return A.best_unique(pairs.where("query <> reference")).select("query", "reference", "distance")


def _line_counts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("sample"), F.col("l_partkey").alias("sequence")).agg(F.count("*").alias("n"))


def depth_max(how: str):
    def query(spark, sf_dir):
        return M.depth_max(_line_counts(spark, sf_dir), how=how)

    return query


def rpm_m_index(spark, sf_dir):
    return M.metrics(_line_counts(spark, sf_dir), least=2)


def site_matrix(spark, sf_dir):
    return M.matrix(_site_counts(spark, sf_dir), sample_names(spark, sf_dir), least=2)


# --- genotypes --------------------------------------------------------------------------------


def _references(tags: DataFrame) -> DataFrame:
    """One reference per place: a palindromic enzyme's tag is read on both strands."""
    return tags.select(S.canonical_tag(F.col("tag")).alias("tag")).distinct()


def _piles(spark, sf_dir):
    tags = checkpointed(D.digest(sequences(spark, sf_dir).select("doc_id", "sample", "seq"), ALFI))
    return G.pileup(G.map_tags(tags, _references(tags)))


def pileup(spark, sf_dir):
    return _piles(spark, sf_dir)


def genotypes(spark, sf_dir):
    return G.genotypes(_piles(spark, sf_dir), least=2).select("sample", "ref_seq", "pos", "depth", "gt")


def site_quality(spark, sf_dir):
    return G.site_quality(genotypes(spark, sf_dir), len(sample_names(spark, sf_dir)))


def good_sites(spark, sf_dir):
    return G.good_sites(site_quality(spark, sf_dir), 0.4, 0.0)


def backbone(spark, sf_dir):
    refs = _references(D.digest(sequences(spark, sf_dir).select("doc_id", "seq"), ALFI))
    calls = checkpointed(genotypes(spark, sf_dir))
    return G.backbone(refs, calls, calls).groupBy("sample", "gt").agg(F.count("*").alias("n"))


def genotype_lines(spark, sf_dir):
    calls = checkpointed(genotypes(spark, sf_dir).where("gt is not null"))
    refs = calls.select(F.col("ref_seq").alias("tag")).distinct()
    return G.genotype_rows(G.backbone(G.checked_references(refs), calls, calls), sample_names(spark, sf_dir))


def named_sites(spark, sf_dir):
    sites = M.named_sites(D.motif_sites(sequences(spark, sf_dir), CHG, ["doc_id"]), "doc_id", "start")
    return sites.select("doc_id", "start", "site_id", S.site_number(F.col("site_id")).alias("site_no"))


# --- abundance --------------------------------------------------------------------------------


def _line_abundance(spark, sf_dir):
    li, o, p = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "part"))
    return li.select("l_orderkey", "l_partkey", "l_quantity").join(
        o.select("o_orderkey", F.col("o_orderpriority").alias("sample")), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(p.select("p_partkey", F.col("p_brand").alias("taxon")), F.col("l_partkey") == F.col("p_partkey")).groupBy("sample", "taxon").agg(
        F.sum("l_quantity").alias("abundance")
    )


def absolute_counts(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    meta = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("o_orderpriority").alias("sample")).agg(
        F.count("*").cast("double").alias("ch"), F.max("c_acctbal").alias("ve"), F.lit(100.0).alias("vd"), F.lit(10.0).alias("vl")
    )
    return O.absolute(_line_abundance(spark, sf_dir), meta, "Brand#11")


def _two_sides(spark, sf_dir):
    """(sample, species, value) of the abundances written with an underscore, as exports do, and of those typed otherwise."""
    df = table(spark, sf_dir, "rna_species_abundance").withColumn("exported", F.contains("species", F.lit("_"))).withColumn("species", S.species_name(F.col("species")))
    rows = df.where("species is not null and abundance is not null")
    return [
        rows.where(side).groupBy(F.col("sample_id").alias("sample"), "species").agg(F.sum("abundance").alias("value")) for side in ("exported", "not exported")
    ]


def rna_dna(spark, sf_dir):
    return O.rna_dna(*_two_sides(spark, sf_dir))


def rna_dna_threshold(spark, sf_dir):
    return O.rna_dna(*_two_sides(spark, sf_dir), 0.001, 0.001).select("sample", "species", "ratio")


def status_counts(spark, sf_dir):
    dna, rna = _two_sides(spark, sf_dir)
    return O.status_counts(O.rna_dna(dna, rna), dna.select("species").union(rna.select("species")).distinct().count())


def unmatched_species(spark, sf_dir):
    return R.set_difference(*_two_sides(spark, sf_dir), "species")


def unmatched_samples(spark, sf_dir):
    """Libraries that only the reads or only the manifest hold."""
    libraries = _reads(spark, sf_dir).select("library_id").where("library_id is not null")
    return R.set_difference(libraries, table(spark, sf_dir, "serial_manifest").select("library_id"), "library_id")


def sample_totals(spark, sf_dir):
    rna = table(spark, sf_dir, "rna_species_abundance").select(F.col("sample_id").alias("sample"), F.col("abundance").alias("value"))
    return O.share_sums(rna, tolerance=1e-3).select("sample")


def _report(spark, sf_dir):
    r = table(spark, sf_dir, "rna_species_abundance")
    low = F.lower(F.trim("species"))
    rank = F.when(low.isNull() | low.isin("", "unknown", "no hit"), "U").when(low.isin("host", "unclassified", "mixed culture"), "R").otherwise("S")
    return r.select(F.col("sample_id").alias("sample"), F.floor(F.coalesce("abundance", F.lit(0.0)) * 1000000).alias("clade"), rank.alias("rank"), F.col("species").alias("name"))


def kraken_species(spark, sf_dir):
    return O.kraken_species(_report(spark, sf_dir))


def kraken_totals(spark, sf_dir):
    return O.kraken_totals(_report(spark, sf_dir))


# --- taxonomy ---------------------------------------------------------------------------------


def _genomes(spark, sf_dir):
    return table(spark, sf_dir, "database_genomes")


def lineage_conflicts(spark, sf_dir):
    return R.lineage_conflicts(_genomes(spark, sf_dir))


def genome_numbers(spark, sf_dir):
    return R.with_numbers(R.valid_entries(_genomes(spark, sf_dir)), 500).select("source_id", "genome_id", "shard")


def shard_summary(spark, sf_dir):
    return R.shard_summary(R.with_numbers(R.valid_entries(_genomes(spark, sf_dir)), 500))


def file_names(spark, sf_dir):
    m = table(spark, sf_dir, "serial_manifest")
    runs = m.select("library_id", S.plain_file_name(F.col("r1")).alias("run"), S.safe_name(F.col("t2")).alias("sample"))
    return runs.join(_reads(spark, sf_dir).groupBy("library_id").agg(F.count("*").alias("reads")), "library_id")


def repeated_species(spark, sf_dir):
    return R.repeated(R.valid_entries(_genomes(spark, sf_dir)), "species")


def harmonised(spark, sf_dir):
    """Every genome with the lineage of the first one, by source_id, of its species."""
    new = R.valid_entries(_genomes(spark, sf_dir))
    old = new.groupBy("species").agg(F.min_by(F.struct(*R.LINEAGE[:-1]), "source_id").alias("first")).select("species", "first.*")
    return R.harmonise(new, old).select("source_id", "species", *R.LINEAGE[:-1], "changed")


def _typed_species(spark, sf_dir):
    return table(spark, sf_dir, "rna_species_abundance").select(S.species_name(F.col("species")).alias("species")).where("species is not null")


def shared_species(spark, sf_dir):
    """Species of the list that an abundance row writes exactly so."""
    return R.shared_keys(R.valid_entries(_genomes(spark, sf_dir)).select(F.trim("species").alias("species")), _typed_species(spark, sf_dir), "species")


def listed_species(spark, sf_dir):
    """Species of the list that no abundance row writes exactly so, and the other way round."""
    return R.set_difference(R.valid_entries(_genomes(spark, sf_dir)).select(F.trim("species").alias("species")), _typed_species(spark, sf_dir), "species")


QUERIES = {
    "read_status": read_status, "retention_qc": retention_qc, "strict_quality": strict_quality, "length_hist": length_hist, "windowed_yield": windowed_yield,
    "read_first_hit": read_first_hit, "dup_read_ids": dup_read_ids, "pair_reads": pair_reads, "pair_counts": pair_counts,
    "fastq_to_fasta": fastq_to_fasta, "split5_windows": split5_windows, "recover_tags_first": recover_tags("first"),
    "recover_tags_unique": recover_tags("unique"), "recover_tags_all": recover_tags("all"), "demultiplexed": demultiplexed,
    "manifest_long": manifest_long, "merged_pairs": merged_pairs, "motif_sites_cpg": motif_sites(CPG), "motif_sites_chg": motif_sites(CHG),
    "site_copies": site_copies, "site_totals": site_totals, "fixed_motif_reads": fixed_motif_reads, "site_counts": site_counts,
    "hamming_best": hamming_best, "depth_max_mean": depth_max("mean"), "depth_max_median": depth_max("median"), "rpm_m_index": rpm_m_index,
    "site_matrix": site_matrix, "pileup": pileup, "genotypes": genotypes, "site_quality": site_quality, "good_sites": good_sites,
    "genotype_lines": genotype_lines, "named_sites": named_sites, "shard_summary": shard_summary, "file_names": file_names,
    "backbone": backbone, "absolute_counts": absolute_counts, "rna_dna": rna_dna, "rna_dna_threshold": rna_dna_threshold,
    "status_counts": status_counts, "unmatched_species": unmatched_species, "unmatched_samples": unmatched_samples,
    "sample_totals": sample_totals, "kraken_species": kraken_species, "kraken_totals": kraken_totals,
    "lineage_conflicts": lineage_conflicts, "genome_numbers": genome_numbers, "repeated_species": repeated_species,
    "harmonised": harmonised, "shared_species": shared_species, "listed_species": listed_species,
}

# --- SQL --------------------------------------------------------------------------------------


def _above(column: str, quality: int) -> str:
    return f"len(list_filter(string_split({column}, ''), lambda q: ascii(q) - 33 > {quality}))"


def _key(column: str) -> str:
    return rf"nullif(regexp_replace(regexp_extract({column}, '^[\s\x0b\x{{85}}\p{{Z}}]*[@>]*[\s\x0b\x{{85}}\p{{Z}}]*([^\s\x0b\x{{85}}\p{{Z}}]+)', 1), '/[12]\z', ''), '')"


_STATUS = f"""st AS (SELECT *, CASE WHEN coalesce(length(seq), 0) = 0 OR coalesce(length(qual), 0) = 0 THEN 'empty'
  WHEN NOT regexp_full_match(seq, '[ACGTacgt]+') THEN 'ambiguous'
  WHEN {_above('qual', 20)} * 100 < length(qual) * 80 THEN 'low_quality' ELSE 'kept' END AS status FROM fastq_records)"""
_SIDES = f"""f AS (SELECT {_key('id')} AS read_id, arrival_no AS arrival_no_1 FROM forward_seen),
  r AS (SELECT {_key('id')} AS read_id, arrival_no AS arrival_no_2 FROM reverse_reads)"""
_POSITIONS = ", ".join(f"({i}, {s}, {e})" for i, (s, e) in enumerate(BSAXI.windows, 1))
_WINDOWS = f"""{_seqs_sql()}, pos(position, s, e) AS (VALUES {_POSITIONS}),
  cut AS (SELECT doc_id, part::INT AS part, substr(seq, part * 177 + 1, 177) AS seq FROM (
    SELECT *, unnest(range(0, (length(seq) + 176) // 177)) AS part FROM seqs)),
  w AS (SELECT doc_id, part, position, substr(seq, s + 1, e - s + 1) AS "window", length(seq) <= e AS truncated FROM cut, pos),
  h AS (SELECT doc_id, part, position, (i - 1)::INT AS start, pattern, substr("window", i, {BSAXI.length}) AS tag FROM (
    SELECT doc_id, part, position, "window", 1 AS pattern, unnest(list_filter(range(1, length("window") - {BSAXI.length} + 2), lambda i: regexp_full_match(substr("window", i, {BSAXI.length}), '{BSAXI.forward}'))) AS i FROM w
    UNION ALL
    SELECT doc_id, part, position, "window", 2, unnest(list_filter(range(1, length("window") - {BSAXI.length} + 2), lambda i: regexp_full_match(substr("window", i, {BSAXI.length}), '{BSAXI.reverse}'))) FROM w)),
  o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, part, position ORDER BY start, pattern)::INT AS hit,
    row_number() OVER (PARTITION BY doc_id, part, position ORDER BY pattern, start) AS rank, count(*) OVER (PARTITION BY doc_id, part, position) AS n FROM h)"""
_MANIFEST = "m AS (" + " UNION ".join(f"SELECT library_id, {i} AS position, trim(t{i}) AS sample FROM serial_manifest WHERE trim(t{i}) <> ''" for i in range(1, 6)) + ")"


def _sites_sql(m: enzymes.Motif) -> str:
    def scan(letters: str, strand: str) -> str:
        window = f".{{{m.left}}}{enzymes.motif_regex(letters)}.{{{m.right}}}"
        text = f"substr(seq, i, {m.length})"
        out = text if strand == "+" else f"reverse(translate({text}, 'ACGT', 'TGCA'))"
        return f"""SELECT doc_id, sample, (i - 1)::INT AS start, '{strand}' AS strand, {out} AS sequence FROM (SELECT doc_id, sample, seq,
          unnest(list_filter(range(1, length(seq) - {m.length} + 2), lambda i: regexp_full_match(substr(seq, i, {m.length}), '{window}'))) AS i FROM seqs)"""

    mirrored = enzymes.reverse_complement(m.motif)
    parts = [scan(m.motif, "+")] + ([scan(mirrored, "-")] if m.both and mirrored != m.motif else [])
    return f"""{_seqs_sql()}, every AS ({' UNION ALL '.join(parts)}),
      sites AS (SELECT doc_id, sample, start, arg_min(strand, sequence || strand) AS strand, min(sequence) AS sequence FROM every GROUP BY doc_id, sample, start)"""


_COPIES = f"{_sites_sql(CHG)}, copies AS (SELECT *, count(*) OVER (PARTITION BY sequence) AS copy_number FROM sites)"


def _rc(column: str) -> str:
    return f"reverse(translate({column}, 'ACGT', 'TGCA'))"


# Every site is its own reference, so the best stratum is that of no differences: a read counts where no other
# site is its reverse complement.
_SITE_COUNTS = f"""{_sites_sql(CHG)}, uq AS (SELECT DISTINCT sequence FROM sites),
  alone AS (SELECT a.sequence FROM uq a LEFT JOIN uq b ON b.sequence = {_rc('a.sequence')} WHERE b.sequence IS NULL OR b.sequence = a.sequence),
  sc AS (SELECT sample, sequence, count(*) AS n FROM sites JOIN alone USING (sequence) GROUP BY ALL)"""
_LINES = "lc AS (SELECT l_suppkey AS sample, l_partkey AS sequence, count(*) AS n FROM lineitem GROUP BY ALL)"
_DEPTH = f"""{_LINES}, ranked AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC) AS k, count(*) OVER (PARTITION BY sample) AS m FROM lc),
  top AS (SELECT * FROM ranked WHERE k <= greatest(1, ceil(m * 0.02)))"""
_LRT = "2 * (n1 * ln(1 - 0.01 * 3 / 4) + n2 * ln(0.01 / 4) - (n1 + n2) * ln(0.5 - 0.01 / 4))"
# Every canonical tag is a reference, so a tag maps without differences to its canonical form and is read on its strand.
_PILE = f"""{_hits_sql(ALFI)},
  mapped AS (SELECT sample, least(tag, {_rc('tag')}) AS ref_seq, count(*) AS n FROM hits GROUP BY ALL),
  bases AS (SELECT sample, ref_seq, n, unnest(range(1, length(ref_seq) + 1)) AS pos, unnest(string_split(ref_seq, '')) AS base FROM mapped),
  piles AS (SELECT sample, ref_seq, pos::INT AS pos, {', '.join(f"coalesce(sum(n) FILTER (base = '{b}'), 0)::BIGINT AS {b}" for b in G.BASES)} FROM bases GROUP BY ALL)"""
_GT = f"""{_PILE},
  alleles AS (SELECT *, list_sort([(-A, 'A'), (-C, 'C'), (-G, 'G'), (-T, 'T')]) AS l FROM piles),
  two AS (SELECT sample, ref_seq, pos, -l[1][1] AS n1, -l[2][1] AS n2, l[1][2] AS a1, l[2][2] AS a2 FROM alleles),
  gts AS (SELECT sample, ref_seq, pos, n1 + n2 AS depth, CASE WHEN n1 + n2 < 2 OR n1 + n2 >= 500 THEN NULL
     WHEN -{_LRT} > 3.84 THEN least(a1, a2) || greatest(a1, a2) WHEN {_LRT} > 3.84 THEN a1 || a1 END AS gt FROM two)"""
_QUALITY = f"""{_GT}, al AS (SELECT ref_seq, pos, count(*) AS called, [{', '.join(f"sum((gt[1] = '{b}')::INT + (gt[2] = '{b}')::INT)" for b in G.BASES)}] AS n FROM gts WHERE gt IS NOT NULL GROUP BY ALL),
  ql AS (SELECT ref_seq, pos, called, called / (SELECT count(DISTINCT sample) FROM seqs) AS call_rate, CASE WHEN len(list_filter(n, lambda x: x > 0)) >= 2
     THEN list_min(list_filter(n, lambda x: x > 0)) / (2 * called) ELSE 0.0 END AS maf FROM al)"""
_SPECIES = r"nullif(regexp_replace(regexp_replace(regexp_replace({c}, '^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+\z', '', 'g'), '[ \t\n\x0b\f\r]+', '_', 'g'), '_+', '_', 'g'), '')"
_RNA = ", ".join(
    f"{name} AS (SELECT sample_id AS sample, {_SPECIES.format(c='species')} AS species, sum(abundance) AS {name} FROM rna_species_abundance WHERE {side} contains(species, '_') AND abundance IS NOT NULL AND {_SPECIES.format(c='species')} IS NOT NULL GROUP BY ALL)"
    for name, side in (("dna", ""), ("rna", "NOT"))
)
_RATIO = f"""{_RNA}, j AS (SELECT sample, species, coalesce(dna, 0) AS dna, coalesce(rna, 0) AS rna FROM dna FULL JOIN rna USING (sample, species)
    WHERE sample IN (SELECT sample FROM dna) AND sample IN (SELECT sample FROM rna)),
  ratios AS (SELECT *, CASE WHEN dna > 0 THEN rna / dna END AS ratio, CASE WHEN dna > 0 AND rna > 0 THEN log2(rna / dna) END AS log2_ratio,
    CASE WHEN dna > 0 AND rna > 0 THEN 'both' WHEN dna > 0 THEN 'DNA_only' WHEN rna > 0 THEN 'RNA_only' ELSE 'missing' END AS status FROM j)"""
_REPORT = """report AS (SELECT sample_id AS sample, floor(coalesce(abundance, 0) * 1000000)::BIGINT AS clade, species AS name,
    CASE WHEN species IS NULL OR lower(trim(species)) IN ('', 'unknown', 'no hit') THEN 'U'
      WHEN lower(trim(species)) IN ('host', 'unclassified', 'mixed culture') THEN 'R' ELSE 'S' END AS rank FROM rna_species_abundance)"""
_VALID = "v AS (SELECT * FROM database_genomes WHERE trim(species) NOT IN ('', 'NA', 'N/A', '-'))"
_DIFF = """SELECT {k}, 'left' AS side FROM (SELECT {k} FROM {a} EXCEPT SELECT {k} FROM {b})
  UNION ALL SELECT {k}, 'right' FROM (SELECT {k} FROM {b} EXCEPT SELECT {k} FROM {a})"""
_RANKS = R.LINEAGE[:-1]


def _fixed_sql(m: enzymes.Motif, adapter: str) -> str:
    """Reads with the motif at its place or one base beside it; the window lies on the read before the adapter."""
    assert not m.both and m.shift == 1
    shape = enzymes.motif_regex(m.motif)

    def window(offset: int, column: str) -> str:
        first = m.start - 1 + offset - m.left
        return f"CASE WHEN {first} >= 0 AND bound >= {first + m.length} AND regexp_full_match(substr(s, {first + m.left + 1}, {len(m.motif)}), '{shape}') THEN substr({column}, {first + 1}, {m.length}) END"

    return f"""r AS (SELECT library_id, rec_no, upper(seq) AS s, qual, CASE WHEN contains(upper(seq), '{adapter}') THEN instr(upper(seq), '{adapter}') - 1 ELSE length(seq) END AS bound FROM fastq_records),
      w AS (SELECT *, {', '.join(f"{window(o, c)} AS {c}{k}" for k, o in enumerate((0, -1, 1)) for c in ('s', 'qual'))} FROM r)
      SELECT library_id, rec_no, CASE WHEN s0 IS NOT NULL OR (s1 IS NULL) <> (s2 IS NULL) THEN 'matched' WHEN s1 IS NOT NULL THEN 'ambiguous' ELSE 'no_match' END AS status,
        CASE WHEN s0 IS NOT NULL THEN s0 WHEN s1 IS NULL OR s2 IS NULL THEN coalesce(s1, s2) END AS sequence,
        CASE WHEN s0 IS NOT NULL THEN qual0 WHEN s1 IS NULL OR s2 IS NULL THEN coalesce(qual1, qual2) END AS quality FROM w"""


ORACLES = {
    "read_status": f"WITH {_STATUS} SELECT rec_no, status FROM st",
    "retention_qc": f"""WITH {_STATUS} SELECT library_id, count(*) AS total, {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ('kept', 'ambiguous', 'low_quality', 'empty'))},
      count(*) FILTER (status = 'kept') / count(*) AS retention FROM st GROUP BY library_id""",
    "strict_quality": f"""SELECT rec_no, length(qual) > 0 AND {_above('qual', 29)} * 100 >= length(qual) * 80 AS q30,
      length(qual) - {_above('qual', 9)} <= 5 AS few_bad, length(seq) > 0 AND (length(seq) - length(replace(seq, 'N', ''))) / length(seq) <= 0.02 AS n_share,
      length(seq) > 0 AND length(seq) - length(replace(seq, 'N', '')) <= 1 AS n_count FROM fastq_records WHERE qual IS NOT NULL AND seq IS NOT NULL""",
    "windowed_yield": """SELECT library_id AS sample, strftime(run_at, '%Y-%m-%d') AS day, count(*) AS reads, sum(length(seq))::BIGINT AS bases
      FROM fastq_records WHERE run_at IS NOT NULL GROUP BY ALL""",
    "length_hist": "SELECT library_id, length(seq)::INT AS length, count(*) AS n FROM fastq_records GROUP BY ALL",
    "read_first_hit": f"""WITH h AS (SELECT rec_no, substr(upper(seq), 1, 50) AS s, substr(qual, 1, 50) AS q FROM fastq_records),
      t AS (SELECT *, CASE WHEN regexp_matches(s, '{BCGI.forward}') THEN regexp_extract(s, '{BCGI.forward}') ELSE nullif(regexp_extract(s, '{BCGI.reverse}'), '') END AS tag FROM h)
      SELECT rec_no, tag, substr(q, instr(s, tag), {BCGI.length}) AS tag_qual FROM t WHERE tag IS NOT NULL""",
    "dup_read_ids": f"SELECT library_id, mate, {_key('header')} AS key, count(*) AS n FROM fastq_records WHERE {_key('header')} IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "pair_reads": f"WITH {_SIDES} SELECT * FROM f JOIN r USING (read_id)",
    "pair_counts": f"""WITH {_SIDES}, a AS (SELECT read_id, count(*) AS n_1 FROM f WHERE read_id IS NOT NULL GROUP BY 1), b AS (SELECT read_id, count(*) AS n_2 FROM r WHERE read_id IS NOT NULL GROUP BY 1)
      SELECT read_id, coalesce(n_1, 0) AS n_1, coalesce(n_2, 0) AS n_2, coalesce(n_1, 0) * coalesce(n_2, 0) AS pairs FROM a FULL JOIN b USING (read_id)""",
    "fastq_to_fasta": "SELECT rec_no, '>' || substr(header, 2) || chr(10) || upper(seq) AS record FROM fastq_records WHERE seq IS NOT NULL AND header IS NOT NULL",
    "split5_windows": f'WITH {_WINDOWS} SELECT doc_id, part, position, "window", truncated FROM w',
    "recover_tags_first": f"WITH {_WINDOWS} SELECT doc_id, part, position, 1 AS hit, start, pattern, tag FROM o WHERE rank = 1",
    "recover_tags_unique": f"WITH {_WINDOWS} SELECT doc_id, part, position, hit, start, pattern, tag FROM o WHERE n = 1",
    "recover_tags_all": f"WITH {_WINDOWS} SELECT doc_id, part, position, hit, start, pattern, tag FROM o",
    "demultiplexed": f"""WITH {_MANIFEST}, pos(position, s, e) AS (VALUES {_POSITIONS}),
      w AS (SELECT library_id, position, length(seq) <= e AS truncated FROM fastq_records, pos WHERE substr(seq, s + 1, e - s + 1) <> '')
      SELECT sample, library_id, position, count(*) AS n, count(*) FILTER (truncated) AS truncated FROM w JOIN m USING (library_id, position) GROUP BY ALL""",
    "manifest_long": f"WITH {_MANIFEST} SELECT m.*, reads FROM m LEFT JOIN (SELECT library_id, count(*) AS reads FROM fastq_records GROUP BY 1) USING (library_id)",
    "merged_pairs": f"""WITH {_seqs_sql()}, cut AS (SELECT doc_id, part::INT AS part, substr(seq, part * 160 + 1, 160) AS s FROM (
        SELECT *, unnest(range(0, (length(seq) + 159) // 160)) AS part FROM seqs)),
      pairs AS (SELECT doc_id, part, left(s, 100) AS a, right(s, 100) AS b FROM cut WHERE s <> ''),
      o AS (SELECT *, list_max(list_filter(range(10, least(length(a), length(b)) + 1), lambda n: n - hamming(right(a, n), left(b, n)) >= 0.9 * n)) AS overlap FROM pairs)
      SELECT doc_id, part, a || substr(b, overlap + 1) AS merged, overlap::INT AS overlap FROM o WHERE overlap IS NOT NULL""",
    "fixed_motif_reads": f"""WITH {_fixed_sql(RLAI, 'ACGTACGTACG')}""",
    "motif_sites_cpg": f"WITH {_sites_sql(CPG)} SELECT doc_id, start, strand, sequence FROM sites",
    "motif_sites_chg": f"WITH {_sites_sql(CHG)} SELECT doc_id, start, strand, sequence FROM sites",
    "site_copies": f"WITH {_COPIES} SELECT doc_id, start, strand, sequence, copy_number FROM copies",
    "site_totals": f'WITH {_COPIES} SELECT count(*) AS total, count(*) FILTER (copy_number = 1) AS "unique", count(*) FILTER (copy_number > 1) AS repeated, 0::BIGINT AS ambiguous FROM copies',
    "site_counts": f"WITH {_SITE_COUNTS} SELECT * FROM sc",
    "site_matrix": f"WITH {_SITE_COUNTS} SELECT sequence, {', '.join(f'''coalesce(sum(n) FILTER (sample = '{s}'), 0)::BIGINT AS {s}''' for s in NAMED_SAMPLES)} FROM sc GROUP BY sequence HAVING max(n) >= 2",
    "hamming_best": f"""WITH {_hits_sql(BCGI)}, t AS (SELECT DISTINCT tag FROM hits),
      near AS (SELECT a.tag AS query, b.tag AS reference, hamming(a.tag, b.tag) AS distance FROM t a JOIN t b ON a.tag <> b.tag AND hamming(a.tag, b.tag) <= 2),
      low AS (SELECT query, min(distance) AS distance FROM near GROUP BY query)
      SELECT query, min(reference) AS reference, distance::INT AS distance FROM near JOIN low USING (query, distance) GROUP BY query, distance HAVING count(*) = 1""",
    "depth_max_mean": f"WITH {_DEPTH} SELECT sample, avg(n) AS depth_max FROM top GROUP BY sample",
    "depth_max_median": f"WITH {_DEPTH} SELECT sample, median(n) AS depth_max FROM top GROUP BY sample",
    "rpm_m_index": f"""WITH {_DEPTH}, d AS (SELECT sample, avg(n) AS depth_max FROM top GROUP BY sample)
      SELECT sample, sequence, n, depth_max, CASE WHEN n >= 2 THEN n / sum(n) OVER (PARTITION BY sample) * 1e6 END AS rpm,
        CASE WHEN n >= 2 AND depth_max > 1 THEN ln(n) / ln(depth_max) END AS m_index FROM lc JOIN d USING (sample)""",
    "pileup": f"WITH {_PILE} SELECT * FROM piles",
    "genotypes": f"WITH {_GT} SELECT * FROM gts",
    "site_quality": f"WITH {_QUALITY} SELECT * FROM ql",
    "good_sites": f"WITH {_QUALITY} SELECT * FROM ql WHERE call_rate >= 0.4",
    "backbone": f"""WITH {_GT}, refs AS (SELECT DISTINCT ref_seq FROM mapped),
      places AS (SELECT sample, ref_seq, unnest(range(1, {ALFI.length} + 1)) AS pos FROM refs, (SELECT DISTINCT sample FROM gts))
      SELECT sample, coalesce(gt, '--') AS gt, count(*) AS n FROM places LEFT JOIN gts USING (sample, ref_seq, pos) GROUP BY ALL""",
    "genotype_lines": f"""WITH {_GT}, refs AS (SELECT DISTINCT ref_seq FROM gts WHERE gt IS NOT NULL),
      places AS (SELECT ref_seq, unnest(range(1, {ALFI.length} + 1)) AS pos, unnest(string_split(ref_seq, '')) AS base FROM refs)
      SELECT ref_seq, pos::INT AS pos, base, concat_ws(' ', ref_seq, pos, base, {', '.join(f"coalesce(max(gt) FILTER (sample = '{s}'), '--')" for s in NAMED_SAMPLES)}) AS line
      FROM places LEFT JOIN gts USING (ref_seq, pos) GROUP BY ref_seq, pos, base""",
    "named_sites": f"""WITH {_sites_sql(CHG)}, n AS (SELECT doc_id, start, row_number() OVER (ORDER BY doc_id, start) AS site_no FROM sites)
      SELECT doc_id, start, printf('site%09d', site_no) AS site_id, site_no FROM n""",
    "shard_summary": f"""WITH {_VALID}, n AS (SELECT row_number() OVER (ORDER BY source_id) - 1 AS k FROM v)
      SELECT (k // 500 + 1) * 500 AS shard, count(*) AS genomes, lpad(min(k)::VARCHAR, 8, '0') AS first_id, lpad(max(k)::VARCHAR, 8, '0') AS last_id FROM n GROUP BY 1""",
    "file_names": r"""SELECT library_id, regexp_replace(regexp_replace(r1, '^.*/', ''), '\.(f(ast)?q|fa(sta)?|fna)(\.gz)?$', '') AS run,
      regexp_replace(regexp_replace(t2, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS sample, reads
      FROM serial_manifest JOIN (SELECT library_id, count(*) AS reads FROM fastq_records GROUP BY 1) USING (library_id)""",
    "absolute_counts": """WITH a AS (SELECT o_orderpriority AS sample, p_brand AS taxon, sum(l_quantity) AS abundance FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
      meta AS (SELECT o_orderpriority AS sample, count(*)::DOUBLE AS ch, max(c_acctbal) AS ve FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
      h AS (SELECT sample, abundance AS host FROM a WHERE taxon = 'Brand#11')
      SELECT sample, taxon, abundance, ch * abundance / host AS concentration, ch * abundance / host * ve * 10 / 100 AS library_cells FROM a JOIN h USING (sample) JOIN meta USING (sample)""",
    "rna_dna": f"WITH {_RATIO} SELECT * FROM ratios",
    "rna_dna_threshold": f"WITH {_RATIO} SELECT sample, species, ratio FROM ratios WHERE dna >= 0.001 AND rna >= 0.001",
    "status_counts": f"""WITH {_RATIO}, n AS (SELECT count(*) AS all_species FROM (SELECT species FROM dna UNION SELECT species FROM rna)),
      c AS (SELECT sample, {', '.join(f"count(*) FILTER (status = '{s}') AS {s}" for s in O.STATUSES[:3])} FROM ratios GROUP BY sample)
      SELECT c.*, all_species - "both" - DNA_only - RNA_only AS missing FROM c, n""",
    "unmatched_species": f"WITH {_RNA} {_DIFF.format(k='species', a='dna', b='rna')}",
    "unmatched_samples": f"WITH a AS (SELECT library_id FROM fastq_records WHERE library_id IS NOT NULL), b AS (SELECT library_id FROM serial_manifest) {_DIFF.format(k='library_id', a='a', b='b')}",
    "sample_totals": "SELECT sample_id AS sample FROM rna_species_abundance GROUP BY 1 HAVING abs(sum(abundance) - 1) > 1e-3",
    "kraken_species": f"WITH {_REPORT} SELECT sample, {_SPECIES.format(c='name')} AS species, sum(clade)::BIGINT AS reads FROM report WHERE rank = 'S' AND {_SPECIES.format(c='name')} IS NOT NULL GROUP BY ALL",
    "kraken_totals": f"""WITH {_REPORT}, t AS (SELECT sample, {', '.join(f"coalesce(sum(clade) FILTER (rank = '{r}'), 0)::BIGINT AS {n}" for r, n in (('R', 'classified'), ('U', 'unclassified'), ('S', 'species_reads')))},
      count(*) FILTER (rank = 'S' AND clade > 0) AS detected FROM report GROUP BY sample)
      SELECT *, CASE WHEN classified + unclassified > 0 THEN classified / (classified + unclassified) ELSE 0.0 END AS classified_share,
        CASE WHEN classified > 0 THEN species_reads / classified ELSE 0.0 END AS species_share FROM t""",
    "lineage_conflicts": f"WITH {_VALID} SELECT species, count(DISTINCT concat_ws('|', {', '.join(f'''coalesce({c}, '')''' for c in _RANKS)})) AS lineages FROM v GROUP BY species HAVING lineages > 1",
    "genome_numbers": f"WITH {_VALID}, n AS (SELECT source_id, row_number() OVER (ORDER BY source_id) - 1 AS k FROM v) SELECT source_id, lpad(k::VARCHAR, 8, '0') AS genome_id, (k // 500 + 1) * 500 AS shard FROM n",
    "repeated_species": f"WITH {_VALID} SELECT species, count(*) AS n FROM v GROUP BY species HAVING count(*) > 1",
    "harmonised": f"""WITH {_VALID}, f AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY species ORDER BY source_id) = 1)
      SELECT v.source_id, species, {', '.join(f'f.{c}' for c in _RANKS)}, {' OR '.join(f'v.{c} IS DISTINCT FROM f.{c}' for c in _RANKS)} AS changed FROM v JOIN f USING (species)""",
    "shared_species": f"WITH {_VALID} SELECT trim(species) AS species FROM v INTERSECT SELECT {_SPECIES.format(c='species')} FROM rna_species_abundance",
    "listed_species": f"WITH {_VALID}, a AS (SELECT trim(species) AS species FROM v), b AS (SELECT {_SPECIES.format(c='species')} AS species FROM rna_species_abundance WHERE {_SPECIES.format(c='species')} IS NOT NULL) {_DIFF.format(k='species', a='a', b='b')}",
}
