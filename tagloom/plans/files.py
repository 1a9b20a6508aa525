"""Queries over the file sources and sinks, the databases on disk and the models.

Each writes rows of the given tables in an operator's format to a folder of its own below the shared
checkpoint folder and reads them back with the operator's source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.functions import seq as S
from tagloom.operators import digest as D
from tagloom.operators import methyl as M
from tagloom.operators import model
from tagloom.operators import multiomics as O
from tagloom.operators import profile as P
from tagloom.operators import refdb as R
from tagloom.operators.reads import manifest_long
from tagloom.plans import omics, tags
from tagloom.session import checkpoint_dir, checkpointed, table
from tagloom.sources import fastx, sinks, tables

BCGI = enzymes.select("BcgI")[0]
#: labelled rows that the forest is fitted on
FIT_ROWS = 5000


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


def _text(df: DataFrame, line, path: str) -> None:
    """One line a row."""
    df.select(line.alias("value")).write.text(path)


def _sheet(df: DataFrame, path: str) -> None:
    """Columns split by tabs, as they are, under a header."""
    plain = {"quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(sep="\t", header=True, **plain).csv(path)


def _tabbed(*columns: str):
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


# --- records ----------------------------------------------------------------------------------


def fastq_files(spark, sf_dir):
    """The whole reads as FASTQ and back."""
    path = _folder(spark)
    reads = table(spark, sf_dir, "fastq_records").where("seq <> '' and qual <> ''")
    sinks.write_records(reads, sinks.fastq_record(F.col("header"), F.col("seq"), F.col("qual"), F.col("plus")), path, compressed=False)
    return fastx.scan_fastq(spark, path, strict=False).groupBy("header", "seq", "qual", "problem").agg(F.count("*").alias("n"))


def _hits(spark, sf_dir):
    hits = D.positional_hits(tags.sequences(spark, sf_dir), ["doc_id"], {"+": BCGI.forward, "-": BCGI.reverse})
    tag = F.when(F.col("strand") == "-", S.reverse_complement(F.col("hit"))).otherwise(F.col("hit"))
    return hits.select(sinks.hit_name(F.col("doc_id").cast("string"), F.col("strand"), F.col("start")).alias("name"), tag.alias("tag"))


def digest_files(spark, sf_dir):
    """The hits of a digest as compressed FASTA and back."""
    path, hits = _folder(spark), _hits(spark, sf_dir)
    sinks.write_records(hits, sinks.fasta_record(F.col("name"), F.col("tag")), path)
    return fastx.read_fasta(spark, path).select("seqname", "seq")


def lenient_files(spark, sf_dir):
    """A4: the same by the reader that passes over broken archives."""
    path, hits = _folder(spark), _hits(spark, sf_dir)
    sinks.write_records(hits, sinks.fasta_record(F.col("name"), F.col("tag")), path)
    return fastx.read_fasta_lenient(spark, f"{path}/*.gz").select("seqname", "seq")


def sequence_files(spark, sf_dir):
    """Reads by the reader that looks at the files first."""
    path = _folder(spark)
    reads = table(spark, sf_dir, "fastq_records").where("seq <> '' and qual <> ''")
    sinks.write_records(reads, sinks.fastq_record(F.col("header"), F.col("seq"), F.col("qual")), path)
    return fastx.read_sequences(spark, path).groupBy("header", "seq").agg(F.count("*").alias("n"))


def padded_tags(spark, sf_dir):
    """D3: tags of documents in the older form."""
    return D.padded_genome_tags(tags.sequences(spark, sf_dir), omics.ALFI, ["doc_id"])


def padded_references(spark, sf_dir):
    """Reference tags of the SNP search, padded."""
    refs = omics._references(D.digest(tags.sequences(spark, sf_dir).select("doc_id", "seq"), omics.ALFI))
    return refs.select("tag", sinks.padded_reference(F.col("tag")).alias("padded"))


# --- manifests and matrices -------------------------------------------------------------------


def _library_reads(spark, sf_dir):
    return table(spark, sf_dir, "fastq_records").groupBy(F.col("library_id").alias("sample")).agg(F.count("*").alias("reads"))


def profiling_files(spark, sf_dir):
    """A10: the manifest of libraries with their reads."""
    path = _folder(spark)
    _text(table(spark, sf_dir, "serial_manifest"), _tabbed("library_id", "r1", "r2"), path)
    files = tables.profiling_manifest(spark, path).select("sample", F.col("files")[0].alias("first"), F.size("files").alias("n_files"))
    return files.join(_library_reads(spark, sf_dir), "sample", "left")


def sheet_files(spark, sf_dir):
    """A sheet of the libraries, with their reads."""
    path = _folder(spark)
    _sheet(table(spark, sf_dir, "serial_manifest").select(F.col("library_id").alias("sample_id"), F.col("r1").alias("read1")), path)
    sheet = tables.sample_sheet(spark, path, ("read1",)).select(F.col("sample_id").alias("sample"), "read1")
    return sheet.join(_library_reads(spark, sf_dir), "sample", "left")


def serial_files(spark, sf_dir):
    """The manifest as a file; samples of each library with its reads."""
    path = _folder(spark)
    _sheet(table(spark, sf_dir, "serial_manifest").select("library_id", "r1", "r2", "t1", "t2", "t3", "t4", "t5"), path)
    return manifest_long(tables.serial_manifest(spark, path)).join(_library_reads(spark, sf_dir).withColumnRenamed("sample", "library_id"), "library_id", "left")


def genome_files(spark, sf_dir):
    """Manifest and id map as files."""
    path = _folder(spark)
    genomes = R.valid_entries(table(spark, sf_dir, "database_genomes"))
    _text(genomes.withColumn("note", F.lit("x")), _tabbed("source_id", *R.LINEAGE, "note", "genome_path"), f"{path}/manifest")
    read = tables.genome_manifest(spark, f"{path}/manifest")
    sinks.write_id_map(checkpointed(R.assign_ids(read, size=500)), f"{path}/ids")
    return read.join(tables.id_map(spark, f"{path}/ids"), "source_id").select("source_id", "genome_id", "species", "genus", "genome_path", F.size("extra").alias("extra"))


def matrix_files(spark, sf_dir):
    """Abundances as a wide matrix in a file, read back as long rows; six digits are kept."""
    path = _folder(spark)
    rows = table(spark, sf_dir, "rna_species_abundance").withColumn("species", S.species_name(F.col("species"))).where("species is not null")
    names = [r[0] for r in rows.select("sample_id").distinct().orderBy("sample_id").collect()]
    sinks.write_matrix(rows, path, "species", "sample_id", "abundance", names, form="")  # as exact text, else ties of the rounding fall otherwise
    value = F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.round(F.col("value") * 1e6) / 1e6)  # most are 0; a tie goes by the product, as in SQL
    return tables.wide_matrix(spark, path, "species").select("species", "sample", value.alias("value"))


def kraken_files(spark, sf_dir):
    """Classifier reports, one folder for each sample, and their totals."""
    path = _folder(spark)
    report = omics._report(spark, sf_dir).select("sample", F.lit(0.0).alias("pct"), "clade", F.col("clade").alias("direct"), "rank", F.lit("0").alias("taxid"), F.regexp_replace("name", "[\t\r\n]", " ").alias("name"))
    roots = report.where("rank = 'R'").groupBy("sample").agg(F.sum("clade").alias("clade"))  # a report has one root row
    roots = roots.select("sample", F.lit(0.0).alias("pct"), "clade", F.col("clade").alias("direct"), F.lit("R").alias("rank"), F.lit("1").alias("taxid"), F.lit("root").alias("name"))
    report.where("rank <> 'R'").unionByName(roots).write.partitionBy("sample").option("sep", "\t").option("quote", "").option("emptyValue", "").csv(path)
    return O.kraken_totals(tables.kraken_report(spark, path, by_folder=True))


def quant_files(spark, sf_dir):
    """Metadata as text separated by blanks, joined with the abundances."""
    path = _folder(spark)
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    meta = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.translate("o_orderpriority", " ", "_").alias("sample")).agg(F.count("*").alias("ch"), F.max("c_acctbal").alias("ve"))
    lines = meta.select(F.concat_ws("   ", "sample", "ch", F.format_string("%.2f", "ve"), F.lit("100"), F.lit("10")).alias("value"))
    heads = spark.createDataFrame([("# volumes",), ("Sample_ID CH VE VD VL",)], "value string")
    lines.unionByName(heads).write.text(path)
    abundance = omics._line_abundance(spark, sf_dir).withColumn("sample", F.translate("sample", " ", "_"))
    return O.absolute(abundance, tables.quant_metadata(spark, path), "Brand#11")


def qc_files(spark, sf_dir):
    """The retention table as a file, as it is written."""
    path = _folder(spark)
    qc = omics.retention_qc(spark, sf_dir).where("library_id is not null")
    sinks.write_tsv(qc.select("library_id", "total", "kept", F.round("retention", 6).alias("retention")), path, ["library_id"])
    return tables.read_tsv(spark, path)


def profile_files(spark, sf_dir):
    """The profile of all samples as a file with a lineage, and back."""
    path = _folder(spark)
    prof = tags.profile_gscore(spark, sf_dir).select("sample", F.lit("Any").alias("Kingdom"), F.col("taxon").alias("Species"), "theoretical", "seq_tags", "seq_reads")
    sinks.write_tsv(prof.withColumn("theoretical", F.round("theoretical", 6)), path, ["sample", "Species"])
    read = tables.profile_table(spark, path)
    return read.select("sample", F.element_at("lineage", -1).alias("species"), F.size("lineage").alias("ranks"), F.round("theoretical", 6).alias("theoretical"), "seq_tags", "seq_reads")


def site_files(spark, sf_dir):
    """Named sites and the reads on them as files, brought together again."""
    path = _folder(spark)
    sites = M.copy_numbers(D.motif_sites(tags.sequences(spark, sf_dir), omics.CHG, ["doc_id"]))
    named = checkpointed(M.named_sites(sites, "doc_id", "start").select("site_id", F.col("doc_id").alias("seqname"), (F.col("start") + 1).alias("start_1based"), "strand", "sequence", "copy_number"))
    sinks.write_tsv(named, f"{path}/sites", ["site_id"])
    sinks.write_tsv(named.select("site_id", F.col("copy_number").alias("raw_count")).where("raw_count > 1"), f"{path}/counts", ["site_id"])
    joined = M.require_sites(tables.count_table(spark, f"{path}/counts"), tables.site_table(spark, f"{path}/sites"))
    return joined.select("site_id", "raw_count", "seqname", "start_1based", "sequence", "copy_number")


def mapping_totals(spark, sf_dir):
    """Reads, reads on sites, sites with a read and with two reads of each sample."""
    sites = checkpointed(D.motif_sites(tags.sequences(spark, sf_dir), omics.CHG, ["doc_id", "sample"]))
    return M.mapping_totals(sites, M.site_counts(sites, sites, 2), least=2)


def all_species(spark, sf_dir):
    """Species of the list or of the abundances."""
    return R.all_keys(R.valid_entries(table(spark, sf_dir, "database_genomes")).select(F.trim("species").alias("species")), omics._typed_species(spark, sf_dir), "species")


# --- databases --------------------------------------------------------------------------------


def _document_genomes(spark, sf_dir):
    """Documents as genomes of the database: the language is the species, the kind of document the genus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "kind_code", "mt_from")
    seqs = tags.sequences(spark, sf_dir).select("doc_id", "taxon", "seq")
    ranks = {r: F.lit("Text") for r in R.LINEAGE[:-2]} | {"genus": F.coalesce("kind_code", F.lit("none")), "species": F.col("taxon")}
    return seqs.join(docs, "doc_id").select(F.format_string("D%09d", "doc_id").alias("source_id"), *[c.alias(r) for r, c in ranks.items()], "mt_from", "seq")


def _database(spark, sf_dir):
    """O1, O2: a database of the originals, brought up to date with the machine translations."""
    path, genomes = _folder(spark), _document_genomes(spark, sf_dir)
    R.build_database(genomes.where("mt_from is null").drop("mt_from"), BCGI, f"{path}/old", size=100)
    R.update_database(genomes.where("mt_from is not null").drop("mt_from"), BCGI, f"{path}/old", f"{path}/new")
    return f"{path}/new"


def database_genomes_numbered(spark, sf_dir):
    """Genomes with ids and shards after the update, with their unique tags."""
    path = _database(spark, sf_dir)
    stats = spark.read.parquet(f"{path}/unique_stats").select("genome_id", "genome_tags", "taxon_mean")
    return spark.read.parquet(f"{path}/genomes").join(stats, "genome_id", "left").select("source_id", "genome_id", "shard", "species", "genus", "genome_tags", "taxon_mean")


def database_totals(spark, sf_dir):
    """Totals of the database with the number of violations; the manifest must name the same relations."""
    path = _database(spark, sf_dir)
    master, unique = (spark.read.parquet(f"{path}/{t}") for t in ("master_tags", "unique_tags"))
    written = spark.read.json(f"{path}/manifest").first()
    return R.totals(master, unique).withColumns({
        "violations": F.lit(R.violations(master, unique, BCGI).count()).cast("long"), "written": F.lit(written["relations"]).cast("long"), "shard_size": F.lit(written["shard_size"]).cast("long"),
    })


def database_shards(spark, sf_dir):
    """Master tags of the translated genomes from their shards alone, looked up among the unique tags."""
    path = _database(spark, sf_dir)
    added = table(spark, sf_dir, "documents").where("mt_from is not null").select(F.format_string("D%09d", "doc_id").alias("source_id"))
    ids = spark.read.parquet(f"{path}/genomes").join(added, "source_id", "left_semi").select("genome_id")
    master = R.master_of(spark, path, ids, R.shard_size(spark.read.parquet(f"{path}/genomes")))
    found = R.look_up(spark, path, master).select("tag").distinct()
    return master.join(found, "tag").groupBy("shard").agg(F.count("*").alias("relations"), F.count_distinct("tag").alias("tags"))


def legacy_ids(spark, sf_dir):
    """An id map for a database that has none, and the shard size from its shards' bounds."""
    genomes = checkpointed(R.with_numbers(R.valid_entries(table(spark, sf_dir, "database_genomes")), 400))
    return R.legacy_id_map(genomes).withColumn("shard_size", F.lit(R.shard_size(genomes)))


def database_dump(spark, sf_dir):
    """B2, O1: the master tags of a database as FASTA and back."""
    path = _folder(spark)
    R.build_database(_document_genomes(spark, sf_dir).drop("mt_from"), BCGI, f"{path}/db", size=100)
    sinks.dump_tags(spark.read.parquet(f"{path}/db/master_tags"), f"{path}/dump")
    return fastx.read_fasta(spark, f"{path}/dump").select("seqname", "seq")


def taxonomy_files(spark, sf_dir):
    """The numbered genomes as a compressed list, as it is written."""
    path = _folder(spark)
    numbered = checkpointed(R.assign_ids(R.valid_entries(table(spark, sf_dir, "database_genomes")), "reassign", 500))
    sinks.write_taxonomy(numbered, path, R.LINEAGE)
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- models -----------------------------------------------------------------------------------


def model_calls(spark, sf_dir):
    """L1, L2: calls by a callable on the features of merged taxa, spread to their members."""
    prof = P.merge_subspecies(tags.profile_gscore(spark, sf_dir).withColumn("species", F.concat("taxon", F.lit("_"), F.upper(F.substring("sample", 1, 1)))))
    rows = prof.withColumns({"ln_g": F.ln("g_score"), "ln_share": F.ln("seq_reads")}).select("sample", "merged", "ln_g", "ln_share")
    calls = model.predict_with(lambda x: (x["ln_g"] > 3).astype("float64"), rows, ("ln_g", "ln_share"))
    members = tags.profile_gscore(spark, sf_dir).select("sample", F.concat("taxon", F.lit("_"), F.upper(F.substring("sample", 1, 1))).alias("species"), "taxon")
    return model.spread_to_subspecies(calls, members.withColumn("merged", S.merged_name(F.col("species")))).select("sample", "species", "prob", "pred")


def forest_calls(spark, sf_dir):
    """L1: a forest that tells reads with an ambiguous base by their numbers; fitted on ``FIT_ROWS`` reads, applied to all."""
    reads = table(spark, sf_dir, "fastq_records").where("seq <> '' and qual <> ''")
    rows = reads.select(
        "rec_no", "piece_no", F.length("seq").cast("double").alias("length"), S.bases_above(F.col("qual"), 20).cast("double").alias("good"),
        F.length(F.translate(F.upper("seq"), "AT", "")).cast("double").alias("gc"), (~S.only_acgt(F.col("seq"))).cast("int").alias("truth"),
    )
    names = ("length", "good", "gc")
    fit = model.fit_forest(rows.where("truth is not null").orderBy("rec_no").limit(FIT_ROWS), "truth", trees=10, names=names)
    return model.predict_forest(fit, rows, names).groupBy("truth", "pred").agg(F.count("*").alias("n"))


QUERIES = {
    "fastq_files": fastq_files, "digest_files": digest_files, "lenient_files": lenient_files, "padded_references": padded_references,
    "profiling_files": profiling_files, "sheet_files": sheet_files, "serial_files": serial_files, "genome_files": genome_files,
    "sequence_files": sequence_files, "padded_tags": padded_tags, "database_dump": database_dump, "taxonomy_files": taxonomy_files,
    "matrix_files": matrix_files, "kraken_files": kraken_files, "quant_files": quant_files, "qc_files": qc_files, "profile_files": profile_files,
    "site_files": site_files, "mapping_totals": mapping_totals, "all_species": all_species, "database_numbers": database_genomes_numbered,
    "database_totals": database_totals, "database_shards": database_shards, "legacy_ids": legacy_ids, "model_calls": model_calls, "forest_calls": forest_calls,
}

# --- SQL --------------------------------------------------------------------------------------

_HITS = tags._hits_sql(BCGI)
_NAMED_HITS = f"""{tags._seqs_sql()}, every AS (
    SELECT doc_id, '+' AS strand, i - 1 AS start, substr(seq, i, {BCGI.length}) AS tag FROM (SELECT doc_id, seq, unnest(list_filter(range(1, length(seq) - {BCGI.length} + 2), lambda i: regexp_full_match(substr(seq, i, {BCGI.length}), '{BCGI.forward}'))) AS i FROM seqs)
    UNION ALL
    SELECT doc_id, '-', i - 1, reverse(translate(substr(seq, i, {BCGI.length}), 'ACGT', 'TGCA')) FROM (SELECT doc_id, seq, unnest(list_filter(range(1, length(seq) - {BCGI.length} + 2), lambda i: regexp_full_match(substr(seq, i, {BCGI.length}), '{BCGI.reverse}'))) AS i FROM seqs))
  SELECT right(repeat('.', 50) || doc_id || '_' || strand || '_' || start, 50) AS seqname, tag AS seq FROM every"""
_READS = "n AS (SELECT library_id AS sample, count(*) AS reads FROM fastq_records GROUP BY 1)"
#: originals are numbered from 0 by source_id, translations from the next multiple of 100 on
_NUMBERED = f"""{_HITS}, g AS (SELECT doc_id, taxon, coalesce(kind_code, 'none') AS own_genus, mt_from IS NOT NULL AS added FROM seqs JOIN documents USING (doc_id)),
  k AS (SELECT *, row_number() OVER (PARTITION BY added ORDER BY doc_id) - 1 AS k FROM g),
  ids AS (SELECT *, k + CASE WHEN added THEN (SELECT (max(k) // 100 + 1) * 100 FROM k WHERE NOT added) ELSE 0 END AS id FROM k),
  known AS (SELECT taxon, min(own_genus) AS genus FROM ids WHERE NOT added GROUP BY taxon),
  genomes AS (SELECT doc_id, taxon, id, (id // 100 + 1) * 100 AS shard, CASE WHEN added AND known.genus IS NOT NULL THEN known.genus ELSE own_genus END AS genus FROM ids LEFT JOIN known USING (taxon)),
  master AS (SELECT doc_id, taxon, tag, count(*) AS copies FROM hits GROUP BY ALL),
  confined AS (SELECT tag FROM master GROUP BY tag HAVING min(taxon) = max(taxon)),
  uniq AS (SELECT doc_id, taxon, tag FROM master WHERE copies = 1 AND tag IN (SELECT tag FROM confined)),
  st AS (SELECT *, avg(genome_tags) OVER (PARTITION BY taxon) AS taxon_mean FROM (SELECT doc_id, taxon, count(*) AS genome_tags FROM uniq GROUP BY ALL))"""

ORACLES = {
    "fastq_files": "SELECT header, seq, qual, NULL::VARCHAR AS problem, count(*) AS n FROM fastq_records WHERE seq <> '' AND qual <> '' GROUP BY ALL",
    "sequence_files": "SELECT substr(header, 2) AS header, upper(seq) AS seq, count(*) AS n FROM fastq_records WHERE seq <> '' AND qual <> '' GROUP BY ALL",
    "padded_tags": f"WITH {tags._hits_sql(omics.ALFI)}, b AS (SELECT doc_id, tag FROM hits UNION ALL SELECT doc_id, {omics._rc('tag')} FROM hits) SELECT doc_id, lpad(tag, 40, '0') AS tag, count(*) AS copies FROM b GROUP BY ALL",
    "database_dump": f"""WITH {_HITS}, k AS (SELECT doc_id, taxon, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM seqs)
      SELECT printf('%08d', k) || '_' || count(*) AS seqname, tag AS seq FROM hits JOIN k USING (doc_id) GROUP BY k, tag""",
    "taxonomy_files": f"""WITH {omics._VALID}, k AS (SELECT *, row_number() OVER (ORDER BY source_id) - 1 AS k FROM v)
      SELECT concat_ws(chr(9), lpad(k::VARCHAR, 8, '0'), {', '.join(f"coalesce({c}, '')" for c in R.LINEAGE)}, coalesce(genome_path, '')) AS line FROM k""",
    "digest_files": f"WITH {_NAMED_HITS}",
    "lenient_files": f"WITH {_NAMED_HITS}",
    "padded_references": f"WITH {tags._hits_sql(omics.ALFI)} SELECT DISTINCT least(tag, {omics._rc('tag')}) AS tag, least(tag, {omics._rc('tag')}) || repeat('A', 58) AS padded FROM hits",
    "profiling_files": f"WITH {_READS} SELECT library_id AS sample, coalesce(nullif(r1, ''), r2) AS first, ((coalesce(r1, '') <> '')::INT + (coalesce(r2, '') <> '')::INT) AS n_files, reads FROM serial_manifest LEFT JOIN n ON library_id = sample",
    "sheet_files": f"WITH {_READS} SELECT library_id AS sample, r1 AS read1, reads FROM serial_manifest LEFT JOIN n ON library_id = sample",
    "serial_files": f"WITH {omics._MANIFEST}, {_READS} SELECT library_id, position, m.sample, reads FROM m LEFT JOIN n ON library_id = n.sample",
    "genome_files": f"""WITH {omics._VALID}, k AS (SELECT *, row_number() OVER (ORDER BY source_id) - 1 AS k FROM v)
      SELECT source_id, lpad(k::VARCHAR, 8, '0') AS genome_id, trim(species) AS species, coalesce(trim(genus), '') AS genus, coalesce(genome_path, '') AS genome_path, 1 AS extra FROM k""",
    "matrix_files": f"""WITH a AS (SELECT {omics._SPECIES.format(c='species')} AS species, sample_id AS sample, sum(abundance) AS value FROM rna_species_abundance WHERE {omics._SPECIES.format(c='species')} IS NOT NULL GROUP BY ALL)
      SELECT s.species, t.sample, round(coalesce(value, 0), 6) AS value FROM (SELECT DISTINCT species FROM a) s CROSS JOIN (SELECT DISTINCT sample FROM a) t LEFT JOIN a USING (species, sample)""",
    "kraken_files": omics.ORACLES["kraken_totals"],
    "quant_files": omics.ORACLES["absolute_counts"].replace("SELECT sample, taxon, abundance,", "SELECT replace(sample, ' ', '_') AS sample, taxon, abundance,"),
    "qc_files": f"WITH {omics._STATUS} SELECT library_id, count(*)::VARCHAR AS total, count(*) FILTER (status = 'kept')::VARCHAR AS kept, printf('%.12g', round(count(*) FILTER (status = 'kept') / count(*), 6)) AS retention FROM st WHERE library_id IS NOT NULL GROUP BY library_id",
    "profile_files": f"WITH {tags._DB} SELECT sample, taxon AS species, 3 AS ranks, round(theoretical, 6) AS theoretical, seq_tags::DOUBLE AS seq_tags, seq_reads::DOUBLE AS seq_reads FROM prof",
    "site_files": f"""WITH {omics._COPIES}, k AS (SELECT *, row_number() OVER (ORDER BY doc_id, start) AS k FROM copies)
      SELECT printf('site%09d', k) AS site_id, copy_number AS raw_count, doc_id::VARCHAR AS seqname, start::BIGINT + 1 AS start_1based, sequence, copy_number FROM k WHERE copy_number > 1""",
    "mapping_totals": f"""WITH {omics._SITE_COUNTS}, r AS (SELECT sample, count(*) AS reads FROM sites GROUP BY sample),
      c AS (SELECT sample, sum(n)::BIGINT AS mapped, count(*) AS detected, count(*) FILTER (n >= 2) AS qualified FROM sc GROUP BY sample)
      SELECT sample, reads, coalesce(mapped, 0) AS mapped, coalesce(detected, 0) AS detected, coalesce(qualified, 0) AS qualified FROM r LEFT JOIN c USING (sample)""",
    "all_species": f"WITH {omics._VALID} SELECT trim(species) AS species FROM v UNION SELECT {omics._SPECIES.format(c='species')} FROM rna_species_abundance WHERE {omics._SPECIES.format(c='species')} IS NOT NULL",
    "database_numbers": f"WITH {_NUMBERED} SELECT printf('D%09d', doc_id) AS source_id, printf('%08d', id) AS genome_id, shard::BIGINT AS shard, g.taxon AS species, genus, genome_tags, taxon_mean FROM genomes g LEFT JOIN st USING (doc_id)",
    "database_totals": f"""WITH {_NUMBERED} SELECT (SELECT count(*) FROM master) AS relations, (SELECT count(DISTINCT tag) FROM master) AS tags, (SELECT sum(copies)::BIGINT FROM master) AS copies,
      count(*) AS unique_rows, count(DISTINCT tag) AS unique_tags, 0::BIGINT AS violations, (SELECT count(*) FROM master) AS written, 100::BIGINT AS shard_size FROM uniq""",
    "database_shards": f"""WITH {_NUMBERED} SELECT shard::BIGINT AS shard, count(*) AS relations, count(DISTINCT tag) AS tags FROM master JOIN genomes USING (doc_id)
      WHERE doc_id IN (SELECT doc_id FROM ids WHERE added) AND tag IN (SELECT tag FROM uniq) GROUP BY shard""",
    "legacy_ids": f"WITH {omics._VALID}, k AS (SELECT row_number() OVER (ORDER BY source_id) - 1 AS k FROM v) SELECT 'legacy_' || lpad(k::VARCHAR, 8, '0') AS source_id, lpad(k::VARCHAR, 8, '0') AS genome_id, 400 AS shard_size FROM k",
    "model_calls": f"WITH {tags._DB} SELECT sample, taxon || '_' || upper(sample[1]) AS species, (ln(g_score) > 3)::INT::DOUBLE AS prob, (ln(g_score) > 3)::INT AS pred FROM prof",
}
