"""File sources that Spark splits, sinks and databases on disk."""

import gzip
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.operators import refdb as R
from tagloom.plans import files, registry
from tagloom.sources import fastx, sinks, tables

RNG = random.Random(8)
BCGI = enzymes.select("BcgI")[0]


def reads(n):
    out = []
    for i in range(n):
        k = RNG.randint(5, 60)
        qual = "".join(RNG.choices("@+!I~", k=k))
        out.append((f"@r{i} x", "".join(RNG.choices("ACGTN", k=k)), "+" if i % 3 else f"+r{i}", qual))
    return out


@pytest.mark.parametrize("split", [333, 2000, 10**9])
def test_fastq_is_split_anywhere(spark, tmp_path, split):
    rows = {p: reads(200) for p in ("a.fq", "b.fastq", "c.fq.gz")}
    for p, own in rows.items():
        text = ("\r\n" if p == "b.fastq" else "\n").join("\n".join(r).replace("\n", "\r\n" if p == "b.fastq" else "\n") for r in own) + ("" if p == "a.fq" else "\n")
        (tmp_path / p).write_bytes(gzip.compress(text.encode()) if p.endswith("gz") else text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if split < 10**9 else "4194304")
    try:
        got = fastx.scan_fastq(spark, str(tmp_path)).select("header", "seq", "plus", "qual").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", "4194304")
    assert sorted(map(tuple, got)) == sorted(r for own in rows.values() for r in own)


def test_broken_fastq(spark, tmp_path):
    (tmp_path / "x.fq").write_text("@a\nAC\n+\n@I\n@b\nAC\n+\nI\n@c\nAC\nx\nII\n@d\nAC\n")
    got = {r["header"]: (r["qual"], r["problem"]) for r in fastx.scan_fastq(spark, str(tmp_path), strict=False).collect()}
    assert got == {"@a": ("@I", None), "@b": ("I", "sequence and quality differ in length"), "@c": ("II", "separator without +"), "@d": (None, "truncated")}
    with pytest.raises(Exception, match="at @"):
        fastx.scan_fastq(spark, str(tmp_path)).collect()
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.fq").write_text("")
    assert fastx.scan_fastq(spark, str(tmp_path / "e")).count() == 0


def test_lenient_fasta(spark, tmp_path):
    whole = gzip.compress(b">a one\nac\r\nGT\n>b\n>c\nTT\n")
    (tmp_path / "w.gz").write_bytes(whole)
    (tmp_path / "cut.gz").write_bytes(gzip.compress(bytes(RNG.choices(b"ACGT\n>", k=5000)))[:-900])
    (tmp_path / "p.fa").write_text(">d\nAA\nC")
    got = fastx.read_fasta_lenient(spark, str(tmp_path)).select("seqname", "seq").collect()
    assert sorted(map(tuple, got)) == [("a", "ACGT"), ("c", "TT"), ("d", "AAC")]


def test_id_modes_and_shards(spark):
    make = lambda *ids: spark.createDataFrame([(i,) for i in ids], "source_id string")
    ids = lambda df: sorted((r["source_id"], r["genome_id"], r["shard"]) for r in df.collect())
    own = make("00000007", "00000400")
    assert ids(R.assign_ids(own, "auto", 100)) == ids(R.assign_ids(own, "preserve", 100)) == [("00000007", "00000007", 100), ("00000400", "00000400", 500)]
    assert ids(R.assign_ids(own, "reassign", 100)) == [("00000007", "00000000", 100), ("00000400", "00000001", 100)]
    for other in (make("x", "00000001"), make("00000001", "00000001"), make("00000001", None)):
        assert {r[1] for r in ids(R.assign_ids(other.na.fill("z"), "auto", 1))} == {"00000000", "00000001"}
        with pytest.raises(ValueError):
            R.assign_ids(other, "preserve")
    with pytest.raises(ValueError):
        R.assign_ids(own, "other")
    assert R.shard_size(spark.createDataFrame([(600,), (900,), (1500,)], "shard long")) == 300
    with pytest.raises(ValueError):
        R.shard_size(spark.createDataFrame([], "shard long"))
    old = spark.createDataFrame([("00000001",), ("00000002",)], "genome_id string")
    assert sorted(map(tuple, R.legacy_id_map(old).collect())) == [("legacy_00000001", "00000001"), ("legacy_00000002", "00000002")]
    for bad in (old.union(old), old.withColumn("genome_id", F.lit("7"))):
        with pytest.raises(Exception, match="no id of its own"):
            R.legacy_id_map(bad).collect()


def test_database_on_disk(spark, tmp_path):
    rng = random.Random(3)
    dna = lambda n: "".join(rng.choices("ACGT", k=n))
    rows = [(f"s{i}", *["K"] * 5, f"G{i % 4}", f"G_{i % 4}" if i < 11 else None, dna(30_000)) for i in range(12)]
    df = spark.createDataFrame(rows, ["source_id", *R.LINEAGE, "seq"]).repartition(4)
    late = F.col("source_id").isin("s8", "s9")
    R.build_database(df.where(~late), BCGI, f"{tmp_path}/old", size=5)
    R.update_database(df.where(late).withColumn("phylum", F.lit("other")), BCGI, f"{tmp_path}/old", f"{tmp_path}/new")
    got = {r["source_id"]: (r["genome_id"], r["shard"], r["phylum"]) for r in spark.read.parquet(f"{tmp_path}/new/genomes").collect()}
    assert len(got) == 11 and got["s0"] == ("00000000", 5, "K") and got["s8"] == ("00000010", 15, "K") and got["s9"] == ("00000011", 15, "K")
    with pytest.raises(ValueError, match="already in the database"):
        R.update_database(df.limit(1), BCGI, f"{tmp_path}/old", f"{tmp_path}/again")
    master, unique = (spark.read.parquet(f"{tmp_path}/new/{t}") for t in ("master_tags", "unique_tags"))
    assert R.violations(master, unique, BCGI).count() == 0 and R.totals(master, unique).first()["relations"] == master.count() > 0
    ids = spark.createDataFrame([("00000010",), ("00000002",)], "genome_id string")
    some = R.master_of(spark, f"{tmp_path}/new", ids, 5)
    assert sorted(map(tuple, some.select("genome_id", "tag").collect())) == sorted(map(tuple, master.join(ids, "genome_id").select("genome_id", "tag").collect()))
    filters = re.search(r"PartitionFilters: \[(.*?)\]", some._jdf.queryExecution().executedPlan().toString())
    assert filters and re.search(r"shard#\d+ IN \((5,15|15,5)\)", filters[1])  # other shards are not read
    asked = unique.select("tag").limit(3).unionByName(spark.createDataFrame([("none",)], "tag string"))
    assert R.look_up(spark, f"{tmp_path}/new", asked).select("tag").distinct().count() == unique.select("tag").limit(3).distinct().count()
    sinks.dump_tags(master, f"{tmp_path}/dump")
    assert fastx.read_fasta(spark, f"{tmp_path}/dump").count() == master.count()
    sinks.write_taxonomy(spark.read.parquet(f"{tmp_path}/new/genomes").withColumn("genome_path", F.lit("p")), f"{tmp_path}/tax", R.LINEAGE)
    assert spark.read.text(f"{tmp_path}/tax").count() == 11
    assert spark.read.json(f"{tmp_path}/new/manifest").first()["relations"] == master.count()


def test_tables_of_sites_and_profiles(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    sites = put("s", "site_id\tseqname\tstart_1based\tstrand\tsequence\tcopy_number\nsite000000001\tc\t5\t+\tANA\tNA\n")
    assert tuple(tables.site_table(spark, sites).first()) == ("site000000001", "c", 5, "+", "ANA", None)
    assert tables.count_table(spark, put("c", "site_id\traw_count\nsite000000001\t7\n")).first()["raw_count"] == 7
    for bad in ("site\traw_count\nx\t7\n", "site_id\traw_count\nx\ty\n"):
        with pytest.raises(ValueError):
            tables.count_table(spark, put("b", bad))
    r = tables.profile_table(spark, put("p", "#Kingdom\tSpecies\ttheoretical\treads\nB\tX_y\t2.5\t7\n")).first()
    assert r["lineage"] == ["B", "X_y"] and r["lineage_key"] == "B\tX_y" and (r["theoretical"], r["reads"]) == (2.5, 7.0)
    df = spark.range(1000).selectExpr("cast(id as string) as k", "id as v").repartition(8)
    sinks.write_tsv(df, f"{tmp_path}/many", ["k"])
    back = tables.read_tsv(spark, f"{tmp_path}/many")
    assert back.count() == 1000 and back.columns == ["k", "v"]


def test_matrix_of_more_samples_than_columns_fit(spark, tmp_path):
    """21,000 samples, more than the 10,000 that the query took and the 20,480 columns of Spark's reader."""
    n = 21_000
    name = "if(id = 7, 'r000008', concat(if(id % 2 = 0, '#r', 'R'), lpad(cast(id as string), 6, '0')))"  # names that differ by case only
    cells = spark.range(n).selectExpr("id as entry_id", f"{name} as sample_id", "concat(' sp ', cast(id % 3 as string)) as species", "if(id % 5 = 0, null, id / 20000.0D) as abundance")
    twice = cells.where("entry_id < 1000").withColumn("abundance", F.col("abundance") + 0.0000005)  # ties of the rounding
    cells.unionByName(twice).repartition(4).write.parquet(f"{tmp_path}/rna_species_abundance.parquet")
    got = files.matrix_files(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view rna_species_abundance as select * from '{tmp_path}/rna_species_abundance.parquet/*.parquet'")
    want = con.execute(registry.ORACLES["matrix_files"]).fetchall()
    assert len(want) == 3 * n and sorted(map(tuple, got.collect())) == sorted(want)


def test_matrix_of_odd_cells(spark, tmp_path):
    df = spark.createDataFrame([("b", "t", 0.25), ("b", "t", 0.5), ("a", "s", None), ("c", None, 3.0)], "species string, sample string, value double")
    sinks.write_matrix(df, f"{tmp_path}/m", "species", "sample", "value", [None, "s", "t"])
    lines = [r[0] for r in spark.read.text(f"{tmp_path}/m").collect()]
    assert [x for x in lines if x != "species\t\ts\tt"] == ["a\t0\t0\t0", "b\t0\t0\t0.75", "c\t0\t0\t0"]
    m = tables.wide_matrix(spark, f"{tmp_path}/m", "species")
    assert sorted(map(tuple, m.collect()), key=repr) == sorted(((r, s, 0.75 if (r, s) == ("b", "t") else 0.0) for r in "abc" for s in (None, "s", "t")), key=repr)
    sinks.write_matrix(df.limit(0), f"{tmp_path}/none", "species", "sample", "value", [])
    assert tables.wide_matrix(spark, f"{tmp_path}/none", "species").count() == 0
    with pytest.raises(ValueError):
        sinks.write_matrix(df, f"{tmp_path}/bad", "species", "sample", "value", ["s", "t\tu"])
    for k, text in enumerate(("Kingdom\tSpecies\tFamily\ts1\ts2\nK\tx\tF\t0.5\n", "Species\ts1\ts1\nx\t1\t1\n", "Species\ts1\nx\t\n", "Species\ts1\nx\tNaN\n")):
        (tmp_path / f"w{k}").write_text(text)
        with pytest.raises(ValueError):
            tables.wide_matrix(spark, f"{tmp_path}/w{k}", "Species", ("Kingdom", "Family"))
    (tmp_path / "ranks").write_text("#Kingdom\tSpecies\tFamily\ts1\ts2\nK\tx\tF\t0.5\t1\n")
    assert sorted(map(tuple, tables.wide_matrix(spark, f"{tmp_path}/ranks", "Species", ("Kingdom", "Family")).collect())) == [("x", "s1", 0.5), ("x", "s2", 1.0)]
