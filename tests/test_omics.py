"""Reads, pairs, methylation, genotypes, abundance, sources and streams."""

import gzip
import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.functions import seq as S
from tagloom.operators import approxjoin as A
from tagloom.operators import methyl as M
from tagloom.operators import multiomics as O
from tagloom.operators import reads as Q
from tagloom.operators import refdb as R
from tagloom.operators import snp as G
from tagloom.sources import fastx, sinks, tables
from tagloom.streaming import tags as stream

RNG = random.Random(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sequence_functions(spark):
    df = spark.createDataFrame([("AACGTN", " Homo  sapiens ", 29999)], "s string, n string, i long")
    r = df.select(
        S.reverse_complement(F.col("s")), S.canonical_tag(F.col("s")), S.species_name(F.col("n")), S.shard_boundary(F.col("i"), 30000),
        S.shard_boundary(F.col("i") + 1, 30000), S.genome_number(F.col("i")), S.merged_name(F.lit("a_b_X")), S.merged_name(F.lit("a_b")),
        S.n_within(F.col("s"), 0.1), S.n_within(F.col("s"), 1), sinks.hit_name(F.lit("x" * 60), F.lit("+"), F.lit(5)), sinks.padded_reference(F.lit("C")),
    ).first()
    assert tuple(r)[:10] == ("NACGTT", "AACGTN", "Homo_sapiens", 30000, 60000, "00029999", "a_b", "a_b", False, True)
    assert r[10] == ("x" * 60 + "_+_5")[-50:] and r[11] == "C" + "A" * 58


def test_read_status(spark):
    data = [(1, "ACGT", "II5I"), (2, "ACGT", "IIII"), (3, "ACNT", "IIII"), (4, None, "I"), (5, "", ""), (6, "acgtA", "IIII5")]
    df = spark.createDataFrame(data, "id long, seq string, qual string")
    got = {r["id"]: r["status"] for r in Q.with_status(df).collect()}
    assert got == {1: "low_quality", 2: "kept", 3: "ambiguous", 4: "empty", 5: "empty", 6: "kept"}
    r = Q.retention(Q.with_status(df).withColumn("k", F.lit(1)), ["k"]).first()
    assert (r["total"], r["kept"], r["retention"]) == (6, 2, 2 / 6)


def test_pairs(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3), (None, 4)], "read_id string, v long")
    b = spark.createDataFrame([("x", 5), ("x", 6), ("z", 7), (None, 8)], "read_id string, v long")
    expected = [("x", i, j) for i in (1, 2) for j in (5, 6)]
    assert rows(Q.pair_reads(a, b)) == rows(Q.pair_reads(a, b, salt=5).select("read_id", "v_1", "v_2")) == expected
    assert rows(Q.pair_counts(a, b)) == [("x", 2, 2, 4), ("y", 1, 0, 0), ("z", 0, 1, 0)]
    with pytest.raises(Exception, match="repeated read id x"):
        Q.require_unique(a).collect()
    assert Q.require_unique(a.where("v > 1")).count() == 3


def test_merge_pairs(spark):
    whole = "".join(RNG.choices("ACGT", k=160))
    rc = whole[60:][::-1].translate(str.maketrans("ACGT", "TGCA"))
    wrong = "A" + rc[1:-1] + ("A" if rc[-1] != "A" else "C")
    df = spark.createDataFrame([(1, whole[:100], rc), (2, whole[:100], wrong), (3, "A" * 50, "C" * 50), (4, None, "A"), (5, "", "")], "id long, seq_1 string, seq_2 string")
    got = {r["id"]: (r["merged"], r["overlap"]) for r in Q.merge_pairs(df, ["id"]).collect()}
    assert got[1] == (whole, 40) and got[2][1] == 40 and set(got) == {1, 2}
    assert Q.merge_pairs(df, ["id"], longest=159).count() == 0


@pytest.mark.parametrize("length,letters", [(27, "ACGT"), (50, "ACGT"), (70, "ACGT"), (20, "ACGTN")])
def test_hamming_pairs_equal_brute_force(spark, length, letters):
    base = ["".join(RNG.choices(letters, k=length)) for _ in range(12)]

    def near(s):
        s = list(s)
        for _ in range(RNG.randint(0, 4)):
            s[RNG.randrange(length)] = RNG.choice(letters)
        return "".join(s)

    q, r = [near(RNG.choice(base)) for _ in range(60)] + [None, "", "AC"], [near(RNG.choice(base)) for _ in range(60)] + [None, "", "AC"]
    dq, dr = spark.createDataFrame([(x,) for x in q], "query string"), spark.createDataFrame([(x,) for x in r], "reference string")
    dist = lambda a, b: sum(x != y for x, y in zip(a, b))
    expected = {(a, b, "+", dist(a, b)) for a in q if a for b in r if b and len(a) == len(b) and dist(a, b) <= 2}
    for hot in (A.HOT, 1, 4):  # segments of more references than that are split further
        got = [tuple(x) for x in A.hamming_pairs(dq, dr, 2, hot=hot).where("query <> ''").collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    best = {}
    for a, b, _, d in expected:
        best.setdefault(a, []).append((d, b))
    unique = {(a, min(x)[1], min(x)[0]) for a, x in best.items() if sum(d == min(x)[0] for d, _ in x) == 1}
    assert {(x["query"], x["reference"], x["distance"]) for x in A.best_unique(A.hamming_pairs(dq, dr, 2)).where("query <> ''").collect()} == unique


def test_methylation_numbers(spark):
    counts = spark.createDataFrame([("s", f"x{i}", i) for i in range(1, 101)], "sample string, sequence string, n long")
    assert [M.depth_max(counts, 0.02, how).first()["depth_max"] for how in ("mean", "median")] == [99.5, 99.5]
    m = {r["sequence"]: r for r in M.metrics(counts).collect()}
    assert m["x2"]["rpm"] is None and m["x5"]["rpm"] == 5 / 5050 * 1e6 and math.isclose(m["x10"]["m_index"], math.log(10) / math.log(99.5))
    sites = spark.createDataFrame([(1, "ACGT"), (2, "ACGT"), (3, "AAAA"), (4, "ANNA")], "site long, sequence string")
    assert tuple(M.site_totals(M.copy_numbers(sites)).first()) == (4, 1, 2, 1)
    reads = spark.createDataFrame([("s",)] * 9 + [("t",)], "sample string")
    got = M.mapping_totals(reads, spark.createDataFrame([("s", "a", 5), ("s", "b", 1)], "sample string, sequence string, n long"))
    assert rows(got) == [("s", 9, 6, 2, 1), ("t", 1, 0, 0, 0)]
    listed = spark.createDataFrame([("x1", 7), ("x2", 8), ("x2", 8)], "site_id string, start int")
    found = lambda *ids: M.require_sites(spark.createDataFrame([(i, 1) for i in ids], "site_id string, n long"), listed)
    assert rows(found("x1")) == [("x1", 1, 7)]
    for bad, what in ((("x1", "x9"), "no such site: x9"), (("x2",), "site listed twice: x2")):
        with pytest.raises(Exception, match=what):
            found(*bad).collect()


def test_genotypes(spark):
    piles = [("s", "T", i, *c) for i, c in enumerate([(10, 0, 0, 0), (5, 0, 0, 5), (3, 0, 0, 0), (500, 0, 0, 0), (0, 0, 0, 0), (9, 1, 0, 0)])]
    df = spark.createDataFrame(piles, "sample string, ref_seq string, pos int, A long, C long, G long, T long")
    assert [r["gt"] for r in G.genotypes(df).orderBy("pos").collect()][:5] == ["AA", "AT", None, None, None]
    calls = spark.createDataFrame([("1", "T", 1, "AA"), ("2", "T", 1, "AT"), ("3", "T", 1, "--"), ("4", "T", 1, "TT")], "sample string, ref_seq string, pos int, gt string")
    r = G.site_quality(calls, 4).first()
    assert (r["called"], r["call_rate"], r["maf"]) == (3, 0.75, 0.5)
    refs = spark.createDataFrame([("AC",)], "tag string")
    back = G.backbone(refs, calls, calls.withColumn("ref_seq", F.lit("AC")))
    assert back.count() == 8 and back.where("gt = '--'").count() == 5


def test_ratios(spark):
    names = ("Lewinella_cohaerens", "Sulfitobacter_geojensis", "Other_species")
    make = lambda cols: spark.createDataFrame([(s, n, v) for s, c in cols.items() for n, v in zip(names, c)], "sample string, species string, value double")
    dna, rna = make({"Sample1": (0.1, 0.2, 0.7), "Sample2": (0.2, 0.1, 0.7), "only": (1.0, 0.0, 0.0)}), make({"Sample1": (0.3, 0.05, 0.65), "Sample2": (0.1, 0.4, 0.5)})
    got = {(r["sample"], r["species"]): r for r in O.rna_dna(dna, rna).collect()}
    assert [round(got[s, n]["ratio"], 6) for s in ("Sample1", "Sample2") for n in names] == [3, 0.25, 0.928571, 0.5, 4, 0.714286]
    edge = O.rna_dna(
        spark.createDataFrame([("s", "a", 0.0), ("s", "b", 0.1), ("s", "c", 0.0)], dna.schema), spark.createDataFrame([("s", "a", 0.1), ("s", "b", 0.0), ("s", "c", 0.0)], dna.schema)
    )
    assert rows(edge.select("species", "ratio", "log2_ratio", "status")) == [("a", None, None, "RNA_only"), ("b", 0.0, None, "DNA_only"), ("c", None, None, "missing")]
    assert tuple(O.status_counts(edge, 5).first()) == ("s", 0, 1, 1, 3)
    low = O.rna_dna(spark.createDataFrame([("s", "a", 0.0005)], dna.schema), spark.createDataFrame([("s", "a", 0.5)], dna.schema), 0.001, 0.001)
    assert low.count() == 0


def test_absolute_and_reports(spark):
    a = spark.createDataFrame([("s", "h", 0.4), ("s", "x", 0.2), ("n", "x", 1.0)], "sample string, taxon string, abundance double")
    meta = spark.createDataFrame([("s", 2e6, 0.5, 100.0, 10.0), ("n", 1.0, 1.0, 1.0, 1.0)], "sample string, ch double, ve double, vd double, vl double")
    assert rows(O.absolute(a, meta, "h", strict=False).where("taxon = 'x'")) == [("s", "x", 0.2, 1e6, 50000.0)]
    assert rows(O.absolute(a.where("sample = 's'"), meta, "h").where("taxon = 'x'")) == [("s", "x", 0.2, 1e6, 50000.0)]
    for bad, what in ((a, "no host share in n"), (a.where("sample = 's'").selectExpr("'u' as sample", "taxon", "abundance"), "no metadata for u")):
        with pytest.raises(Exception, match=what):
            O.absolute(bad, meta, "h").collect()
    report = spark.createDataFrame([("s", 80, "R", "root"), ("s", 15, "U", "u"), ("s", 5, "U", "u"), ("s", 30, "S", " A  b"), ("s", 0, "S", "C d"), ("s", 70, "G", "A")], "sample string, clade long, rank string, name string")
    t = O.kraken_totals(report).first()
    assert (t["classified"], t["unclassified"], t["species_reads"], t["detected"], t["classified_share"]) == (80, 20, 30, 1, 0.8)
    assert rows(O.kraken_species(report)) == [("s", "A_b", 30), ("s", "C_d", 0)]


def test_harmonise(spark):
    cols = ["source_id", *R.LINEAGE]
    old = spark.createDataFrame([("o1", "K", "P", "C", "O", "F", "G", "sp1"), ("o2", "K", None, "C", "O", "F", "G", "sp2")], cols)
    new = spark.createDataFrame([("n1", "K", "X", "C", "O", "F", "G", "sp1"), ("n2", "K", None, "C", "O", "F", "G", "sp2"), ("n3", "K", "Y", "C", "O", "F", "G", "sp3")], cols)
    got = {r["source_id"]: (r["phylum"], r["changed"]) for r in R.harmonise(new, old).collect()}
    assert got == {"n1": ("P", True), "n2": (None, False), "n3": ("Y", False)}


def test_files(spark, tmp_path):
    fq = tmp_path / "a.fq.gz"
    with gzip.open(fq, "wt") as f:
        f.write("@r1 x\r\nACGT\r\n+\r\nIIII\r\n@r2\nAC\n+\nI\n@r3\nAC\n")
    got = fastx.read_fastq(spark, [str(fq)], strict=False).orderBy("read_no").collect()
    assert [(r["read_no"], r["header"], r["seq"], r["problem"]) for r in got] == [
        (1, "@r1 x", "ACGT", None), (2, "@r2", "AC", "sequence and quality differ in length"), (3, "@r3", "AC", "truncated"),
    ]
    with pytest.raises(Exception, match="record 2"):
        fastx.read_fastq(spark, [str(fq)]).collect()
    fa = tmp_path / "a.fa"
    fa.write_text(">c1 one\nacg\nT\n>c2\nGG>G\n>c3\n")
    assert [(r["seqname"], r["seq"]) for r in fastx.read_fasta(spark, str(fa)).orderBy("seqname").collect()] == [("c1", "ACGT"), ("c2", "GG>G"), ("c3", "")]
    assert (fastx.sniff(str(fq)), fastx.sniff(str(fa))) == ("fastq", "fasta")
    out = str(tmp_path / "out")
    df = spark.createDataFrame([("c1", "acgt"), ("c2", None)], "n string, s string")
    sinks.write_records(df, sinks.fasta_record(F.col("n"), F.col("s")), out)
    assert [r["seq"] for r in fastx.read_fasta(spark, out).collect()] == ["ACGT"]
    sinks.write_tsv(spark.createDataFrame([("b", 0.1, None), ("a", 1e-15, 2)], "k string, v double, n long"), f"{out}2", ["k"])
    assert sorted(r[0] for r in spark.read.text(f"{out}2").collect()) == ["a\t1e-15\t2", "b\t0.1\tNA", "k\tv\tn"]


def test_tables(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert rows(tables.profiling_manifest(spark, put("m", "# c\ns1\ta.fq\ns2\ta.fq\tb.fq\n"))) == [("s1", ["a.fq"]), ("s2", ["a.fq", "b.fq"])]
    for bad in ("s1\n", "s1\ta\ns1\tb\n"):
        with pytest.raises(ValueError):
            tables.profiling_manifest(spark, put("bad", bad))
    m = tables.wide_matrix(spark, put("w", "#Species\ts1\ts2\nx\t0.5\t1\ny\t0\t0\n"), "Species", most=1)
    assert rows(m) == [("x", "s1", 0.5), ("x", "s2", 1.0), ("y", "s1", 0.0), ("y", "s2", 0.0)]
    for bad in ("-1", "x", "inf", "2"):
        with pytest.raises(ValueError):
            tables.wide_matrix(spark, put(f"w{bad}", f"Species\ts1\nx\t{bad}\n"), "Species", most=1)
    assert rows(tables.quant_metadata(spark, put("q", "# n\nSample_ID CH\nsample01   2000000\n"))) == [("sample01", 2000000.0, None, None, None)]
    with pytest.raises(ValueError):
        tables.quant_metadata(spark, put("q2", "sample_id ch\na -1\n"))
    g = tables.genome_manifest(spark, put("g", "g1\tK\tP\tC\tO\tF\tG\tS_p\te1\te2\t/x.fa\n")).first()
    assert g["species"] == "S_p" and g["extra"] == ["e1", "e2"] and g["genome_path"] == "/x.fa"
    assert rows(tables.id_map(spark, put("i", "source_id\tid\na\t00000001\n"))) == [("a", "00000001")]
    k = tables.kraken_report(spark, [put("k.report", "80.0\t80\t0\tR\t1\troot\n 10.0\t10\t10\tS\t7\t  A b\n")]).where("rank = 'S'").first()
    assert (k["sample"], k["clade"], k["name"]) == ("k", 10, "A b")
    for name in ("x_R1.fq.gz", "x_R2.fq.gz"):
        put(name, "")
    assert set(tables.mates(str(tmp_path))) == {"x"}


def test_stream_equals_batch(spark, tmp_path):
    from tagloom.operators import profile as P
    from tagloom.operators.digest import digest

    enzyme = enzymes.select("CjeI")[0]
    data = [(f"s{i % 2}", "".join(RNG.choices("ACGT", k=1500))) for i in range(12)]
    df = spark.createDataFrame(data, "sample string, seq string")
    for i in range(3):
        df.where(f"pmod(hash(seq), 3) = {i}").write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")
    q = stream.running_tag_counts(source, enzyme).writeStream.outputMode("complete").format("memory").queryName("tags").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("tags")) == rows(P.tag_counts(digest(df, enzyme).select("sample", "tag")))
