"""Queries do the whole job: every document, both strands, every sample."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.operators import approxjoin as A
from tagloom.operators import methyl as M
from tagloom.operators import snp as G
from tagloom.plans import omics, tags

RNG = random.Random(11)
LETTERS = str.maketrans("ACGT", "abcd")


def rc(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


def dist(a, b):
    return sum(x != y for x, y in zip(a, b))


def documents(spark, folder, rows):
    """A data directory of documents whose letters stand for the given bases."""
    data = [(i, "en", source, seq.translate(LETTERS)) for i, source, seq in rows]
    spark.createDataFrame(data, "doc_id long, lang string, source string, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def filled(core, left, right):
    return "".join(RNG.choices("ACGT", k=left)) + core + "".join(RNG.choices("ACGT", k=right))


def changed(tag, places):
    return "".join("ACGT"[("ACGT".index(c) + 1) % 4] if i in places else c for i, c in enumerate(tag))


def test_best_hits_equal_best_unique(spark):
    base = ["".join(RNG.choices("ACGT", k=30)) for _ in range(8)]
    make = lambda: [(changed(RNG.choice(base), RNG.sample(range(30), RNG.randint(0, 3))),) for _ in range(80)]
    q, r = spark.createDataFrame([*make(), (base[0],)], "query string"), spark.createDataFrame([*make(), (base[0],)], "reference string")
    for both in (False, True):
        got = {tuple(x) for x in A.best_hits(q, r, 2, both).collect()}
        assert got and got == {tuple(x) for x in A.best_unique(A.hamming_pairs(q, r, 2, both)).collect()}


def test_every_document_is_query_and_reference(spark, tmp_path):
    core = [filled("CGA" + "".join(RNG.choices("ACGT", k=6)) + "TGC", 10, 10) for _ in range(4)]
    near = [core[0], changed(core[0], {1}), core[1], changed(core[1], {2, 3}), core[2], changed(core[2], {4}), changed(core[2], {5}), core[3]]
    alfi = filled("GCA" + "".join(RNG.choices("ACGT", k=6)) + "TGC", 10, 10)
    site = filled("TCAGA", 14, 14)
    rows = [(2 * i + 1, "ocr_scan", t + "AAAA" + alfi + site) for i, t in enumerate(near)] + [(8, "bulk_xml", alfi + site), (10, "bulk_xml", changed(alfi, {0}))]
    sf = documents(spark, tmp_path, rows)

    def cut(name):
        e = enzymes.select(name)[0]
        return [(s, m[1] if p == e.forward else rc(m[1])) for _, s, seq in rows for p in dict.fromkeys(e.patterns) for m in re.finditer(f"(?=({p}))", seq)]

    every, expected = {t for _, t in cut("BcgI")}, set()
    for q in every:
        hits = [(dist(q, r), r) for r in every if r != q and dist(q, r) <= 2]
        if hits and sum(d == min(hits)[0] for d, _ in hits) == 1:
            expected.add((q, min(hits)[1], min(hits)[0]))
    assert expected and {tuple(r) for r in omics.hamming_best(spark, sf).collect()} == expected
    depth = omics.pileup(spark, sf).where("pos = 1").groupBy("sample").agg(F.sum(F.col("A") + F.col("C") + F.col("G") + F.col("T"))).collect()
    assert {tuple(r) for r in depth} == set(Counter(s for s, _ in cut("AlfI")).items())
    sites = omics.motif_sites(omics.CHG)(spark, sf)
    assert sites.count() > 0 and omics.site_counts(spark, sf).agg(F.sum("n")).first()[0] == sites.count()
    assert {r["sample"] for r in omics.backbone(spark, sf).collect()} == {"ocr_scan", "bulk_xml"}


def test_reads_of_the_other_strand_are_mapped(spark, tmp_path):
    tag = min((t := filled("GCATTTTTTTGC", 10, 10)), rc(t))
    far, palindrome = changed(rc(tag), {3}), "ACGTACGTAC" + "GCAAAATTTTGC" + "GTACGTACGT"
    reads = spark.createDataFrame([("s", tag), ("s", rc(tag)), ("s", far), ("s", palindrome)], "sample string, tag string")
    mapped = G.map_tags(reads, spark.createDataFrame([(tag,), (palindrome,)], "tag string"))
    assert {tuple(r) for r in mapped.collect()} == {("s", tag, tag, 2), ("s", tag, rc(far), 1), ("s", palindrome, palindrome, 1)}
    sites = spark.createDataFrame([("s", tag)], "sample string, sequence string")
    reads = reads.where(F.col("tag") != palindrome).withColumnRenamed("tag", "sequence")
    assert [tuple(r) for r in M.site_counts(reads, sites).collect()] == [("s", tag, 3)]
    # one equal reference on each strand: no single best one
    assert M.site_counts(reads, sites.union(spark.createDataFrame([("s", rc(tag))], sites.schema))).where(F.col("n") > 1).count() == 0
    sf = documents(spark, tmp_path, [(1, "ocr_scan", tag), (2, "ocr_scan", rc(tag))])
    piles = omics.pileup(spark, sf).collect()
    assert {r["ref_seq"] for r in piles} == {tag} and all(r[tag[r["pos"] - 1]] == 2 for r in piles)


def test_samples_are_those_of_the_documents(spark, tmp_path):
    alfi = filled("GCA" + "ACCTGA" + "TGC", 10, 10)
    site, cjei = filled("TCAGA", 14, 14), [filled("CCA" + "".join(RNG.choices("ACGT", k=6)) + "GT", 15, 15) for _ in range(12)]
    rows = [(i, source, (alfi + site) * 4 + "".join(cjei)) for i, source in enumerate(("fax.line", None, "fax.line", "ocr_scan"), 1)]
    sf, names = documents(spark, tmp_path, rows), {"fax.line", "none", "ocr_scan"}
    assert tags.sample_names(spark, sf) == sorted(names)
    with pytest.raises(ValueError, match="more than 2 samples"):
        tags.sample_names(spark, sf, most=2)
    assert set(omics.site_matrix(spark, sf).columns) == names | {"sequence"} and omics.site_matrix(spark, sf).where("none >= 2").count() > 0
    assert {r["call_rate"] for r in omics.site_quality(spark, sf).collect()} == {1.0}
    assert {len(r["line"].split(" ")) for r in omics.genotype_lines(spark, sf).collect()} == {6}
    assert {r["sample"] for r in tags.abundance_unpivot(spark, sf).where("abundance > 0").collect()} == names


def test_last_pieces_are_merged(spark, tmp_path):
    rows = [(1, "ocr_scan", filled("", 105, 105)), (2, "ocr_scan", filled("", 45, 45)), (3, "ocr_scan", filled("", 60, 60))]
    got = {(r["doc_id"], r["part"]): r["merged"] for r in omics.merged_pairs(spark, documents(spark, tmp_path, rows)).collect()}
    assert got == {(i, k // 160): seq[k : k + 160] for i, _, seq in rows for k in range(0, len(seq), 160)}


def test_fixed_motif_reads_are_the_records(spark, tmp_path):
    m = omics.RLAI
    at = m.start - 1
    seq = filled("CCAGT", at, 30)
    qual = "".join(chr(40 + i) for i in range(len(seq)))
    data = [("L", 1, seq, qual), ("L", 2, "A" * 50, "I" * 50), ("L", 3, None, None)]
    spark.createDataFrame(data, "library_id string, rec_no long, seq string, qual string").write.parquet(f"{tmp_path}/fastq_records.parquet")
    got = {r["rec_no"]: r for r in omics.fixed_motif_reads(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 3} and got[1]["status"] == "matched" and got[2]["status"] == got[3]["status"] == "no_match"
    assert (got[1]["sequence"], got[1]["quality"]) == (seq[at - m.left :][: m.length], qual[at - m.left :][: m.length])
