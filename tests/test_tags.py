"""Digestion, database and profile operators against a small independent model."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tagloom import enzymes
from tagloom.functions import seq as S
from tagloom.operators import digest as D
from tagloom.operators import profile as P
from tagloom.operators import refdb as R

RNG = random.Random(7)
CJEI, ALFI, BSAXI = (enzymes.select(n)[0] for n in ("CjeI", "AlfI", "BsaXI"))


def rc(s):
    return s[::-1].translate(str.maketrans("ACGTN", "TGCAN"))


def dna(n, letters="ACGT"):
    return "".join(RNG.choices(letters, k=n))


def model_digest(seq, enzyme):
    seq, out = seq.upper(), []
    for strand, text in (("+", seq), ("-", rc(seq))):
        if strand == "-" and enzyme.palindromic:
            continue
        out += [(strand, m[1]) for m in re.finditer(f"(?=({enzyme.forward}))", text)]
    return Counter(out)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_enzyme_dimension():
    assert [e.id for e in enzymes.ENZYMES] == list(range(1, 17))
    for e in enzymes.ENZYMES:
        assert e.palindromic == (e.name in ("BplI", "FalI", "AlfI"))
        assert len(e.windows) == 5 and e.windows[-1][1] == e.expected + 15 - 2
        assert rc(rc("ACGTN")) == "ACGTN" and len(e.patterns) == 2 - e.palindromic
    assert enzymes.select(17) == enzymes.ENZYMES and enzymes.select("bcgi")[0].id == 5 and enzymes.select()[0].name == "CjePI"
    with pytest.raises(ValueError):
        enzymes.select("EcoRI")
    assert enzymes.motif("AspBHI", "CHG").length == 31 and enzymes.motif().length == 32


@pytest.mark.parametrize("enzyme", [CJEI, ALFI, enzymes.select("Hin4I")[0]], ids=lambda e: e.name)
def test_digest_equals_model(spark, enzyme):
    seqs = [(i, dna(3000), "x") for i in range(4)] + [(5, None, "x"), (6, "", "x"), (7, dna(40).lower(), "x"), (8, dna(500, "ACGTN"), "x")]
    df = spark.createDataFrame(seqs, "id long, seq string, tag string")
    got = Counter(map(tuple, D.digest(df, enzyme).select("id", "strand", "tag").collect()))
    expected = Counter({(i, *k): n for i, s, _ in seqs if s for k, n in model_digest(s, enzyme).items()})
    assert got == expected
    flipped = D.digest(df.withColumn("seq", S.reverse_complement(F.col("seq"))), enzyme)
    if not enzyme.palindromic:
        assert Counter(r["tag"] for r in flipped.collect()) == Counter(t for (_, _, t), n in expected.items() for _ in range(n))
    stats = {r["id"]: r["tags"] for r in D.digest_stats(df, enzyme, "id").collect()}
    assert stats == {i: sum(n for (j, *_), n in expected.items() if j == i) for i, *_ in seqs}


def test_positional_and_plain_scans(spark):
    text = dna(9000)
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, seq string")
    found = rows(D.positional_hits(df, ["id"], {"f": CJEI.forward, "r": CJEI.reverse}))
    expected = [(1, m.start(), n, m[1]) for n, p in (("f", CJEI.forward), ("r", CJEI.reverse)) for m in re.finditer(f"(?=({p}))", text)]
    assert found == sorted(expected, key=str)
    ends = {}
    for p in CJEI.patterns:
        ends |= {m.end(): m[0] for m in re.finditer(p, text)}
    assert rows(D.plain_scan(df, CJEI, ["id"])) == sorted(((1, e, t) for e, t in ends.items()), key=str)


def test_recovery_policies(spark):
    tag = lambda p: re.sub(r"\[ACGT\]\{(\d+)\}", lambda m: "A" * int(m[1]), p)
    fwd, rev = tag(BSAXI.forward), tag(BSAXI.reverse)
    data = [(1, fwd), (2, "G" + rev.lower() + "G" + fwd), (3, "ACGT"), (4, None), (5, fwd + "TT" + fwd)]
    df = spark.createDataFrame(data, "id long, seq string")
    every = D.all_hits(df, BSAXI, ["id"], "all").collect()
    expected = []
    for i, s in data:
        found = sorted((k, no) for no, p in enumerate(BSAXI.patterns, 1) for k in range(len(s or "") - 26) if re.fullmatch(p, s.upper()[k : k + 27]))
        expected += [(i, h, k, no, s.upper()[k : k + 27]) for h, (k, no) in enumerate(found, 1)]
    assert sorted(map(tuple, every)) == sorted(expected)
    per = Counter(r["id"] for r in every)
    assert {r["id"] for r in D.all_hits(df, BSAXI, ["id"], "unique").collect()} == {i for i, n in per.items() if n == 1}
    first = {r["id"]: r["pattern"] for r in D.all_hits(df, BSAXI, ["id"], "first").collect()}
    assert first == {i: min(no for j, _, _, no, _ in expected if j == i) for i in per}


def test_windows_and_first_hit(spark):
    read = dna(177)
    df = spark.createDataFrame([(1, read, read), (2, None, None), (3, "AC", "II")], "id long, seq string, qual string")
    got = {(r["id"], r["position"]): (r["window"], r["truncated"]) for r in D.split_windows(df, BSAXI, ["id"]).collect()}
    assert got[1, 5] == (read[131:], True) and got[1, 1] == (read[:50], False) and got[3, 2] == ("", True)
    tag = "A" * 10 + "GCA" + "C" * 6 + "TGC" + "G" * 10
    hit = D.first_hit(spark.createDataFrame([(1, "T" * 5 + tag, "!" * 5 + "F" * 32), (2, "T" * 60 + tag, "F" * 92)], "id long, seq string, qual string"), ALFI)
    assert rows(hit.select("id", "tag", "tag_qual")) == [(1, tag, "F" * 32)]


@pytest.mark.parametrize("preset", [("MspJI", "CpG"), ("AspBHI", "CHG"), ("RlaI", "CHG")])
def test_motif_sites_and_fixed_reads(spark, preset):
    m = enzymes.motif(*preset)
    mirrored = enzymes.reverse_complement(m.motif)
    pats = [("+", re.compile(enzymes.motif_regex(m.motif)))] + ([("-", re.compile(enzymes.motif_regex(mirrored)))] if m.both and mirrored != m.motif else [])
    text, n = dna(5000), len(m.motif)

    def options(s, k):
        out = []
        for strand, p in pats:
            a, b = k - m.left, k + n + m.right
            if k >= 0 and p.fullmatch(s[k : k + n]) and a >= 0 and b <= len(s):
                out.append((rc(s[a:b]) if strand == "-" else s[a:b], strand, a))
        return out

    expected = [(1, o[2], o[1], o[0]) for k in range(len(text)) if (c := options(text, k)) and (o := min(c))]
    assert rows(D.motif_sites(spark.createDataFrame([(1, text)], "id long, seq string"), m, ["id"])) == sorted(expected, key=str)
    reads = [(i, dna(RNG.randint(25, 60))) for i in range(1500)]

    def fixed(s):
        stop = s.find("ACGTA")
        for ring in [[0], *[[-d, d] for d in range(1, m.shift + 1)]]:
            hits = [min(o) for off in ring if (o := [x for x in options(s, m.start - 1 + off) if stop < 0 or x[2] + m.length <= stop])]
            if hits:
                return ("matched", hits[0][0]) if len(hits) == 1 else ("ambiguous", None)
        return ("no_match", None)

    df = spark.createDataFrame([(i, s, s) for i, s in reads], "id long, seq string, qual string")
    got = {r["id"]: (r["status"], r["sequence"]) for r in D.fixed_motif_reads(df, m, ["id"], adapter="ACGTA").collect()}
    assert got == {i: fixed(s) for i, s in reads} and len({s for s, _ in got.values()}) >= 2


def test_two_scopes_of_uniqueness(spark):
    master = spark.createDataFrame(
        [("A", "p", "T1", 2), ("B", "p", "T1", 1), ("A", "p", "T2", 1), ("C", "q", "T2", 1), ("C", "q", "T3", 1)],
        "genome_id string, taxon string, tag string, copies long",
    )
    assert rows(R.unique_tags(master)) == [("T1", "B", "p", 1), ("T3", "C", "q", 1)]
    stats = {(r["genome_id"], r["genome_tags"], r["taxon_mean"]) for r in R.unique_stats(R.unique_tags(master, False), False).collect()}
    assert stats == {("A", 2, 1.5), ("B", 1, 1.5), ("C", 1, 1.0)}
    own, _ = P.sample_database(master, spark.createDataFrame([("s", "p")], "sample string, taxon string"))
    assert rows(own.select("tag", "genome_id")) == [("T1", "A"), ("T1", "B"), ("T2", "A")]


def test_profile_numbers(spark):
    own = "AAATTT"  # its own reverse complement: counts twice
    tags = spark.createDataFrame([("s", own), ("s", "AAACCC"), ("s", "GGGTTT")], "sample string, tag string")
    assert {(r["tag"], r["n"]) for r in P.tag_counts(tags).collect()} == {(own, 2), ("AAACCC", 2), ("GGGTTT", 2)}
    counts = spark.createDataFrame([("s", f"t{i}", n) for i, n in enumerate((3, 3, 2, 1))], "sample string, tag string, n long")
    unique = spark.createDataFrame([(f"t{i}", g, "p", 1) for i in range(4) for g in ("A", "B")], "tag string, genome_id string, taxon string, copies long")
    p = P.predict(P.profile(counts, unique, R.unique_stats(unique)), 6).collect()[0]
    assert (p["seq_tags"], p["seq_reads"], p["g_score"], p["pred"], p["theoretical"]) == (4, 9, 6.0, 1, 4.0)


def test_shares_host_and_wide(spark):
    df = spark.createDataFrame([("s", "host", 0.5), ("s", "a", 0.25), ("s", "b", 0.25), ("z", "a", 0.0), ("h", "host", 1.0), ("h", "a", 0.0)], "sample string, taxon string, abundance double")
    got = {(r["sample"], r["taxon"]): r["abundance"] for r in P.rescale_without_host(df, "host").collect()}
    assert got == {("s", "a"): 0.5, ("s", "b"): 0.5, ("z", "a"): 0.0, ("h", "a"): 0.0}
    shares = P.share_of_sample(df, "abundance").groupBy("sample").agg(F.sum("share")).collect()
    assert {r[0]: r[1] for r in shares} == {"s": 1.0, "z": None, "h": 1.0}
    wide = P.wide(df, "taxon", "sample", "abundance", ["s", "z"])
    assert rows(wide) == [("a", 0.25, 0.0), ("b", 0.25, 0.0), ("host", 0.5, 0.0)]
    assert P.long(wide, "taxon", "sample", "abundance").count() == 6
    parts = {(r["taxon"], r["part"]): r["share"] for r in P.split_groups(df.where("sample = 's'"), F.col("taxon") == "host", "abundance").collect()}
    assert parts == {("host", "micro"): 1.0, ("a", "macro"): 0.5, ("b", "macro"): 0.5}


def test_database_build_update_validate(spark, tmp_path):
    genomes = [(f"{i:08d}", "p" if i % 2 else "q", dna(4000)) for i in range(6)]
    df = spark.createDataFrame(genomes, "genome_id string, taxon string, seq string")
    R.build(df.where("genome_id < '00000004'"), CJEI, f"{tmp_path}/a")
    R.update(df.where("genome_id >= '00000004'"), CJEI, f"{tmp_path}/a", f"{tmp_path}/b")
    R.build(df, CJEI, f"{tmp_path}/c")
    for t in ("master_tags", "unique_tags", "unique_stats"):
        b, c = (spark.read.parquet(f"{tmp_path}/{x}/{t}") for x in "bc")
        assert rows(b.select(c.columns)) == rows(c) and c.count()
    with pytest.raises(ValueError):
        R.update(df.limit(1), CJEI, f"{tmp_path}/a", f"{tmp_path}/d")
    m, u = (spark.read.parquet(f"{tmp_path}/c/{t}") for t in ("master_tags", "unique_tags"))
    assert R.violations(m, u, CJEI).count() == 0
    assert {r["problem"] for r in R.violations(m.withColumn("copies", F.lit(2)), u, CJEI).collect()} == {"not in the master table"}


def test_all_enzymes_counted_like_the_digests(spark):
    import pyspark.sql.functions as f

    from tagloom.plans import tags

    df = tags.sequences(spark, "/root/testdata/sf0.001").where("doc_id <= 40").cache()
    counts = {e.name: df.select(f.sum(sum(f.size(S.overlapping(f.col("seq"), p)) for p in e.patterns))).first()[0] for e in enzymes.ENZYMES}
    assert counts == {e.name: D.digest(df, e).count() for e in enzymes.ENZYMES}


def test_cut_reads_cover_the_contig(spark):
    texts = {1: "ACGTACG", 2: "", 3: None, 4: "AC", 5: "ACG" * 20_000}
    df = spark.createDataFrame([(k, v, "x") for k, v in texts.items()], "id int, seq string, part string")
    rows = D.cut_reads(df, ["id"], 3).orderBy("id", "part").collect()
    for k, v in texts.items():
        assert [r["seq"] for r in rows if r["id"] == k] == [v[i : i + 3] for i in range(0, len(v or ""), 3)]
