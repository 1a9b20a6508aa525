import random

import pytest
from pyspark.sql import functions as F

from tagloom.functions import seq as S
from tagloom.operators import methyl as M
from tagloom.operators import refdb as R
from tagloom.operators import snp as G
from tagloom.operators.numbering import numbered


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    rows = [(rng.randint(0, 400), i) for i in range(1000)] + [(None, -1), (None, -2)]
    got = numbered(spark.createDataFrame(rows, "a int, b int").repartition(7), "a", "b", first=5).orderBy("no").collect()
    assert [r["no"] for r in got] == list(range(5, 1007))
    assert [(r["a"], r["b"]) for r in got] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert numbered(spark.createDataFrame([], "a int"), "a").count() == 0


def test_names_and_keys(spark):
    r = spark.createDataFrame([("runs/w1/LB_R1.fastq.gz", " Soil 7/ä ", 12, 12345)], "p string, t string, g long, c long").select(
        S.plain_file_name(F.col("p")), S.safe_name(F.col("t")), S.tag_key(F.col("g"), F.col("c")).alias("k"), S.site_name(F.col("g")).alias("s")
    ).withColumns({"g": S.key_genome(F.col("k")), "c": S.key_copies(F.col("k")), "n": S.site_number(F.col("s")), "x": S.site_number(F.lit("site"))}).first()
    assert tuple(r) == ("LB_R1", "Soil_7", "0000001212345", "site000000012", 12, 12345, 12, None)


def test_checks(spark):
    stats = spark.createDataFrame([("g", "p", 2, 2.0)], "genome_id string, taxon string, genome_tags long, taxon_mean double")
    tags = lambda n: spark.createDataFrame([(f"t{i}", "g", "p", 1) for i in range(n)], "tag string, genome_id string, taxon string, copies long")
    assert R.stats_mismatches(stats, tags(2)).count() == 0 and R.stats_mismatches(stats, tags(3)).count() == 1
    with pytest.raises(ValueError):
        G.checked_references(spark.createDataFrame([("ACG",), ("AC",)], "tag string"))
    with pytest.raises(Exception, match="not ACGT"):
        G.checked_references(spark.createDataFrame([("ANG",)], "tag string")).collect()
    M.same_structure({"motif": "A"}, {"motif": "A", "other": 1})
    with pytest.raises(ValueError):
        M.same_structure({"motif": "A"}, {"motif": "C"})
