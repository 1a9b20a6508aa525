"""Shape of the plans, of the registry and of the model operators."""

import random

import pytest

import __spark_entry__
from tagloom.operators import model
from tagloom.plans import files, omics, parsing, registry, tags

SF = "/root/testdata/sf0.001"
PYTHON_SCANS = {"lenient_files", "model_calls", "dedup_digest", "merged_pairs", "motif_sites_cpg", "motif_sites_chg", "site_copies", "site_totals"}
CHECKPOINTS = {n for m in (tags, omics, files) for n in m.QUERIES if n.startswith(("unique", "profile", "genomes_d", "quant", "abundance", "coverage", "host", "split_s", "subsp", "site", "hamming", "pileup", "mapping_totals", "geno", "good", "backbone", "enzyme"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - CHECKPOINTS))
def test_no_python_no_product_and_pruned_scans(spark, name):
    text = plan(registry.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON_SCANS:
        assert "InPandas" not in text and "InArrow" not in text and "BatchEvalPython" not in text
    if "documents.parquet" in text:
        assert "applicant_id" not in text and "pub_no" not in text


def test_registry():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 70
    assert all(n in queries for n in parsing.QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_forest_and_callable(spark):
    rng = random.Random(1)
    rows = [(f"s{i % 3}", f"t{i}", *(rng.gauss(i % 2 * 3, 1) for _ in range(4)), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "sample string, merged string, ln_coverage double, ln_g double, ln_depth double, ln_share double, truth int")
    fit = model.fit_forest(df.where("cast(substr(merged, 2) as int) < 200"), "truth", trees=10)
    held = model.predict_forest(fit, df.where("cast(substr(merged, 2) as int) >= 200"))
    assert held.where("pred = truth").count() >= 95
    own = model.predict_with(lambda x: (x["ln_g"] > 1.5).astype(float), df)
    assert own.count() == 300 and own.where("pred = truth").count() > 250
    members = df.selectExpr("sample", "merged", "concat(merged, '_A') as species")
    assert model.spread_to_subspecies(own, members).count() == 300
