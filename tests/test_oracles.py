"""Queries against their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tagloom.plans import registry

SF = "/root/testdata/sf0.001"
#: the SQL of these names all samples of the given tables, which the smallest ones don't hold
WIDE = {"abundance_wide": "/root/testdata/sf0.01", "site_matrix": "/root/testdata/sf0.01", "genotype_lines": "/root/testdata/sf0.01"}
NAMES = (
    "p1_found", "p1_rejects", "p1_loaded", "digest_hin4i", "digest_all_counts", "profile_gscore", "abundance_wide", "plain_scan", "first_hit", "stats_recount",
    "merged_pairs", "fixed_motif_reads", "site_matrix", "hamming_best", "genotype_lines", "site_quality", "rna_dna", "harmonised", "unmatched_samples",
    "fastq_files", "digest_files", "genome_files", "matrix_files", "kraken_files", "quant_files", "site_files", "database_numbers", "database_totals", "model_calls",
)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: (float(f"{x:.9g}") if not math.isnan(x) else None) if isinstance(x, float) else x
    return sorted(columns), sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, query, sql, folder):
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"create view {f.split('.')[0]} as select * from '{folder}/{f}'")
    df, out = query(spark, folder), con.execute(sql)
    got = normal([tuple(r) for r in df.collect()], df.columns)
    assert got == normal(out.fetchall(), [d[0] for d in out.description])


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    compare(spark, registry.QUERIES[name], registry.ORACLES[name], WIDE.get(name, SF))


def test_every_core_query_but_one_has_sql():
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"forest_calls"}
