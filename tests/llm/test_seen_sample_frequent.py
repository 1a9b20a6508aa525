import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions.seq import canonical_read_id
from tagloom.llm import frequent, sample, seen


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**28 - 1), max_size=200), st.sets(st.integers(0, 2**28 - 1), max_size=200))
def test_quotient_filter_round_trip_and_merge(a, b):
    make = lambda s: seen.QuotientFilter.of_sorted(np.array(sorted(s), dtype=np.uint64), 12, 2)
    assert make(a).fingerprints().tolist() == sorted(a)
    both = make(a).merge(make(b))
    assert both.fingerprints().tolist() == sorted(a | b) and both.remainders.nbytes == 2 * len(a | b)
    assert make(a).merge(make(b), 64).fingerprints().tolist() == sorted(a | b)
    probe = np.array(sorted(b) + [2**28 - 1], dtype=np.uint64)
    assert make(a).contains(probe).tolist() == [int(x) in a for x in probe]


def test_search_and_merge_stay_packed():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**44, 1_000_000).astype(np.uint64))
    some = seen.QuotientFilter.of_sorted(keys[::2], 20, 3)
    assert some.nbytes() < 3.6 * some.n
    assert some.contains(keys).tolist() == [i % 2 == 0 for i in range(len(keys))]
    crowded = seen.QuotientFilter.of_sorted(np.arange(0, 3000, 3, dtype=np.uint64), 4, 1)
    assert crowded.contains(np.arange(3000, dtype=np.uint64)).tolist() == [i % 3 == 0 for i in range(3000)]
    tracemalloc.start()
    some.contains(keys[:1000])
    assert tracemalloc.get_traced_memory()[1] < 3 * some.n  # directories of the bitmaps; unpacked numbers would take 8 bytes each and more
    tracemalloc.stop()


def test_fold_holds_one_epoch_at_a_time():
    fold, rng, earlier = seen._Fold(12, 2), np.random.default_rng(5), set()
    for epoch in range(6):
        fps = np.unique(rng.integers(0, 2**28, 500).astype(np.uint64))
        fps = np.union1d(fps, np.array(sorted(earlier)[::7], dtype=np.uint64))
        got = np.concatenate([fold.part(("a", 0), epoch, part) for part in np.array_split(fps, 4)])
        assert got.tolist() == [int(x) not in earlier for x in fps]
        assert sum(map(len, fold.arrived)) == got.sum() and fold.filter.n == len(earlier)
        earlier |= set(fps.tolist())
    assert fold.part(("a", 1), 0, fps).all()


def test_canonical_read_id(spark):
    cases = {
        " @>id/1 x": "id", "id/1/2": "id/1", "\t@ id": "id", "ID": "ID", "id/3": "id/3", "id.1": "id.1",
        None: None, "": None, "  ": None, "@": None, "/1": None, " id　x": "id",
    }
    df = spark.createDataFrame([(k,) for k in cases], "id string")
    got = [r[0] for r in df.select(canonical_read_id(F.col("id"))).collect()]
    assert got == list(cases.values())


@pytest.mark.parametrize("epochs,keys", [(1, 40), (3, 40), (50, 40), (3, 10**6)])
def test_seen_before_equals_brute_force(spark, epochs, keys, monkeypatch):
    monkeypatch.setattr(seen, "SLICE_KEYS", keys)
    rng = np.random.default_rng(1)
    rows = [(int(i), "hot" if rng.random() < 0.3 else f"k{rng.integers(150)}", "x") for i in rng.permutation(500)]
    rows += [(None, "hot", "x"), (600, None, "x"), (601, "tie", "x"), (601, "tie", "x"), (601, "hot", "x")]
    df = spark.createDataFrame(rows, "n long, k string, side string")
    arrivals = seen.arrivals(df, "a", "n", F.col("k")).unionByName(seen.arrivals(df.where("n < 100"), "b", "n", F.col("k")))
    expected = []
    for side, limit in (("a", 10**6), ("b", 100)):
        use = [(n, k) for n, k, _ in rows if n is not None and k is not None and n < limit]
        first = {}
        for n, k in use:
            first[k] = min(n, first.get(k, n))
        expected += [(side, n) for n, k in use if n > first[k]]
    assert sorted(map(tuple, seen.seen_before(arrivals, epochs).collect())) == sorted(expected)


def test_seen_before_empty_and_error_rates(spark):
    df = spark.createDataFrame([], "n long, k string")
    assert seen.seen_before(seen.arrivals(df, "a", "n", F.col("k"))).count() == 0
    keys = spark.range(20000).select(F.col("id").alias("n"), F.col("id").cast("string").alias("k"))
    rates = {r["bits"]: r for r in seen.error_rates(seen.arrivals(keys, "a", "n", F.col("k")), (20, 64)).collect()}
    assert rates[64]["wrong_measured"] == 0 and rates[20]["keys"] == 20000
    assert abs(rates[20]["wrong_measured"] - rates[20]["wrong_expected"]) < 60


def test_sample_is_uniform_over_places_and_shards(spark):
    df = spark.range(0, 3000, 1, 3).select("id", F.lit(None).cast("string").alias("rec"), F.lit(1).alias("shard"))
    hits = np.zeros(3000)
    for seed in range(30):
        ids = [r["id"] for r in sample.uniform_sample(df, 300, seed, buffer_rows=37).collect()]
        assert len(ids) == 300 == len(set(ids))
        hits[ids] += 1
    assert 0.85 < hits.var() / (3 * 0.9) < 1.15
    assert all(abs(h.sum() - 3000) < 330 for h in np.split(hits, 3))


def test_sample_of_uneven_shards_small_and_empty_inputs(spark):
    df = spark.range(0, 900, 1, 1).union(spark.range(900, 1000, 1, 1))
    small = 0
    for seed in range(40):
        ids = [r["id"] for r in sample.uniform_sample(df, 150, seed, buffer_rows=20).collect()]
        assert len(set(ids)) == 150
        small += sum(i >= 900 for i in ids)
    assert abs(small - 600) < 100
    assert sample.uniform_sample(df, 5000).count() == 1000
    assert sample.uniform_sample(df.where("id < 0"), 10).count() == 0
    assert sample.uniform_sample(df.union(df), 2000).count() == 2000
    with pytest.raises(ValueError):
        sample.uniform_sample(df, 0)


def test_quotas_are_hypergeometric_for_any_population():
    rng = np.random.default_rng(1)
    for populations, size in (([10**12, 3 * 10**12, 0, 5], 1000), ([2**61, 2**61, 2**61], 300), ([30, 10, 60], 40), ([30, 10, 60], 90), ([5, 6], 50), ([7], 3)):
        drawn = np.array([sample.shard_quotas(populations, size, rng) for _ in range(2000)])
        total = sum(populations)
        n = min(size, total)
        assert (drawn.sum(axis=1) == n).all() and (drawn >= 0).all() and (drawn <= np.array(populations, dtype=float)).all()
        share = np.array([p / total for p in populations])
        spread = n * share * (1 - share) * ((total - n) / max(total - 1, 1))
        assert (np.abs(drawn.mean(axis=0) - n * share) <= 5 * np.sqrt(spread / 2000) + 1e-3).all()
        wide = spread > 5
        assert (np.abs(drawn.var(axis=0)[wide] / spread[wide] - 1) < 0.2).all()
    assert sample.shard_quotas([], 5, rng) == [] and sample.shard_quotas([0, 0], 5, rng) == [0, 0]


def test_frequent_values_ties_nulls_and_empty(spark):
    rows = [("a",)] * 4 + [("A",)] + [("b",)] * 2 + [("c",)] * 2 + [(None,)]
    df = spark.createDataFrame(rows, "n string")
    top = frequent.most_frequent(df, F.upper("n"), 2, "v").collect()
    assert [tuple(r) for r in top] == [("A", 5), ("B", 2)]
    heavy = frequent.heavy_hitters(df, F.upper("n"), 5, "v").collect()
    assert sorted(tuple(r) for r in heavy) == [("A", 5, 10), ("B", 2, 10), ("C", 2, 10)]
    assert frequent.heavy_hitters(df.limit(0), F.col("n"), 5).count() == 0
