import os
import random
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import leak


def longest(doc, item):
    """Brute force: length of the longest common run of words."""
    best, last = 0, [0] * (len(item) + 1)
    for x in doc:
        row = [0] * (len(item) + 1)
        for j, y in enumerate(item):
            row[j + 1] = last[j] + 1 if x == y else 0
        best, last = max(best, *row), row
    return best


def all_matches(doc, item, least):
    """Brute force: (place, length, item word) of the longest match of each document place, where it is long enough."""
    out = []
    for p in range(len(doc)):
        best = max(((n, -j) for j in range(len(item)) for n in [next((k for k in range(min(len(doc) - p, len(item) - j)) if doc[p + k] != item[j + k]), min(len(doc) - p, len(item) - j))]), default=(0, 0))
        if best[0] >= least:
            out.append((p, best[0], -best[1]))
    return out


def passages(matches):
    """Brute force: [first, end, longest] of overlapping matches."""
    out = []
    for p, n, _ in matches:
        if out and p < out[-1][1]:
            out[-1][1:] = [max(out[-1][1], p + n), max(out[-1][2], n)]
        else:
            out.append([p, p + n, n])
    return [tuple(x) for x in out]


def shard_of(docs, known):
    parts = [np.array([known.number.get(w, 0) for w in d] + [0], np.int32) for d in docs]
    return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcx"), max_size=30), min_size=1, max_size=6), st.lists(st.lists(st.sampled_from("abc"), max_size=20), max_size=4))
def test_shard_matches_equal_brute_force(docs, items):
    known = leak.Items([(i, " ".join(w)) for i, w in enumerate(items)], min_words=4)
    words, starts = shard_of(docs, known)
    got = {}
    for item, place, end, n, at, item_word in leak.shard_matches(words, known).itertuples(index=False):
        d = int(np.searchsorted(starts, place, side="right")) - 1
        got.setdefault((d, item), []).append((place - starts[d], end - starts[d], n))
        assert docs[d][at - starts[d] :][:n] == items[item][item_word:][:n] and place <= at and at + n <= end
    expected = {(d, i): p for d, x in enumerate(docs) for i, y in enumerate(items) if (p := passages(all_matches(x, y, 4)))}
    assert got == expected
    assert {k: max(n for _, _, n in v) for k, v in got.items()} == {(d, i): n for d, x in enumerate(docs) for i, y in enumerate(items) if (n := longest(x, y)) >= 4}


def test_suffix_array_is_in_full_order():
    rng = np.random.default_rng(1)
    for top, size in ((4, 3000), (2, 400)):
        words = rng.integers(0, top, size).astype(np.int32)
        array = leak.SuffixArray(words, 5, size)
        runs = ["".join(map(chr, words[s:])).split("\0")[0] for s in array.starts]
        assert runs == sorted(runs) and len(runs) == sum((words[i : i + 5] != 0).all() for i in range(size - 4))
        common = [len(os.path.commonprefix([a, b])) for a, b in zip(runs, runs[1:])]
        assert array.agreement()[1:].tolist() == common


def test_hot_passage_takes_bounded_memory():
    known = leak.Items([(1, "0 " * 400), (2, "a b " * 20 + "0 " * 200)])
    words = np.append(np.full(500_000, known.number["0"], np.int32), 0)
    tracemalloc.start()
    got = leak.shard_matches(words, known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [tuple(r) for r in got.itertuples(index=False)] == [(1, 0, 500_000, 400, 0, 0), (2, 0, 500_000, 200, 0, 40)]
    assert peak < 500_000 * 250  # so a whole shard takes about half a gigabyte


def test_items_in_blocks(spark):
    rng = random.Random(6)
    items = {i: [f"w{rng.randrange(10**6)}" for _ in range(20)] for i in range(12)}
    docs = spark.createDataFrame([(i, "x " + " ".join(w) + " y " + " ".join(w[:14])) for i, w in items.items()], "doc_id long, text string")
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = sorted(map(tuple, leak.find_leaks(docs, df, block_chars=400).collect()))
    assert got == sorted(map(tuple, leak.find_leaks(docs, df).collect())) == sorted(x for i in items for x in ((i, i, 1, 21, 20, 1, 0), (i, i, 22, 36, 14, 22, 0)))


def test_find_leaks(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    items = {i: [word() for _ in range(30)] for i in range(5)}
    noise = lambda n: " ".join(word() for _ in range(n))
    passage = items[0][3:17]
    docs = [
        (1, f"{noise(40)} {' '.join(passage)} {noise(9)}"),
        (2, f"{noise(5)} {' '.join(items[1][:12])} {noise(5)}"),  # one word short
        (3, f"{noise(5)}\r\n{'-'.join(items[1][:13]).upper()}; {noise(5)}"),
        (4, " ".join("".join({"a": "а", "e": "ｅ"}.get(c, c) for c in w) for w in passage)),
        (5, " ".join(items[2] + items[3])), (6, None), (7, ""), (8, noise(20000) + " " + " ".join(items[4])),
        (9, " ".join(passage[:7]) + " x " + " ".join(passage[7:])), (1, " ".join(items[0])), (None, " ".join(items[2])),
    ]
    d = spark.createDataFrame([(i, t, 7, 8) for i, t in docs], "doc_id long, text string, item_id int, n_words int")
    b = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(9, None), (10, ""), (11, "too short"), (0, " ".join(items[0]))], "item_id long, text string")
    for shard in (30, leak.SHARD_WORDS):
        found = leak.find_leaks(d, b, shard_words=shard)
        got = sorted(((r["doc_id"], r["item_id"], r["n_words"], r["item_word"]) for r in found.collect()), key=str)
        assert got == sorted([(1, 0, 14, 3), (1, 0, 30, 0), (3, 1, 13, 0), (4, 0, 14, 3), (5, 2, 30, 0), (5, 3, 30, 0), (8, 4, 30, 0), (None, 2, 30, 0)], key=str)
    kept = sorted(r["doc_id"] for r in leak.without_leaks(d, leak.find_leaks(d, b)).collect())
    assert kept == [2, 6, 7, 9]
    assert leak.find_leaks(d.limit(0), b).count() == 0 and leak.find_leaks(d, b.limit(0)).count() == 0
