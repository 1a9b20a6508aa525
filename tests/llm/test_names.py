import random

import pytest

from tagloom.llm import names

LIST = ["Thalocola_salinarius", "Thalocola_flavatica", "Galocola_montarius", "Galocola_montbrius", "Xantalubacter_montensis", "Gravicola_nivarius", "Gravicola_rubarius", "Thalocola_urbarius"]
TYPED = {
    "Thalocola_salinarius": "Thalocola_salinarius",
    "  THALOCOLA   salinarius ": "Thalocola_salinarius",
    "Thálöcola\xa0salinarius": "Thalocola_salinarius",
    "ThalocolaSalinarius": "Thalocola_salinarius",
    "salinarius (Thalocola)": "Thalocola_salinarius",
    "k__Protozoa|g__Thalocola|s__salinarius": "Thalocola_salinarius",
    "Candidatus Thalocola cf. salinarius str. X20 [RNA]": "Thalocola_salinarius",
    "T. salinarius": "Thalocola_salinarius",
    "Xant. montensis": "Xantalubacter_montensis",
    "Xantalubactre ontensis": "Xantalubacter_montensis",
    "Thalocol asalinarius": "Thalocola_salinarius",
    "galocola montbrius": "Galocola_montbrius",
    "Galocola montarius": "Galocola_montarius",
    "Galocola flavatica": None,  # genus and epithet listed, not together
    "Galocola flavtica": None,  # nearest to that unlisted combination, none of the list near
    "Gravicola urbarius": "Gravicola_rubarius",  # one swap of neighbours from a listed name: a slip, though it is written like another one
    "Gravicola urbraius": "Gravicola_rubarius",  # misspelt, so the unlisted combination doesn't stand in the way
    "Xantalubactre bacterium ontensis": "Xantalubacter_montensis",  # similar words needn't be neighbours
    "salinraius isolate of Thalcola": "Thalocola_salinarius",
    "Thalocola": None, "uncultured Thalocola": None, "Thalocola sp. 7": None,
    "unknown": None, "": None, "   ": None, "-": None, "海": None,
    "G. flavatica": None, "Thalocola kwarziphila": None,
}


def test_matcher():
    m = names.NameMatcher(LIST)
    assert {k: m.match(k)[0] for k in TYPED} == TYPED
    assert names.NameMatcher([]).match("Thalocola salinarius") == (None, None)
    assert m.match("x " * 20000 + "Thalocola salinarius")[0] == "Thalocola_salinarius"


def test_edits_equal_brute_force():
    def slow(a, b):
        d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
                if i and j and x == b[j - 1] and a[i - 1] == y:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a) - 1, len(b) - 1]

    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 7))) for _ in range(2))
        assert names.edits(a, b, 3) == min(slow(a, b), 4)


def test_index_equals_scan():
    rng = random.Random(4)
    vocabulary = {"".join(rng.choices("abc", k=rng.randint(1, 11))) for _ in range(300)}
    index = names.WordIndex(vocabulary)
    for _ in range(200):
        word = "".join(rng.choices("abc", k=rng.randint(4, 11)))
        assert index.near(word) == {w: d for w in vocabulary if (d := names.edits(word, w, 3)) <= 3}
    assert index.near("ab") == ({"ab": 0} if "ab" in vocabulary else {})
    assert names.WordIndex([]).near("abcd") == {}


def test_one_swap():
    assert names.one_swap("urbi", "rubi") and not names.one_swap("rubi", "rubi") and not names.one_swap("abc", "cba") and not names.one_swap("ab", "a")


def test_rows(spark):
    rows = [(i, k, "c", "t") for i, k in enumerate(TYPED)] + [(90, None, "c", "t"), (91, "T. salinarius", "c", "t"), (91, "T. salinarius", "c", "t")]
    df = spark.createDataFrame(rows, "entry_id long, species string, canonical string, typed string")
    genomes = spark.createDataFrame([(n,) for n in [*LIST, LIST[0], None, "", "NA", "N/A", "-"]], "species string")
    listed = names.reference_names(genomes)
    assert listed == sorted(LIST)
    got = sorted(map(tuple, names.map_rows(df, listed, "entry_id").collect()))
    expected = [(i, v) for i, v in enumerate(TYPED.values()) if v] + [(91, "Thalocola_salinarius")] * 2
    assert got == sorted(expected)
    left = {r["typed"]: r["n"] for r in names.unmatched(df, listed).collect()}
    assert left == {k: 1 for k, v in TYPED.items() if not v and k.strip()} | {None: 3}
    assert names.map_rows(df.limit(0), listed, "entry_id").count() == 0
    assert names.map_rows(df, [], "entry_id").count() == 0


def test_bound_of_the_list(spark, monkeypatch):
    monkeypatch.setattr(names, "MAX_NAMES", 3)
    with pytest.raises(ValueError):
        names.reference_names(spark.createDataFrame([(f"A_b{c}",) for c in "cdefg"], "species string"))
