import random
import unicodedata
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import lookalike

PLAIN = lookalike.Canonicalizer()
FULL = lookalike.Canonicalizer({"blade": 9, "Blade": 3, "bladé": 2, "rotor": 5, "été": 4})

SAME = [
    ("ｂｌａｄｅ", "blade"), ("b​la­de﻿", "blade"), ("blаdе", "blade"), ("bladé", "bladé"),
    ("a\xa0b　c", "a b c"), ("a‑b－c", "a-b-c"), ("Å K Ω \xb5m", "Å K Ω μm"), ("rοtοr", "rotor"),
    ("ﾊﾞ", "バ"), ("е́", "é"), ("x" * 100_000 + "é", "x" * 100_000 + "é"),
]
OTHER = [("blade", "Blade"), ("é", "e"), ("2", "²"), ("1", "①"), ("½", "1/2"), ("a,b", "a;b"), ("−", "-"), ("a b", "ab"), ("—", "-"), ("ρ", "p")]


def test_equal_and_different_forms():
    for make in (PLAIN, FULL):
        assert all(make(a) == make(b) for a, b in SAME)
        assert all(make(a) != make(b) for a, b in OTHER)
        assert make("") == ""


def test_trie_and_budget():
    assert FULL.by_trie("ｂlаde") == "blade" and FULL.by_trie("blades") is None
    assert FULL.by_trie("étе́") == "été"
    loose = lookalike.Canonicalizer({"blade": 9, "rotor": 5}, budget=1)
    assert [loose.by_trie(w) for w in ("blаdee", "blаdx", "rotr", "xx")] == ["blade", "blade", "rotor", None]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abelo éｅеοаd́​\xa0-1²,\n漢", max_size=40))
def test_trie_never_changes_the_result(text):
    once = FULL(text)
    assert once == PLAIN.by_table(text) == FULL(once)
    assert unicodedata.is_normalized("NFC", once)


MANY = lookalike.Canonicalizer({
    "Москва": 50, "Mосква": 60, "оса": 7, "oca": 2, "sea": 9, "ѕеа": 3, "λόγος": 4, "blade": 9, "Вблизи": 1, "Ваня": 3, "տուս": 2, "voxel": 0,
})


def test_trie_decides_the_spelling():
    # genuine words of other scripts stay what they are, however they were written
    for word, written in (("Москва", "Mocквa"), ("Москва", "Mо\u200bскв\u0430"), ("λόγος", "λόγoς"), ("Ваня", "Bаня"), ("տուս", "տուu")):
        assert MANY(word) == MANY(written) == word
    assert PLAIN("Москва") == "Mocквa" and PLAIN("λόγος") == "λóγoς"
    # several candidates in the state set: the most frequent spelling wins, for Latin letters too
    assert MANY("oca") == MANY("оcа") == "оса" and MANY("an oca.") == "an оса." and MANY("ѕеа") == MANY("sеa") == "sea"
    assert MANY("ocas") == "ocas" and MANY("Oca") == "Oca"
    # no spelling reached: the table
    assert MANY("Варна") == PLAIN("Варна") and MANY("о") == "o"


def test_spellings_are_of_one_script():
    good, bad = ("ab", "été", "Москва", "λόγος", "漢字", "ガラス"), ("a", "Mocквa", "blаde", "ｂｌ", "e\u0301t", "a\u200bb", "x²", "ab1", "µm", "ɡood", "Ⅰa", "a" * 41)
    assert all(map(lookalike.is_spelling, good)) and not any(map(lookalike.is_spelling, bad))


def test_words_end_where_their_look_alikes_do():
    words = PLAIN.words
    inside = lambda c: words.fullmatch("x" + c) is not None
    assert not [hex(k) for k, v in lookalike.equivalence_table().items() if v and inside(chr(k)) != all(map(inside, v))]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="осаoca sеМMквλΔ∆бéе\u0301ｅ\u200b\xa0-1²,ﾊﾞバ゙\n", max_size=30), st.text(alphabet="осаoca М\u200b", max_size=6))
def test_equal_for_the_trie_is_equal_for_the_table(text, more):
    form = MANY(text + more)
    assert lookalike.fold(form) == lookalike.fold(text + more)  # a form looks like its text
    assert form == MANY(lookalike.fold(text + more)) == MANY(form)  # and depends on nothing but its looks


def test_classes(spark):
    rows = [(1, "blade"), (2, "blаde"), (3, "blade"), (4, "ｂlade"), (5, "rotor"), (6, "rotor"), (7, ""), (8, None), (None, "blade"), (3, "blade"), (9, "Blade")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, links int, class int")
    got = sorted(map(tuple, lookalike.same_looking_classes(df).collect()))
    assert got == [(1, 1, 3, 2), (2, 1, 3, 3), (3, 1, 3, 2), (4, 1, 3, 3), (5, 5, 1, 0), (6, 5, 1, 0), (9, 9, 1, 0)]
    assert sum(r[3] for r in got) == 2 * lookalike.same_looking_pairs(df).count()
    assert lookalike.same_looking_classes(df.limit(0)).count() == 0


def test_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    swaps = {"a": "аａ", "e": "еｅ", " ": "\xa0 ", "o": "оο", "-": "‑"}
    base = ["the blade - rotor", "The blade - rotor", "été a", "123 a", "x"]
    texts = []
    for b in base:
        texts += [b, b] + ["".join(rng.choice(swaps.get(c, c)) if rng.random() < 0.4 else c for c in b) for _ in range(4)]
    rows = [(i, t, "c", 1) for i, t in enumerate(texts)] + [(100, None, "c", 1), (101, "", "c", 1), (102, "", "c", 1), (None, "blаde", "c", 1), (0, base[0], "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, raw int")
    use = {(i, t) for i, t, _, _ in rows if i is not None and t}
    expected = {
        (min(a, b), max(a, b)) for (a, x), (b, y) in combinations(use, 2) if a != b and x != y and PLAIN.by_table(x) == PLAIN.by_table(y)
    }
    got = [tuple(r) for r in lookalike.same_looking_pairs(df).collect()]
    assert sorted(got) == sorted(expected) and len(got) > 20
    assert lookalike.same_looking_pairs(df.limit(0)).count() == 0
    forms = lookalike.canonical_texts(df, {}).collect()
    assert len(forms) == len(rows) and [r["canonical"] for r in forms if r["doc_id"] in (100, 101)] == [None, ""]
    assert lookalike.count_spellings(df, size=2) == {"blade": sum("blade" in t for _, t, _, _ in rows if t), "rotor": sum("rotor" in t for _, t, _, _ in rows if t)}


def test_spellings_are_the_most_frequent(spark):
    df = spark.range(3000).selectExpr("id", "repeat(concat('w', translate(cast(id as string), '0123456789', 'abcdefghij'), ' '), cast(id % 7 + 1 as int)) as text")
    got = lookalike.count_spellings(df, size=300)
    counts = {f"w{str(i).translate(str.maketrans('0123456789', 'abcdefghij'))}": i % 7 + 1 for i in range(3000)}
    assert got == dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:300])


def test_many_equal_copies_of_one_writing(spark):
    df = spark.range(4001).selectExpr("id as doc_id", "if(id = 2000, 'bl\u0430de', 'blade') as text")
    got = {tuple(r) for r in lookalike.same_looking_pairs(df).collect()}
    assert got == {tuple(sorted((2000, i))) for i in range(4001) if i != 2000}
