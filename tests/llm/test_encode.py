import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tagloom.llm import encode

ENC, TOKEN = encode.load(open(encode.DEFAULT_RANKS, "rb").read())
PIECES = ["the ", "don't", "'", "'s", "'ll", "l", " ", "  ", "\n", "\t", "!!", "é", "漢字", "123", "abcdefgh", "　", "\xa0", "😀", "we're", "aaaa", "=" * 9, "x" * 40]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60), st.integers(1, 30))
def test_tree_equals_direct_encoding(pieces, size):
    text = "".join(pieces)
    parts = [ENC.encode_ordinary(t) for t in encode._blocks(text, size)]
    assert encode.join_tree(parts, ENC, TOKEN) == ENC.encode_ordinary(text)


@pytest.mark.parametrize("alphabet", ["ACGT", "ab", "aé漢", "=-", " \n", "'sl"])
def test_long_unsplit_text(alphabet):
    rng = random.Random(alphabet)
    text = "".join(rng.choices(alphabet, k=6000)) + "a" * 3000
    for size in (97, 1000, 2500):
        parts = [ENC.encode_ordinary(t) for t in encode._blocks(text, size)]
        assert encode.join_tree(parts, ENC, TOKEN) == ENC.encode_ordinary(text)


def test_corpus(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(encode.DEFAULT_RANKS.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    rng = random.Random(3)
    texts = [None, "", " ", "<|endoftext|> don't", "x" * 20, "word " * 5000, "ACGT" * 20000, "".join(rng.choices("ab cé漢\n'", k=9000))]
    rows = [(i, t, [1], "no") for i, t in enumerate(texts)] + [(1, "again", [1], "no"), (None, "word " * 300, [1], "no")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>, no string")
    got = sorted(((r["doc_id"], r["ids"]) for r in encode.encode_corpus(df, block_chars=100).collect()), key=str)
    expected = sorted(((i, other.encode(t, add_special_tokens=False).ids if t else []) for i, t, _, _ in rows), key=str)
    assert got == expected
    assert encode.encode_corpus(df.limit(0)).count() == 0
