"""Visually identical text with different characters: one canonical form (problem 8).

Words of a text are read by a weighted edit automaton over a trie of spellings: reading a look-alike
of an edge's letter or a character that nobody sees costs nothing, every visible edit costs one, and
with the default budget of none only spellings that look the same are reached. The automaton holds
all of them at once, in whatever script they are written, and the most frequent one is the canonical
spelling: a Cyrillic word stays Cyrillic, and a Latin one with Cyrillic letters in it becomes Latin.
The trie holds the most frequent spellings in one script, counted over every text; its size is a
parameter, so what each task holds never grows with the data. Words that reach no spelling, and
everything between words, are normalised by the table of the same equivalences.

What looks the same reaches the same spellings, and a spelling is only reached by what looks like
it. So texts get one form if and only if the table makes them equal, whatever the trie holds; the
trie decides how that form is written.

The form keeps what can be seen: letter case, accents, digits, punctuation, raised or circled
digits, fractions.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import checkpointed

VOCABULARY = 50_000

# Letters of other scripts that look like Latin ones (Greek, Cyrillic, Armenian, letter-like
# Roman numerals), and signs that look like others, in the order of the target.
LOOK_ALIKES = {
    "A": "ΑА", "B": "ΒВ", "C": "СϹⅭ", "D": "Ⅾ", "E": "ΕЕ", "H": "ΗН", "I": "ΙІӀⅠ", "J": "ЈͿ", "K": "ΚК", "L": "Ⅼ", "M": "ΜМⅯ",
    "N": "Ν", "O": "ΟОՕ", "P": "ΡР", "Q": "Ԛ", "S": "ЅՏ", "T": "ΤТ", "V": "ѴⅤ", "W": "Ԝ", "X": "ΧХⅩ", "Y": "ΥҮ", "Z": "Ζ",
    "a": "а", "c": "сϲⅽ", "d": "ԁⅾ", "e": "е", "g": "ɡց", "h": "һհ", "i": "іⅰ", "j": "јϳ", "l": "ӏⅼ", "m": "ⅿ", "o": "οоօ",
    "p": "р", "q": "ԛզ", "s": "ѕ", "u": "ս", "v": "νѵⅴ", "w": "ԝ", "x": "хⅹ", "y": "у", "μ": "µ",
    "Δ": "∆", "·": "⋅∙", ":": "∶", "*": "∗", "/": "∕", "|": "∣", "~": "∼",
}
HYPHENS = "‐‑﹣－"
# Ranges of the characters that Unicode calls default ignorable.
INVISIBLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)


@cache
def equivalence_table() -> dict[int, str]:
    """Code point -> what it is brought to, after canonical decomposition ('' where nothing is seen)."""
    table: dict[int, str] = {}
    for c in map(chr, range(0x80, 0x10000)):  # other planes have no wide, narrow or space characters
        kind, _, rest = unicodedata.decomposition(c).partition(" ")
        if kind in ("<wide>", "<narrow>"):
            table[ord(c)] = unicodedata.normalize("NFD", "".join(chr(int(x, 16)) for x in rest.split()))
        elif unicodedata.category(c) == "Zs":
            table[ord(c)] = " "
    table |= {ord(c): "-" for c in HYPHENS} | {ord(c): k for k, v in LOOK_ALIKES.items() for c in v}
    table |= {x: "" for low, high in INVISIBLE for x in range(low, high + 1)}
    return {k: "".join(table.get(ord(c), c) for c in v) for k, v in table.items()}


_GAPS = re.compile(r"([ \t\n\r]+)")
_ASCII_WORDS = re.compile("[A-Za-z]+")
#: scripts with look-alikes in each other; a spelling doesn't mix them
_CONFUSABLE = {"LATIN", "GREEK", "CYRILLIC", "ARMENIAN"}
LONGEST = 40


@cache
def _script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ", 1)[0]


def fold(text: str) -> str:
    """The table's form of a text."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(equivalence_table()))


def is_spelling(word: str) -> bool:
    """Whether a word can be canonical: composed letters of one script, none of them wide, narrow, hidden or a sign."""
    if not (2 <= len(word) <= LONGEST and word.isalpha()):
        return False
    if word.isascii():
        return True
    scripts = {x for c in word if (x := _script(c)) in _CONFUSABLE}
    if len(scripts) > 1 or unicodedata.normalize("NFC", word) != word:
        return False
    table = equivalence_table()
    return all(ord(c) not in table or _script(c) in scripts - {"LATIN"} for c in unicodedata.normalize("NFD", word))


class Canonicalizer:
    """Brings texts to the canonical form; ``spellings`` with counts fill the trie."""

    def __init__(self, spellings: dict[str, int] | None = None, budget: int = 0):
        self.table, self.budget = equivalence_table(), budget
        spaces = "".join(chr(k) for k, v in self.table.items() if v == " ")
        self._spaces = re.compile(f"[{spaces}]")
        hidden = "".join(f"{chr(a)}-{chr(b)}" for a, b in INVISIBLE)
        # a character is part of a word exactly where what it looks like is
        self.words = re.compile(rf"((?:[^\W\d_]|∆)(?:[^\W\d_]+|[∆\u0300-\u036f\u3099\u309a{hidden}]+)*)")
        #: letters that look like a letter of the table's form, itself first
        self.alike = {k: (k, *v) for k, v in LOOK_ALIKES.items()}
        self.trie: dict = {}
        #: Latin-looking words whose canonical spelling is another one
        self.turned: dict[str, str] = {}
        for word, n in (spellings or {}).items():
            if not is_spelling(word):
                continue
            node = self.trie
            for c in unicodedata.normalize("NFD", word):
                node = node.setdefault(c, {})
            node[""] = (n, word)
            if not word.isascii() and (seen := fold(word)).isascii():
                best = min((-n, word), (-(spellings.get(x := self.turned.get(seen, seen), 0)), x))[1]
                if best != seen:
                    self.turned[seen] = best
        self._known: dict[str, str] = {}

    def by_table(self, text: str) -> str:
        return fold(text)

    def by_trie(self, word: str) -> str | None:
        """The canonical spelling at the least cost within the budget, the most frequent of equals."""
        states: dict[int, tuple[int, dict]] = {id(self.trie): (0, self.trie)}
        for c in unicodedata.normalize("NFD", word):
            for seen in self.table.get(ord(c), c):  # nothing for what nobody sees
                after: dict[int, tuple[int, dict]] = {}

                def reach(cost: int, node: dict, after=after) -> None:
                    if cost <= self.budget and (id(node) not in after or after[id(node)][0] > cost):
                        after[id(node)] = (cost, node)

                letters = self.alike.get(seen, (seen,))
                for cost, node in states.values():
                    for x in letters:
                        if x in node:
                            reach(cost, node[x])
                    if cost < self.budget:
                        reach(cost + 1, node)  # a character too many
                        for edge, child in node.items():
                            if edge:
                                reach(cost + 1, child)  # another character
                                for x in letters:
                                    if x in child:
                                        reach(cost + 1, child[x])  # a character missing
                if not after:
                    return None
                states = after
        ends = [(cost, -node[""][0], node[""][1]) for cost, node in states.values() if "" in node]
        return min(ends)[2] if ends else None

    def token(self, token: str) -> str:
        known = self._known.get(token)
        if known is None:
            if self.trie:
                parts = [(i % 2 and self.by_trie(p)) or fold(p) for i, p in enumerate(self.words.split(token))]
                known = unicodedata.normalize("NFC", "".join(parts))
            else:
                known = fold(token)
            if len(token) <= 64:
                if len(self._known) >= 200_000:
                    self._known.clear()
                self._known[token] = known
        return known

    def __call__(self, text: str) -> str:
        if text.isascii():
            if not self.turned or self.turned.keys().isdisjoint(_ASCII_WORDS.findall(text)):
                return text
            return _ASCII_WORDS.sub(lambda m: self.turned.get(m[0], m[0]), text)
        parts = _GAPS.split(self._spaces.sub(" ", text))
        if self.turned:
            return "".join(map(self.token, parts))
        return "".join([p if p.isascii() else self.token(p) for p in parts])


def count_spellings(df: DataFrame, text_col: str = "text", size: int = VOCABULARY) -> dict[str, int]:
    """The ``size`` most frequent spellings of all texts with their counts, in whatever script.

    Each task counts the words of its own rows first, so the shuffle holds distinct words only. How
    many words have which count tells the least count that is wanted, so no partition sends more
    than it must; ties at the end go by the word.
    """

    def count(frames):
        words = Canonicalizer().words
        n: Counter[str] = Counter()
        for pdf in frames:
            for text in pdf["text"]:
                n.update((_ASCII_WORDS if text.isascii() else words).findall(text))
            if len(n) > 500_000:
                yield _clean(n)
                n = Counter()
        yield _clean(n)

    def _clean(n):
        kept = [(w, k) for w, k in n.items() if is_spelling(w)]
        return pd.DataFrame({"word": [w for w, _ in kept], "n": [k for _, k in kept]}).astype({"word": "object", "n": "int64"})

    words = df.select(F.col(text_col).alias("text")).where("text is not null").mapInPandas(count, "word string, n long")
    counted = checkpointed(words.groupBy("word").agg(F.sum("n").alias("n")))
    # exact up to 1024, then 64 steps for each doubling: a few thousand rows however large the counts are
    step = F.when(F.col("n") <= 1024, F.col("n")).otherwise(F.floor(F.log2("n") * 64) + 384)
    enough, bound = 0, 0
    for row in counted.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.col("step").desc()).collect():
        enough, bound = enough + row["words"], row["least"]
        if enough >= size:
            break
    top = counted.where(F.col("n") >= bound).orderBy(F.col("n").desc(), "word").limit(size)
    return {r["word"]: r["n"] for r in checkpointed(top).collect()}


def canonical_texts(
    df: DataFrame, spellings: dict[str, int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, canonical) of each row; null stays null and empty stays empty."""
    source = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(spellings)

    def run(frames):
        canonical = Canonicalizer(shared.value)
        for pdf in frames:
            yield pd.DataFrame({"_id": pdf["_id"], "canonical": [None if t is None else canonical(t) for t in pdf["_text"]]})

    schema = T.StructType([source.schema["_id"], T.StructField("canonical", T.StringType())])
    return source.mapInPandas(run, schema).withColumnRenamed("_id", id_col)


def signatures(df: DataFrame, spellings: dict[str, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, form, raw): 128-bit digests of the canonical and of the written text, non-empty texts only."""
    source = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.length("_text") > 0)
    shared = df.sparkSession.sparkContext.broadcast(spellings)

    def run(frames):
        canonical = Canonicalizer(shared.value)
        for pdf in frames:
            raw = [hashlib.md5(t.encode()).digest() for t in pdf["_text"]]
            form = [r if (x := canonical(t)) == t else hashlib.md5(x.encode()).digest() for t, r in zip(pdf["_text"], raw)]
            yield pd.DataFrame({"_id": pdf["_id"], "form": form, "raw": raw})

    schema = T.StructType([source.schema["_id"], T.StructField("form", T.BinaryType()), T.StructField("raw", T.BinaryType())])
    return source.mapInPandas(run, schema)


def same_looking_pairs(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY
) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of rows whose texts differ in code points but share the form.

    Equal, null and empty texts are no pair; rows with a null id or the same id give none;
    repeated rows don't repeat a pair. Only rows of a form that is written in two ways at least
    take part, and they meet through the pairs of writings of that form.
    """
    spellings = count_spellings(df, text_col, vocabulary)
    found = checkpointed(signatures(df, spellings, id_col, text_col))
    several = found.groupBy("form").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low != high").select("form")
    rows = found.join(several, "form", "left_semi").dropDuplicates(["form", "raw", "_id"])
    # writings meet before rows do, so equal copies never meet each other
    ways = rows.select("form", "raw").distinct()
    x, y = (ways.select("form", F.col("raw").alias(f"raw_{k}")) for k in "xy")
    writings = x.join(y, "form").where("raw_x < raw_y").select("raw_x", "raw_y")
    for k in "xy":
        writings = writings.join(rows.select(F.col("raw").alias(f"raw_{k}"), F.col("_id").alias(f"id_{k}")), f"raw_{k}")
    return (
        writings.where("id_x != id_y")
        .select(F.least("id_x", "id_y").alias(f"{id_col}_a"), F.greatest("id_x", "id_y").alias(f"{id_col}_b")).distinct()
    )


def same_looking_classes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY
) -> DataFrame:
    """(id, class, writings, links) of each non-empty text: the result that grows with the rows, not with their pairs.

    ``class`` is the least id of the texts that share the form, ``writings`` in how many ways that
    form is written, ``links`` how many rows of the class are written in another way; the pairs of
    ``same_looking_pairs`` are twice as many links. Rows with a null id are left out, repeated rows
    count once. Rows are counted by their writing first; they meet one row for each writing.
    """
    found = checkpointed(signatures(df, count_spellings(df, text_col, vocabulary), id_col, text_col))
    rows = found.where(F.col("_id").isNotNull()).distinct()
    ways = rows.groupBy("form", "raw").agg(F.count("*").alias("own"), F.min("_id").alias("low"))
    forms = ways.groupBy("form").agg(F.sum("own").alias("all"), F.min("low").alias("class"), F.count("*").alias("writings"))
    meant = ways.join(forms, "form").select("form", "raw", "class", "writings", (F.col("all") - F.col("own")).alias("links"))
    return rows.join(meant, ["form", "raw"]).select(F.col("_id").alias(id_col), "class", "writings", "links")
