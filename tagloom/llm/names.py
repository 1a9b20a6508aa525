"""Mapping free-entered species names to a reference list (problem 5).

The distinct typed values (one shuffle with map-side combining, so frequent placeholders collapse
early) meet a multi-pattern automaton over the canonical names and their aliases: binomial, joined
binomial, reversed binomial, and genus shortened to its first letters where that is unambiguous.
Of the mentions found in a value the longest non-overlapping ones win. Values without a mention go
to token-set similarity: any two of their words, wherever they stand, against genus and epithet
words, by edits (insertion, deletion, substitution, swap of neighbours). The words near a given one
come from an inverted index over deletion neighbourhoods, so the list is never scanned. The result
is joined back to the rows by the typed value.

The reference list is bounded: more than ``MAX_NAMES`` names are an error. Its matcher is built once
and travels as a broadcast, so what each task holds never grows with the data.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from itertools import combinations

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_NAMES = 50_000
MAX_EDITS = 3
SHORT_WORD = 4
SHORT_GENUS = range(1, 7)
NO_NAMES = ("", "na", "n/a", "-")
#: words that stand between genus and epithet without changing the name
BETWEEN = {"cf", "aff", "nr"}


def words(value: str) -> list[str]:
    """Words of letters in plain lower case: accents folded, joined capitals and rank marks split."""
    text = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    text = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", re.sub(r"\b[a-z]__", " ", text)).lower()
    return [w for w in re.findall(r"[a-z]+", text) if w not in BETWEEN]


def edits(a: str, b: str, most: int) -> int:
    """Optimal string alignment distance, or ``most`` + 1 where it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


PREFIX = 7


def _keep_rows(length: int) -> np.ndarray:
    """For a prefix of so many letters: one row per way to delete up to ``MAX_EDITS``, with the place values of the kept letters."""
    rows = []
    for gone in range(min(MAX_EDITS, length) + 1):
        for out in combinations(range(length), gone):
            kept = [i for i in range(length) if i not in out]
            row = [0] * length
            for power, i in enumerate(reversed(kept)):
                row[i] = 27**power
            rows.append(row)
    return np.array(rows, dtype=np.int64).reshape(-1, length)


_KEEP = [_keep_rows(max(1, n)) for n in range(PREFIX + 1)]


def _letters(word: str) -> np.ndarray:
    return np.frombuffer(word.encode(), np.uint8).astype(np.int64) - 96


class WordIndex:
    """Inverted index from deletion neighbourhoods to words.

    Two words within ``MAX_EDITS`` share what is left of their first ``PREFIX`` letters after up to
    ``MAX_EDITS`` deletions on each side. The index holds these remainders as numbers, sorted; a
    word's own remainders are looked up by binary search, and only what shares one is compared.
    """

    def __init__(self, vocabulary):
        self.words = sorted(vocabulary)
        self.known = {w: i for i, w in enumerate(self.words)}
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int32)
        self.bags = np.array([self.bag(w) for w in self.words], dtype=np.int8).reshape(-1, 26)
        keys, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        by_length = defaultdict(list)
        for i, w in enumerate(self.words):
            by_length[min(len(w), PREFIX)].append(i)
        for n, members in by_length.items():
            codes = np.array([_letters(self.words[i][:PREFIX]) for i in members]) @ _KEEP[n].T
            keys.append(codes.reshape(-1))
            ids.append(np.repeat(np.array(members, np.int32), codes.shape[1]))
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids = keys[order], ids[order]

    @staticmethod
    def bag(word: str) -> list[int]:
        n = Counter(word)
        return [min(n[c], 100) for c in "abcdefghijklmnopqrstuvwxyz"]

    def near(self, word: str, most: int = MAX_EDITS) -> dict[str, int]:
        """Words within ``most`` edits; words under ``SHORT_WORD`` letters stand for themselves only."""
        if len(word) < SHORT_WORD:
            return {word: 0} if word in self.known else {}
        codes = np.unique(_KEEP[min(len(word), PREFIX)] @ _letters(word[:PREFIX]))
        low, high = np.searchsorted(self.keys, codes, "left"), np.searchsorted(self.keys, codes, "right")
        spans = [self.ids[a:b] for a, b in zip(low.tolist(), high.tolist()) if b > a]
        if not spans:
            return {}
        some = np.unique(np.concatenate(spans))
        some = some[np.abs(self.lengths[some] - len(word)) <= most]
        close = np.abs(self.bags[some].astype(np.int16) - np.array(self.bag(word), dtype=np.int16)).sum(axis=1) <= 2 * most
        found = {self.words[i]: edits(word, self.words[i], most) for i in some[close].tolist()}
        return {w: d for w, d in found.items() if d <= most}


def one_swap(a: str, b: str) -> bool:
    """Whether two words differ by one swap of neighbouring letters."""
    if len(a) != len(b):
        return False
    at = [i for i, (x, y) in enumerate(zip(a, b)) if x != y]
    return len(at) == 2 and at[1] == at[0] + 1 and a[at[0]] == b[at[1]] and a[at[1]] == b[at[0]]


class NameMatcher:
    """Typed value -> (canonical name, how it was found) for a bounded list of binomials."""

    def __init__(self, names: list[str]):
        self.listed: dict[tuple[str, str], str] = {}
        for name in sorted(names):
            w = words(name)
            if len(w) >= 2:
                self.listed.setdefault((w[0], " ".join(w[1:])), name)
        self.genera, self.epithets = WordIndex({g for g, _ in self.listed}), WordIndex({e for _, e in self.listed if " " not in e})
        self.joined = WordIndex({(g + e).replace(" ", "") for g, e in self.listed})
        self.by_joined = {(g + e).replace(" ", ""): n for (g, e), n in self.listed.items()}
        self.longest = max(map(len, self.by_joined), default=0)
        self.support = Counter(e for _, e in self.listed)
        aliases: dict[str, set[str]] = defaultdict(set)
        for (g, e), name in self.listed.items():
            for n in SHORT_GENUS:
                if n < len(g):
                    aliases[f" {g[:n]} {e} "].add(name)
        # over mirrored text, where all aliases of a name share their way through the epithet
        self.automaton = ahocorasick.Automaton()
        for alias, owners in aliases.items():
            if len(owners) == 1:
                self.automaton.add_word(alias[::-1], (len(alias), next(iter(owners)), "short"))
        for (g, e), name in self.listed.items():  # after the aliases: a full name overrides
            for alias in (f" {g}{e} ", f" {e} {g} ", f" {g} {e} "):
                self.automaton.add_word(alias[::-1], (len(alias), name, "mention"))
        if self.listed:
            self.automaton.make_automaton()

    def mentions(self, typed: list[str]) -> list[tuple[int, int, str, str]]:
        """Longest non-overlapping mentions as (length, -end, name, how), best first."""
        text = " " + " ".join(typed) + " "
        last = len(text) - 1
        found = sorted(((n, end - n + 1 - last, name, how) for end, (n, name, how) in self.automaton.iter(text[::-1])), reverse=True)
        kept: list[tuple[int, int, str, str]] = []
        for n, end, name, how in found:
            start = -end - n + 1
            if all(-end <= -e2 - n2 + 1 or start >= -e2 for n2, e2, _, _ in kept):
                kept.append((n, end, name, how))
        return kept

    def near_names(self, typed: list[str]) -> list[tuple[int, str, str]]:
        """(edits, genus, epithet) of every genus and epithet near two different words of the value, wherever they stand."""
        genera: dict[str, list[tuple[int, int]]] = defaultdict(list)
        epithets: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for at, word in enumerate(dict.fromkeys(typed)):
            for near, found in ((self.genera, genera), (self.epithets, epithets)):
                for w, d in near.near(word).items():
                    found[w] = sorted([*found[w], (d, at)])[:2]
        out = []
        for g, gs in genera.items():
            for e, es in epithets.items():
                if sums := [dg + de for dg, i in gs for de, j in es if i != j and dg + de <= MAX_EDITS]:
                    out.append((min(sums), g, e))
        return out

    def similar(self, typed: list[str]) -> str | None:
        """The listed name with the most similar set of words, or None.

        Edits add up over genus and epithet. A listed name may stand one edit behind the nearest
        combination off the list. Where that combination is written exactly it is another species,
        unless one swap of neighbouring letters makes it a listed name: that is a slip of typing.
        """
        near = self.near_names(typed)
        if near:
            least = min(d for d, _, _ in near)
            ranks = [(d, -self.support[e], self.listed[g, e]) for d, g, e in near if d <= least + 1 and (g, e) in self.listed]
            if least == 0 and (not ranks or min(ranks)[0] > 0):
                exact = [(g, e) for d, g, e in near if d == 0]
                ranks = [
                    (d, -self.support[e], self.listed[g, e]) for d, g, e in near
                    if (g, e) in self.listed and any((g == a and one_swap(e, b)) or (e == b and one_swap(g, a)) for a, b in exact)
                ]
            return min(ranks)[2] if ranks else None
        best: tuple | None = None  # an edit may have moved the space between the words
        for n in (1, 2, 3):
            for i in range(len(typed) - n + 1):
                whole = "".join(typed[i : i + n])
                if 8 <= len(whole) <= self.longest + MAX_EDITS:
                    for w, d in self.joined.near(whole).items():
                        rank = (d, self.by_joined[w])
                        best = min(best, rank) if best else rank
        return best[1] if best else None

    def match(self, value: str) -> tuple[str | None, str | None]:
        typed = words(value)
        if not typed or not self.listed:
            return None, None
        if kept := self.mentions(typed):
            return kept[0][2], kept[0][3]
        name = self.similar(typed)
        return name, "similar" if name else None


def reference_names(genomes: DataFrame, column: str = "species") -> list[str]:
    """The distinct names of the list; null, empty and placeholder entries are none."""
    name = F.trim(F.col(column))
    rows = (
        genomes.select(name.alias("name")).where(F.col("name").isNotNull() & ~F.lower("name").isin(*NO_NAMES))
        .distinct().limit(MAX_NAMES + 1).collect()
    )
    if len(rows) > MAX_NAMES:
        raise ValueError(f"the reference list has more than {MAX_NAMES} names")
    return sorted(r["name"] for r in rows)


def map_values(values: DataFrame, names: list[str], column: str = "species") -> DataFrame:
    """(typed, canonical, how) of the distinct non-null values; canonical null where unmatched."""
    typed = values.select(F.col(column).alias("typed")).where(F.col(column).isNotNull()).groupBy("typed").agg(F.count("*").alias("n"))
    # A value is a few bytes and costs much time: spread by number. By another hash than the
    # aggregate's, else Spark drops the exchange and merges the partitions by their bytes.
    typed = typed.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("typed"))

    shared = values.sparkSession.sparkContext.broadcast(NameMatcher(names))

    def run(frames):
        matcher = shared.value
        for pdf in frames:
            found = [matcher.match(v) for v in pdf["typed"]]
            yield pd.DataFrame(
                {"typed": pdf["typed"], "n": pdf["n"], "canonical": [f[0] for f in found], "how": [f[1] for f in found]}
            )

    return typed.mapInPandas(run, "typed string, n long, canonical string, how string")


def map_rows(rows: DataFrame, names: list[str], id_col: str, column: str = "species") -> DataFrame:
    """(id, canonical) of the rows whose typed value names an entry of the list.

    Null and blank values, placeholders, a genus alone and names off the list give no row.
    Repeated rows stay repeated. Other columns of the input are not looked at.
    """
    mapping = map_values(rows, names, column).where(F.col("canonical").isNotNull()).select("typed", "canonical")
    slim = rows.select(F.col(id_col).alias("_id"), F.col(column).alias("typed"))
    return slim.join(mapping, "typed").select(F.col("_id").alias(id_col), "canonical")


def unmatched(rows: DataFrame, names: list[str], column: str = "species") -> DataFrame:
    """(typed, n) of the distinct values that name no entry; null and blank values together as null."""
    blank = F.when(F.trim(F.col(column)) != "", F.col(column))
    nulls = rows.where(blank.isNull()).agg(F.count("*").alias("n")).where("n > 0").select(F.lit(None).cast("string").alias("typed"), "n")
    return map_values(rows.where(blank.isNotNull()), names, column).where(F.col("canonical").isNull()).select("typed", "n").unionByName(nulls)
