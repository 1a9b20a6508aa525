"""Evaluation texts leaking into training text: suffix arrays of the training words (problem 7).

The words of the held-out items are numbered; all other words are 0. A task reads its documents into
one array of word numbers per shard, with a 0 after each document, and sorts the suffixes that start
with at least ``MIN_WORDS`` numbered words; no other suffix can hold a match. Ranks are doubled until
they cover the longest item, so suffixes are in full order as far as any match can reach. Every
suffix of every item is looked up in the shard by binary search; the suffixes that share its first
``MIN_WORDS`` words are its neighbours in the array, and how far they agree falls off from its place
by the common prefixes of neighbours. So each training suffix learns its longest match with an item
from the nearest item suffixes before and behind it, and no pair of an item suffix and a training
suffix is ever formed: the work is a line for each item and training suffix that match, the memory
that of one item at a time. Matches that overlap in a document make one passage.

A document is whole in its shard, so shards need no exchange; only the passages are shuffled.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.lookalike import Canonicalizer

MIN_WORDS = 13
SHARD_WORDS = 2_000_000
#: characters of held-out items that a task holds at a time; more are done in blocks, each over all documents
BLOCK_CHARS = 16_000_000
_WORD = re.compile(r"[^\W_]+")


def text_words(text: str, canonical: Canonicalizer) -> list[str]:
    """Runs of letters and digits of the canonical form, without regard to letter case."""
    return _WORD.findall(canonical(text).casefold())


class Items:
    """The numbered words of the items and where their suffixes start, in the suffixes' order."""

    def __init__(self, rows: list[tuple[int, str]], min_words: int = MIN_WORDS):
        canonical = Canonicalizer()
        self.min_words, self.number = min_words, {}
        words, owner, place, self.longest = [], [], [], 0
        for item, text in rows:
            own = [self.number.setdefault(w, len(self.number) + 1) for w in text_words(text, canonical)]
            words += [*own, 0]
            owner += [item] * (len(own) + 1)
            place += [*range(len(own)), -1]
            self.longest = max(self.longest, len(own))
        self.words, self.owner, self.place = np.array(words, np.int32), np.array(owner, np.int64), np.array(place, np.int32)
        self.starts = SuffixArray(self.words, min_words, self.longest).starts
        if len(self.starts):  # the same first words need one search
            heads = self.words[self.starts[:, None] + np.arange(min_words)]
            self.heads, self.of_head = np.unique(heads, axis=0, return_inverse=True)
            self.of_head = self.of_head.reshape(-1)
        else:
            self.heads, self.of_head = np.zeros((0, min_words), np.int32), np.zeros(0, np.int64)


def known_run(words: np.ndarray) -> np.ndarray:
    """How many non-zero numbers in a row start at each place."""
    n = len(words)
    stops = np.append(np.flatnonzero(words == 0), n)
    return stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)


class SuffixArray:
    """Suffixes with ``depth`` known words in the order of their first ``longest`` words, and how far neighbours agree."""

    def __init__(self, words: np.ndarray, depth: int, longest: int):
        starts = np.flatnonzero(known_run(words) >= depth)
        inside = np.zeros(len(words) + 1, dtype=bool)
        for shift in range(depth):
            inside[starts + shift] = True
        self.places = np.flatnonzero(inside)  # with each start all of its known words are inside
        self.at = np.full(len(words) + 1, -1, np.int32)
        self.at[self.places] = np.arange(len(self.places), dtype=np.int32)
        n = len(self.places)
        self.run = known_run(words)
        self.ranks = [np.unique(words[self.places], return_inverse=True)[1].astype(np.int32) + 1]
        width = 1
        while n and width < max(longest, depth) and (last := self.ranks[-1]).max() < n:
            key = last.astype(np.int64) * (int(last.max()) + 1)
            key += self._rank_at(last, self.places + width)
            order = np.argsort(key, kind="stable")
            step = np.ones(n, dtype=np.int32)
            step[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(n, dtype=np.int32)
            rank[order] = np.cumsum(step, dtype=np.int32)
            self.ranks.append(rank)
            width *= 2
        self.starts = starts[np.argsort(self.ranks[-1][self.at[starts]], kind="stable")]

    def _rank_at(self, rank: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes at some places; 0 where no known word is."""
        at = self.at[np.minimum(places, len(self.at) - 1)]
        return np.where(at >= 0, rank[np.maximum(at, 0)], 0)

    def agreement(self) -> np.ndarray:
        """Common known words of each suffix with the one before it, by the ranks from wide to narrow."""
        out = np.zeros(len(self.starts), np.int64)
        if len(out) < 2:
            return out
        a, b, common = self.starts[:-1].copy(), self.starts[1:].copy(), out[1:]
        for k in range(len(self.ranks) - 1, -1, -1):
            x = self._rank_at(self.ranks[k], a)
            step = ((x == self._rank_at(self.ranks[k], b)) & (x > 0)).astype(np.int64) << k
            common += step
            a += step
            b += step
        out[1:] = np.minimum(common, np.minimum(self.run[self.starts[:-1]], self.run[self.starts[1:]]))
        return out


def search(words: np.ndarray, suffixes: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place in the suffix array of the suffixes that start with each head."""
    depth = heads.shape[1]

    def bound(right: bool) -> np.ndarray:
        low, high = np.zeros(len(heads), np.int64), np.full(len(heads), len(suffixes), np.int64)
        while (active := low < high).any():
            middle = np.minimum((low + high) // 2, len(suffixes) - 1)
            order = np.zeros(len(heads), np.int8)
            for k in range(depth):
                open_ = np.flatnonzero(order == 0)
                if not len(open_):
                    break
                order[open_] = np.sign(words[suffixes[middle[open_]] + k] - heads[open_, k])
            less = (order < 0) | (right & (order == 0))
            low, high = np.where(active & less, middle + 1, low), np.where(active & ~less, middle, high)
        return low

    if not len(suffixes):
        zero = np.zeros(len(heads), np.int64)
        return zero, zero
    return bound(False), bound(True)


def _insertion(words: np.ndarray, suffixes: np.ndarray, items: Items, starts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where item suffixes would stand among the training suffixes of their range: before equal ones."""
    low, high = low.copy(), high.copy()
    while len(active := np.flatnonzero(low < high)):
        middle = (low[active] + high[active]) // 2
        a, b = suffixes[middle], starts[active]
        n = _common(words, a, items, b)
        less = words[a + n] < items.words[b + n]
        low[active] = np.where(less, middle + 1, low[active])
        high[active] = np.where(less, high[active], middle)
    return low


def _common(words: np.ndarray, a: np.ndarray, items: Items, b: np.ndarray) -> np.ndarray:
    """Common words of training suffixes and item suffixes that share their first ``min_words``; both end with a 0."""
    n = np.full(len(a), items.min_words, np.int64)
    live = np.arange(len(a))
    while len(live):
        x = words[a[live] + n[live]]
        live = live[(x == items.words[b[live] + n[live]]) & (x != 0)]
        n[live] += 1
    return n


COLUMNS = ["item", "place", "end", "n_words", "longest_at", "item_start"]


def _passages(matches: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``COLUMNS``: those of an item that overlap become one, which keeps the longest match (the first of equals)."""
    matches = matches[np.lexsort((matches[:, 1], matches[:, 0]))]
    shift = matches[:, 0] * width  # items one behind the other, so that one running maximum serves all
    ends = np.maximum.accumulate(shift + matches[:, 2])
    new = np.append(True, (shift + matches[:, 1])[1:] >= ends[:-1])
    first, passage = np.flatnonzero(new), np.cumsum(new) - 1
    out = matches[np.lexsort((matches[:, 5], matches[:, 4], -matches[:, 3], passage))[first]]
    out[:, 1] = matches[first, 1]
    out[:, 2] = (ends - shift)[np.append(first[1:], len(matches)) - 1]
    return out


def shard_matches(words: np.ndarray, items: Items) -> pd.DataFrame:
    """(item, place, end, n_words, longest_at, item_start) of the passages of each item in one shard.

    ``words`` ends with a 0. A passage is a run of words covered by matches that overlap; its
    longest match has ``n_words`` words, from ``longest_at`` here and ``item_start`` there.
    """
    array = SuffixArray(words, items.min_words, items.longest)
    suffixes = array.starts
    low, high = search(words, suffixes, items.heads)
    found = np.flatnonzero((high - low)[items.of_head] > 0)  # item suffixes, in their order
    if not len(found):
        return pd.DataFrame(np.zeros((0, len(COLUMNS)), np.int64), columns=COLUMNS)
    starts, head = items.starts[found], items.of_head[found]
    low, high = low[head], high[head]
    at = _insertion(words, suffixes, items, starts, low, high)
    behind, before = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for some, next_, agrees in ((at < high, 0, behind), (at > low, 1, before)):
        agrees[some] = _common(words, suffixes[at[some] - next_], items, starts[some])
    names, item = np.unique(items.owner[starts], return_inverse=True)
    by_item = np.lexsort((np.arange(len(item)), item))
    groups = np.split(by_item, np.flatnonzero((np.diff(item[by_item]) != 0) | (np.diff(head[by_item]) != 0)) + 1)
    # the usual case at once: one suffix of the item meets one of the shard
    lone = np.array([g[0] for g in groups if len(g) == 1 and high[g[0]] - low[g[0]] == 1], dtype=np.int64)
    done = [np.zeros((0, len(COLUMNS)), np.int64)]
    if len(lone):
        place, n = suffixes[low[lone]], np.maximum(behind, before)[lone]
        done.append(_passages(np.stack([item[lone], place, place + n, n, place, items.place[starts[lone]]], axis=1), len(words) + 1))
    groups = [g for g in groups if len(g) > 1 or high[g[0]] - low[g[0]] > 1]
    lcp = array.agreement() if groups else None
    for g in groups:
        a, b = low[g[0]], high[g[0]]
        longest, source = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
        for k, i in enumerate(g):  # on to the place of the next item suffix, and back to that of the one before
            on, back = at[g[k + 1]] if k + 1 < len(g) else b, at[g[k - 1]] if k else a
            for reach, start in ((_reach(lcp, at[i], on, behind[i]), at[i] - a), (_reach_back(lcp, at[i], back, before[i]), back - a)):
                span = slice(start, start + len(reach))
                better = reach > longest[span]
                longest[span][better] = reach[better]
                source[span][better] = items.place[starts[i]]
        place = suffixes[a:b]
        done.append(_passages(np.stack([np.full(b - a, item[g[0]]), place, place + longest, longest, place, source], axis=1), len(words) + 1))
    out = _passages(np.concatenate(done), len(words) + 1)
    out[:, 0] = names[out[:, 0]]
    return pd.DataFrame(out, columns=COLUMNS)


def _reach(lcp: np.ndarray, at: int, end: int, first: int) -> np.ndarray:
    """Common words of an item suffix with the training suffixes from its place on, which agree ``first`` there."""
    return np.minimum.accumulate(np.append(first, lcp[at + 1 : end])) if end > at else lcp[:0]


def _reach_back(lcp: np.ndarray, at: int, end: int, first: int) -> np.ndarray:
    """The same for the training suffixes before its place, in their order."""
    return np.minimum.accumulate(np.append(first, lcp[end + 1 : at][::-1]))[::-1] if at > end else lcp[:0]


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text",
    min_words: int = MIN_WORDS, shard_words: int = SHARD_WORDS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, item, doc_word, end_word, n_words, longest_at, item_word): every passage of an item in a document.

    A passage runs from ``doc_word`` up to ``end_word``, counted from 0, and is covered by matches that
    overlap; the longest of them has ``n_words`` words, from ``longest_at`` of the document and
    ``item_word`` of the item (the first of equals). Null and empty texts match nothing. Rows with the
    same id count as one document with several texts, equal rows once; items with the same id as one item.
    Items with more than ``block_chars`` characters together are dealt into blocks, each of which is
    searched for in all documents.
    """
    rows = items.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("i is not null and length(t) > 0").distinct()
    blocks = -(-(rows.agg(F.sum(F.length("t"))).first()[0] or 0) // block_chars) or 1
    block = F.pmod(F.xxhash64("i"), F.lit(blocks))
    parts = [_leaks_of(docs, rows.where(block == k) if blocks > 1 else rows, id_col, text_col, min_words, shard_words) for k in range(blocks)]
    return reduce(DataFrame.unionByName, parts).distinct().withColumnsRenamed({"_id": id_col, "_item": item_col})


def _leaks_of(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, min_words: int, shard_words: int) -> DataFrame:
    """The passages of one block of items, which the driver holds and broadcasts."""
    shared = docs.sparkSession.sparkContext.broadcast(Items(sorted((r["i"], r["t"]) for r in rows.collect()), min_words))
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.length("_text") > 0)
    numbers = ("_item", "doc_word", "end_word", "n_words", "longest_at", "item_word")
    schema = T.StructType([source.schema["_id"], *(T.StructField(c, T.LongType()) for c in numbers)])

    def run(frames):
        known, canonical = shared.value, Canonicalizer()
        number = known.number
        ids, parts, held = [], [], 0

        def shard():
            starts = np.cumsum([0] + [len(p) for p in parts])
            hits = shard_matches(np.concatenate(parts), known)
            doc = np.searchsorted(starts, hits["place"].to_numpy(), side="right") - 1
            out = {"_id": pd.Series(ids, dtype=object).iloc[doc].to_numpy(), "_item": hits["item"].to_numpy()}
            out |= {c: hits[h].to_numpy() - starts[doc] for c, h in (("doc_word", "place"), ("end_word", "end"))}
            out |= {"n_words": hits["n_words"].to_numpy(), "longest_at": hits["longest_at"].to_numpy() - starts[doc], "item_word": hits["item_start"].to_numpy()}
            return pd.DataFrame(out)

        for pdf in frames:
            for key, text in zip(pdf["_id"], pdf["_text"]):
                own = [number.get(w, 0) for w in text_words(text, canonical)]
                ids.append(key)
                parts.append(np.array([*own, 0], np.int32))
                held += len(own) + 1
                if held >= shard_words:
                    yield shard()
                    ids, parts, held = [], [], 0
        if parts:
            yield shard()

    return source.mapInPandas(run, schema)


def without_leaks(docs: DataFrame, leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that hold no passage; rows with a null id are kept unless a null id leaked."""
    bad = leaks.select(F.col(id_col).alias("_leaked")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_leaked"]), "left_anti")
