"""Has this key been seen before? Sorted quotient filters over hash slices (problem 2).

The first bits of a key's hash are cut into slice | quotient | remainder. Arrival order is cut into
epochs. Spark reduces the rows of each epoch to distinct fingerprints (map-side combine, so a key that
holds a third of all rows costs one row per map task) and sorts them by slice, epoch and fingerprint;
the sort spills to disk. A task reads that order as a stream: the fingerprints of an epoch are looked
up in the filter of all earlier epochs of the slice, and when the epoch ends the new ones, a sorted
filter of their own, are merged into it. So a task holds one filter and the new fingerprints of one
epoch, never the earlier keys. The number of slices follows the number of rows and the hash spreads
keys evenly, so what a slice holds is bounded.

The filter stores the remainders packed to whole bytes, ordered by quotient, with two bitmaps as
run metadata: which quotients occur and where each run ends. It is searched and merged in this form.

Answers: a key that came earlier is always called seen. A new key is wrongly called seen when
another key of its side has the same bits; with d keys and b bits the expected number of such answers
is d (d - 1) / 2**(b + 1). ``error_rates`` derives it and measures it through the filters.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import checkpointed

SLICE_KEYS = 400_000
EPOCHS = 16
BITS = 64
#: quotients that a merge unpacks at a time, a multiple of 8
CHUNK = 1 << 15

#: place of the k-th set bit of a byte (8 where it has fewer), counted from its first bit
_SELECT = np.array([[*(i for i in range(8) if byte >> (7 - i) & 1), *[8] * 8][:8] for byte in range(256)], dtype=np.int64)


def _set_before(bits: np.ndarray) -> np.ndarray:
    """Set bits before each byte of a bitmap, and all of them at the end."""
    out = np.zeros(len(bits) + 1, np.int32)
    np.cumsum(np.bitwise_count(bits), out=out[1:])
    return out


class QuotientFilter:
    """Sorted quotient filter of the fingerprints of one slice."""

    def __init__(self, quotient_bits: int, remainder_bytes: int, n: int, occupied: np.ndarray, run_ends: np.ndarray, remainders: np.ndarray):
        self.quotient_bits, self.remainder_bytes, self.n = quotient_bits, remainder_bytes, n
        self.occupied, self.run_ends, self.remainders = occupied, run_ends, remainders

    @classmethod
    def of_sorted(cls, fingerprints: np.ndarray, quotient_bits: int, remainder_bytes: int) -> QuotientFilter:
        """Filter of sorted distinct unsigned fingerprints of quotient + remainder bits."""
        fps = fingerprints.astype(np.uint64)
        occupied, ends, packed = cls._pack(fps, 0, max(8, 1 << quotient_bits), remainder_bytes)
        return cls(quotient_bits, remainder_bytes, len(fps), np.packbits(occupied), np.packbits(ends), packed)

    @staticmethod
    def _pack(fps: np.ndarray, first: int, width: int, remainder_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(occupied, run ends, remainders) of sorted fingerprints whose quotients lie in a range."""
        quotient = (fps >> np.uint64(8 * remainder_bytes)).astype(np.int64)
        occupied = np.zeros(width, dtype=bool)
        occupied[quotient - first] = True
        ends = np.ones(len(fps), dtype=bool)
        ends[:-1] = quotient[1:] != quotient[:-1]
        return occupied, ends, np.ascontiguousarray(fps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :remainder_bytes])

    def _run_bounds(self, rank: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Place behind the run of the given rank; 0 for rank -1. ``before``: ``_set_before`` of the run ends."""
        byte = np.maximum(np.searchsorted(before, rank, side="right") - 1, 0)
        inside = np.clip(rank - before[byte], 0, 7)
        end = 8 * byte + _SELECT[self.run_ends[np.minimum(byte, len(self.run_ends) - 1)], inside] + 1
        return np.where(rank < 0, 0, end)

    def contains(self, fingerprints: np.ndarray) -> np.ndarray:
        """Which fingerprints are stored: the run of the quotient is found by rank and select and its packed remainders are compared."""
        out = np.zeros(len(fingerprints), dtype=bool)
        if not self.n or not len(fingerprints):
            return out
        fps = fingerprints.astype(np.uint64)
        quotient = (fps >> np.uint64(8 * self.remainder_bytes)).astype(np.int64)
        byte, bit = quotient >> 3, 7 - (quotient & 7)
        has = self.occupied[byte] >> bit & 1 == 1
        asked = np.flatnonzero(has)
        byte, bit = byte[asked], bit[asked]
        rank = _set_before(self.occupied)[byte] + np.bitwise_count(self.occupied[byte] >> bit) - 1
        before = _set_before(self.run_ends)
        at, end = self._run_bounds(rank - 1, before), self._run_bounds(rank, before)
        want = fps[asked].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : self.remainder_bytes]
        live = np.arange(len(asked))
        while len(live):
            out[asked[live]] |= (self.remainders[at[live]] == want[live]).all(axis=1)
            at[live] += 1
            live = live[(at[live] < end[live]) & ~out[asked[live]]]
        return out

    def chunks(self, quotients: int = CHUNK):
        """(first quotient, its range's fingerprints), one range of quotients after another; only that range is unpacked."""
        ends = _set_before(self.run_ends) if self.n else None
        ranks = _set_before(self.occupied)
        for first in range(0, 8 * len(self.occupied), quotients):
            last = min(first + quotients, 8 * len(self.occupied))
            low, high = ranks[first >> 3], ranks[last >> 3]
            if low == high:
                yield first, np.zeros(0, np.uint64)
                continue
            a, b = self._run_bounds(np.array([low - 1, high - 1]), ends).tolist()
            wide = np.zeros((b - a, 8), dtype=np.uint8)
            wide[:, : self.remainder_bytes] = self.remainders[a:b]
            stop = np.unpackbits(self.run_ends[a >> 3 : (b + 7) >> 3])[a & 7 : (a & 7) + b - a].astype(bool)
            run = np.append(0, np.cumsum(stop[:-1])).astype(np.int64)
            own = first + np.flatnonzero(np.unpackbits(self.occupied[first >> 3 : last >> 3]))
            yield first, own[run].astype(np.uint64) << np.uint64(8 * self.remainder_bytes) | wide.view("<u8").reshape(-1)

    def fingerprints(self) -> np.ndarray:
        return np.concatenate([fps for _, fps in self.chunks()])

    def merge(self, other: QuotientFilter, quotients: int = CHUNK) -> QuotientFilter:
        """Filter of the fingerprints of both, merged range by range of the quotients."""
        occupied, ends, packed = [], [], []
        for (first, a), (_, b) in zip(self.chunks(quotients), other.chunks(quotients)):
            o, e, p = self._pack(np.union1d(a, b), first, min(quotients, 8 * len(self.occupied) - first), self.remainder_bytes)
            occupied.append(np.packbits(o))
            ends.append(e)
            packed.append(p)
        every = np.concatenate(ends)
        return QuotientFilter(
            self.quotient_bits, self.remainder_bytes, len(every), np.concatenate(occupied), np.packbits(every), np.concatenate(packed)
        )

    def nbytes(self) -> int:
        return self.occupied.nbytes + self.run_ends.nbytes + self.remainders.nbytes


def layout(rows: int, bits: int = BITS) -> tuple[int, int, int]:
    """(slice bits, quotient bits, remainder bytes) of fingerprints of so many bits for so many rows."""
    quotient_and_slice = max(8, math.ceil(math.log2(max(rows, 1) / 0.75 + 1)))
    remainder_bytes = min(max(1, math.ceil((bits - quotient_and_slice) / 8)), (bits - 8) // 8)
    high = bits - 8 * remainder_bytes
    slices = min(high, max(0, math.ceil(math.log2(max(rows, 1) / SLICE_KEYS))))
    return slices, high - slices, remainder_bytes


def arrivals(df: DataFrame, side: str, order: str, key: Column) -> DataFrame:
    """(side, order_no, key) of rows with a key and a place in the order."""
    return df.select(F.lit(side).alias("side"), F.col(order).cast("long").alias("order_no"), key.alias("key")).where(
        F.col("key").isNotNull() & F.col("order_no").isNotNull()
    )


def fingerprints(rows: DataFrame) -> DataFrame:
    """(side, order_no, fp) of arrivals, made once and stored: keys are long and costly to bring to their form."""
    return checkpointed(rows.select("side", "order_no", F.xxhash64("key").alias("fp")))


def _first_bits(fp: Column, bits: int) -> Column:
    return F.shiftrightunsigned(fp, BITS - bits) if bits < BITS else fp


class _Fold:
    """Reads sorted (side, slice, epoch, fp, order_no) batches and tells which rows are new; one filter and one epoch at a time."""

    def __init__(self, quotient_bits: int, remainder_bytes: int):
        self.empty = QuotientFilter.of_sorted(np.zeros(0, np.uint64), quotient_bits, remainder_bytes)
        self.slice, self.epoch, self.filter, self.arrived = None, None, self.empty, []

    def _close_epoch(self) -> None:
        if self.arrived:
            new = QuotientFilter.of_sorted(np.concatenate(self.arrived), self.empty.quotient_bits, self.empty.remainder_bytes)
            self.filter = self.filter.merge(new) if self.filter.n else new
            self.arrived = []

    def part(self, where: tuple, epoch: int, fps: np.ndarray) -> np.ndarray:
        """Which of the fingerprints, sorted and of one slice and epoch, are new."""
        if where != self.slice:
            self.slice, self.epoch, self.filter, self.arrived = where, epoch, self.empty, []
        elif epoch != self.epoch:
            self._close_epoch()
            self.epoch = epoch
        fresh = ~self.filter.contains(fps)
        self.arrived.append(fps[fresh])
        return fresh


def first_arrivals(prints: DataFrame, epochs: int = EPOCHS, bits: int = BITS) -> DataFrame:
    """(side, fp, order_no): the first arrival of each of the ``fingerprints``, cut to so many bits, by folding the filters."""
    facts = prints.agg(F.count("*"), F.min("order_no"), F.max("order_no")).first()
    n, low, top = facts[0], facts[1] or 0, facts[2] or 0
    width = max(1, -(-(top - low + 1) // epochs))
    slice_bits, quotient_bits, remainder_bytes = layout(n, bits)
    inner = quotient_bits + 8 * remainder_bytes

    reduced = (
        prints.withColumn("fp", _first_bits(F.col("fp"), bits))
        .groupBy("side", F.floor((F.col("order_no") - low) / width).cast("int").alias("epoch"), "fp")
        .agg(F.min("order_no").alias("order_no"))
        .select("side", (F.shiftrightunsigned("fp", inner).cast("int") if slice_bits else F.lit(0)).alias("slice"), "epoch", "fp", "order_no")
    )
    # by the bits below the slice's as unsigned numbers
    place = F.col("fp").bitwiseAND(F.lit((1 << inner) - 1)) if inner < 64 else F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    in_order = reduced.repartition("side", "slice").sortWithinPartitions("side", "slice", "epoch", place)

    def run(batches):
        fold = _Fold(quotient_bits, remainder_bytes)
        mask = np.uint64((1 << inner) - 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            side = batch.column("side").dictionary_encode()
            slice_, epoch = batch.column("slice").to_numpy(), batch.column("epoch").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64) & mask
            codes = side.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(slice_) != 0) | (np.diff(epoch) != 0)) + 1
            new = np.concatenate([
                fold.part((side.dictionary[int(codes[part[0]])].as_py(), int(slice_[part[0]])), int(epoch[part[0]]), fps[part])
                for part in np.split(np.arange(batch.num_rows), cuts)
            ])
            yield batch.select(["side", "fp", "order_no"]).filter(pa.array(new))

    return in_order.mapInArrow(run, "side string, fp long, order_no long")


def seen_before(rows: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """(side, order_no) of the rows whose key came with a lower order_no on the same side.

    ``rows``: side, order_no, key as ``arrivals`` gives them; rows with a null key or order are no
    part of it. Rows that share key and order_no are not earlier than each other. The row set
    minus the first arrivals needs no join on the key, so a hot key can't skew it.
    """
    prints = fingerprints(rows)
    return prints.join(first_arrivals(prints, epochs), ["order_no", "fp", "side"], "left_anti").select("side", "order_no")


def error_rates(rows: DataFrame, bits: tuple[int, ...] = (24, 32, 40, 64), epochs: int = EPOCHS) -> DataFrame:
    """Derived and measured wrong answers of filters over fingerprints of so many bits.

    A wrong answer is a first arrival of a key that is called seen. Measured: the exact first
    arrivals that are no first arrival for the filters, which are folded once for each number of bits.
    """
    exact = rows.groupBy("side", "key").agg(F.min("order_no").alias("order_no"), F.count("*").alias("n"))
    totals = exact.groupBy("side").agg(F.sum("n").alias("rows"), F.count("*").alias("keys"))

    prints = fingerprints(rows)

    def wrong(b: int) -> DataFrame:
        missed = exact.select("side", "order_no", _first_bits(F.xxhash64("key"), b).alias("fp")).join(
            first_arrivals(prints, epochs, b), ["order_no", "fp", "side"], "left_anti"
        )
        return missed.groupBy("side").agg(F.count("*").alias("wrong")).select("side", F.lit(b).alias("bits"), "wrong")

    counted = reduce(DataFrame.unionByName, map(wrong, bits))
    every = totals.select("side", "rows", "keys", F.explode(F.array(*map(F.lit, bits))).alias("bits"))
    n = F.coalesce("wrong", F.lit(0))
    return every.join(counted, ["side", "bits"], "left").select(
        "side", "bits", "rows", "keys",
        (F.col("keys") * (F.col("keys") - 1.0) / 2 / F.pow(F.lit(2.0), F.col("bits"))).alias("wrong_expected"),
        n.alias("wrong_measured"),
        (n / F.col("rows")).alias("wrong_rate"),
    )
