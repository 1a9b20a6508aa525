"""Fixed-size uniform sample of data of unknown length: geometric files per shard (problem 3).

A shard is one input partition, read once in the order of delivery. It keeps a reservoir of
``size`` records as a geometric file: accepted records gather in a buffer, a full buffer is
flushed as a segment in random order, and the records it pushes out are taken off the ends of the
older segments, so each of them shrinks by a random share and geometrically in the long run.
Nothing but the buffer and the segments' lengths stays in the task's memory: a segment is emitted
when it is flushed and "overwritten" by a shorter length in the shard's closing records.

The segments are written once to the shared checkpoint folder. The shards are then merged by
numbers alone: how many records each shard gives is a multivariate hypergeometric draw weighted
by the shards' populations, each shard spreads its number over its segments by another one, and
that many records are read off the front of each segment. No record is shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import checkpointed

MAX_SHARDS = 4096


def _segments(batches, size: int, buffer_rows: int, seed: int, shard: int):
    """Yield (flush, accepted rows in random order), last (None, live lengths, population)."""
    rng = np.random.default_rng([seed, shard])
    live: list[int] = []
    kept: list[pa.Table] = []
    slots: list[int] = []
    seen = offset = 0

    def flush():
        nonlocal kept, slots, offset, live
        if not slots:
            return None
        rows = pa.concat_tables(kept).take(pa.array(rng.permutation(np.array(slots, dtype=np.int64))))
        over = sum(live) + len(slots) - size
        if over > 0:
            live = (np.array(live) - rng.multivariate_hypergeometric(live, over, method="marginals")).tolist()
        live.append(len(slots))
        kept, slots, offset = [], [], 0
        return len(live) - 1, rows

    for batch in batches:
        place = seen + 1 + np.arange(batch.num_rows)
        accepted = np.flatnonzero(rng.random(batch.num_rows) * place < size)
        seen += batch.num_rows
        if not len(accepted):
            continue
        table = pa.Table.from_batches([batch]).take(pa.array(accepted))
        kept.append(table)
        start = 0
        for j, p in enumerate(place[accepted].tolist()):
            where = rng.random() * size if p > size else size
            if where < len(slots):
                slots[int(where)] = offset + j - start
            else:
                slots.append(offset + j - start)
            if len(slots) == buffer_rows or p == size:
                yield flush()
                kept, offset, start = [table.slice(j + 1)], 0, j + 1
        offset += len(accepted) - start
        if len(kept) > 64:  # many small batches with few survivors: keep only what the slots name
            joined = pa.concat_tables(kept).take(pa.array(slots, pa.int64()))
            kept, slots, offset = [joined], list(range(len(slots))), len(slots)
    if last := flush():
        yield last
    yield None, live, seen


def shard_segments(df: DataFrame, size: int, seed: int, buffer_rows: int, max_shards: int = MAX_SHARDS) -> DataFrame:
    """(shard, flush, slot, live, population, rec): records and, with slot -1, closing records."""
    rec = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("rec")).coalesce(max_shards)
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()), T.StructField("flush", T.IntegerType()),
            T.StructField("slot", T.LongType()), T.StructField("live", T.LongType()),
            T.StructField("population", T.LongType()), T.StructField("rec", rec.schema[0].dataType),
        ]
    )

    def run(batches):
        shard = TaskContext.get().partitionId()
        kind = None

        def source():
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                yield b

        for item in _segments(source(), size, buffer_rows, seed, shard):
            if item[0] is None:
                _, live, population = item
                n = max(1, len(live))
                columns = [
                    pa.array([shard] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([-1] * n, pa.int64()),
                    pa.array(live or [0], pa.int64()), pa.array([population] * n, pa.int64()), pa.nulls(n, kind) if kind is not None else None,
                ]
                if kind is not None:
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            else:
                flush, rows = item
                n = rows.num_rows
                columns = [
                    pa.array([shard] * n, pa.int32()), pa.array([flush] * n, pa.int32()), pa.array(range(n), pa.int64()),
                    pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), rows.column(0).combine_chunks(),
                ]
                yield from pa.Table.from_arrays(columns, names=schema.names).to_batches()

    return rec.mapInArrow(run, schema)


def shard_quotas(populations: list[int], size: int, rng: np.random.Generator) -> list[int]:
    """A multivariate hypergeometric draw: how many of ``size`` records each shard gives.

    ``size`` different record numbers are drawn out of all records and counted by the shard they lie
    in, which is that distribution exactly for any population below 2**63. Of more than half of the
    records, those that stay out are drawn instead.
    """
    ends = np.cumsum(np.array(populations, dtype=np.int64))
    total = int(ends[-1]) if len(ends) else 0
    size = min(size, total)
    inverse = 2 * size > total
    wanted = total - size if inverse else size
    places = np.zeros(0, np.int64)
    while len(places) < wanted:  # draws until so many are different: every set has the same chance
        places = np.unique(np.append(places, rng.integers(total, size=wanted - len(places))))
    drawn = np.bincount(np.searchsorted(ends, places, side="right"), minlength=len(ends))
    return (np.array(populations, dtype=np.int64) - drawn if inverse else drawn).tolist()


def uniform_sample(
    df: DataFrame, size: int, seed: int = 7, buffer_rows: int | None = None, max_shards: int = MAX_SHARDS
) -> DataFrame:
    """``size`` rows of ``df`` (all if it has fewer), every row with the same chance.

    Repeated rows are rows of their own, so a record that was delivered twice has two chances; nulls in any column make no difference; an empty input
    gives an empty sample. The result is fixed by the seed and the input's partitions. The tables
    of numbers are bounded by ``max_shards`` and the segments of a shard (about
    size / buffer_rows * (1 + ln(population / size))), never by the data.
    """
    if size < 1:
        raise ValueError("size must be positive")
    buffer_rows = buffer_rows or max(1, size // 8)
    segments = checkpointed(shard_segments(df, size, seed, buffer_rows, max_shards))
    closing = segments.where("slot = -1").select("shard", "flush", "live", "population")

    def draw_shards(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard").reset_index(drop=True)
        quota = shard_quotas(pdf["population"].tolist(), size, np.random.default_rng([seed, 1 << 30]))
        return pd.DataFrame({"shard": pdf["shard"], "quota": quota})

    def draw_segments(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("flush").reset_index(drop=True)
        rng = np.random.default_rng([seed, 1 << 31, int(pdf["shard"][0])])
        live = pdf["live"].to_numpy()
        if live.sum() < min(size, pdf["population"][0]):
            raise ValueError(f"shard {pdf['shard'][0]} keeps {live.sum()} records")
        q = rng.multivariate_hypergeometric(live, int(pdf["quota"][0]), method="marginals")
        return pd.DataFrame({"shard": pdf["shard"], "flush": pdf["flush"], "quota": q})

    shards = (
        closing.groupBy("shard").agg(F.max("population").alias("population"))
        .withColumn("all", F.lit(0)).groupBy("all").applyInPandas(draw_shards, "shard int, quota long")
    )
    quotas = closing.join(shards, "shard").groupBy("shard").applyInPandas(draw_segments, "shard int, flush int, quota long")
    return (
        segments.where("slot >= 0").select("shard", "flush", "slot", "rec")
        .join(F.broadcast(quotas), ["shard", "flush"])
        .where(F.col("slot") < F.col("quota"))
        .select("rec.*")
    )
