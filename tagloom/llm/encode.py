"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 6).

Texts up to ``BLOCK_CHARS`` are encoded where they are read: a scan and no shuffle. Longer texts
are cut into blocks that are spread over the cluster and encoded in parallel, then joined as a
tree: at each join the tokens next to it are decoded and encoded again in a growing window until
both sides agree. A side agrees when its window edge is a place where the tokenizer always splits
(a blank after a visible ASCII character), when the window has reached the end of that side, or
when the re-encoded window repeats the side's own outermost tokens.

The vocabulary has a fixed size and travels as a broadcast; its path is a parameter.
"""

from __future__ import annotations

import base64
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.session import checkpointed

BLOCK_CHARS = 8192
FAN_IN = 16
#: pre-tokenizer of the byte_bpe_50k vocabulary (fixed value of the published tokenizer)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
AGREE = 4
TEXTS_AT_ONCE = 256

_loaded: dict[int, tuple] = {}


def load(ranks_file: bytes):
    """(encoding, bytes of each id) of a ranks file, kept once per Python worker."""
    key = hash(ranks_file)
    if key not in _loaded:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines() if ranks_file else ())}
        _loaded[key] = (
            tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}),
            {i: b for b, i in ranks.items()},
        )
    return _loaded[key]


def _splits_before(data: bytes, before: bytes) -> bool:
    return bool(data) and bool(before) and data[0] in b" \t\n\r" and 0x21 <= before[-1] <= 0x7E


def join_ids(left: list[int], right: list[int], encoding, token: dict[int, bytes]) -> list[int]:
    """Ids of the joined text from the ids of two neighbouring parts."""
    if not left or not right:
        return left or right
    size = 8
    while True:
        a, b = max(0, len(left) - size), min(len(right), size)
        while a > 0 and token[left[a]][0] & 0xC0 == 0x80:  # a window holds whole characters
            a -= 1
        while b < len(right) and token[right[b]][0] & 0xC0 == 0x80:
            b += 1
        text = b"".join([token[i] for i in left[a:]] + [token[i] for i in right[:b]]).decode("utf-8")
        window = encoding.encode_ordinary(text)
        left_ok = (
            a == 0 or _splits_before(token[left[a]], token[left[a - 1]])
            or (len(left) - a > AGREE and window[:AGREE] == left[a : a + AGREE])
        )
        right_ok = (
            b == len(right) or _splits_before(token[right[b]], token[right[b - 1]])
            or (b > AGREE and window[-AGREE:] == right[b - AGREE : b])
        )
        if left_ok and right_ok:
            return left[:a] + window + right[b:]
        size *= 2


def join_tree(parts: list[list[int]], encoding, token) -> list[int]:
    """Ids of the text of neighbouring parts, joined in pairs."""
    while len(parts) > 1:
        parts = [
            join_ids(parts[i], parts[i + 1], encoding, token) if i + 1 < len(parts) else parts[i]
            for i in range(0, len(parts), 2)
        ]
    return parts[0] if parts else []


def _blocks(text: str, block_chars: int) -> list[str]:
    return [text[i : i + block_chars] for i in range(0, len(text), block_chars)]


def encode_corpus(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = DEFAULT_RANKS,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(id, ids) for each row of ``df``, without special tokens.

    Null and empty texts give an empty list. Repeated and null ids stay rows of their own; strings
    that look like special tokens are ordinary text; other columns are not looked at.
    """
    spark = df.sparkSession
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    slim = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = slim.schema["_id"].dataType
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode_batches(batches, passed, names):
        encoding, _ = load(ranks.value)
        for batch in batches:
            lengths, flat = [], [np.zeros(0, np.int32)]
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):  # numbers as objects take nine times the room
                lists = [encoding.encode_ordinary(t) if t else [] for t in batch.column("_text").slice(at, TEXTS_AT_ONCE).to_pylist()]
                lengths += map(len, lists)
                flat.append(np.fromiter(chain.from_iterable(lists), dtype=np.int32))
            offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
            np.cumsum(lengths, out=offsets[1:])
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(flat)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), ids], names=names)

    length = F.length("_text")
    short = slim.where(length.isNull() | (length <= block_chars)).mapInArrow(
        lambda batches: encode_batches(batches, ["_id"], [id_col, "ids"]), out
    )

    part = T.StructType(
        [T.StructField("_row", T.LongType()), T.StructField("_id", id_type), T.StructField("no", T.LongType())]
    )

    def cut(batches):
        for batch in batches:
            row, key, text = (batch.column(c) for c in ("_row", "_id", "_text"))
            for i in range(batch.num_rows):
                pieces = _blocks(text[i].as_py(), block_chars)
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [row.take(pa.array([i] * n)), key.take(pa.array([i] * n)), pa.array(range(n), pa.int64()), pa.array(pieces, pa.string())],
                    names=["_row", "_id", "no", "_text"],
                )

    ids_field = T.StructField("ids", T.ArrayType(T.IntegerType()))
    blocks = (
        slim.where(length > block_chars)
        .withColumn("_row", F.monotonically_increasing_id())
        .mapInArrow(cut, T.StructType([*part.fields, T.StructField("_text", T.StringType())]))
        .repartition("_row", "no")
    )
    nodes = checkpointed(
        blocks.mapInArrow(
            lambda batches: encode_batches(batches, ["_row", "_id", "no"], ["_row", "_id", "no", "ids"]),
            T.StructType([*part.fields, ids_field]),
        )
    )

    def join_group(pdf: pd.DataFrame) -> pd.DataFrame:
        encoding, token = load(ranks.value)
        pdf = pdf.sort_values("no")
        ids = join_tree([list(map(int, x)) for x in pdf["ids"]], encoding, token)
        return pd.DataFrame({"_row": pdf["_row"].iloc[:1], "_id": pdf["_id"].iloc[:1], "no": [int(pdf["no"].iloc[0]) // FAN_IN], "ids": [ids]})

    many = (nodes.agg(F.max("no")).first()[0] or 0) + 1
    while many > 1:
        nodes = nodes.groupBy("_row", F.expr(f"no div {FAN_IN}")).applyInPandas(join_group, T.StructType([*part.fields, ids_field]))
        many = -(-many // FAN_IN)
    return short.unionByName(nodes.select(F.col("_id").alias(id_col), "ids"))
