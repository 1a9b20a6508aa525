"""FASTQ and FASTA sources (survey A1, A3-A9).

``scan_fastq`` and ``read_fasta`` read through Spark and split plain files. ``read_fastq`` numbers the
records of a file, for which it streams each file in one task.
"""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FASTQ_SCHEMA = "path string, read_no long, header string, seq string, plus string, qual string, problem string"
BATCH = 10_000


def _lines(path: str):
    opener = gzip.open if path.lower().endswith(".gz") else open
    with opener(path, "rt", encoding="utf-8", newline="\n") as f:
        for line in f:
            yield line.removesuffix("\n").removesuffix("\r")


def _problem(record: list[str]) -> str | None:
    if len(record) < 4:
        return "truncated"
    header, seq, plus, qual = record
    if not header.startswith("@"):
        return "header without @"
    if not plus.startswith("+"):
        return "separator without +"
    return None if len(seq) == len(qual) else "sequence and quality differ in length"


def read_fastq(spark: SparkSession, paths: list[str], strict: bool = True) -> DataFrame:
    """Records of FASTQ files (.gz by suffix) in shared storage, with their number in the file.

    ``strict`` fails on a broken record; else ``problem`` names what is wrong with it.
    """
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))

    def read(frames):
        for pdf in frames:
            for path in pdf["path"]:
                rows, record, no = [], [], 0

                def flush(path=path):
                    nonlocal record, no
                    no += 1
                    wrong = _problem(record)
                    if wrong and strict:
                        raise ValueError(f"{wrong} at record {no} of {path}")
                    rows.append((path, no, *(record + [None] * 4)[:4], wrong))
                    record = []

                for line in _lines(path):
                    record.append(line)
                    if len(record) == 4:
                        flush()
                        if len(rows) >= BATCH:
                            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FASTQ_SCHEMA.split(", ")])
                            rows = []
                if record and any(record):
                    flush()
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in FASTQ_SCHEMA.split(", ")])

    return files.mapInPandas(read, FASTQ_SCHEMA)


def scan_fastq(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """(path, header, seq, plus, qual, problem) by Spark's own reader, from any storage that it reads.

    Plain files are split, compressed ones read as a stream. Records are what lies between line starts
    with @. A quality line that starts with @ as well breaks its record in two; only such pieces are
    brought back to their file's order and joined, all others stay where they were read. Blanks at line
    ends of the other system are removed; a first header with two @ is read with one. ``strict`` fails
    on a broken record, else ``problem`` names what is wrong with it.
    """
    raw = spark.read.option("lineSep", "\n@").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value"
    )
    text = F.regexp_replace(F.regexp_replace("value", r"\r(?=\n|\z)", ""), r"\n\z", "")
    text = F.when((F.col("block") == 0) & text.startswith("@") & text.contains("\n"), F.substr(text, F.lit(2))).otherwise(text)
    pieces = raw.select("path", "block", "at", F.split(text, "\n").alias("l")).where((F.size("l") > 1) | (F.col("l")[0] != ""))
    in_file = Window.partitionBy("path").orderBy("block", "at")
    broken = pieces.where(F.size("l") != 4).withColumns({
        "_next": F.lead(F.struct("block", "at", "l")).over(in_file), "_last": F.lag(F.struct("block", "at", "l")).over(in_file),
    })

    def joins(a: str, b: str) -> Column:
        """Whether a piece of three lines and the next one of one line are neighbours."""
        near = (F.col(f"{b}at") == F.col(f"{a}at") + 1) | (F.col(f"{b}block") != F.col(f"{a}block"))
        return F.coalesce((F.size(f"{a}l") == 3) & F.col(f"{a}l")[2].startswith("+") & (F.size(f"{b}l") == 1) & near, F.lit(False))

    mended = broken.where(~joins("_last.", "")).select(
        "path", F.when(joins("", "_next."), F.concat("l", F.array(F.concat(F.lit("@"), F.col("_next.l")[0])))).otherwise(F.col("l")).alias("l")
    )
    lines = [F.get("l", F.lit(i)) for i in range(4)]
    problem = (
        F.when(F.size("l") != 4, "truncated").when(~lines[2].startswith("+"), "separator without +")
        .when(F.length(lines[1]) != F.length(lines[3]), "sequence and quality differ in length")
    )
    records = pieces.where(F.size("l") == 4).select("path", "l").unionByName(mended).select(
        "path", F.concat(F.lit("@"), lines[0]).alias("header"), lines[1].alias("seq"), lines[2].alias("plus"), lines[3].alias("qual"), problem.alias("problem")
    )
    fault = F.raise_error(F.concat(F.col("problem"), F.lit(" at "), F.col("header"), F.lit(" of "), F.col("path")))
    return records.where(F.when(F.col("problem").isNull(), F.lit(True)).otherwise(fault)) if strict else records


def read_fasta_lenient(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A4: (path, seqname, seq) of FASTA files; a file that is cut or no archive gives no rows at all.

    A genome is one file and one row of its content, so files are what is spread over the tasks.
    """
    def run(frames):
        for pdf in frames:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    text = (gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content).decode("utf-8", "replace")
                except (EOFError, OSError, zlib.error):
                    continue
                records = [r.partition("\n") for r in ("\n" + text.replace("\r", "")).split("\n>")[1:]]
                rows = [(path, (head.split() or [""])[0], "".join(body.split()).upper()) for head, _, body in records]
                yield pd.DataFrame([r for r in rows if r[2]], columns=["path", "seqname", "seq"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "path string, seqname string, seq string")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(path, seqname, header, seq) of plain or compressed FASTA; sequences in upper case.

    A record starts at a line with >. Text before the first one makes the row's seqname null.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    value = F.regexp_replace("value", "\r", "")
    head = F.regexp_replace(F.substring_index(value, "\n", 1), r"\A>", "")
    body = F.when(F.instr(value, "\n") > 0, F.upper(F.regexp_replace(F.expr("substr(_v, instr(_v, '\n') + 1)"), r"\s+", ""))).otherwise(F.lit(""))
    return raw.withColumn("_v", value).where("trim(_v) <> ''").select(
        "path", F.regexp_extract(head, r"\A\s*(\S+)", 1).alias("seqname"), head.alias("header"), body.alias("seq")
    )


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """(path, header, seq) of FASTQ or FASTA files, whichever the first line that isn't blank shows."""
    first = spark.read.text(path).where("trim(value) <> ''").select(F.substring("value", 1, 1)).first()
    if first is None or first[0] not in ("@", ">"):
        raise ValueError(f"neither FASTA nor FASTQ: {path}")
    records = scan_fastq(spark, path) if first[0] == "@" else read_fasta(spark, path)
    return records.select("path", F.regexp_replace("header", r"\A@", "").alias("header"), F.upper("seq").alias("seq"))


def sniff(path: str) -> str:
    """``fastq`` or ``fasta`` by the first non-blank line."""
    for line in _lines(path):
        if line.strip():
            kind = {"@": "fastq", ">": "fasta"}.get(line[0])
            if kind:
                return kind
            break
    raise ValueError(f"neither FASTA nor FASTQ: {path}")
