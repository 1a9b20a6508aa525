"""Text sinks: records, matrices and their number formats (survey B1, B8, B11-B13, B15, B18, C13, C31)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: characters that a file cannot hold within a field
BREAKS = re.compile(r"[\t\r\n]")
#: characters of the lines that go to the JVM at once
BATCH_CHARS = 1 << 20


def fasta_record(name: Column, seq: Column) -> Column:
    """Two lines; sequence in upper case."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.upper(seq))


def fastq_record(header: Column, seq: Column, qual: Column, plus: Column | None = None) -> Column:
    return F.concat_ws("\n", header, seq, plus if plus is not None else F.lit("+"), qual)


def write_records(df: DataFrame, record: Column, path: str, compressed: bool = True, mode: str = "errorifexists") -> None:
    """B1: one record per row as text; Spark's commit makes it appear as a whole."""
    df.select(record.alias("value")).where("value is not null").write.mode(mode).text(path, compression="gzip" if compressed else "none")


def hit_name(name: Column, strand: Column, start: Column, width: int = 50) -> Column:
    """name_strand_start, dots on the left up to the width, the last ``width`` characters of longer ones."""
    return F.right(F.concat(F.repeat(F.lit("."), F.lit(width)), F.concat_ws("_", name, strand, start.cast("string"))), F.lit(width))


def padded_reference(tag: Column, n: int = 58) -> Column:
    """B18."""
    return F.concat(tag, F.repeat(F.lit("A"), F.lit(n)))


def rendered(value: Column, form: str = ".12g", missing: str = "NA") -> Column:
    """C-style number text, which Java's formatter doesn't give; for exports only."""

    @F.pandas_udf("string")
    def render(x: pd.Series) -> pd.Series:
        return x.map(lambda v: missing if pd.isna(v) else format(v, form))

    return render(value.cast("double"))


def write_tsv(df: DataFrame, path: str, order: list[str], form: str = ".12g", mode: str = "errorifexists", one_file: bool = False) -> None:
    """Sorted rows; doubles by ``form``, nulls NA.

    The order runs over the part files, each of which has the header. ``one_file`` is for tables that
    are known to be small: it takes all rows through one task.
    """
    out = df.orderBy(*order).select(
        *[rendered(F.col(f"`{c}`"), form).alias(c) if t == "double" else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NA")).alias(c) for c, t in df.dtypes]
    )
    (out.coalesce(1) if one_file else out).write.mode(mode).option("sep", "\t").option("quote", "").option("header", True).csv(path)


def write_matrix(df: DataFrame, path: str, row: str, column: str, value: str, names: list[str | None], form: str = ".12g", mode: str = "errorifexists") -> None:
    """One line a row of ``df``'s cells, sorted, one field for each of ``names``; values of a cell added up, missing 0.

    A field is a place in a line and no column of a plan, so a task holds one line, however many names there are.
    Each part file has the header. A cell without a column name counts as missing, the field of such a name has an empty head.
    """
    if wrong := [n for n in names if n is not None and (n == "" or BREAKS.search(n))]:
        raise ValueError(f"a header cannot hold the names {wrong[:5]}")
    header = "\t".join([row, *["" if n is None else n for n in names]])
    place = {n: k for k, n in enumerate(names)}

    def rendered_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[str]:
        yield header
        at, fields = None, []
        for batch in batches:
            for r, c, v in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if r != at:
                    if BREAKS.search(r):
                        raise ValueError(f"a line cannot hold the row {r!r}")
                    if at is not None:
                        yield "\t".join([at, *fields])
                    at, fields = r, ["0"] * len(names)
                if c is not None and v is not None:
                    fields[place[c]] = format(v, form)
        if at is not None:
            yield "\t".join([at, *fields])

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chars = [], 0
        for line in rendered_rows(batches):
            held.append(line)
            chars += len(line)
            if chars >= BATCH_CHARS:
                yield pa.RecordBatch.from_pydict({"value": pa.array(held, "string")})
                held, chars = [], 0
        yield pa.RecordBatch.from_pydict({"value": pa.array(held, "string")})

    if names:
        cells = df.groupBy(row, column).agg(F.sum(F.col(value).cast("double")).alias(value))
        out = cells.repartitionByRange(row).sortWithinPartitions(row).mapInArrow(lines, "value string")
    else:  # no cells, which could leave no part file
        out = df.sparkSession.createDataFrame([(header,)], "value string")
    out.write.mode(mode).text(path)


def write_id_map(genomes: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """source_id and genome_id with a header."""
    write_tsv(genomes.select("source_id", "genome_id"), path, ["genome_id"], mode=mode)


def write_taxonomy(genomes: DataFrame, path: str, lineage: tuple[str, ...], mode: str = "errorifexists") -> None:
    """genome_id, lineage and genome path in the order of the ids, compressed."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in ("genome_id", *lineage, "genome_path")])
    genomes.orderBy("genome_id").select(line.alias("value")).write.mode(mode).text(path, compression="gzip")


def dump_tags(master: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """B2: a database's tags back as FASTA, one record for each tag and genome, named genome_copies."""
    write_records(master, fasta_record(F.concat_ws("_", "genome_id", F.col("copies").cast("string")), F.col("tag")), path, mode=mode)
