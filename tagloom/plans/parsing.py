"""Queries of problem 1 over raw_fastq."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators import parsing
from tagloom.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.rejected(table(spark, sf_dir, "raw_fastq")).select("raw_id").distinct()


def p1_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.rejected(table(spark, sf_dir, "raw_fastq")).select(
        "raw_id", F.concat_ws(",", "reasons").alias("reasons")
    )


def p1_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.load_valid(table(spark, sf_dir, "raw_fastq")).select(
        "raw_id", "library_id", "header", "seq", "plus", "qual"
    )


QUERIES = {"p1_found": p1_found, "p1_rejects": p1_rejects, "p1_loaded": p1_loaded}

_CELLS = r"""
raw_cells AS (
  SELECT *, CASE
    WHEN layout = 'fastq' THEN regexp_split_to_array(regexp_replace(raw, '\r?\n\z', ''), '\r?\n')
    WHEN layout = 'tsv' THEN string_split(raw, chr(9))
    WHEN layout = 'json' AND regexp_full_match(
        regexp_replace(raw, '\\(["\\/bfnrt]|u[0-9a-fA-F]{4})', 'x', 'g'),
        '[ \t\r\n]*\[[ \t\r\n]*"[^"\\\x00-\x1f]*"([ \t\r\n]*,[ \t\r\n]*"[^"\\\x00-\x1f]*"){3}[ \t\r\n]*\][ \t\r\n]*')
      THEN [json_extract_string(raw, '$[0]'), json_extract_string(raw, '$[1]'),
            json_extract_string(raw, '$[2]'), json_extract_string(raw, '$[3]')]
    END AS cells
  FROM raw_fastq),
judged AS (
  SELECT *, coalesce(len(cells) = 4
      AND regexp_matches(cells[1], '^@[^\s\x0b\x{85}\p{Z}]')
      AND regexp_full_match(cells[2], '[ACGTNacgtn]+')
      AND starts_with(cells[3], '+')
      AND regexp_full_match(cells[4], '[!-~]+')
      AND length(cells[2]) = length(cells[4]), false) AS valid
  FROM raw_cells)
"""

_WHOLE = """CASE WHEN raw IS NULL THEN 'no_value' WHEN layout IS NULL OR layout NOT IN ('fastq', 'tsv', 'json') THEN 'unknown_layout'
    WHEN cells IS NULL THEN 'json_not_four_strings' WHEN len(cells) <> 4 THEN 'column_count' END"""
_BROKEN = r"""list_sort(list_filter([
    CASE WHEN NOT starts_with(cells[1], '@') THEN 'header_without_at' END,
    CASE WHEN regexp_matches(cells[1], '^@([\s\x0b\x{85}\p{Z}]|$)') THEN 'header_blank' END,
    CASE WHEN cells[2] = '' THEN 'seq_empty' END,
    CASE WHEN NOT regexp_full_match(cells[2], '[ACGTNacgtn]*') THEN 'seq_alphabet' END,
    CASE WHEN NOT starts_with(cells[3], '+') THEN 'plus_missing' END,
    CASE WHEN NOT regexp_full_match(cells[4], '[!-~]*') THEN 'qual_characters' END,
    CASE WHEN length(cells[2]) <> length(cells[4]) THEN 'qual_length' END], lambda x: x IS NOT NULL))"""

ORACLES = {
    "p1_rejects": f"""WITH {_CELLS}, w AS (SELECT raw_id, {_WHOLE} AS whole, cells FROM raw_cells),
      r AS (SELECT raw_id, coalesce(whole, array_to_string({_BROKEN}, ',')) AS reasons FROM w)
      SELECT raw_id, reasons FROM r WHERE reasons <> ''""",
    "p1_found": f"WITH {_CELLS} SELECT raw_id FROM judged WHERE NOT valid",
    "p1_loaded": f"""WITH {_CELLS} SELECT raw_id, library_id, cells[1] AS header, cells[2] AS seq,
        cells[3] AS plus, cells[4] AS qual FROM judged WHERE valid""",
}
