"""Rows that fail to parse: validated loading of raw reads (problem 1).

Every raw value is split into cells by its layout, the cells are exploded into
(row, column, value), each cell meets the rules of its column from a small rule table, the
broken rules are aggregated per row, and the clean rows are the anti-join with the rows that
have errors. Everything is a built-in expression; the only shuffles are the aggregate (one
small row per raw row after the map-side combine) and the anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("header", "seq", "plus", "qual")

#: A JSON array of exactly four strings after every legal escape was replaced by ``x``.
_JSON_STRING = r'"[^"\\\x00-\x1f]*"'
_WS = r"[ \t\r\n]*"
JSON_FOUR = rf"\A{_WS}\[{_WS}" + rf"{_WS},{_WS}".join([_JSON_STRING] * 4) + rf"{_WS}\]{_WS}\z"
JSON_ESCAPE = r'\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})'

#: column number, reason, pattern that a valid value matches; a rule's number is its place here
RULES = (
    (0, "header_without_at", r"\A@"),
    (0, "header_blank", r"\A(?:@[^\h\v]|[^@]|\z)"),
    (1, "seq_empty", r"\A[\s\S]"),
    (1, "seq_alphabet", r"\A[ACGTNacgtn]*\z"),
    (2, "plus_missing", r"\A\+"),
    (3, "qual_characters", r"\A[!-~]*\z"),
)


def rule_table(spark: SparkSession) -> DataFrame:
    """The rules as a table; its size is fixed by ``RULES``."""
    return spark.createDataFrame([(i, *rule) for i, rule in enumerate(RULES)], "rule_no int, column_no int, reason string, pattern string")


def holds(rule_no: Column, value: Column) -> Column:
    """Whether a value obeys a rule; each pattern is compiled once, as it is written into the plan."""
    verdict = F.lit(None).cast("boolean")
    for i, (_, _, pattern) in enumerate(RULES):
        verdict = F.when(rule_no == i, value.rlike(pattern)).otherwise(verdict)
    return verdict


def parse_cells(layout: Column, raw: Column) -> Column:
    """Cells of a raw value by layout; null where it has no cells at all.

    fastq: lines ended by LF or CRLF, the last line end may be missing. tsv: split by tabs.
    json: a strict JSON array of four strings, anything else gives null.
    """
    strict = F.regexp_replace(raw, JSON_ESCAPE, "x").rlike(JSON_FOUR)
    return (
        F.when(layout == "fastq", F.split(F.regexp_replace(raw, r"\r?\n\z", ""), r"\r?\n", -1))
        .when(layout == "tsv", F.split(raw, "\t", -1))
        .when((layout == "json") & strict, F.from_json(raw, "array<string>"))
    )


def _keyed(reads: DataFrame, layout: str, raw: str) -> DataFrame:
    """Rows with the key of their verdict: it depends on nothing but layout and raw value."""
    return reads.withColumn("_content", F.xxhash64(F.col(layout), F.col(raw)))


def find_errors(
    reads: DataFrame, id_col: str = "raw_id", layout: str = "layout", raw: str = "raw"
) -> DataFrame:
    """One row (id, _content, reasons) for each row that holds no single valid read.

    Null raw, null or unknown layout: reason ``no_value`` or ``unknown_layout``. A wrong number
    of cells gives ``column_count`` and no cell rules are tried. Repeated rows (same id and same
    content) share one error row; rows with the same id and other content are judged apart; a
    null id is an id like any other. Other columns of the input are not looked at.
    """
    spark = reads.sparkSession
    slim = _keyed(
        reads.select(
            F.col(id_col).alias("_id"), F.col(layout).alias("layout"), F.col(raw).alias("raw")
        ),
        "layout",
        "raw",
    )
    cells = slim.select(
        "_id", "_content", "layout", F.col("raw").isNull().alias("_null"),
        parse_cells(F.col("layout"), F.col("raw")).alias("cells"),
    ).withColumn(
        "whole",
        F.when(F.col("_null"), "no_value")
        .when(F.col("layout").isNull() | ~F.col("layout").isin("fastq", "tsv", "json"), "unknown_layout")
        .when(F.col("cells").isNull(), "json_not_four_strings")
        .when(F.size("cells") != len(COLUMNS), "column_count"),
    )
    exploded = cells.select(
        "_id", "_content", "whole",
        F.posexplode_outer(F.when(F.col("whole").isNull(), F.col("cells"))).alias("column_no", "value"),
    )
    judged = exploded.join(F.broadcast(rule_table(spark)), "column_no", "left").select(
        "_id", "_content",
        F.coalesce("whole", F.when(~holds(F.col("rule_no"), F.col("value")), F.col("reason"))).alias("reason"),
        F.when(F.col("column_no") == 1, F.length("value")).alias("seq_length"),
        F.when(F.col("column_no") == 3, F.length("value")).alias("qual_length"),
    )
    return (
        judged.groupBy("_id", "_content")
        .agg(
            F.collect_set("reason").alias("reasons"),
            F.max("seq_length").alias("seq_length"),
            F.max("qual_length").alias("qual_length"),
        )
        .select(
            F.col("_id").alias(id_col), "_content",
            F.array_sort(
                F.when(
                    F.col("seq_length") != F.col("qual_length"),
                    F.array_union("reasons", F.array(F.lit("qual_length"))),
                ).otherwise(F.col("reasons"))
            ).alias("reasons"),
        )
        .where(F.size("reasons") > 0)
    )


def rejected(reads: DataFrame, id_col: str = "raw_id", layout: str = "layout", raw: str = "raw") -> DataFrame:
    """(id, reasons) of the rows set apart."""
    return find_errors(reads, id_col, layout, raw).drop("_content")


def load_valid(reads: DataFrame, id_col: str = "raw_id", layout: str = "layout", raw: str = "raw") -> DataFrame:
    """The valid rows with their cells as columns header, seq, plus, qual beside the input's.

    Input columns of those names are replaced by the parsed values.
    """
    errors = find_errors(reads, id_col, layout, raw).select(F.col(id_col).alias("_bad_id"), F.col("_content").alias("_bad"))
    keyed = _keyed(reads, layout, raw)
    clean = keyed.join(
        errors, keyed["_content"].eqNullSafe(errors["_bad"]) & keyed[id_col].eqNullSafe(errors["_bad_id"]), "left_anti"
    )
    cells = clean.withColumn("_cells", parse_cells(F.col(layout), F.col(raw)))
    return cells.withColumns({c: F.col("_cells")[i] for i, c in enumerate(COLUMNS)}).drop("_cells", "_content")
