"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.seq import canonical_read_id
from tagloom.llm import encode, frequent, leak, lookalike, names, sample, seen
from tagloom.session import table

SAMPLE_SIZE = 50_000


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        seen.arrivals(table(spark, sf_dir, name), side, "arrival_no", canonical_read_id(F.col("id")))
        for side, name in (("forward", "forward_seen"), ("reverse", "reverse_reads"))
    ]
    return sides[0].unionByName(sides[1])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen.seen_before(_arrivals(spark, sf_dir)).select("side", F.col("order_no").alias("arrival_no"))


def p2_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen.error_rates(_arrivals(spark, sf_dir))


def p3_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.uniform_sample(table(spark, sf_dir, "fastq_records"), SAMPLE_SIZE)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent.heavy_hitters(table(spark, sf_dir, "fastq_records"), F.upper("seq"), 200, "seq").select("seq")


def p4_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequent.most_frequent(table(spark, sf_dir, "fastq_records"), F.upper("seq"), 1000, "seq")


def _reference(spark: SparkSession, sf_dir: str) -> list[str]:
    return names.reference_names(table(spark, sf_dir, "database_genomes"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "rna_species_abundance")
    return names.map_rows(rows, _reference(spark, sf_dir), "entry_id").select("entry_id", F.col("canonical").alias("species"))


def p5_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.unmatched(table(spark, sf_dir, "rna_species_abundance"), _reference(spark, sf_dir))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p7_leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return leak.without_leaks(docs, p7_leaks(spark, sf_dir)).select("doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.same_looking_pairs(table(spark, sf_dir, "documents"))


def p8_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.same_looking_classes(table(spark, sf_dir, "documents"))


def p8_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lookalike.canonical_texts(docs, lookalike.count_spellings(docs))


QUERIES = {
    "p2_found": p2_found, "p2_error_rate": p2_error_rate, "p3_sample": p3_sample,
    "p4_found": p4_found, "p4_top": p4_top, "p5_found": p5_found, "p5_unmatched": p5_unmatched,
    "p6_ids": p6_ids, "p7_found": p7_found, "p7_leaks": p7_leaks, "p7_clean": p7_clean,
    "p8_found": p8_found, "p8_classes": p8_classes, "p8_canonical": p8_canonical,
}

_KEY = r"""nullif(regexp_replace(regexp_extract(id, '^[\s\x0b\x{85}\p{Z}]*[@>]*[\s\x0b\x{85}\p{Z}]*([^\s\x0b\x{85}\p{Z}]+)', 1), '/[12]\z', ''), '')"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _form_sql(column: str) -> str:
    """The table's form of a text: what DuckDB's NFC leaves is replaced character by character."""
    one, more, hidden = {}, {}, []
    for c in map(chr, [*range(0x80, 0xD800), *range(0xF900, 0x10000)]):
        seen = lookalike.fold(c)
        if not seen:
            hidden.append(ord(c))
        elif seen != unicodedata.normalize("NFC", c):
            (one if len(seen) == 1 else more)[c] = seen
    out = f"regexp_replace({column}, '[{''.join(f'\\x{{{x:X}}}' for x in hidden)}]', '', 'g')"
    for c, seen in more.items():
        out = f"replace({out}, {_quoted(c)}, {_quoted(seen)})"
    return f"nfc_normalize(translate({out}, {_quoted(''.join(one))}, {_quoted(''.join(one.values()))}))"


_FORMS = f"forms AS (SELECT doc_id, text, {_form_sql('text')} AS form FROM documents WHERE text <> '')"
_GRAMS = """{name} AS (SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS gram FROM (
      SELECT {key}, regexp_extract_all(lower({form}), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source}))"""
_LEAKS = f"""{_GRAMS.format(name='i', key='item_id', form=_form_sql('text'), source="benchmark WHERE text <> ''")},
      d AS (SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS gram FROM (
        SELECT doc_id, regexp_extract_all(lower(form), '[\\p{{L}}\\p{{N}}]+') AS w FROM forms)) SEMI JOIN i USING (gram)),
      leaks AS (SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (gram))"""

ORACLES = {
    "p7_found": f"WITH {_FORMS}, {_LEAKS} SELECT doc_id, item_id FROM leaks",
    "p7_clean": f"WITH {_FORMS}, {_LEAKS} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM leaks)",
    "p8_found": f"""WITH {_FORMS}, several AS (SELECT form FROM forms GROUP BY form HAVING min(text) <> max(text)), s AS (SELECT * FROM forms SEMI JOIN several USING (form))
      SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM s a JOIN s b ON a.form = b.form AND a.text <> b.text AND a.doc_id < b.doc_id""",
    "p8_classes": f"""WITH {_FORMS}, own AS (SELECT form, text, count(*) AS own FROM forms GROUP BY ALL),
      c AS (SELECT form, sum(own)::BIGINT AS every, count(*) AS writings FROM own GROUP BY form), m AS (SELECT form, min(doc_id) AS class FROM forms GROUP BY form)
      SELECT doc_id, class, writings, every - own AS links FROM forms JOIN own USING (form, text) JOIN c USING (form) JOIN m USING (form)""",
    "p2_found": f"""
      WITH rows AS (
        SELECT 'forward' AS side, arrival_no, {_KEY} AS k FROM forward_seen
        UNION ALL SELECT 'reverse', arrival_no, {_KEY} FROM reverse_reads)
      SELECT side, arrival_no FROM (
        SELECT *, min(arrival_no) OVER (PARTITION BY side, k) AS first_no FROM rows WHERE k IS NOT NULL)
      WHERE arrival_no > first_no""",
    "p4_found": """
      SELECT upper(seq) AS seq FROM fastq_records WHERE seq IS NOT NULL GROUP BY upper(seq)
      HAVING count(*) * 200 >= (SELECT count(*) FROM fastq_records)""",
    "p4_top": """
      SELECT upper(seq) AS seq, count(*) AS n FROM fastq_records WHERE seq IS NOT NULL
      GROUP BY upper(seq) ORDER BY n DESC, seq LIMIT 1000""",
}
