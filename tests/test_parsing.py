import json

from tagloom.operators import parsing

SCHEMA = "raw_id long, layout string, raw string, value string, header string"


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "v", "clash") for i, r in enumerate(rows)], SCHEMA)


VALID = [
    ("fastq", "@a 1\nACGTN\n+\n!~FFF"),
    ("fastq", "@a\r\nacgtn\r\n+x\r\nFFFFF\r\n"),
    ("tsv", "@a\tA\t+\t\""),
    ("json", json.dumps(["@a\t\"q\"", "AC", "+", "\\F"])),
    ("json", ' [\n "@a", "\\u0041C" , "+","FF"]\n'),
    ("fastq", "@long\n" + "A" * 300_000 + "\n+\n" + "F" * 300_000 + "\n"),
]
BROKEN = {
    ("fastq", None): ["no_value"],
    (None, "@a\nA\n+\nF"): ["unknown_layout"],
    ("csv", "@a,A,+,F"): ["unknown_layout"],
    ("fastq", ""): ["column_count"],
    ("fastq", "@a\nA\n+\nF\n\n"): ["column_count"],
    ("fastq", "a\nA\n+\nF"): ["header_without_at"],
    ("fastq", "@ a\nA\n+\nF"): ["header_blank"],
    ("fastq", "@ a\nA\n+\nF"): ["header_blank"],
    ("fastq", "@\nA\n+\nF"): ["header_blank"],
    ("fastq", "@a\n\n+\n"): ["column_count"],
    ("fastq", "@a\n\n+\n\n"): ["seq_empty"],
    ("fastq", "@a\nAX\n-\nF F"): ["plus_missing", "qual_characters", "qual_length", "seq_alphabet"],
    ("tsv", "@a\tA\t+\tF\n"): ["qual_characters", "qual_length"],
    ("json", '["@a","A","+","F"] x'): ["json_not_four_strings"],
    ("json", '["@a","A","+",1]'): ["json_not_four_strings"],
    ("json", "['@a','A','+','F']"): ["json_not_four_strings"],
    ("json", '["@a","A","+","\\q"]'): ["json_not_four_strings"],
    ("json", '["@a","A","+","F",]'): ["json_not_four_strings"],
}


def test_reasons(spark):
    rows = VALID + list(BROKEN)
    got = {r["raw_id"]: r["reasons"] for r in parsing.rejected(frame(spark, rows)).collect()}
    assert got == {i + len(VALID): v for i, v in enumerate(BROKEN.values())}


def test_clean_rows_are_loaded_with_clashing_names(spark):
    rows = VALID + list(BROKEN)
    out = parsing.load_valid(frame(spark, rows))
    assert out.columns.count("header") == 1 and "value" in out.columns
    got = {r["raw_id"]: (r["header"], r["seq"]) for r in out.collect()}
    assert got[3] == ('@a\t"q"', "AC") and got[4] == ("@a", "AC") and len(got) == len(VALID)


def test_null_ids_repeats_and_empty(spark):
    rows = [(None, "fastq", "@a\nA\n+\nF", "v", "h"), (None, "fastq", "bad", "v", "h"), (1, "fastq", "bad", "v", "h"), (1, "fastq", "bad", "v", "h")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(parsing.rejected(df).collect(), key=str) == sorted(
        [(1, ["column_count"]), (None, ["column_count"])], key=str
    )
    assert [r["raw_id"] for r in parsing.load_valid(df).collect()] == [None]
    assert parsing.rejected(df.limit(0)).count() == 0 and parsing.load_valid(df.limit(0)).count() == 0
