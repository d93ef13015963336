"""Reading bulk text: what is a value, what is an error, what is null."""

import datetime as dt
from decimal import Decimal

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows_of, text_files
from tallybook.functions.typing import lenient, strict
from tallybook.schemas import BULK, CODES, COMPACT_DATE, RAW, SLASH_DATE, BulkFormat, columns
from tallybook.sources.delimited import (
    header_names, read_delimited, read_lenient, read_text_columns, read_with_dictionary, write_delimited,
)

SCHEMA = columns("id string, flag string, day date, paid amount, note string")
TRAILING = BulkFormat(SCHEMA, COMPACT_DATE, trailing_delimiter=True)
GOOD = [("C1", "N", dt.date(2024, 1, 1), Decimal("12.50"), "x"), ("C3", "A", None, Decimal("7.00"), 'he said "hi')]


def test_trailing_delimiter_stray_quote_and_empty_fields(spark, tmp_path):
    path = text_files(tmp_path, a=["C1|N|01012024|12.5|x|", 'C3|A||7|he said "hi|'])
    assert rows_of(read_delimited(spark, path, TRAILING)) == GOOD


@pytest.mark.parametrize("line", [
    "C2||13452024|1|x|", "C2||01012024|abc|x|", "C2|N|01012024|1", "C2|N|01012024|1|x||more"])
def test_strict_read_fails_on_a_bad_line(spark, tmp_path, line):
    rows = read_delimited(spark, text_files(tmp_path, a=[line]), TRAILING)
    with pytest.raises((PySparkException, Py4JJavaError)):
        rows.collect()
    if line.count("|") != 5:
        with pytest.raises((PySparkException, Py4JJavaError)):
            rows.select("id").collect()


def test_lenient_read_turns_bad_values_null(spark, tmp_path):
    path = text_files(tmp_path, a=['C2||13452024|abc|""|', "C4|A", "C1|N|01012024|12.5|x|"])
    assert rows_of(read_lenient(spark, path, TRAILING)) == [GOOD[0], ("C2", None, None, None, '""')]


def test_numbers_out_of_range(spark, tmp_path):
    path, bulk = text_files(tmp_path, a=["99999|99999", "2024|x", "-1|12345678901"]), BulkFormat(columns("y smallint, n int"))
    assert rows_of(read_lenient(spark, path, bulk)) == [(-1, None), (2024, None), (None, 99999)]
    with pytest.raises(PySparkException):
        read_delimited(spark, path, bulk).collect()


def test_bulk_text_is_unquoted_so_quotes_do_not_hide_delimiters(spark, tmp_path):
    path = text_files(tmp_path, a=['C5|"q|r"'])
    assert rows_of(read_text_columns(spark, path, columns("a string, b string, c string"))) == [("C5", '"q', 'r"')]
    quoted = read_text_columns(spark, path, columns("a string, b string"), quoted=True)
    assert rows_of(quoted) == [("C5", "q|r")]


def test_first_line_is_data_unless_said_to_be_a_header(spark, tmp_path):
    path, bulk = text_files(tmp_path, a=["id|n", "C1|2"]), BulkFormat(columns("id string, n string"))
    assert len(rows_of(read_delimited(spark, path, bulk))) == 2
    assert rows_of(read_delimited(spark, path, bulk, header=True)) == [("C1", "2")]


def test_header_file_orders_the_columns(spark, tmp_path):
    bulk = BulkFormat(columns("id string, n int"))
    names = text_files(tmp_path / "names", a=["n,id"])
    path = text_files(tmp_path / "data", a=["2|C1"])
    assert header_names(spark, names) == ["n", "id"]
    assert rows_of(read_with_dictionary(spark, path, names, bulk)) == [("C1", 2)]


def test_header_file_with_other_columns_is_refused(spark, tmp_path):
    names = text_files(tmp_path / "names", a=["id,n,more"])
    with pytest.raises(ValueError, match="more"):
        read_with_dictionary(spark, str(tmp_path), names, BulkFormat(columns("id string, n int")))


def test_text_survives_being_written_and_read(spark, tmp_path):
    rows = [(" lead", 'q"uo"te', "back\\slash"), ("pi|pe", '"start', "trail "), ("é", None, "a")]
    schema = columns("a string, b string, c string")
    write_delimited(spark.createDataFrame(rows, schema), f"{tmp_path}/t")
    assert rows_of(read_text_columns(spark, f"{tmp_path}/t", schema, header=True, quoted=True)) == sorted(rows)


@pytest.mark.parametrize("text, fmt, day", [
    ("02292024", COMPACT_DATE, dt.date(2024, 2, 29)), ("02/29/2024", SLASH_DATE, dt.date(2024, 2, 29)),
    ("2/3/2024", SLASH_DATE, dt.date(2024, 2, 3)), (None, COMPACT_DATE, None)])
def test_dates(spark, text, fmt, day):
    frame = spark.createDataFrame([(text,)], "t string")
    both = frame.select(strict(F.col("t"), T.DateType(), fmt), lenient(F.col("t"), T.DateType(), fmt))
    assert rows_of(both) == [(day, day)]


@pytest.mark.parametrize("text, fmt", [("02302024", COMPACT_DATE), ("13/1/2024", SLASH_DATE), ("x", SLASH_DATE)])
def test_days_that_do_not_exist(spark, text, fmt):
    frame = spark.createDataFrame([(text,)], "t string")
    assert rows_of(frame.select(lenient(F.col("t"), T.DateType(), fmt))) == [(None,)]
    with pytest.raises(PySparkException):
        frame.select(strict(F.col("t"), T.DateType(), fmt)).collect()


def test_strict_reads_also_fail_where_casts_would_hide_bad_values(spark, tmp_path):
    bad = text_files(tmp_path / "bad", a=["C2||01012024|abc|x|"])
    good = text_files(tmp_path / "good", a=["C1|N|01012024|12.5|x|", 'C3|A||7|he said "hi|'])
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert rows_of(read_delimited(spark, good, TRAILING)) == GOOD
        with pytest.raises((PySparkException, Py4JJavaError), match="abc"):
            read_delimited(spark, bad, TRAILING).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_declared_layouts():
    assert {name: len(schema) for name, schema in RAW.items()} == {
        "candidates": 15, "cand_cmte_link": 7, "committees": 15, "committee_trans": 21, "independent_exp": 22,
        "indiv_contributions": 21, "operating_exp": 25, "political_parties": 2, "committee_types": 2,
        "report_types": 2, "transaction_types": 2}
    assert all(name == name.upper() for bulk in BULK.values() for name in bulk.names)
    assert all(name == name.lower() for schema in CODES.values() for name in schema.fieldNames())
    assert [n for n, bulk in BULK.items() if bulk.trailing_delimiter] == ["operating_exp"]
