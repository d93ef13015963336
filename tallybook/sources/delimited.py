"""Pipe-delimited text, read in splits by every executor."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.typing import cast_to_schema, try_cast_to_schema, unconvertible
from tallybook.operators.frames import drop_trailing_column, rename_positional
from tallybook.schemas import BulkFormat, as_text

DELIMITER = "|"
# Columns beside the data: the file a row came from, and its line if that does not fit.
FILE, MALFORMED = "_file", "_malformed"
# A whole line, where lines are moved as they are.
LINE = "_line"
# Bulk lines have no quoting: a quote sign is an ordinary character there.
UNQUOTED = {"sep": DELIMITER, "quote": ""}
# Code tables are written with a header, and with quotes where a value needs them.
QUOTED = {"sep": DELIMITER, "quote": '"', "escape": '"'}
EXACT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_text_columns(spark: SparkSession, path: str, schema: T.StructType, header: bool = False,
                      quoted: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """All columns as text under the declared names, by position.

    A permissive read fills a short line with nulls and drops what a long one
    has too much. With FAILFAST either fails the job; lines are then split
    whole, because a wrong count does not show in columns left out.
    """
    style = QUOTED if quoted else UNQUOTED
    reader = spark.read.schema(as_text(schema)).option("columnPruning", mode != "FAILFAST")
    return reader.csv(path, header=header, mode=mode, **style, **EXACT)


def delimited_files(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                    quoted: bool = True) -> DataFrame:
    """Rows of delimited text with the file each came from, and the line if its column count is wrong.

    Every line is split whole (columnPruning off), because Spark does not
    notice a wrong count in columns it was allowed to leave out.
    """
    fields = as_text(schema).add(MALFORMED, T.StringType())
    reader = spark.read.schema(fields).option("columnPruning", False)
    rows = reader.csv(path, header=header, columnNameOfCorruptRecord=MALFORMED,
                      **(QUOTED if quoted else UNQUOTED), **EXACT)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))


def read_delimited(spark: SparkSession, path: str, bulk: BulkFormat, header: bool = False,
                   dictionary: str | None = None) -> DataFrame:
    """A bulk file in its declared types; a line or a value that does not fit fails the job.

    ``dictionary`` names the dataset's header file, which then gives the column order.
    """
    return cast_to_schema(strict_lines(spark, path, bulk, header, dictionary), bulk.schema, bulk.date_format)


def strict_lines(spark: SparkSession, path: str, bulk: BulkFormat, header: bool = False,
                 dictionary: str | None = None) -> DataFrame:
    """All lines of a bulk file as text columns; one with a wrong field count fails the job."""
    names = file_order(spark, dictionary, bulk)
    text = read_text_columns(spark, path, _numbered(bulk, names), header, mode="FAILFAST")
    if bulk.trailing_delimiter:
        text = drop_trailing_column(text)
    return rename_positional(text, names)


def lenient_lines(spark: SparkSession, path: str, bulk: BulkFormat, header: bool = False,
                  dictionary: str | None = None) -> DataFrame:
    """All lines of a bulk file as text columns, with the file, and the whole line if its field count is wrong."""
    names = file_order(spark, dictionary, bulk)
    rows = delimited_files(spark, path, _numbered(bulk, names), header, quoted=False)
    return rename_positional(rows, names).select(*bulk.names, MALFORMED, FILE)


def split_lines(spark: SparkSession, path: str, bulk: BulkFormat, dictionary: str | None = None) -> DataFrame:
    """What ``lenient_lines`` gives of files without a header line, and the line itself, by its delimiters alone.

    Without quotes a line needs no parser, which takes several times as long.
    """
    names = file_order(spark, dictionary, bulk)
    shown = F.col("value").contains(DELIMITER) | F.col("value").rlike(r"[^\x00-\x20]")  # blank lines are no rows
    lines = spark.read.text(path).where(shown).select(F.make_valid_utf8("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))
    fields = lines.withColumn("_fields", _fields(F.col(LINE)))
    malformed = F.when(F.size("_fields") != len(names) + bulk.trailing_delimiter, F.col(LINE))
    return fields.select(*_by_name(names, bulk), malformed.alias(MALFORMED), FILE, LINE)


def line_columns(lines: DataFrame, bulk: BulkFormat, names: list[str]) -> DataFrame:
    """Whole lines with the right field count as text columns; ``names`` has the order of the fields."""
    return lines.select(_fields(F.col(LINE)).alias("_fields")).select(*_by_name(names, bulk))


def line_field(name: str, bulk: BulkFormat, names: list[str]) -> Column:
    """One field of a whole line with the right field count, without the others."""
    before, after = names.index(name), len(names) + bulk.trailing_delimiter - names.index(name)
    if before < after:
        field = F.substring_index(F.substring_index(LINE, DELIMITER, before + 1), DELIMITER, -1)
    else:
        field = F.substring_index(F.substring_index(LINE, DELIMITER, -after), DELIMITER, 1)
    return F.nullif(field, F.lit(""))


def _fields(line: Column) -> Column:
    return F.split(line, rf"\{DELIMITER}", -1)


def _by_name(names: list[str], bulk: BulkFormat) -> list[Column]:
    at = {name: i for i, name in enumerate(names)}
    return [F.nullif(F.get("_fields", F.lit(at[n])), F.lit("")).alias(n) for n in bulk.names]


def good_lines(lines: DataFrame, bulk: BulkFormat) -> DataFrame:
    """The lines with the right field count, typed; a value that does not fit turns null."""
    return try_cast_to_schema(whole_lines(lines, bulk), bulk.schema, bulk.date_format)


def whole_lines(lines: DataFrame, bulk: BulkFormat) -> DataFrame:
    """The lines with the right field count, as text columns."""
    return lines.where(F.col(MALFORMED).isNull()).select(*bulk.names)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(file, line) of the lines with a wrong field count, whose values cannot be told apart."""
    # Spark does not read the line alone: nothing of the first column goes along
    none = F.substring(F.coalesce(F.col(lines.columns[0]), F.lit("")), 1, 0)
    return lines.where(F.col(MALFORMED).isNotNull()).select(
        F.col(FILE).alias("file"), F.concat(F.col(MALFORMED), none).alias("line"))


def line_report(lines: DataFrame, bulk: BulkFormat, tolerated_percent: int) -> DataFrame:
    """Per file: lines, lines with a wrong field count, values turned null, and whether it is skipped for the wrong lines."""
    good = F.col(MALFORMED).isNull()
    nulled = sum((unconvertible(F.col(f.name), f.dataType, bulk.date_format).cast("bigint") for f in bulk.schema
                  if not isinstance(f.dataType, T.StringType)), F.lit(0).cast("bigint"))
    counts = lines.groupBy(F.col(FILE).alias("file")).agg(
        F.count("*").alias("n_rows"), F.count_if(~good).alias("n_wrong"),
        F.coalesce(F.sum(F.when(good, nulled)), F.lit(0)).alias("n_nulled"))
    return counts.withColumn("skipped", F.col("n_wrong") * 100 > F.col("n_rows") * tolerated_percent)


def read_lenient(spark: SparkSession, path: str, bulk: BulkFormat, header: bool = False,
                 dictionary: str | None = None) -> DataFrame:
    """A bulk file in its declared types; a value that does not fit turns null.

    Lines with a wrong field count are not among the rows: ``rejected_lines`` has them.
    """
    return good_lines(lenient_lines(spark, path, bulk, header, dictionary), bulk)


def read_with_dictionary(spark: SparkSession, path: str, dictionary: str, bulk: BulkFormat) -> DataFrame:
    """A bulk file whose column order comes from its own one-line header file."""
    return read_delimited(spark, path, bulk, dictionary=dictionary)


def file_order(spark: SparkSession, dictionary: str | None, bulk: BulkFormat) -> list[str]:
    """The declared names in the order of the header file; other names there fail before any row is read."""
    if not dictionary:
        return bulk.names
    names = header_names(spark, dictionary)
    differing = set(bulk.names) ^ set(names)
    if differing or len(names) != len(bulk.names):
        raise ValueError(f"header file and declared columns differ in {sorted(differing) or 'repeated names'}")
    return names


def header_names(spark: SparkSession, path: str) -> list[str]:
    return spark.read.csv(path, header=True).columns


def write_delimited(rows: DataFrame, path: str, header: bool = True, quoted: bool = True, **how) -> None:
    style = QUOTED if quoted else UNQUOTED | {"emptyValue": ""}
    rows.write.options(**how).csv(path, header=header, **style, **EXACT)


def _numbered(bulk: BulkFormat, names: list[str]) -> T.StructType:
    """Text columns for every field of a line, with the one after a trailing delimiter."""
    width = len(names) + bulk.trailing_delimiter
    return T.StructType([T.StructField(f"column_{i + 1}", T.StringType()) for i in range(width)])
