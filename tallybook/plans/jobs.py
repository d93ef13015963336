"""The jobs a user runs per dataset: ingest to the landing area, then load to a raw table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.typing import cast_to_schema, try_cast_to_schema
from tallybook.operators.keys import key_audit
from tallybook.operators.ledger import BEGUN, CURRENT, load_folder, note_load, sweep_loads
from tallybook.operators.load import (
    TOLERATED_PERCENT, checked, delimited_files, keep_good, load_report, match_by_name, match_by_position,
    session_with, skip_bad_files, switch_view, write_load, written,
)
from tallybook.schemas import BulkFormat
from tallybook.sources.delimited import (
    FILE, LINE, MALFORMED, file_order, lenient_lines, line_columns, line_field, line_report, rejected_lines, split_lines,
    strict_lines, whole_lines,
)
from tallybook.sources.html import html_code_table
from tallybook.sources.inventory import inventory, rows_by_kind
from tallybook.sources.staged import (
    REFUSED, STAGED, STAGING, note_run, require_staged, run_folder, side_folder, stage_delimited, stage_parquet, stored_bytes,
)


def ingest_bulk(spark: SparkSession, text: str, bulk: BulkFormat, root: str, run_date: str, header: bool = False,
                dictionary: str | None = None, tolerated_percent: int = TOLERATED_PERCENT) -> None:
    """Bulk text, typed, staged as Parquet under the run date.

    ``dictionary`` is the dataset's header file, if it comes with one. A lenient
    dataset leaves two more tables (``read_rejects``, ``read_line_report``): the
    lines with a wrong field count, and the counts per file; a file with too
    many such lines is not staged. If that are all files, the run is refused: what an
    earlier ingest staged for the date stays, but is not loaded again. The manifest
    (``read_manifest``) tells how each ingest of the run ended.
    """
    note_run(spark, root, run_date, STAGING)
    size = stored_bytes(spark, text) if bulk.cluster else 0
    if not bulk.lenient:
        n_rows = stage_parquet(strict_lines(spark, text, bulk, header, dictionary), root, run_date, bulk.cluster, size,
                               lambda rows: cast_to_schema(rows, bulk.schema, bulk.date_format))
        note_run(spark, root, run_date, STAGED, lines=n_rows, wrong=0, skipped=0)
        return
    lines = lenient_lines(spark, text, bulk, header, dictionary) if header else split_lines(spark, text, bulk, dictionary)
    report = written(line_report(lines, bulk, tolerated_percent), side_folder(root, "reports", run_date), "overwrite")
    counts = report.agg(F.count("*").alias("files"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("lines"),
                        F.coalesce(F.sum("n_wrong"), F.lit(0)).alias("wrong"),
                        F.count_if("skipped").alias("skipped")).first().asDict()
    rejects = rejected_lines(lines)  # without any the text is not read for them
    written(rejects if counts["wrong"] else rejects.limit(0), side_folder(root, "rejects", run_date), "overwrite")
    if counts["files"] and counts["files"] == counts["skipped"]:
        note_run(spark, root, run_date, REFUSED, **counts)
        raise ValueError(f"{text}: every file was refused, nothing is staged for {run_date}")
    skipped = report.where("skipped").select("file")
    kept = lines.join(skipped, F.col(FILE) == F.col("file"), "left_anti") if counts["skipped"] else lines

    def typed(rows: DataFrame) -> DataFrame:
        return try_cast_to_schema(rows, bulk.schema, bulk.date_format)

    if header:
        stage_parquet(whole_lines(kept, bulk), root, run_date, bulk.cluster, size, typed)
    else:
        names = file_order(spark, dictionary, bulk)
        keys = [line_field(k, bulk, names) for k in (*bulk.cluster[:1], *bulk.cluster[-1:])]
        whole = kept.where(F.col(MALFORMED).isNull()) if counts["wrong"] else kept  # without wrong lines none is split to tell
        stage_parquet(whole.select(LINE), root, run_date, bulk.cluster, size,
                      lambda rows: typed(line_columns(rows, bulk, names)), keys)
    note_run(spark, root, run_date, STAGED, **counts)


def read_rejects(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """(file, line) that a lenient ingest could not split."""
    return spark.read.parquet(side_folder(root, "rejects", run_date))


def read_line_report(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """(file, n_rows, n_wrong, n_nulled, skipped) of a lenient ingest."""
    return spark.read.parquet(side_folder(root, "reports", run_date))


def ingest_code_table(pages: DataFrame, key: str, html: str, schema: T.StructType, root: str,
                      run_date: str) -> None:
    """The first table of each page, staged as delimited text under the run date."""
    stage_delimited(html_code_table(pages, key, html, schema).drop(key), root, run_date)


def load_bulk(spark: SparkSession, root: str, run_date: str, target: T.StructType, table: str, load_id: str,
              view: str, database: str | None = None, min_rows: int = 0, key: str | None = None,
              unique: Sequence[str] = (), refuse_repeats: bool = False) -> DataFrame:
    """One run's staged Parquet as the new rows of a raw table, by column name and within the tolerance, file by file.

    Every file is matched by its own columns, with case. An unreadable file, and one that breaks inside its data, is skipped like
    one with too many bad rows; no row of it is loaded. A run that the last ingest refused is not loaded.

    ``unique`` names the columns of an id that should be on one row only: ids that repeat are listed beside
    the load (``read_key_audit``), and with ``refuse_repeats`` they keep the view from switching.
    """
    require_staged(spark, root, run_date)
    exact = session_with(spark, {"spark.sql.caseSensitive": "true"})
    folder = run_folder(root, run_date)
    files = written(inventory(exact, folder), f"{table}/files/{load_id}")
    nothing = exact.createDataFrame([], T.StructType([*target, T.StructField(FILE, T.StringType())]))
    parts = [checked(match_by_name(rows, target), target) for rows in [nothing, *rows_by_kind(exact, folder, files, target)]]
    report = f"{table}/reports/{load_id}"
    good = keep_good(reduce(DataFrame.unionByName, parts), target, report, key=key, files=files)
    return _refreshed(spark, good, report, table, load_id, view, database, min_rows, unique, refuse_repeats)


def read_key_audit(spark: SparkSession, table: str, load_id: str) -> DataFrame:
    """(key columns, n_rows) of the ids that stand on several rows of a load."""
    return spark.read.parquet(f"{table}/audits/{load_id}")


def load_code_table(spark: SparkSession, root: str, run_date: str, target: T.StructType, table: str,
                    load_id: str, view: str, database: str | None = None, min_rows: int = 0) -> DataFrame:
    """One run's staged delimited text, by column position, as the new rows of a raw table."""
    rows = match_by_position(delimited_files(spark, run_folder(root, run_date), target), target)
    report = f"{table}/reports/{load_id}"
    return _refreshed(spark, skip_bad_files(rows, target, report), report, table, load_id, view, database, min_rows)


def _refreshed(spark: SparkSession, good: DataFrame, report: str, table: str, load_id: str, view: str, database: str | None,
               min_rows: int, unique: Sequence[str] = (), refuse_repeats: bool = False) -> DataFrame:
    """A run whose files were all skipped is refused: the table keeps its rows. So is one that loads other rows than it counted."""
    told = load_report(spark, report).agg(
        F.count("*").alias("files"), F.count_if("skipped").alias("skipped"),
        F.coalesce(F.sum(F.when(~F.col("skipped"), F.col("n_rows") - F.col("n_bad"))), F.lit(0)).alias("rows")).first()
    if told.files and told.files == told.skipped:
        raise ValueError(f"{view}: every file was skipped, the previous load stays")
    note_load(spark, f"{table}/rows", load_id, BEGUN)
    loaded = write_load(good, f"{table}/rows", load_id, view, min_rows, told.rows)
    if unique:
        repeated = key_audit(loaded, f"{table}/audits/{load_id}", *unique)
        if refuse_repeats and not repeated.isEmpty():
            raise ValueError(f"{view}: {', '.join(unique)} repeats, the previous load stays")
    switch_view(spark, f"{table}/rows", load_id, view, database)
    note_load(spark, f"{table}/rows", load_id, CURRENT)
    return spark.read.schema(loaded.schema).parquet(load_folder(f"{table}/rows", load_id))


def sweep_table(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Remove the loads of a raw table that its view no longer shows, but for the ``keep`` last ones; their reports stay."""
    return sweep_loads(spark, f"{table}/rows", keep)
