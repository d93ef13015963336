"""Loading staged files into raw tables: column matching, a tolerance for bad rows, full refresh."""

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.typing import lenient, unconvertible
from tallybook.operators.ledger import BEGUN, CURRENT, load_folder, note_load
from tallybook.schemas import columns
from tallybook.sources.delimited import FILE, MALFORMED, delimited_files  # noqa: F401  delimited_files is part of loading
from tallybook.sources.staged import PARQUET

BAD = "_bad"
# Fixed value: a file is skipped when more than this share of its rows is bad.
TOLERATED_PERCENT = 5

#: Rows that are put in order at once: what a task then holds, some 100 MB, does not depend on how its input is split.
RUN_ROWS = 250_000

REPORT = columns("file string, n_rows bigint, n_bad bigint, n_without_key bigint, n_nulls bigint, fault string, "
                 "skipped boolean")


def unmatched_names(rows: DataFrame, target: T.StructType) -> list[str]:
    """Target columns that the rows do not have under exactly that name."""
    return [name for name in target.fieldNames() if name not in rows.columns]


def match_by_name(rows: DataFrame, target: T.StructType) -> DataFrame:
    """Target columns in order, matched with case; absent ones are null, others are left out.

    Spark itself resolves names without case, so the names are compared here.
    """
    absent = unmatched_names(rows, target)
    kept = [name for name in (FILE, MALFORMED) if name in rows.columns]
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in absent else F.col(f.name)
                         for f in target], *kept)


def match_by_position(rows: DataFrame, target: T.StructType) -> DataFrame:
    """The first columns of the rows under the target's names; fewer columns than the target's are refused."""
    kept = [name for name in (FILE, MALFORMED) if name in rows.columns]
    data = [name for name in rows.columns if name not in kept]
    if len(data) < len(target):
        raise ValueError(f"{len(data)} columns for the {len(target)} of the target")
    return rows.select(*[F.col(old).alias(f.name) for old, f in zip(data, target)], *kept)


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of Parquet of one schema with the file each came from."""
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias(FILE))


def checked(rows: DataFrame, target: T.StructType, date_format: str | None = None) -> DataFrame:
    """The target's columns in their types, whether the row is bad, and its file."""
    typed = [F.col(f.name) if rows.schema[f.name].dataType == f.dataType else
             lenient(F.col(f.name), f.dataType, date_format).alias(f.name) for f in target]
    return rows.select(*typed, _bad(rows, target, date_format).alias(BAD), FILE)


def skip_bad_files(rows: DataFrame, target: T.StructType, report_path: str, date_format: str | None = None,
                   tolerated_percent: int = TOLERATED_PERCENT, key: str | None = None) -> DataFrame:
    """Typed good rows of every file that keeps within the tolerance.

    A row is bad if its line has the wrong number of columns or a value is not
    of its declared type.
    """
    return keep_good(checked(rows, target, date_format), target, report_path, tolerated_percent, key)


def keep_good(rows: DataFrame, target: T.StructType, report_path: str, tolerated_percent: int = TOLERATED_PERCENT,
              key: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """The good ones of checked rows, of files within the tolerance.

    The first pass counts bad rows per file and writes the counts as a load
    report; the second reads the list of skipped files back, so its size is known, and drops their
    rows without moving the others. ``key`` is the column whose nulls are counted, the first if not given.
    With an inventory of ``files`` the report has those without rows too, and a file that
    cannot be read, or gives other than its footer's number of rows, is skipped with its fault. All columns are read for that.
    """
    spark = rows.sparkSession
    nulls = reduce(add, (F.col(n).isNull().cast("bigint") for n in target.fieldNames()))
    report = rows.groupBy(F.col(FILE).alias("file")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(BAD).alias("n_bad"),
        F.count_if(F.col(key or target.fieldNames()[0]).isNull()).alias("n_without_key"),
        *([F.sum(nulls).alias("n_nulls")] if files is not None else []))
    over = F.col("n_bad") * 100 > F.col("n_rows") * tolerated_percent
    if files is None:
        report = report.select("*", F.lit(None).cast("bigint").alias("n_nulls"), F.lit(None).cast("string").alias("fault"),
                               over.alias("skipped"))
    else:
        none, read = F.lit(0).cast("bigint"), report.withColumnRenamed("file", "_read")
        counted = [F.coalesce(c, none).alias(c) for c in ("n_rows", "n_bad", "n_without_key", "n_nulls")]
        told = files.select("file", F.col("n_rows").alias("_footer"), "fault")
        report = told.join(read, F.col("file") == F.col("_read"), "left").select("file", "fault", "_footer", *counted)
        broken = F.when(F.col("n_rows") != F.col("_footer"), F.concat(
            F.lit("broken inside: "), "n_rows", F.lit(" of "), "_footer", F.lit(" rows")))
        report = report.withColumn("fault", F.coalesce("fault", broken)).withColumn(
            "skipped", over | F.col("fault").isNotNull()).drop("_footer")
    report.write.partitionBy("skipped").parquet(report_path)

    skipped = load_report(spark, report_path).where("skipped").select("file")
    kept = rows.where(~F.col(BAD))
    if not skipped.isEmpty():
        kept = kept.join(skipped, F.col(FILE) == F.col("file"), "left_anti")
    return kept.select(*target.fieldNames())


def load_report(spark: SparkSession, report_path: str) -> DataFrame:
    """Per file: rows, bad rows, rows without a key, null values, what is wrong with the file, and whether it was skipped."""
    return spark.read.schema(REPORT).parquet(report_path)


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """Another session of the same application and catalog, with this one's settings but for the given ones."""
    other = spark.newSession()
    for name, value in {**spark.conf.getAll, **settings}.items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def written(rows: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """The rows as a table of their own: no lineage to replay, and a size that Spark knows."""
    rows.write.mode(mode).parquet(path, **PARQUET)
    return rows.sparkSession.read.parquet(path)


def in_runs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of each task in runs, each ordered by the keys, nulls last: ids of neighbours are alike then, in all columns that
    go with them, and take less space in a file.

    Nothing is moved between tasks, and nothing goes to disk, as a sort of whole tasks would.
    """
    def ordered(batches: Iterator, by: Sequence[str] = tuple(keys), most: int = RUN_ROWS) -> Iterator:
        import pyarrow as pa

        held, n_rows = [], 0

        def run() -> Iterator:
            yield from pa.Table.from_batches(held).sort_by([(k, "ascending") for k in by]).combine_chunks().to_batches(10_000)

        for batch in batches:
            held.append(batch)
            n_rows += batch.num_rows
            if n_rows >= most:
                yield from run()
                held, n_rows = [], 0
        if held:
            yield from run()

    return rows.mapInArrow(ordered, rows.schema)


def write_load(rows: DataFrame, root: str, load_id: str, name: str, min_rows: int = 0,
               exactly: int | None = None) -> DataFrame:
    """The rows of one load beside those of others, counted if a number is asked. Nothing points to them yet."""
    loaded = written(rows, load_folder(root, load_id))
    n_rows = loaded.count() if min_rows or exactly is not None else 0
    if n_rows < min_rows:
        raise ValueError(f"{name}: fewer than {min_rows} rows loaded, the previous load stays")
    if exactly is not None and n_rows != exactly:
        raise ValueError(f"{name}: {n_rows} rows loaded where {exactly} were counted, the previous load stays")
    return loaded


def switch_view(spark: SparkSession, root: str, load_id: str, view: str, database: str | None = None) -> None:
    """Let a view point to a load: in the catalog with a database, otherwise in the session."""
    path = load_folder(root, load_id)
    if database:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{view} AS SELECT * FROM parquet.`{path}`")
    else:
        spark.read.parquet(path).createOrReplaceTempView(view)


def full_refresh(rows: DataFrame, root: str, load_id: str, view: str, database: str | None = None,
                 min_rows: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """Replace a table's rows, so that loading the same run again makes no duplicates.

    The rows are written next to the previous load, and only then does the view
    point to them: a load that fails, or has fewer rows than asked, leaves the previous rows in place.
    A load id names one attempt; trying again takes a new one. With ``order`` the rows are written in runs ordered by these
    columns, as rows with near ids are alike: files are smaller, and so are those of tables made of them row by row.
    """
    spark = rows.sparkSession
    note_load(spark, root, load_id, BEGUN)
    loaded = write_load(in_runs(rows, order) if order else rows, root, load_id, view, min_rows)
    switch_view(spark, root, load_id, view, database)
    note_load(spark, root, load_id, CURRENT)
    return loaded


def _bad(rows: DataFrame, target: T.StructType, date_format: str | None) -> Column:
    bad = F.col(MALFORMED).isNotNull() if MALFORMED in rows.columns else F.lit(False)
    for field in target:
        if rows.schema[field.name].dataType != field.dataType:
            bad = bad | unconvertible(F.col(field.name), field.dataType, date_format)
    return bad
