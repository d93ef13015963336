"""The landing area: one folder per dataset, in it one ``run_date=`` folder per run."""

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import columns
from tallybook.scratch import shuffles_removed
from tallybook.sources.delimited import EXACT, QUOTED, read_text_columns

RUN_DATE = "run_date"
# Fixed value: the compression of every Parquet file written; about a third smaller than the default, as fast.
PARQUET = {"compression": "zstd"}

# What an ingest says of a run: each attempt notes "staging" before anything is replaced, then "staged" or "refused".
MANIFEST = columns("attempt bigint, state string, files bigint, lines bigint, wrong bigint, skipped bigint")
STAGING, STAGED, REFUSED = "staging", "staged", "refused"


#: Bytes of text per staged file: typed and sorted Parquet takes a fifth of them. A task sorts the rows of a file, which
#: take four times the text in memory; with 512 MB they went to disk.
TEXT_PER_FILE = 128 << 20
#: Bytes of text in a byte of a compressed file, by its ending: rather too many, for smaller files.
UNPACKED = {".gz": 6, ".bz2": 8, ".deflate": 6, ".snappy": 4}
# Marks inside a packed line: no line of text holds either.
FIELD_END, NULL = "\n", "\r"


def stage_parquet(rows: DataFrame, root: str, run_date: str, cluster: Sequence[str] = (), text_bytes: int = 0,
                  typed: Callable[[DataFrame], DataFrame] | None = None, keys_of_line: Sequence[Column] = ()) -> int:
    """Write one run's rows, also if there are none, and tell how many; staging the same date again replaces only that date.

    With ``cluster`` the files hold ranges of the first column, so a reader of one value opens few row groups, and
    rows alike in the others stand together, which makes files smaller. The last column breaks ties: one value with very
    many rows is dealt over files by it. There are as many files as the text's bytes ask for, and no fewer than cores.

    With ``typed`` the rows are columns of text from lines, and it gives them their types. That is done after they were
    dealt: text in one column is a good third smaller to move than typed columns. Rows that are whole lines come with
    ``keys_of_line``, the text of the two keys in a line, and are moved as they are.
    """
    if cluster:
        files = max(rows.sparkSession.sparkContext.defaultParallelism, -(-text_bytes // TEXT_PER_FILE))
        keys = [cluster[0], cluster[-1]]
        if typed:
            type_of = typed(rows).schema
            texts = keys_of_line or [F.col(k) for k in keys]
            dealt = (rows if keys_of_line else _packed(rows, keys)).repartitionByRange(
                files, *(text.try_cast(type_of[k].dataType) for text, k in zip(texts, keys)))
            rows = typed(dealt if keys_of_line else _unpacked(dealt, rows.columns, keys))
        else:
            rows = rows.repartitionByRange(files, *keys)
        rows = rows.sortWithinPartitions(*cluster)
    elif typed:
        rows = typed(rows)
    seen = Observation()  # behind the shuffle, whose sample of keys would be counted too
    with shuffles_removed(rows.sparkSession):
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(run_folder(root, run_date), **PARQUET)
    return seen.get["rows"]


def _packed(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys, and all other columns of text as one."""
    others = (F.coalesce(F.col(c), F.lit(NULL)) for c in rows.columns if c not in keys)
    return rows.select(*keys, F.concat_ws(FIELD_END, *others).alias("_line"))


def _unpacked(rows: DataFrame, names: Sequence[str], keys: Sequence[str]) -> DataFrame:
    at = {name: i for i, name in enumerate(n for n in names if n not in keys)}
    split = rows.select(*keys, F.split("_line", FIELD_END, -1).alias("_fields"))
    return split.select(*(F.col(n) if n in keys else F.nullif(F.col("_fields")[at[n]], F.lit(NULL)).alias(n) for n in names))


def stage_delimited(rows: DataFrame, root: str, run_date: str) -> None:
    rows.write.mode("overwrite").csv(run_folder(root, run_date), header=True, **QUOTED, **EXACT)


def run_folder(root: str, run_date: str) -> str:
    """Where one run's rows lie. Reading it lists no other run and takes no other run's columns."""
    return f"{root.rstrip('/')}/{RUN_DATE}={date.fromisoformat(run_date)}"


def side_folder(root: str, kind: str, run_date: str) -> str:
    """Where what belongs to a run, but is not its rows, lies; readers of the root pass it over."""
    return f"{root.rstrip('/')}/_{kind}/{RUN_DATE}={date.fromisoformat(run_date)}"


def read_staged_parquet(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    return spark.read.parquet(run_folder(root, run_date))


def read_staged_delimited(spark: SparkSession, root: str, run_date: str, schema: T.StructType) -> DataFrame:
    """One run's rows as text; the header line is skipped and columns count by position."""
    return read_text_columns(spark, run_folder(root, run_date), schema, header=True, quoted=True)


def read_manifest(spark: SparkSession, root: str, run_date: str) -> DataFrame:
    """(attempt, state, files, lines, wrong, skipped) that the ingests of a run noted, none if it was staged by other means."""
    try:
        return spark.read.schema(MANIFEST).parquet(side_folder(root, "manifests", run_date))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def run_state(spark: SparkSession, root: str, run_date: str) -> Row | None:
    """What was noted last."""
    return read_manifest(spark, root, run_date).orderBy("attempt", ascending=False).first()


def note_run(spark: SparkSession, root: str, run_date: str, state: str, files: int | None = None, lines: int | None = None,
             wrong: int | None = None, skipped: int | None = None) -> None:
    """Add a line to a run's manifest; nothing there is ever replaced."""
    last = run_state(spark, root, run_date)
    line = ((last.attempt if last else 0) + 1, state, files, lines, wrong, skipped)
    spark.createDataFrame([line], MANIFEST).coalesce(1).write.mode("append").parquet(side_folder(root, "manifests", run_date))


def require_staged(spark: SparkSession, root: str, run_date: str) -> None:
    """Refuse a run whose last ingest was refused or did not come to its end."""
    last = run_state(spark, root, run_date)
    if last and last.state != STAGED:
        raise ValueError(f"run {run_date} of {root} is not staged: its last ingest is noted as {last.state}")


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a folder, or of one file; about that of the text if they are compressed."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    times = F.lit(1)
    for end, unpacked in UNPACKED.items():
        times = F.when(F.col("path").endswith(end), unpacked).otherwise(times)
    return listed.agg(F.sum(F.col("length") * times)).first()[0] or 0
