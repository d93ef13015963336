"""What lies in a folder of Parquet: one row per file, told by its footer, which a task reads.

Nothing is collected: the list of files is a table from the start, and no job is run per file.
"""

import sys
from collections.abc import Iterator, Sequence
from functools import partial
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.sources.delimited import FILE

# The reader of footers goes along with its tasks, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stores whose files a task opens by itself and then reads the footer alone. From any other store
#: Spark hands it the whole file, so a file there must fit into a task's memory.
OPENED_BY_TASKS = ("file",)

INVENTORY = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("length", T.LongType()), T.StructField("n_rows", T.LongType()),
    T.StructField("types", T.MapType(T.StringType(), T.StringType())), T.StructField("fault", T.StringType())])
_ROWS = pa.schema([("file", pa.string()), ("length", pa.int64()), ("n_rows", pa.int64()),
                   ("types", pa.map_(pa.string(), pa.string())), ("fault", pa.string())])


def inventory(spark: SparkSession, folder: str, opened: Sequence[str] = OPENED_BY_TASKS) -> DataFrame:
    """(file, length, n_rows, types, fault) of every file below a folder.

    ``types`` has the columns by their exact names; ``fault`` says why a file cannot be read, and is null if it can.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    direct = (urlsplit(folder).scheme or urlsplit(spark.conf.get("spark.hadoop.fs.defaultFS", "file:///")).scheme) in opened
    content = [] if direct else ["content"]
    told = listed.select(F.col("_metadata.file_path").alias("file"), "path", "length", *content)
    return told.mapInArrow(partial(_footers, direct=direct), INVENTORY)


def _footers(batches: Iterator[pa.RecordBatch], direct: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(len(batch)):
            file, path, length = (batch.column(i)[row].as_py() for i in range(3))
            where = unquote(urlsplit(path).path) if direct else pa.BufferReader(batch.column(3)[row].as_buffer())
            n_rows, types, fault = _footer(where)
            yield pa.RecordBatch.from_pylist([{"file": file, "length": length, "n_rows": n_rows, "types": list(types.items()),
                                               "fault": fault}], schema=_ROWS)


def _footer(where) -> tuple[int, dict[str, str], str | None]:
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    try:
        with pq.ParquetFile(where) as opened:
            names = opened.schema_arrow.names
            if len(set(names)) < len(names):
                return 0, {}, "a column name twice"
            return opened.metadata.num_rows, {f.name: from_arrow_type(f.type).simpleString() for f in opened.schema_arrow}, None
    except Exception as error:  # whatever a file holds, it is told as a row
        return 0, {}, f"{type(error).__name__}: {error}"[:200]


def kinds(files: DataFrame, names: Sequence[str]) -> tuple[DataFrame, list[dict[str, str]]]:
    """(file, kind) of the readable files, and per kind the types of the named columns.

    Files are of one kind if no column has two types in them; an absent column has any. Kinds are few, whatever the number of
    files: only the distinct types are looked at here.
    """
    said = F.array(*(F.coalesce(F.try_element_at("types", F.lit(n)), F.lit("")) for n in names))
    readable = files.where("fault IS NULL").select("file", said.alias("said"))
    found = sorted((row.said for row in readable.select("said").distinct().collect()), key=lambda s: (s.count(""), s))
    merged: list[list[str]] = []
    kind_of = []
    for said in found:
        fits = (i for i, of in enumerate(merged) if all(not a or not b or a == b for a, b in zip(said, of)))
        kind = next(fits, len(merged))
        if kind == len(merged):
            merged.append([""] * len(names))
        merged[kind] = [a or b for a, b in zip(merged[kind], said)]
        kind_of.append((said, kind))
    named = files.sparkSession.createDataFrame(kind_of, "said array<string>, kind int")
    return readable.join(F.broadcast(named), "said").select("file", "kind"), [
        {n: kind for n, kind in zip(names, of) if kind} for of in merged]


def rows_by_kind(spark: SparkSession, folder: str, files: DataFrame, target: T.StructType) -> list[DataFrame]:
    """Per kind of files their rows, with those of the target's columns that they have under exactly those names, and the file.

    ``spark`` must resolve names with case. A file that breaks off gives the rows before; its number of rows then differs from
    the inventory's. Each kind is one scan of the folder that leaves the files of other kinds alone.
    """
    of_file, found = kinds(files, target.fieldNames())
    scans = []
    for kind, types in enumerate(found):
        schema = T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in types.items()])
        reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
        rows = reader.parquet(folder).select("*", F.col("_metadata.file_path").alias(FILE))
        if len(found) > 1:
            mine = of_file.where(F.col("kind") == kind).select("file")
            rows = rows.join(mine, F.col(FILE) == F.col("file"), "left_semi")
        scans.append(rows)
    return scans
