"""Ids that are declared unique, checked against what was loaded."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.load import written
from tallybook.scratch import scratch_dir


def repeated_keys(rows: DataFrame, *key: str) -> DataFrame:
    """(key columns, n_rows) of every key that stands on more than one row; keys with a null are compared as they are.

    First only 64-bit hashes are counted, in part where the rows lie, so what is shuffled is a few bytes per row and a
    key with very many rows is reduced before. Rows whose hash came more than once are suspects; they alone are
    grouped by the keys themselves, which also parts different keys of one hash.
    """
    marked = rows.select(*key, F.xxhash64(*key).alias("_hash"))
    suspects = marked.groupBy("_hash").agg(F.count("*").alias("n")).where("n > 1").select("_hash")
    # written, so that its size is known: a few suspects are broadcast, many are not
    suspects = written(suspects, scratch_dir(rows.sparkSession, "suspects"))
    found = marked.join(suspects, "_hash", "left_semi").groupBy(*key).agg(F.count("*").alias("n_rows"))
    return found.where("n_rows > 1")


def key_audit(rows: DataFrame, path: str, *key: str) -> DataFrame:
    """The repeated keys of a load, kept as a table."""
    return written(repeated_keys(rows, *key), path)
