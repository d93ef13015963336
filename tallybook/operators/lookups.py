"""Joins that add a label from a code table.

There is no broadcast hint here. Spark knows the size of a table it reads and
broadcasts it below spark.sql.autoBroadcastJoinThreshold; above that the join
is a shuffled one, whose hot codes adaptive execution splits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_label(rows: DataFrame, code: str, codes: DataFrame, key: str, label: str, how: str = "inner") -> DataFrame:
    """Rows plus ``label`` of the code table, without the two key columns' overlap.

    An inner lookup drops rows whose code is unknown or null, and a code listed
    twice gives two rows; a left lookup keeps every row.
    """
    table = codes.select(F.col(key).alias("_code"), F.col(label))
    return rows.join(table, F.col(code) == F.col("_code"), how).drop("_code")
