"""Small whole-frame steps used while typing bulk files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame


def rename_positional(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Names given to the first columns in order, all at once; later columns keep theirs."""
    if len(names) > len(rows.columns):
        raise ValueError(f"{len(names)} names for {len(rows.columns)} columns")
    return rows.toDF(*names, *rows.columns[len(names):])


def drop_trailing_column(rows: DataFrame) -> DataFrame:
    """Without the empty column that a delimiter at the end of each line makes."""
    return rows.drop(rows.columns[-1])
