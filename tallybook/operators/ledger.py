"""Which loads of a table, or of a set of tables that switch together, there are, and which of them may go.

The ledger is a small table beside the loads, to which lines are only added.
"""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallybook.schemas import columns
from tallybook.scratch import list_folder, remove_folder

LEDGER = columns("line bigint, load_id string, state string")
# A load is begun before its first row is written, and current once readers see it.
BEGUN, CURRENT = "begun", "current"


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{root}/_ledger")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def note_load(spark: SparkSession, root: str, load_id: str, state: str) -> None:
    last = read_ledger(spark, root).agg({"line": "max"}).first()[0] or 0
    line = spark.createDataFrame([(last + 1, load_id, state)], LEDGER)
    line.coalesce(1).write.mode("append").parquet(f"{root}/_ledger")


def load_folder(root: str, load_id: str) -> str:
    return f"{root}/load_id={load_id}"


def sweep_loads(spark: SparkSession, root: str, keep: int = 2, tables: Sequence[str] = (),
                forget: Callable[[str, str], None] | None = None) -> list[str]:
    """Remove the loads that no reader and no running job needs, and return their ids.

    The ``keep`` loads that were current last stay, the newest of which readers see; so do those begun after it, which may
    still be running. ``tables`` are the folders below ``root`` that switch together; without them it is one table.
    ``forget`` is called with table and load id before a folder goes.
    """
    lines = read_ledger(spark, root).orderBy("line").collect()  # a line or two per load
    switched = [line for line in lines if line.state == CURRENT]
    if not switched:
        return []
    kept = set(list(dict.fromkeys(line.load_id for line in reversed(switched)))[:max(keep, 1)])
    kept |= {line.load_id for line in lines if line.state == BEGUN and line.line > switched[-1].line}
    known, gone = {line.load_id for line in lines}, set()
    for table in tables or ("",):
        folder = f"{root}/{table}" if table else root
        for name, _ in list_folder(spark, folder):
            load_id = name.removeprefix("load_id=")
            if name.startswith("load_id=") and load_id in known - kept:
                if forget:
                    forget(table, load_id)
                remove_folder(spark, f"{folder}/{name}")
                gone.add(load_id)
    return sorted(gone)
