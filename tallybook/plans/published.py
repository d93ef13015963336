"""Models in a database: cleaned tables by load, one pointer that all views read, and the marts as views.

Every load of a cleaned table is a partition. The view of a table shows the partition that the view ``current_load`` names, and
the marts are views over these; so replacing that one view switches all of them at once. Spark folds the pointer into a
literal, reads the one partition and knows its size. The links between candidates and committees, which a mart reads
raw, are loaded along.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallybook.functions.codes import NO_CATEGORY, OFFICE
from tallybook.operators.ledger import load_folder
from tallybook.plans.marts import CANDIDATE, CYCLE

POINTER = "current_load"
LOADS = "_loads"

_OFFICE = " ".join(f"WHEN '{code}' THEN '{text}'" for code, text in OFFICE.items())
_SHOWN = ", ".join(f"CASE cand_office {_OFFICE} ELSE cand_office END AS cand_office" if c == "cand_office" else c for c in CANDIDATE)

#: The marts as SQL over the other views of the same database, in the order in which they are made.
MART_VIEWS = {
    "fct_cand_committee_trans": """
        SELECT cmte_id, cmte_nm, amndt_id, rp_typ, trans_tp_desc, cand_name AS cand_repcipient, paid.city AS cand_city,
               paid.state AS cand_state, paid.zip_code AS cand_zip_code, transaction_dt, transaction_amt, sub_id
        FROM (SELECT * FROM {db}.src_independent_exp WHERE cand_id IS NOT NULL AND amndt_id <> 'Termination') AS paid
        JOIN (SELECT cand_id, cand_name FROM {db}.src_candidates) USING (cand_id)
        JOIN (SELECT cmte_id, cmte_nm FROM {db}.src_committees) USING (cmte_id)""",
    "fct_candidate_indiv_cont": f"""
        SELECT {_SHOWN}, total_contributions
        FROM (SELECT {', '.join(CANDIDATE)}, sum(amt) AS total_contributions
              FROM (SELECT cmte_id, entity_tp, sum(transaction_amt) AS amt
                    FROM {{db}}.src_indiv_contributions GROUP BY cmte_id, entity_tp) AS sums
              JOIN (SELECT cand_id, cmte_id FROM {{db}}.cand_cmte_link WHERE cand_election_yr = {CYCLE}) AS links USING (cmte_id)
              JOIN (SELECT cand_id, {', '.join(CANDIDATE)} FROM {{db}}.src_candidates
                    WHERE cand_election_yr = {CYCLE}) AS candidates USING (cand_id)
              GROUP BY {', '.join(CANDIDATE)}) AS totals""",
    "fct_candidate_operating_exp": """
        SELECT cmte_id, cmte_name, cand_name, name, city, state, purpose, category_desc, transaction_amt, transaction_dt, sub_id
        FROM {db}.src_operating_exp
        JOIN (SELECT cmte_id, cmte_nm AS cmte_name, cand_id FROM {db}.src_committees) USING (cmte_id)
        JOIN (SELECT cand_id, cand_name FROM {db}.src_candidates) USING (cand_id)""",
    "fct_committee_operating_exp": """
        SELECT cmte_id, cmte_name, name, city, state, purpose, category_desc, transaction_amt, transaction_dt, sub_id
        FROM {db}.src_operating_exp JOIN (SELECT cmte_id, cmte_nm AS cmte_name FROM {db}.src_committees) USING (cmte_id)""",
    "fct_categories_operating_exp": f"""
        SELECT category, sum(transaction_amt) AS transaction_amt
        FROM (SELECT coalesce(category_desc, '{NO_CATEGORY}') AS category, transaction_amt
              FROM {{db}}.fct_committee_operating_exp) AS spent
        GROUP BY category""",
    "fct_indiv_cont_by_state": """
        SELECT state, sum(transaction_amt) AS sum_individual_cont FROM {db}.src_indiv_contributions GROUP BY state""",
}


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, load_id: str, database: str) -> None:
    """Let the views of a database show a load whose tables are written under ``root``.

    Everything but the last statement leaves readers where they are. The very first load has nothing to switch from:
    its pointer is set before the views, so those that are there show it.
    """
    for name, rows in tables.items():
        _add_partition(spark, name, rows, load_folder(f"{root}/{name}", load_id), load_id, database)
    point = f"CREATE OR REPLACE VIEW {database}.{POINTER} AS SELECT '{load_id}' AS load_id"
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        spark.sql(point)
    for name, rows in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {', '.join(f'`{c}`' for c in rows.columns)} "
                  f"FROM {database}.{name}{LOADS} WHERE load_id = (SELECT load_id FROM {database}.{POINTER})")
    for name, sql in MART_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {sql.format(db=database)}")
    spark.sql(point)


def _add_partition(spark: SparkSession, name: str, rows: DataFrame, folder: str, load_id: str, database: str) -> None:
    loads = f"{database}.{name}{LOADS}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {loads} ({fields}, load_id string) USING parquet PARTITIONED BY (load_id) "
              f"LOCATION '{folder.rsplit('/', 1)[0]}'")
    known = [(f.name, f.dataType.simpleString()) for f in spark.table(loads).schema][:-1]
    if known != [(f.name, f.dataType.simpleString()) for f in rows.schema]:
        raise ValueError(f"{loads} has other columns than the new load: publish it into another database")
    spark.sql(f"ALTER TABLE {loads} ADD PARTITION (load_id = '{load_id}') LOCATION '{folder}'")


def withdraw(spark: SparkSession, name: str, load_id: str, database: str) -> None:
    """Forget a load of a table; its files are left."""
    spark.sql(f"ALTER TABLE {database}.{name}{LOADS} DROP IF EXISTS PARTITION (load_id = '{load_id}')")
