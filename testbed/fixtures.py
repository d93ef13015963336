"""The raw tables as views over the driver's tables (FIXTURES.md §3).

One SELECT per raw table, in SQL that Spark and DuckDB both read. Each view is a
projection of one whole table, so a model's plan over these views holds only the
joins, filters and groupings of the model.
"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallybook.schemas import RAW

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "lineitem"]

TXN = """
SELECT 'C' || CAST(l_partkey AS STRING) AS cmte_id,
       CASE l_linenumber % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'A' WHEN 2 THEN 'T' WHEN 3 THEN 'Q' END AS amndt_ind,
       CASE WHEN l_discount < 0.1 THEN 'Q' || CAST(l_orderkey % 27 AS STRING) END AS rpt_tp,
       'G' || CAST(year(l_shipdate) AS STRING) AS transaction_pgi,
       'IMG' || CAST(l_orderkey AS STRING) AS image_num,
       CAST(l_partkey % 27 AS STRING) || 'Y' AS transaction_tp,
       CASE WHEN l_quantity > 25 THEN 'IND' ELSE 'ORG' END AS entity_tp,
       'PAYEE ' || CAST(l_suppkey AS STRING) || ' "D/B/A" NO. ' || CAST(l_orderkey AS STRING) AS name,
       'CITY ' || CAST(l_partkey % 50 AS STRING) AS city,
       CASE WHEN l_linenumber <> 6 THEN 'S' || CAST(l_suppkey % 25 AS STRING) END AS state,
       lpad(CAST(l_partkey AS STRING), 5, '0') || lpad(CAST(l_linenumber AS STRING), 4, '0') AS zip_code,
       CASE WHEN l_quantity >= 5 THEN 'EMPLOYER ' || CAST(l_suppkey AS STRING) END AS employer,
       'OCCUPATION ' || l_linestatus AS occupation,
       CAST(l_shipdate AS DATE) AS transaction_dt,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS transaction_amt,
       CASE WHEN l_returnflag = 'R' THEN 'C' || CAST(l_suppkey AS STRING) END AS other_id,
       CASE WHEN l_quantity > 10 THEN 'K' || CAST(l_suppkey AS STRING) END AS cand_id,
       'SA' || CAST(l_orderkey AS STRING) || '.' || CAST(l_linenumber AS STRING) AS tran_id,
       CAST(l_orderkey % 1000000 AS INT) AS file_num,
       CASE WHEN l_discount > 0.08 THEN 'X' END AS memo_cd,
       CASE WHEN l_tax > 0.04 THEN 'MEMO ' || l_returnflag END AS memo_text,
       l_orderkey * 10 + l_linenumber AS sub_id,
       CAST(year(l_shipdate) AS SMALLINT) AS rpt_yr,
       CASE WHEN l_linenumber <> 2 THEN 'CATEGORY ' || CAST(l_linenumber AS STRING) END AS category_desc,
       l_linenumber AS ln
FROM {lineitem}
"""

VIEWS = {
    "political_parties": """
SELECT 'P' || CAST(r_regionkey AS STRING) AS party_code, r_name AS party_code_desc
FROM {region}
""",
    "committee_types": """
SELECT 'T' || CAST(n_nationkey AS STRING) AS cmte_typ_code, 'TYPE ' || n_name AS cmte_typ
FROM {nation}
""",
    "report_types": """
SELECT 'Q' || CAST(n_nationkey AS STRING) AS rp_typ_code, 'REPORT ' || n_name AS rp_typ
FROM {nation}
""",
    "transaction_types": """
SELECT CAST(n_nationkey AS STRING) || 'Y' AS trans_tp, 'TRANSACTION ' || n_name AS trans_tp_desc
FROM {nation}
""",
    "candidates": """
SELECT 'K' || CAST(s_suppkey AS STRING) AS cand_id, s_name AS cand_name,
       'P' || CAST(s_nationkey % 7 AS STRING) AS cand_pty_affiliation,
       CAST(CASE WHEN s_suppkey % 4 = 0 THEN 2022 ELSE 2024 END AS SMALLINT) AS cand_election_yr,
       CASE WHEN s_suppkey % 11 <> 0 THEN 'S' || CAST(s_nationkey AS STRING) END AS cand_office_st,
       CASE s_suppkey % 5 WHEN 0 THEN 'H' WHEN 1 THEN 'S' WHEN 2 THEN 'P' WHEN 3 THEN 'X' END AS cand_office,
       CASE WHEN s_suppkey % 3 <> 0 THEN lpad(CAST(s_suppkey % 20 AS STRING), 2, '0') END AS cand_office_district,
       CASE s_suppkey % 6 WHEN 0 THEN 'I' WHEN 1 THEN 'C' WHEN 2 THEN 'O' WHEN 3 THEN 'Z' END AS cand_ici,
       'C' AS cand_status, 'C' || CAST(s_suppkey AS STRING) AS cand_pcc,
       CAST(s_suppkey AS STRING) || ' MAIN ST' AS cand_st1, CAST(NULL AS STRING) AS cand_st2,
       'CITY ' || CAST(s_nationkey AS STRING) AS cand_city, 'S' || CAST(s_nationkey AS STRING) AS cand_st,
       lpad(CAST(s_suppkey AS STRING), 9, '0') AS cand_zip
FROM {supplier}
""",
    "cand_cmte_link": """
SELECT 'K' || CAST(CAST(floor(c_custkey / 12) AS BIGINT) AS STRING) AS cand_id,
       CASE WHEN c_custkey % 5 = 0 THEN 2022 ELSE 2024 END AS cand_election_yr, 2024 AS fec_election_yr,
       'C' || CAST(c_custkey AS STRING) AS cmte_id, 'T' || CAST(c_custkey % 27 AS STRING) AS cmte_tp,
       'P' AS cmte_dsgn, CAST(c_custkey % 1000000000 AS INT) AS linkage_id
FROM {customer}
UNION ALL
SELECT 'K' || CAST(CAST(floor(c_custkey / 24) AS BIGINT) AS STRING) AS cand_id, 2024 AS cand_election_yr,
       2024 AS fec_election_yr, 'C' || CAST(c_custkey AS STRING) AS cmte_id,
       'T' || CAST(c_custkey % 27 AS STRING) AS cmte_tp, 'J' AS cmte_dsgn,
       CAST(c_custkey % 1000000000 AS INT) AS linkage_id
FROM {customer}
""",
    "committees": """
SELECT 'C' || CAST(c_custkey AS STRING) AS cmte_id, c_name AS cmte_nm,
       'TREASURER ' || CAST(c_custkey AS STRING) AS tresnam,
       CAST(c_custkey AS STRING) || ' HIGH ST' AS cmte_st1, CAST(NULL AS STRING) AS cmte_st2,
       'CITY ' || CAST(c_nationkey AS STRING) AS cmte_city, 'S' || CAST(c_nationkey AS STRING) AS cmte_st,
       lpad(CAST(c_custkey AS STRING), 9, '0') AS cmte_zip,
       CASE c_custkey % 8 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'D' WHEN 3 THEN 'J' WHEN 4 THEN 'P'
                          WHEN 5 THEN 'U' WHEN 6 THEN 'Z' END AS cmte_dsgn,
       'T' || CAST(c_custkey % 27 AS STRING) AS cmte_tp,
       CASE WHEN c_custkey % 10 <> 0 THEN 'P' || CAST(c_nationkey % 7 AS STRING) END AS cmte_pty_affiliation,
       'M' AS cmte_filing_freq,
       CASE c_custkey % 7 WHEN 0 THEN 'C' WHEN 1 THEN 'L' WHEN 2 THEN 'T' WHEN 3 THEN 'V' WHEN 4 THEN 'W'
                          WHEN 5 THEN 'Q' END AS org_tp,
       CASE WHEN c_custkey % 2 = 0 THEN 'ORG ' || c_name END AS connected_org_nm,
       CASE WHEN c_custkey % 3 <> 0 THEN 'K' || CAST(CAST(floor(c_custkey / 12) AS BIGINT) AS STRING) END AS cand_id
FROM {customer}
""",
    "committee_trans": f"""
SELECT cmte_id, amndt_ind, rpt_tp, transaction_pgi, image_num, transaction_tp, entity_tp, name, city, state,
       zip_code, employer, occupation, transaction_dt, transaction_amt, other_id, tran_id,
       CAST(file_num AS STRING) AS file_num, memo_cd, memo_text, CAST(sub_id AS STRING) AS sub_id
FROM ({TXN}) AS txn
""",
    "independent_exp": f"""
SELECT cmte_id, amndt_ind, rpt_tp, transaction_pgi, image_num, transaction_tp, entity_tp, name, city, state,
       zip_code, employer, occupation, transaction_dt, transaction_amt, other_id, cand_id, tran_id,
       file_num, memo_cd, memo_text, CAST(sub_id AS STRING) AS sub_id
FROM ({TXN}) AS txn
""",
    "indiv_contributions": f"""
SELECT cmte_id, amndt_ind, rpt_tp, transaction_pgi, image_num, transaction_tp, entity_tp, name, city, state,
       zip_code, employer, occupation, transaction_dt, transaction_amt, other_id, tran_id,
       file_num, memo_cd, memo_text, CAST(sub_id AS STRING) AS sub_id
FROM ({TXN}) AS txn
""",
    "operating_exp": f"""
SELECT cmte_id, amndt_ind, rpt_yr, rpt_tp, image_num, 'LINE 17' AS line_num, 'F3' AS form_tp_cd,
       'SB' AS sched_tp_cd, name, city, state, zip_code, transaction_dt, transaction_amt, transaction_pgi,
       occupation AS purpose, CAST(ln AS STRING) AS category, category_desc, memo_cd, memo_text, entity_tp,
       sub_id, CAST(file_num AS BIGINT) AS file_num, tran_id, CAST(NULL AS STRING) AS back_ref_tran_id
FROM ({TXN}) AS txn
""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of raw tables that were written before, by the folder of the driver's tables they come from.
LANDED: dict[str, str] = {}


def land(spark: SparkSession, sf_dir: str, root: str, files: int) -> None:
    """Write all raw tables, each in several files, for ``raw_tables`` to read from now on."""
    for name, rows in raw_tables(spark, sf_dir).items():
        rows.repartition(files).write.parquet(f"{root}/{name}")
    LANDED[sf_dir] = root


def raw_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = VIEWS,
               dealt: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The named raw tables under their declared column names; ``dealt`` has driver's tables whose rows were moved before."""
    if sf_dir in LANDED and not dealt:
        return {n: spark.read.parquet(f"{LANDED[sf_dir]}/{n}") for n in names}
    tables = {t: table(spark, sf_dir, t) for t in DRIVER_TABLES} | dict(dealt or {})
    return {n: spark.sql(VIEWS[n], **{t: d for t, d in tables.items() if f"{{{t}}}" in VIEWS[n]})
            .toDF(*RAW[n].fieldNames()) for n in names}


def view_sql(name: str) -> str:
    """The SELECT of a raw table over the driver's own table names."""
    return VIEWS[name].format(**{t: t for t in DRIVER_TABLES}).strip()


def break_inside(spark: SparkSession, folder: str) -> None:
    """Zero the later half of the data of every Parquet file in a folder; heads and footers stay as they are."""
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in store.listStatus(path):
        if status.getPath().getName().endswith(".parquet"):
            stream = store.open(status.getPath())
            data = bytearray(stream.readAllBytes())
            stream.close()
            footer = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
            data[footer // 2:footer] = bytes(footer - footer // 2)
            out = store.create(status.getPath(), True)
            out.write(data)
            out.close()
