"""The six cleaned tables: codes become labels, columns are picked and ordered."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.codes import (
    AMENDMENT, DESIGNATION, INCUMBENCY, ORGANIZATION, district_label, label, zip5,
)
from tallybook.operators.lookups import with_label


def src_candidates(candidates: DataFrame, political_parties: DataFrame) -> DataFrame:
    rows = with_label(candidates, "cand_pty_affiliation", political_parties, "party_code", "party_code_desc")
    return rows.select(
        "cand_id", "cand_name", "party_code_desc", "cand_election_yr", "cand_office_st", "cand_office",
        district_label(F.col("cand_office_st"), F.col("cand_office_district")).alias("cand_office_district"),
        label(F.col("cand_ici"), INCUMBENCY, keep_unknown=False).alias("cand_ici"),
        "cand_status", "cand_city", "cand_st")


def src_committees(committees: DataFrame, committee_types: DataFrame, political_parties: DataFrame) -> DataFrame:
    rows = with_label(committees, "cmte_tp", committee_types, "cmte_typ_code", "cmte_typ")
    rows = with_label(rows, "cmte_pty_affiliation", political_parties, "party_code", "party_code_desc", "left")
    return rows.select(
        "cmte_id", "cmte_nm", "cmte_city", "cmte_st", "cmte_zip",
        label(F.col("cmte_dsgn"), DESIGNATION).alias("cmte_dsgn"),
        "cmte_typ", "party_code_desc",
        label(F.col("org_tp"), ORGANIZATION).alias("org_tp"),
        "connected_org_nm", "cand_id")


def _reports(filings: DataFrame, report_types: DataFrame) -> DataFrame:
    """Filings with the amendment and the report type in words."""
    rows = filings.withColumn("amndt_id", label(F.col("amndt_ind"), AMENDMENT))
    return with_label(rows, "rpt_tp", report_types, "rp_typ_code", "rp_typ")


def _transactions(filings: DataFrame, report_types: DataFrame, transaction_types: DataFrame) -> DataFrame:
    """Filings with the transaction type in words as well."""
    rows = _reports(filings, report_types)
    return with_label(rows, "transaction_tp", transaction_types, "trans_tp", "trans_tp_desc")


# The columns that the three transaction tables share, in output order.
PAYEE = ["cmte_id", "amndt_id", "rp_typ", "transaction_pgi", "trans_tp_desc", "entity_tp", "name", "city", "state"]
DETAIL = ["employer", "occupation", "transaction_dt", "transaction_amt"]


def src_committee_transactions(committee_trans: DataFrame, report_types: DataFrame,
                               transaction_types: DataFrame) -> DataFrame:
    rows = _transactions(committee_trans, report_types, transaction_types)
    return rows.select(*PAYEE, "zip_code", *DETAIL, "other_id", "memo_text", "sub_id")


def src_independent_exp(independent_exp: DataFrame, report_types: DataFrame,
                        transaction_types: DataFrame) -> DataFrame:
    rows = _transactions(independent_exp, report_types, transaction_types)
    return rows.select(*PAYEE, "zip_code", *DETAIL, "other_id", "cand_id", "sub_id")


def src_indiv_contributions(indiv_contributions: DataFrame, report_types: DataFrame,
                            transaction_types: DataFrame) -> DataFrame:
    rows = _transactions(indiv_contributions, report_types, transaction_types)
    return rows.select(*PAYEE, zip5(F.col("zip_code")).alias("zip_code"), *DETAIL, "sub_id")


def src_operating_exp(operating_exp: DataFrame, report_types: DataFrame) -> DataFrame:
    return _reports(operating_exp, report_types).select(
        "cmte_id", "amndt_id", "rpt_yr", "rp_typ", "name", "city", "state", "zip_code",
        "transaction_amt", "transaction_dt", "purpose", "category_desc", "memo_text", "sub_id")
