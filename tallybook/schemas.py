"""Declared layouts of the eleven raw tables.

Amounts are decimal(18,2) so that sums are exact; dates are typed while the
text is read, with the format kept next to the layout.
"""

from dataclasses import dataclass

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(), "smallint": T.ShortType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "boolean": T.BooleanType(), "double": T.DoubleType(), "date": T.DateType(), "amount": T.DecimalType(18, 2),
}


def columns(text: str) -> T.StructType:
    """A schema from "name type, name type"; unlike DDL text it needs no running session."""
    pairs = (pair.split() for pair in text.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class BulkFormat:
    """One pipe-delimited bulk dataset: its columns and how its text is shaped."""

    schema: T.StructType
    date_format: str | None = None
    trailing_delimiter: bool = False
    lenient: bool = False  # values that do not fit their type turn null instead of failing the read
    cluster: tuple[str, ...] = ()  # how staged rows are ordered: by range of the first column, ties by the last

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


# The published layouts of the bulk files, in file order.
CANDIDATES = """
    CAND_ID string, CAND_NAME string, CAND_PTY_AFFILIATION string, CAND_ELECTION_YR smallint,
    CAND_OFFICE_ST string, CAND_OFFICE string, CAND_OFFICE_DISTRICT string, CAND_ICI string,
    CAND_STATUS string, CAND_PCC string, CAND_ST1 string, CAND_ST2 string, CAND_CITY string,
    CAND_ST string, CAND_ZIP string
"""
CAND_CMTE_LINK = """
    CAND_ID string, CAND_ELECTION_YR int, FEC_ELECTION_YR int, CMTE_ID string, CMTE_TP string,
    CMTE_DSGN string, LINKAGE_ID int
"""
COMMITTEES = """
    CMTE_ID string, CMTE_NM string, TRESNAM string, CMTE_ST1 string, CMTE_ST2 string,
    CMTE_CITY string, CMTE_ST string, CMTE_ZIP string, CMTE_DSGN string, CMTE_TP string,
    CMTE_PTY_AFFILIATION string, CMTE_FILING_FREQ string, ORG_TP string,
    CONNECTED_ORG_NM string, CAND_ID string
"""
COMMITTEE_TRANS = """
    CMTE_ID string, AMNDT_IND string, RPT_TP string, TRANSACTION_PGI string, IMAGE_NUM string,
    TRANSACTION_TP string, ENTITY_TP string, NAME string, CITY string, STATE string,
    ZIP_CODE string, EMPLOYER string, OCCUPATION string, TRANSACTION_DT date,
    TRANSACTION_AMT amount, OTHER_ID string, TRAN_ID string, FILE_NUM string,
    MEMO_CD string, MEMO_TEXT string, SUB_ID string
"""
INDEPENDENT_EXP = """
    CMTE_ID string, AMNDT_IND string, RPT_TP string, TRANSACTION_PGI string, IMAGE_NUM string,
    TRANSACTION_TP string, ENTITY_TP string, NAME string, CITY string, STATE string,
    ZIP_CODE string, EMPLOYER string, OCCUPATION string, TRANSACTION_DT date,
    TRANSACTION_AMT amount, OTHER_ID string, CAND_ID string, TRAN_ID string,
    FILE_NUM int, MEMO_CD string, MEMO_TEXT string, SUB_ID string
"""
INDIV_CONTRIBUTIONS = """
    CMTE_ID string, AMNDT_IND string, RPT_TP string, TRANSACTION_PGI string, IMAGE_NUM string,
    TRANSACTION_TP string, ENTITY_TP string, NAME string, CITY string, STATE string,
    ZIP_CODE string, EMPLOYER string, OCCUPATION string, TRANSACTION_DT date,
    TRANSACTION_AMT amount, OTHER_ID string, TRAN_ID string, FILE_NUM int,
    MEMO_CD string, MEMO_TEXT string, SUB_ID string
"""
OPERATING_EXP = """
    CMTE_ID string, AMNDT_IND string, RPT_YR smallint, RPT_TP string, IMAGE_NUM string,
    LINE_NUM string, FORM_TP_CD string, SCHED_TP_CD string, NAME string, CITY string,
    STATE string, ZIP_CODE string, TRANSACTION_DT date, TRANSACTION_AMT amount,
    TRANSACTION_PGI string, PURPOSE string, CATEGORY string, CATEGORY_DESC string,
    MEMO_CD string, MEMO_TEXT string, ENTITY_TP string, SUB_ID bigint, FILE_NUM bigint,
    TRAN_ID string, BACK_REF_TRAN_ID string
"""
BY_COMMITTEE = ("CMTE_ID", "RPT_TP", "AMNDT_IND", "TRANSACTION_PGI", "ENTITY_TP", "STATE", "CITY", "ZIP_CODE", "TRANSACTION_DT", "SUB_ID")
COMPACT_DATE = "MMddyyyy"
SLASH_DATE = "M/d/yyyy"

BULK = {
    "candidates": BulkFormat(columns(CANDIDATES)),
    "cand_cmte_link": BulkFormat(columns(CAND_CMTE_LINK)),
    "committees": BulkFormat(columns(COMMITTEES)),
    "committee_trans": BulkFormat(columns(COMMITTEE_TRANS), COMPACT_DATE, cluster=BY_COMMITTEE),
    "independent_exp": BulkFormat(columns(INDEPENDENT_EXP), COMPACT_DATE, cluster=BY_COMMITTEE),
    "indiv_contributions": BulkFormat(columns(INDIV_CONTRIBUTIONS), COMPACT_DATE, cluster=BY_COMMITTEE),
    "operating_exp": BulkFormat(columns(OPERATING_EXP), SLASH_DATE, trailing_delimiter=True, lenient=True,
                                cluster=BY_COMMITTEE),
}

# The code tables, each a code and its label.
CODES = {
    "political_parties": columns("party_code string, party_code_desc string"),
    "committee_types": columns("cmte_typ_code string, cmte_typ string"),
    "report_types": columns("rp_typ_code string, rp_typ string"),
    "transaction_types": columns("trans_tp string, trans_tp_desc string"),
}

# The physical name of each raw table in a database.
SOURCES = {
    "candidates": "raw_candidates", "committees": "raw_committees", "transaction_types": "raw_transaction_types",
    "committee_types": "raw_committee_types", "political_parties": "raw_political_parties",
    "indiv_contributions": "raw_individual_contributions", "report_types": "raw_report_types",
    "committee_trans": "raw_committee_transactions", "operating_exp": "raw_operating_expenditures",
    "independent_exp": "raw_independent_expenditures", "cand_cmte_link": "raw_cand_cmte_link",
}

RAW = {name: bulk.schema for name, bulk in BULK.items()} | CODES


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])

# The ids that the publisher says are unique, by raw table.
UNIQUE = {"committees": ("CMTE_ID",), "indiv_contributions": ("SUB_ID",), "operating_exp": ("SUB_ID",)}
