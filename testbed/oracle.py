"""SQL that computes each registered query's rows over the driver's tables, for an independent check.

Each text is one statement: the raw tables it needs as CTEs, then the query,
written from the meaning of the models and not from the Spark code.
"""

from tallybook.schemas import BULK
from testbed.fixtures import view_sql


def over(names: str, sql: str) -> str:
    ctes = ", ".join(f"{name} AS ({view_sql(name)})" for name in names.split())
    return f"WITH {ctes} {sql.strip()}"


def declared(name: str, **instead: str) -> str:
    """All declared columns of a raw table, shown as the queries show them."""
    cast = {"decimal(18,2)": "DOUBLE", "date": "VARCHAR"}
    parts = []
    for field in BULK[name].schema:
        value = instead.get(field.name, field.name.lower())
        kind = cast.get(field.dataType.simpleString())
        parts.append(f'CAST({value} AS {kind}) AS "{field.name}"' if kind else f'{value} AS "{field.name}"')
    return over(name, f"SELECT {', '.join(parts)} FROM {name}")


AMENDED = """CASE {0}.amndt_ind WHEN 'N' THEN 'New' WHEN 'A' THEN 'Amendment' WHEN 'T' THEN 'Termination'
             ELSE {0}.amndt_ind END"""
OFFICE_NAME = "CASE {0} WHEN 'H' THEN 'House' WHEN 'S' THEN 'Senate' WHEN 'P' THEN 'President' ELSE {0} END"
DESIGNATION_NAME = """CASE cmte_dsgn WHEN 'A' THEN 'Authorized by Candidate' WHEN 'B' THEN 'Lobbyist/Registrant PAC'
    WHEN 'D' THEN 'Leadership PAC' WHEN 'J' THEN 'Joint Fundrasier'
    WHEN 'P' THEN 'Principal Campaign Committee of the Candidate' WHEN 'U' THEN 'Unauthorized' ELSE cmte_dsgn END"""
ORGANIZATION_NAME = """CASE org_tp WHEN 'C' THEN 'Administratively Terminated' WHEN 'L' THEN 'Membership Organization'
    WHEN 'T' THEN 'Trade Association' WHEN 'V' THEN 'Cooperative' WHEN 'W' THEN 'Cooperative w/o Capital Stock'
    ELSE org_tp END"""
INCUMBENCY_NAME = "CASE cand_ici WHEN 'I' THEN 'Incumbent' WHEN 'C' THEN 'Challenger' WHEN 'O' THEN 'Open Seat' END"

LINES = f"""SELECT {{0}}.cmte_id AS cmte_id, {AMENDED} AS amndt_id, r.rp_typ AS rp_typ,
    {{0}}.transaction_pgi AS transaction_pgi, t.trans_tp_desc AS trans_tp_desc, {{0}}.entity_tp AS entity_tp,
    {{0}}.name AS name, {{0}}.city AS city, {{0}}.state AS state, {{1}} AS zip_code, {{0}}.employer AS employer,
    {{0}}.occupation AS occupation, {{0}}.transaction_dt AS transaction_dt,
    {{0}}.transaction_amt AS transaction_amt, {{2}} {{0}}.sub_id AS sub_id
    FROM {{0}}, report_types r, transaction_types t
    WHERE r.rp_typ_code = {{0}}.rpt_tp AND t.trans_tp = {{0}}.transaction_tp"""

# The cleaned tables, with exact amounts and dates.
CLEANED = {
    "src_candidates": (
        "candidates political_parties",
        f"""SELECT c.cand_id AS cand_id, c.cand_name AS cand_name, p.party_code_desc AS party_code_desc,
            c.cand_election_yr AS cand_election_yr, c.cand_office_st AS cand_office_st,
            c.cand_office AS cand_office, c.cand_office_st || c.cand_office_district AS cand_office_district,
            {INCUMBENCY_NAME} AS cand_ici, c.cand_status AS cand_status, c.cand_city AS cand_city,
            c.cand_st AS cand_st
            FROM candidates c, political_parties p WHERE p.party_code = c.cand_pty_affiliation"""),
    "src_committees": (
        "committees committee_types political_parties",
        f"""SELECT m.cmte_id AS cmte_id, m.cmte_nm AS cmte_nm, m.cmte_city AS cmte_city, m.cmte_st AS cmte_st,
            m.cmte_zip AS cmte_zip, {DESIGNATION_NAME} AS cmte_dsgn, k.cmte_typ AS cmte_typ,
            (SELECT max(p.party_code_desc) FROM political_parties p
             WHERE p.party_code = m.cmte_pty_affiliation) AS party_code_desc,
            {ORGANIZATION_NAME} AS org_tp, m.connected_org_nm AS connected_org_nm, m.cand_id AS cand_id
            FROM committees m, committee_types k WHERE k.cmte_typ_code = m.cmte_tp"""),
    "src_committee_transactions": (
        "committee_trans report_types transaction_types",
        LINES.format("committee_trans", "committee_trans.zip_code", """committee_trans.other_id AS other_id,
            committee_trans.memo_text AS memo_text,""")),
    "src_independent_exp": (
        "independent_exp report_types transaction_types",
        LINES.format("independent_exp", "independent_exp.zip_code", """independent_exp.other_id AS other_id,
            independent_exp.cand_id AS cand_id,""")),
    "src_indiv_contributions": (
        "indiv_contributions report_types transaction_types",
        LINES.format("indiv_contributions", "substr(indiv_contributions.zip_code, 1, 5)", "")),
    "src_operating_exp": (
        "operating_exp report_types",
        f"""SELECT o.cmte_id AS cmte_id, {AMENDED.format('o')} AS amndt_id, o.rpt_yr AS rpt_yr, r.rp_typ AS rp_typ,
            o.name AS name, o.city AS city, o.state AS state, o.zip_code AS zip_code,
            o.transaction_amt AS transaction_amt, o.transaction_dt AS transaction_dt, o.purpose AS purpose,
            o.category_desc AS category_desc, o.memo_text AS memo_text, o.sub_id AS sub_id
            FROM operating_exp o, report_types r WHERE r.rp_typ_code = o.rpt_tp"""),
}

# The marts: the cleaned tables and raw tables each reads, and its rows.
MARTS = {
    "fct_cand_committee_trans": (
        "src_independent_exp src_candidates src_committees", "",
        """SELECT i.cmte_id AS cmte_id, m.cmte_nm AS cmte_nm, i.amndt_id AS amndt_id, i.rp_typ AS rp_typ,
           i.trans_tp_desc AS trans_tp_desc, k.cand_name AS cand_repcipient, i.city AS cand_city,
           i.state AS cand_state, i.zip_code AS cand_zip_code, i.transaction_dt AS transaction_dt,
           i.transaction_amt AS transaction_amt, i.sub_id AS sub_id
           FROM src_independent_exp i, src_candidates k, src_committees m
           WHERE k.cand_id = i.cand_id AND m.cmte_id = i.cmte_id AND i.amndt_id <> 'Termination'"""),
    "fct_candidate_indiv_cont": (
        "src_candidates src_indiv_contributions", "cand_cmte_link",
        f"""SELECT cand_name, party_code_desc, cand_office_st, {OFFICE_NAME.format('office')} AS cand_office,
            cand_office_district, total_contributions
            FROM (SELECT k.cand_name AS cand_name, k.party_code_desc AS party_code_desc,
                  k.cand_office_st AS cand_office_st, k.cand_office AS office,
                  k.cand_office_district AS cand_office_district, sum(i.transaction_amt) AS total_contributions
                  FROM src_candidates k, cand_cmte_link l, src_indiv_contributions i
                  WHERE l.cand_id = k.cand_id AND i.cmte_id = l.cmte_id
                    AND k.cand_election_yr = 2024 AND l.cand_election_yr = 2024
                  GROUP BY 1, 2, 3, 4, 5) AS by_raw_office"""),
    "fct_candidate_operating_exp": (
        "src_operating_exp src_committees src_candidates", "",
        """SELECT o.cmte_id AS cmte_id, m.cmte_nm AS cmte_name, k.cand_name AS cand_name, o.name AS name,
           o.city AS city, o.state AS state, o.purpose AS purpose, o.category_desc AS category_desc,
           o.transaction_amt AS transaction_amt, o.transaction_dt AS transaction_dt, o.sub_id AS sub_id
           FROM src_operating_exp o LEFT JOIN src_committees m ON m.cmte_id = o.cmte_id
           JOIN src_candidates k ON k.cand_id = m.cand_id"""),
    "fct_committee_operating_exp": (
        "src_operating_exp src_committees", "",
        """SELECT o.cmte_id AS cmte_id, m.cmte_nm AS cmte_name, o.name AS name, o.city AS city, o.state AS state,
           o.purpose AS purpose, o.category_desc AS category_desc, o.transaction_amt AS transaction_amt,
           o.transaction_dt AS transaction_dt, o.sub_id AS sub_id
           FROM src_operating_exp o JOIN src_committees m ON m.cmte_id = o.cmte_id"""),
    "fct_categories_operating_exp": (
        "src_operating_exp src_committees", "",
        """SELECT coalesce(o.category_desc, 'Other') AS category, sum(o.transaction_amt) AS transaction_amt
           FROM src_operating_exp o JOIN src_committees m ON m.cmte_id = o.cmte_id
           GROUP BY coalesce(o.category_desc, 'Other')"""),
    "fct_indiv_cont_by_state": (
        "src_indiv_contributions", "",
        """SELECT state AS state, sum(transaction_amt) AS sum_individual_cont
           FROM src_indiv_contributions GROUP BY state"""),
}


def model_ctes(marts: list[str], cleaned: list[str]) -> str:
    """A WITH clause with the models named and everything they read."""
    cleaned = list(dict.fromkeys(cleaned + [c for m in marts for c in MARTS[m][0].split()]))
    raw = [r for c in cleaned for r in CLEANED[c][0].split()] + [r for m in marts for r in MARTS[m][1].split()]
    parts = ([f"{r} AS ({view_sql(r)})" for r in dict.fromkeys(raw)]
             + [f"{c} AS ({CLEANED[c][1]})" for c in cleaned]
             + [f"{m} AS ({MARTS[m][2]})" for m in marts])
    return "WITH " + ", ".join(parts)


# How the amounts and dates of a model are shown.
SHOWN = {
    "transaction_amt": "CAST(transaction_amt AS DOUBLE) AS transaction_amt",
    "total_contributions": "CAST(total_contributions AS DOUBLE) AS total_contributions",
    "sum_individual_cont": "CAST(sum_individual_cont AS DOUBLE) AS sum_individual_cont",
    "transaction_dt": "CAST(transaction_dt AS VARCHAR) AS transaction_dt",
}


def shown_model(name: str, columns: str) -> str:
    ctes = model_ctes([name], []) if name in MARTS else model_ctes([], [name])
    return f"{ctes} SELECT {', '.join(SHOWN.get(c, c) for c in columns.split())} FROM {name}"


# The output columns of each model.
COLUMNS = {
    "src_candidates": """cand_id cand_name party_code_desc cand_election_yr cand_office_st cand_office
        cand_office_district cand_ici cand_status cand_city cand_st""",
    "src_committee_transactions": """cmte_id amndt_id rp_typ transaction_pgi trans_tp_desc entity_tp name city state
        zip_code employer occupation transaction_dt transaction_amt other_id memo_text sub_id""",
    "src_committees": """cmte_id cmte_nm cmte_city cmte_st cmte_zip cmte_dsgn cmte_typ party_code_desc org_tp
        connected_org_nm cand_id""",
    "src_independent_exp": """cmte_id amndt_id rp_typ transaction_pgi trans_tp_desc entity_tp name city state
        zip_code employer occupation transaction_dt transaction_amt other_id cand_id sub_id""",
    "src_indiv_contributions": """cmte_id amndt_id rp_typ transaction_pgi trans_tp_desc entity_tp name city state
        zip_code employer occupation transaction_dt transaction_amt sub_id""",
    "src_operating_exp": """cmte_id amndt_id rpt_yr rp_typ name city state zip_code transaction_amt transaction_dt
        purpose category_desc memo_text sub_id""",
    "fct_cand_committee_trans": """cmte_id cmte_nm amndt_id rp_typ trans_tp_desc cand_repcipient cand_city cand_state
        cand_zip_code transaction_dt transaction_amt sub_id""",
    "fct_candidate_indiv_cont": """cand_name party_code_desc cand_office_st cand_office cand_office_district
        total_contributions""",
    "fct_candidate_operating_exp": """cmte_id cmte_name cand_name name city state purpose category_desc
        transaction_amt transaction_dt sub_id""",
    "fct_committee_operating_exp": """cmte_id cmte_name name city state purpose category_desc transaction_amt
        transaction_dt sub_id""",
    "fct_categories_operating_exp": "category transaction_amt",
    "fct_indiv_cont_by_state": "state sum_individual_cont",
}


def all_model_totals() -> str:
    lines = []
    for name, columns in COLUMNS.items():
        amount = next((c for c in columns.split()
                       if c in ("transaction_amt", "total_contributions", "sum_individual_cont")), None)
        total = f"CAST(sum({amount}) AS DOUBLE)" if amount else "CAST(NULL AS DOUBLE)"
        lines.append(f"SELECT '{name}' AS model, count(*) AS n_rows, {total} AS total FROM {name}")
    return f"{model_ctes(list(MARTS), list(CLEANED))} {' UNION ALL '.join(lines)}"


def decoded(name: str, key: str, code: str, text: str) -> str:
    return over(name, f"SELECT {key} AS {key}, {code} AS code, {text} AS label FROM {name}")


SUPPLIER_CODES = """SELECT '0' || CAST(s_suppkey AS VARCHAR) AS code,
    '  "' || s_name || '" | NATION ' || CAST(s_nationkey AS VARCHAR) || ' ' AS label FROM supplier"""

PAGE_CODES = """
SELECT page_id, 'P' || CAST(page_id AS VARCHAR) AS code,
       'Page "' || CAST(page_id AS VARCHAR) || '" | ' || url AS label FROM pages
UNION ALL
SELECT page_id, 'Q' || CAST(page_id AS VARCHAR), 'shared <' || CAST(page_id AS VARCHAR) || '>' FROM pages
UNION ALL
SELECT page_id, 'R' || CAST(page_id AS VARCHAR), 'shared <' || CAST(page_id AS VARCHAR) || '>' FROM pages
UNION ALL
SELECT page_id, 'S' || CAST(page_id AS VARCHAR), CAST(NULL AS VARCHAR) FROM pages
"""

LANDED = """
WITH landed AS (
    SELECT *, o_orderkey % 16 AS file_no,
           CASE o_orderkey % 4 WHEN 0 THEN FALSE WHEN 1 THEN (o_orderkey // 16) % 25 = 0
                WHEN 2 THEN (o_orderkey // 16) % 17 = 0 ELSE TRUE END AS spoilt
    FROM orders),
files AS (
    SELECT file_no, count(*) AS n_rows, count(*) FILTER (spoilt) AS n_bad FROM landed GROUP BY file_no)
"""
LANDED_GOOD = LANDED + """
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice
FROM landed JOIN files USING (file_no) WHERE NOT spoilt AND n_bad <= 0.05 * n_rows
"""


# Spending lines by the file they are put in, and those that get a wrong field count.
SPOILT_LINES = """
    SELECT *, file_num % 16 AS file_no, file_num // 16 AS nth,
           CASE file_num % 4 WHEN 1 THEN (file_num // 16) % 25 = 0 WHEN 2 THEN (file_num // 16) % 3 = 0
                ELSE FALSE END AS wrong
    FROM operating_exp"""
SPOILT = f", spoilt AS ({SPOILT_LINES}) "
SPOILT_KEPT = f""" FROM (SELECT * FROM ({SPOILT_LINES}) AS s
    QUALIFY count(*) FILTER (wrong) OVER (PARTITION BY file_no) <= 0.05 * count(*) OVER (PARTITION BY file_no)) AS kept
    WHERE NOT wrong"""


def shipped(date_format: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '{date_format}') AS text,
        CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped FROM lineitem"""


ORACLE: dict[str, str] = {
    "scan_delimited": declared("indiv_contributions"),
    "scan_delimited_header": declared("committees"),
    "scan_lenient": declared(
        "operating_exp", TRANSACTION_AMT="CASE WHEN memo_cd IS NULL THEN transaction_amt END",
        TRANSACTION_DT="CASE WHEN category_desc IS NOT NULL THEN transaction_dt END",
        RPT_YR="CAST(CASE WHEN category <> '3' THEN rpt_yr END AS VARCHAR)", SUB_ID="CAST(sub_id AS VARCHAR)",
        FILE_NUM="CAST(file_num AS VARCHAR)"),
    "header_dictionary": declared("cand_cmte_link"),
    "html_table_extract": PAGE_CODES,
    "staged_scan": declared("independent_exp"),
    "staged_delimited_scan": SUPPLIER_CODES,
    "parquet_round_trip": declared("committee_trans"),
    "delimited_round_trip": SUPPLIER_CODES,
    "full_refresh": declared("candidates"),
    "load_by_name": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS o_orderpriority,
        o_totalprice, CAST(NULL AS VARCHAR) AS o_clerk, CAST(NULL AS VARCHAR) AS o_items FROM orders""",
    "load_by_position": "SELECT s_suppkey AS supplier, s_nationkey AS nation, s_name AS name FROM supplier",
    "load_skip_bad_files": LANDED_GOOD,
    "load_report": LANDED + """
SELECT file_no, n_rows, n_bad, CAST(0 AS BIGINT) AS n_without_key, n_bad > 0.05 * n_rows AS skipped FROM files""",
    "guarded_refresh": LANDED_GOOD,
    "ingest_code_table": f"SELECT code, label FROM ({PAGE_CODES}) AS extracted",
    **{f"ingest_{name}": declared(name) for name in BULK},
    "rename_positional": """SELECT c_custkey AS c_name, c_name AS c_custkey, c_nationkey AS "NATION",
        c_acctbal AS "BALANCE", c_mktsegment FROM customer""",
    "drop_trailing_column": "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier",
    "cast_to_schema": declared("operating_exp"),
    "parse_date_compact": shipped("%m%d%Y"),
    "parse_date_slash": shipped("%-m/%-d/%Y"),
    "filter_not_null": over("independent_exp", """SELECT sub_id, cand_id, CAST(transaction_amt AS DOUBLE)
        AS transaction_amt FROM independent_exp WHERE cand_id IS NOT NULL"""),
    "filter_equals": over("cand_cmte_link", """SELECT cand_id, cmte_id, cand_election_yr, linkage_id
        FROM cand_cmte_link WHERE cand_election_yr = 2024"""),
    "filter_not_equals": over("independent_exp", f"""SELECT sub_id, {AMENDED.format('independent_exp')} AS amndt_id
        FROM independent_exp WHERE amndt_ind <> 'T'"""),
    "decode_amendment": decoded("committee_trans", "sub_id", "amndt_ind", AMENDED.format("committee_trans")),
    "decode_designation": decoded("committees", "cmte_id", "cmte_dsgn", DESIGNATION_NAME),
    "decode_org_type": decoded("committees", "cmte_id", "org_tp", ORGANIZATION_NAME),
    "decode_incumbency": decoded("candidates", "cand_id", "cand_ici", INCUMBENCY_NAME),
    "decode_office": decoded("candidates", "cand_id", "cand_office", OFFICE_NAME.format("cand_office")),
    "null_to_other": over("operating_exp", """SELECT sub_id, category_desc,
        coalesce(category_desc, 'Other') AS category FROM operating_exp"""),
    "district_label": over("candidates", """SELECT cand_id, cand_office_st || cand_office_district AS district
        FROM candidates"""),
    "zip5": over("indiv_contributions", "SELECT sub_id, substr(zip_code, 1, 5) AS zip5 FROM indiv_contributions"),
    **{name: shown_model(name, columns) for name, columns in COLUMNS.items()},
    "bridge_sum": shown_model("fct_candidate_indiv_cont", COLUMNS["fct_candidate_indiv_cont"]),
    "refresh_models": all_model_totals(),
    "restage_run": declared("independent_exp") + " WHERE file_num % 2 = 0",
    "load_mixed_files": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_orderkey % 4 <> 1 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice
FROM orders WHERE o_orderkey % 4 <> 3""",
    "load_case_mixed": """
SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY",
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) END AS "O_CUSTKEY",
       CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS "O_CLERK" FROM orders""",
    "load_broken_inside": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, '1' AS n_broken
FROM orders WHERE o_orderkey % 4 <> 2""",
    "key_audit": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(sum(times) AS VARCHAR) AS n_rows
FROM (SELECT CASE WHEN o_orderkey % 211 <> 0 THEN o_orderkey END AS o_orderkey,
             CASE WHEN o_orderkey % 97 = 0 THEN 2 WHEN o_orderkey % 1009 = 0 THEN 500 ELSE 1 END AS times FROM orders) AS planted
GROUP BY 1 HAVING sum(times) > 1""",
    "load_after_refused_ingest": declared(
        "operating_exp", RPT_YR="CAST(rpt_yr AS VARCHAR)", SUB_ID="CAST(sub_id AS VARCHAR)",
        FILE_NUM="CAST(file_num AS VARCHAR)").replace(" FROM operating_exp", ", 'staging refused' AS states FROM operating_exp"),
    "ingest_operating_exp_rejects": over("operating_exp", SPOILT + """
SELECT file_no, count(*) AS n_rows, count(*) FILTER (wrong) AS n_wrong,
       CAST(sum(CASE WHEN wrong THEN 0 WHEN category IN ('3', '4') THEN 1 ELSE 0 END) AS BIGINT) AS n_nulled,
       count(*) FILTER (wrong) > 0.05 * count(*) AS skipped,
       count(*) FILTER (wrong) AS n_lines, count(*) FILTER (wrong AND nth % 2 = 0) AS n_long
FROM spoilt GROUP BY file_no"""),
    "ingest_operating_exp_spoilt": declared(
        "operating_exp", RPT_YR="CAST(CASE WHEN category <> '3' THEN rpt_yr END AS VARCHAR)",
        TRANSACTION_AMT="CASE WHEN category <> '4' THEN transaction_amt END", SUB_ID="CAST(sub_id AS VARCHAR)",
        FILE_NUM="CAST(file_num AS VARCHAR)").replace(" FROM operating_exp", SPOILT_KEPT),
    "ingest_cand_cmte_link_by_header": declared("cand_cmte_link"),
    "ingest_operating_exp_by_header": declared("operating_exp"),
    "marts_from_catalog": f"{model_ctes(list(MARTS), [])} " + " UNION ALL ".join(
        f"SELECT '{name}' AS model, concat_ws('|', " + ", ".join(
            f"coalesce(CAST({'CAST(transaction_dt AS DATE)' if c == 'transaction_dt' else c} AS VARCHAR), 'none')"
            for c in COLUMNS[name].split()) + f") AS line FROM {name}" for name in MARTS),
}
