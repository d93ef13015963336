"""The six marts. They stay lazy: each read plans them anew over the cleaned tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.codes import OFFICE, label, or_other

CYCLE = 2024
CANDIDATE = ["cand_name", "party_code_desc", "cand_office_st", "cand_office", "cand_office_district"]


def fct_cand_committee_trans(src_independent_exp: DataFrame, src_candidates: DataFrame,
                             src_committees: DataFrame) -> DataFrame:
    """Payments that name a candidate, without terminated filings (and without unknown amendment)."""
    payments = src_independent_exp.where(F.col("cand_id").isNotNull() & (F.col("amndt_id") != "Termination"))
    return (payments
            .join(src_candidates.select("cand_id", "cand_name"), "cand_id")
            .join(src_committees.select("cmte_id", "cmte_nm"), "cmte_id")
            .select("cmte_id", "cmte_nm", "amndt_id", "rp_typ", "trans_tp_desc",
                    F.col("cand_name").alias("cand_repcipient"), F.col("city").alias("cand_city"),
                    F.col("state").alias("cand_state"), F.col("zip_code").alias("cand_zip_code"),
                    "transaction_dt", "transaction_amt", "sub_id"))


def fct_candidate_indiv_cont(src_candidates: DataFrame, cand_cmte_link: DataFrame,
                             src_indiv_contributions: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """Contributions per candidate of the cycle, over the many-to-many committee links.

    Contributions are summed before they meet the links: a committee with very
    many of them is reduced before any shuffle, and none is repeated per linked
    candidate. Sums of sums are the same sums. They are kept apart by entity type,
    a handful of values, so that a join too large to broadcast shuffles both of
    its sides by itself; adaptive execution can split a hot committee only then.
    """
    sums = src_indiv_contributions.groupBy("cmte_id", "entity_tp").agg(F.sum("transaction_amt").alias("amt"))
    return _candidate_totals(sums.select("cmte_id", "amt"), "amt", cand_cmte_link, src_candidates, cycle)


def candidate_totals_direct(src_candidates: DataFrame, cand_cmte_link: DataFrame,
                            src_indiv_contributions: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """The same totals with every contribution carried through the joins."""
    contributions = src_indiv_contributions.select("cmte_id", "transaction_amt")
    return _candidate_totals(contributions, "transaction_amt", cand_cmte_link, src_candidates, cycle)


def _candidate_totals(amounts: DataFrame, amount: str, cand_cmte_link: DataFrame,
                      src_candidates: DataFrame, cycle: int) -> DataFrame:
    """Totals per candidate attributes, grouped by the raw office code that is put in words afterwards.

    The amounts come first in the joins, so what they meet is each time one table of known size.
    """
    links = cand_cmte_link.where(F.col("cand_election_yr") == cycle).select("cand_id", "cmte_id")
    candidates = src_candidates.where(F.col("cand_election_yr") == cycle).select("cand_id", *CANDIDATE)
    rows = amounts.join(links, "cmte_id").join(candidates, "cand_id")
    totals = rows.groupBy(*CANDIDATE).agg(F.sum(amount).alias("total_contributions"))
    return totals.withColumn("cand_office", label(F.col("cand_office"), OFFICE))


def fct_committee_operating_exp(src_operating_exp: DataFrame, src_committees: DataFrame) -> DataFrame:
    committees = src_committees.select("cmte_id", F.col("cmte_nm").alias("cmte_name"))
    return src_operating_exp.join(committees, "cmte_id").select(
        "cmte_id", "cmte_name", "name", "city", "state", "purpose", "category_desc",
        "transaction_amt", "transaction_dt", "sub_id")


def fct_candidate_operating_exp(src_operating_exp: DataFrame, src_committees: DataFrame,
                                src_candidates: DataFrame) -> DataFrame:
    """Spending of committees that belong to a known candidate."""
    committees = src_committees.select("cmte_id", F.col("cmte_nm").alias("cmte_name"), "cand_id")
    return (src_operating_exp
            .join(committees, "cmte_id")
            .join(src_candidates.select("cand_id", "cand_name"), "cand_id")
            .select("cmte_id", "cmte_name", "cand_name", "name", "city", "state", "purpose",
                    "category_desc", "transaction_amt", "transaction_dt", "sub_id"))


def fct_categories_operating_exp(fct_committee_operating_exp: DataFrame) -> DataFrame:
    category = or_other(F.col("category_desc")).alias("category")
    return fct_committee_operating_exp.groupBy(category).agg(F.sum("transaction_amt").alias("transaction_amt"))


def fct_indiv_cont_by_state(src_indiv_contributions: DataFrame) -> DataFrame:
    """Contributions per state; rows without a state form a group of their own."""
    return src_indiv_contributions.groupBy("state").agg(F.sum("transaction_amt").alias("sum_individual_cont"))
