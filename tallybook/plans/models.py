"""Which model reads what, and a refresh of all of them."""

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from inspect import Parameter, signature

from pyspark.sql import DataFrame, SparkSession

from tallybook.operators.ledger import BEGUN, CURRENT, note_load, sweep_loads
from tallybook.operators.load import switch_view, write_load, written
from tallybook.plans import cleaned, marts
from tallybook.plans.published import publish, withdraw
from tallybook.schemas import SOURCES

CLEANED: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (
        cleaned.src_candidates, cleaned.src_committee_transactions, cleaned.src_committees,
        cleaned.src_independent_exp, cleaned.src_indiv_contributions, cleaned.src_operating_exp)
}
MARTS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (
        marts.fct_cand_committee_trans, marts.fct_candidate_indiv_cont, marts.fct_candidate_operating_exp,
        marts.fct_committee_operating_exp, marts.fct_categories_operating_exp, marts.fct_indiv_cont_by_state)
}
MODELS = CLEANED | MARTS
# Raw tables that marts read.
RAW_INPUTS = ("cand_cmte_link",)
# Cleaned tables that transactions are joined to.
DIMENSIONS = ("src_candidates", "src_committees")


def inputs(name: str) -> list[str]:
    """The tables a model reads: its parameters without a default are their names."""
    return [n for n, p in signature(MODELS[name]).parameters.items() if p.default is Parameter.empty]


def all_inputs(name: str) -> set[str]:
    """Every raw table and model that a model reads, directly or not."""
    direct = inputs(name)
    return set(direct).union(*[all_inputs(i) for i in direct if i in MODELS])


def model(name: str, tables: Mapping[str, DataFrame], **options) -> DataFrame:
    """A model by name; inputs not among the given tables are models themselves. Options are its parameters with a default."""
    return MODELS[name](*[tables[i] if i in tables else model(i, tables) for i in inputs(name)], **options)


def raw_from_catalog(spark: SparkSession, database: str = "raw",
                     physical: Mapping[str, str] = SOURCES) -> dict[str, DataFrame]:
    """The raw tables of a database under their logical names."""
    return {name: spark.table(f"{database}.{table}") for name, table in physical.items()}


def mart_from_raw(name: str, raw: Mapping[str, DataFrame], root: str) -> DataFrame:
    """A mart in one plan over raw transactions, which are never written.

    The candidates and committees it joins are written first. Spark then knows
    how large they are and broadcasts the small ones; its estimate for a cleaned
    table that is still a join is the product of its inputs, so it would shuffle
    every transaction to meet them. Under one root they replace those of the mart before.
    """
    tables = dict(raw)
    for dimension in DIMENSIONS:
        if dimension in all_inputs(name):
            tables[dimension] = written(model(dimension, raw), f"{root}/{dimension}", "overwrite")
    return model(name, tables)


def define_marts(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts as lazy views of the session over cleaned and raw tables, such as another session's refresh left."""
    marts = {name: model(name, tables) for name in MARTS}
    for name, rows in marts.items():
        rows.createOrReplaceTempView(name)
    return marts


def refresh_models(raw: Mapping[str, DataFrame], root: str, load_id: str, database: str | None = None,
                   min_rows: Mapping[str, int] | None = None) -> dict[str, DataFrame]:
    """Write the cleaned tables, all at once, and only when all are there let their views point to them.

    Without a database the marts are lazy views of the session over what was
    written. With one, tables and marts are views in the catalog, where any session reads them, and one pointer switches all of
    them (``plans.published``). If a table fails, or has fewer rows
    than ``min_rows`` asks of it, every view keeps the load before.
    """
    least = min_rows or {}
    spark = next(iter(raw.values())).sparkSession
    rows = {name: model(name, raw) for name in CLEANED}
    if database:
        rows |= {name: raw[name] for name in RAW_INPUTS}
    note_load(spark, root, load_id, BEGUN)
    with ThreadPoolExecutor(len(rows)) as pool:
        loads = {n: pool.submit(write_load, r, f"{root}/{n}", load_id, n, least.get(n, 0)) for n, r in rows.items()}
    tables = {n: load.result() for n, load in loads.items()}
    if database:
        publish(spark, tables, root, load_id, database)
        note_load(spark, root, load_id, CURRENT)
        return {name: tables.get(name, spark.table(f"{database}.{name}")) for name in MODELS}
    for name in tables:
        switch_view(spark, f"{root}/{name}", load_id, name)
    note_load(spark, root, load_id, CURRENT)
    return tables | define_marts({**raw, **tables})


def sweep_models(spark: SparkSession, root: str, database: str | None = None, keep: int = 2) -> list[str]:
    """Remove the refreshes that no view shows and no running refresh writes, but for the ``keep`` last ones."""
    forget = (lambda table, load_id: withdraw(spark, table, load_id, database)) if database else None
    return sweep_loads(spark, root, keep, (*CLEANED, *RAW_INPUTS), forget)
