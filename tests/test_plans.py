"""The shape of the plans: what is read, what moves, and how a hot key is met."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows_of
from tallybook.operators.load import delimited_files, match_by_position, skip_bad_files
from tallybook.plans.marts import candidate_totals_direct
from tallybook.plans.models import MARTS, mart_from_raw, model
from tallybook.schemas import RAW, columns
from testbed.fixtures import raw_tables


@pytest.fixture(scope="module")
def landed(spark, sf_dir, tmp_path_factory):
    """The raw tables as Parquet, as they are after a load."""
    root = tmp_path_factory.mktemp("raw")
    for name, rows in raw_tables(spark, sf_dir).items():
        rows.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in RAW}


@pytest.fixture
def settings(spark):
    """Session settings for one test."""
    changed = []

    def change(**values):
        for key, value in values.items():
            changed.append("spark.sql." + key.replace("__", "."))
            spark.conf.set(changed[-1], value)

    yield change
    for name in changed:
        spark.conf.unset(name)


def test_only_needed_columns_are_read(landed):
    plan = plan_of(model("fct_indiv_cont_by_state", landed))
    assert "ReadSchema: struct<RPT_TP:string,TRANSACTION_TP:string,STATE:string,TRANSACTION_AMT:decimal(18,2)>" in plan


def test_filters_reach_the_files(landed, tmp_path):
    plan = plan_of(mart_from_raw("fct_candidate_indiv_cont", landed, str(tmp_path)))
    assert "IsNotNull(CAND_ELECTION_YR), EqualTo(CAND_ELECTION_YR,2024)" in plan
    assert "EqualTo(cand_election_yr,2024)" in plan
    payments = plan_of(mart_from_raw("fct_cand_committee_trans", landed, f"{tmp_path}/2"))
    assert "IsNotNull(CAND_ID)" in payments and "IsNotNull(CMTE_ID)" in payments


@pytest.mark.parametrize("name, shuffles", [
    ("fct_cand_committee_trans", 0), ("fct_candidate_operating_exp", 0), ("fct_committee_operating_exp", 0),
    ("fct_categories_operating_exp", 1), ("fct_indiv_cont_by_state", 1), ("fct_candidate_indiv_cont", 2)])
def test_transactions_move_only_as_partial_sums(landed, tmp_path, name, shuffles):
    plan = plan_of(mart_from_raw(name, landed, str(tmp_path)), "simple")
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert "SortMergeJoin" not in plan
    assert plan.count("partial_sum") == shuffles


def test_no_python_outside_the_pages(landed):
    for name in MARTS:
        assert "Python" not in plan_of(model(name, landed))


def test_every_join_has_a_way_beyond_broadcast(landed, settings):
    expected = {name: rows_of(model(name, landed)) for name in MARTS}
    settings(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1)
    for name in MARTS:
        result = model(name, landed)
        assert rows_of(result) == expected[name]
        assert "BroadcastHashJoin" not in plan_of(result)


def hot(rows, **values):
    """The rows and as many again under one key: half of them are the hot key's."""
    return rows.unionAll(rows.withColumns({name: F.lit(value) for name, value in values.items()}))


SPLIT = dict(autoBroadcastJoinThreshold=-1, adaptive__autoBroadcastJoinThreshold=-1,
             adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB", adaptive__skewJoin__skewedPartitionFactor="1.5",
             adaptive__advisoryPartitionSizeInBytes="1KB", adaptive__coalescePartitions__enabled="false")


def spread(spark, rows, path):
    """Rows in many files, as many tasks would have written them."""
    rows.repartition(16, "SUB_ID" if "SUB_ID" in rows.columns else rows.columns[0]).write.parquet(path)
    return spark.read.parquet(path)


def test_a_hot_committee_among_transactions_is_split(spark, landed, settings, tmp_path):
    tables = dict(landed, operating_exp=spread(spark, hot(landed["operating_exp"], CMTE_ID="C1"), f"{tmp_path}/hot"))
    expected = rows_of(model("fct_committee_operating_exp", tables))
    settings(**SPLIT)
    result = model("fct_committee_operating_exp", tables)
    assert rows_of(result) == expected
    assert "skew=true" in plan_of(result)


def test_a_hot_code_is_split(spark, landed, settings, tmp_path):
    tables = dict(landed, operating_exp=spread(spark, hot(landed["operating_exp"], RPT_TP="Q1"), f"{tmp_path}/hot"))
    expected = rows_of(model("src_operating_exp", tables))
    settings(**SPLIT)
    result = model("src_operating_exp", tables)
    assert rows_of(result) == expected
    assert "skew=true" in plan_of(result)


def test_a_hot_file_is_split_when_skipped_files_are_not_broadcast(spark, settings, tmp_path):
    """Half of the rows are in one file; the list of skipped files is joined by a shuffle."""
    os.makedirs(f"{tmp_path}/in")
    for i in range(40):
        with open(f"{tmp_path}/in/{i}.txt", "w", encoding="utf-8") as file:
            file.writelines(f"{i}-{j}|{'x' if i % 4 == 3 else j}\n" for j in range(20_000 if i == 0 else 500))
    target = columns("id string, n int")
    settings(**SPLIT, files__maxPartitionBytes="16KB", files__openCostInBytes="1KB")
    rows = match_by_position(delimited_files(spark, f"{tmp_path}/in", target, header=False, quoted=False), target)
    loaded = skip_bad_files(rows, target, f"{tmp_path}/report")
    assert loaded.count() == 20_000 + 29 * 500
    kept = loaded.select("n")
    assert kept.agg(F.sum("n")).first()[0] == sum(range(20_000)) + 29 * sum(range(500))
    kept.collect()
    assert "skew=true" in plan_of(kept)


def test_a_hot_committee_among_links_is_split(spark, landed, settings, tmp_path):
    links = hot(landed["cand_cmte_link"], CMTE_ID="C1")
    for _ in range(4):
        links = hot(links, CMTE_ID="C1")
    many = links.withColumn("CAND_ID", F.concat(F.lit("K"), (F.monotonically_increasing_id() % 10).cast("string")))
    many.repartition(16).write.parquet(f"{tmp_path}/links")
    tables = dict(landed, cand_cmte_link=spark.read.parquet(f"{tmp_path}/links"))
    expected = rows_of(candidate_totals_direct(
        model("src_candidates", tables), tables["cand_cmte_link"], model("src_indiv_contributions", tables)))
    settings(**SPLIT)
    result = model("fct_candidate_indiv_cont", tables)
    assert rows_of(result) == expected
    assert "skew=true" in plan_of(result)
