"""Edge rows of the models, on raw tables of a few rows."""

import datetime as dt
import re
import uuid
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows_of
from tallybook.functions.codes import (
    AMENDMENT, DESIGNATION, INCUMBENCY, OFFICE, ORGANIZATION, district_label, label, or_other, zip5,
)
from tallybook.operators.ledger import note_load
from tallybook.operators.load import full_refresh
from tallybook.operators.lookups import with_label
from tallybook.plans.jobs import sweep_table
from tallybook.plans.marts import candidate_totals_direct
from tallybook.plans.models import (
    CLEANED, MARTS, MODELS, all_inputs, define_marts, inputs, mart_from_raw, model, raw_from_catalog, refresh_models, sweep_models,
)
from tallybook.plans.published import publish
from tallybook.schemas import RAW, SOURCES
from tallybook.scratch import application_folder, list_folder, scratch_dir, scratch_scope, sweep_scratch


def frame(spark, name: str, *rows: dict):
    """A raw table with the given fields set and all others null."""
    schema = RAW[name]
    return spark.createDataFrame([[row.get(field) for field in schema.fieldNames()] for row in rows], schema)


@pytest.fixture(scope="module")
def raw(spark):
    paid = dict(RPT_TP="Q1", TRANSACTION_TP="15", AMNDT_IND="N", TRANSACTION_DT=dt.date(2024, 1, 31))
    gifts = [dict(paid, CMTE_ID="C1", TRANSACTION_AMT=Decimal("10.10"), STATE="TX", ZIP_CODE="012345678"),
             dict(paid, CMTE_ID="C1", TRANSACTION_AMT=Decimal("0.20"), STATE=None, ENTITY_TP="IND"),
             dict(paid, CMTE_ID="C2", TRANSACTION_AMT=None, STATE="NV"),
             dict(paid, CMTE_ID="C3", TRANSACTION_AMT=Decimal("5.00"), STATE="TX", RPT_TP="??"),
             dict(paid, CMTE_ID="C3", TRANSACTION_AMT=Decimal("7.00"), STATE="TX", TRANSACTION_TP=None),
             dict(paid, CMTE_ID=None, TRANSACTION_AMT=Decimal("3.00"), STATE=None)]
    spent = dict(CMTE_ID="C1", RPT_TP="Q1", TRANSACTION_AMT=Decimal("1.00"))
    ran = dict(CAND_PTY_AFFILIATION="DEM", CAND_ELECTION_YR=2024, CAND_OFFICE_ST="TX", CAND_OFFICE="H",
               CAND_OFFICE_DISTRICT="07")
    return {
        "political_parties": frame(spark, "political_parties", dict(party_code="DEM", party_code_desc="Democratic"),
                                   dict(party_code=None, party_code_desc="Null party")),
        "committee_types": frame(spark, "committee_types", dict(cmte_typ_code="H", cmte_typ="House")),
        "report_types": frame(spark, "report_types", dict(rp_typ_code="Q1", rp_typ="April")),
        "transaction_types": frame(spark, "transaction_types", dict(trans_tp="15", trans_tp_desc="Contribution")),
        "candidates": frame(
            spark, "candidates", dict(ran, CAND_ID="K1", CAND_NAME="A", CAND_ICI="I"),
            dict(ran, CAND_ID="K2", CAND_NAME="A", CAND_ICI="?"),
            dict(ran, CAND_ID="K3", CAND_NAME="B", CAND_OFFICE="House", CAND_OFFICE_ST=None),
            dict(ran, CAND_ID="K4", CAND_NAME="C", CAND_ELECTION_YR=2022),
            dict(ran, CAND_ID="K5", CAND_NAME="D", CAND_PTY_AFFILIATION="???"),
            dict(ran, CAND_ID="K6", CAND_NAME="E", CAND_PTY_AFFILIATION=None),
            dict(ran, CAND_ID="K7", CAND_NAME="B", CAND_OFFICE_ST=None),
            dict(ran, CAND_ID="K8", CAND_NAME="F")),
        "committees": frame(
            spark, "committees", dict(CMTE_ID="C1", CMTE_NM="One", CMTE_TP="H", CAND_ID="K1", CMTE_DSGN="J", ORG_TP="W"),
            dict(CMTE_ID="C2", CMTE_NM="Two", CMTE_TP="H", CMTE_PTY_AFFILIATION="DEM", CMTE_DSGN="?"),
            dict(CMTE_ID="C3", CMTE_NM="Three", CMTE_TP="?", CMTE_PTY_AFFILIATION="DEM")),
        "cand_cmte_link": frame(
            spark, "cand_cmte_link", *[dict(CAND_ID=k, CMTE_ID=c, CAND_ELECTION_YR=y) for k, c, y in (
                ("K1", "C1", 2024), ("K2", "C1", 2024), ("K3", "C1", 2024), ("K7", "C1", 2024), ("K4", "C1", 2024),
                ("K1", "C1", 2022), ("K5", "C1", 2024), ("K8", "C2", 2024), ("K1", None, 2024))]),
        "indiv_contributions": frame(spark, "indiv_contributions", *gifts),
        "committee_trans": frame(spark, "committee_trans", *gifts),
        "independent_exp": frame(
            spark, "independent_exp",
            *[dict(paid, CMTE_ID="C1", CAND_ID=k, AMNDT_IND=a, SUB_ID=s) for k, a, s in (
                ("K1", "N", "kept"), ("K1", "Q", "kept, unknown"), ("K1", "T", "terminated"), ("K1", None, "null"),
                (None, "N", "no candidate"), ("K5", "N", "no party"), ("K1", "Termination", "spelled out"))],
            dict(paid, CMTE_ID="C3", CAND_ID="K1", AMNDT_IND="N", SUB_ID="no committee type")),
        "operating_exp": frame(
            spark, "operating_exp", dict(spent, CATEGORY_DESC="Rent", SUB_ID=1), dict(spent, CATEGORY_DESC=None, SUB_ID=2),
            dict(spent, CATEGORY_DESC="Other", SUB_ID=3), dict(spent, CMTE_ID="C2", CATEGORY_DESC="Rent", SUB_ID=4),
            dict(spent, CMTE_ID="C9", CATEGORY_DESC="Rent", SUB_ID=5), dict(spent, CMTE_ID="C3", SUB_ID=6)),
    }


def test_codes(spark):
    code = F.col("code")
    frame = spark.createDataFrame([("N",), ("C",), ("I",), ("H",), (None,)], "code string")
    shown = frame.select("code", label(code, AMENDMENT), label(code, INCUMBENCY, keep_unknown=False), label(code, OFFICE))
    assert rows_of(shown) == [("C", "C", "Challenger", "C"), ("H", "H", None, "House"), ("I", "I", "Incumbent", "I"),
                              ("N", "New", None, "N"), (None, None, None, None)]
    assert (len(AMENDMENT), len(DESIGNATION), len(ORGANIZATION), len(INCUMBENCY), len(OFFICE)) == (3, 6, 5, 3, 3)
    assert DESIGNATION["J"] == "Joint Fundrasier", "spelled as published"


def test_text_helpers(spark):
    a, b = F.col("a"), F.col("b")
    frame = spark.createDataFrame([("TX", "07"), ("TX", None), (None, "07")], "a string, b string")
    assert rows_of(frame.select(district_label(a, b))) == [("TX07",), (None,), (None,)]
    zips = spark.createDataFrame([("012345678",), ("123",), ("",), (None,)], "a string")
    assert rows_of(zips.select(zip5(a))) == [("",), ("01234",), ("123",), (None,)]
    assert rows_of(zips.select(or_other(a)).where("coalesce(a, 'Other') = 'Other'")) == [("Other",)]


def test_a_code_listed_twice_gives_two_rows_and_nulls_never_match(spark):
    rows = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    table = spark.createDataFrame([("A", "one"), ("A", "two"), (None, "null")], "k string, label string")
    assert rows_of(with_label(rows, "code", table, "k", "label")) == [("A", "one"), ("A", "two")]
    assert rows_of(with_label(rows, "code", table, "k", "label", "left")) == [
        ("A", "one"), ("A", "two"), ("B", None), (None, None)]


def test_candidates(raw):
    got = {row.cand_id: row for row in model("src_candidates", raw).collect()}
    assert set(got) == {"K1", "K2", "K3", "K4", "K7", "K8"}, "an unknown or null party drops the candidate"
    assert (got["K1"].cand_office_district, got["K3"].cand_office_district) == ("TX07", None)
    assert (got["K1"].cand_ici, got["K2"].cand_ici) == ("Incumbent", None)


def test_committees(raw):
    rows = model("src_committees", raw).select("cmte_id", "cmte_dsgn", "party_code_desc", "org_tp")
    assert rows_of(rows) == [("C1", "Joint Fundrasier", None, "Cooperative w/o Capital Stock"),
                             ("C2", "?", "Democratic", None)]


def test_transactions_need_both_codes(raw):
    for name in ("src_indiv_contributions", "src_committee_transactions"):
        assert sorted(str(row.cmte_id) for row in model(name, raw).collect()) == ["C1", "C1", "C2", "None"]
    assert rows_of(model("src_indiv_contributions", raw).select("zip_code").where("zip_code is not null")) == [("01234",)]


def test_payments_to_candidates(raw):
    assert sorted(row.sub_id for row in model("fct_cand_committee_trans", raw).collect()) == ["kept", "kept, unknown"]


def test_candidate_totals(raw):
    """K1 and K2 look alike and merge; raw H and raw House stay two rows that read the same; only nulls sum to null."""
    rows = rows_of(model("fct_candidate_indiv_cont", raw))
    assert rows == [
        ("A", "Democratic", "TX", "House", "TX07", Decimal("20.60")),
        ("B", "Democratic", None, "House", None, Decimal("10.30")),
        ("B", "Democratic", None, "House", None, Decimal("10.30")),
        ("F", "Democratic", "TX", "House", "TX07", None)]
    assert rows == rows_of(candidate_totals_direct(
        model("src_candidates", raw), raw["cand_cmte_link"], model("src_indiv_contributions", raw)))


def test_spending(raw):
    assert sorted(row.sub_id for row in model("fct_committee_operating_exp", raw).collect()) == [1, 2, 3, 4]
    assert sorted(row.sub_id for row in model("fct_candidate_operating_exp", raw).collect()) == [1, 2, 3]
    assert rows_of(model("fct_categories_operating_exp", raw)) == [("Other", Decimal("2.00")), ("Rent", Decimal("2.00"))]


def test_states(raw):
    assert rows_of(model("fct_indiv_cont_by_state", raw)) == [
        ("NV", None), ("TX", Decimal("10.10")), (None, Decimal("3.20"))]


def test_model_graph():
    assert len(CLEANED) == len(MARTS) == 6
    assert inputs("fct_categories_operating_exp") == ["fct_committee_operating_exp"]
    assert set().union(*map(all_inputs, MODELS)) - set(MODELS) == set(RAW), "every raw table is read"


def test_refresh_writes_tables_and_defines_views(spark, raw, tmp_path):
    first = refresh_models(raw, str(tmp_path), "one")
    again = refresh_models(raw, str(tmp_path), "two")
    assert list(first) == list(MODELS)
    for name in MODELS:
        expected = rows_of(model(name, raw))
        assert rows_of(first[name]) == rows_of(again[name]) == rows_of(spark.table(name)) == expected
    assert all("load_id=two" in again[name].inputFiles()[0] for name in CLEANED)


@pytest.fixture
def database(spark):
    name = f"models_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_marts_over_a_catalog(spark, raw, tmp_path, database):
    refresh_models(raw, str(tmp_path), "one", database)
    kept = {name: spark.table(f"{database}.{name}") for name in CLEANED}
    marts = define_marts({"cand_cmte_link": raw["cand_cmte_link"], **kept})
    assert {name: rows_of(rows) for name, rows in marts.items()} == {name: rows_of(model(name, raw)) for name in MARTS}


def test_another_session_reads_the_marts_of_a_database(spark, raw, tmp_path, database):
    for name, rows in raw.items():
        full_refresh(rows, f"{tmp_path}/raw/{name}", "one", SOURCES[name], database)
    shown = refresh_models(raw_from_catalog(spark, database), str(tmp_path), "one", database=database)
    other = spark.newSession()
    for name in MODELS:
        assert rows_of(other.table(f"{database}.{name}")) == rows_of(shown[name]) == rows_of(model(name, raw))
        assert other.table(f"{database}.{name}").schema.simpleString() == model(name, raw).schema.simpleString()
    assert not [f for f in tmp_path.iterdir() if f.name in MARTS], "a mart is a view, nothing is written for it"


def test_views_show_the_tables_as_they_are(spark, raw, tmp_path, database):
    refresh_models(raw, str(tmp_path), "one", database)
    mart = spark.newSession().table(f"{database}.fct_committee_operating_exp")
    assert mart.count()
    refresh_models(raw | {"operating_exp": raw["operating_exp"].limit(0)}, str(tmp_path), "two", database)
    other = spark.newSession()
    assert other.table(f"{database}.fct_committee_operating_exp").count() == 0
    assert other.table(f"{database}.fct_categories_operating_exp").count() == 0
    with pytest.raises(ValueError, match="other columns"):
        publish(spark, {"src_candidates": spark.range(1)}, str(tmp_path), "three", database)


def test_a_view_reads_one_load_and_knows_its_size(spark, raw, tmp_path, database):
    for load_id in ("one", "two", "three"):
        refresh_models(raw, str(tmp_path), load_id, database)
    rows = spark.newSession().table(f"{database}.fct_cand_committee_trans")
    plan = plan_of(rows, "cost")
    assert re.search(r"load_id#\d+ = three", plan) and "subquery" not in plan.lower()
    assert rows.inputFiles() and all("/load_id=three/" in file for file in rows.inputFiles())
    stored = sum(f.stat().st_size for f in (tmp_path / "src_candidates" / "load_id=three").glob("*.parquet"))
    assert stored < 10_000 and re.search(r"Relation [^\n]*src_candidates_loads[^\n]*sizeInBytes=[\d.]+ (B|KiB)\)", plan)


def test_a_stop_at_any_statement_leaves_one_load(spark, raw, tmp_path, database, monkeypatch):
    """All tables and marts show one load, whichever statement of a refresh is the last to go through."""
    others = raw | {"operating_exp": raw["operating_exp"].limit(1), "indiv_contributions": raw["indiv_contributions"].limit(0),
                    "independent_exp": raw["independent_exp"].limit(0)}
    refresh_models(raw, str(tmp_path), "old", database)

    def shown():
        return {name: rows_of(spark.newSession().table(f"{database}.{name}")) for name in (*CLEANED, *MARTS)}

    old, statements, real = shown(), [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda s, text, *a, **k: statements.append(text) or real(s, text, *a, **k))
    refresh_models(others, str(tmp_path), "new", database)
    new, n = shown(), len(statements)
    assert old != new and n > 20
    for stop in (0, n // 2, n - 1):
        refresh_models(raw, str(tmp_path), f"old-{stop}", database)
        assert shown() == old
        done = []

        def sql(session, text, *args, **options):
            if len(done) == stop:  # noqa: B023
                raise RuntimeError("stopped")
            done.append(text)  # noqa: B023
            return real(session, text, *args, **options)

        monkeypatch.setattr(type(spark), "sql", sql)
        with pytest.raises(RuntimeError):
            refresh_models(others, str(tmp_path), f"new-{stop}", database)
        monkeypatch.setattr(type(spark), "sql", real)
        assert shown() == old, stop


def loads_on_disk(folder):
    return sorted({f.name for f in folder.rglob("load_id=*")})


def test_old_loads_are_swept(spark, raw, tmp_path, database):
    root = tmp_path / "models"
    for load_id in ("one", "two", "three"):
        refresh_models(raw, str(root), load_id, database)
    before = rows_of(spark.table(f"{database}.fct_cand_committee_trans"))
    assert loads_on_disk(root) == ["load_id=one", "load_id=three", "load_id=two"]
    assert sweep_models(spark, str(root), database, keep=2) == ["one"]
    note_load(spark, str(root), "running", "begun")  # another job has begun a load and written a table
    raw["cand_cmte_link"].write.parquet(f"{root}/cand_cmte_link/load_id=running")
    assert sweep_models(spark, str(root), database, keep=1) == ["two"]
    assert loads_on_disk(root) == ["load_id=running", "load_id=three"]
    assert rows_of(spark.newSession().table(f"{database}.fct_cand_committee_trans")) == before
    assert sweep_models(spark, str(tmp_path / "nothing"), database) == []


def test_old_loads_of_a_raw_table_are_swept(spark, tmp_path):
    for load_id in ("a", "b", "c"):
        full_refresh(spark.range(3), f"{tmp_path}/t/rows", load_id, "swept")
    with pytest.raises(ValueError):
        full_refresh(spark.range(3), f"{tmp_path}/t/rows", "failed", "swept", min_rows=4)
    assert sweep_table(spark, f"{tmp_path}/t", keep=1) == ["a", "b"]
    full_refresh(spark.range(4), f"{tmp_path}/t/rows", "d", "swept")
    assert sweep_table(spark, f"{tmp_path}/t", keep=1) == ["c", "failed"]
    assert spark.table("swept").count() == 4


def test_scratch_goes_with_its_scope_and_its_application(spark, tmp_path):
    def application(name):
        settings = {"spark.checkpoint.dir": f"{tmp_path}", "spark.app.id": name}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
                               _jvm=spark._jvm, _jsc=spark._jsc)

    mine, other = application("mine"), application("other")
    with scratch_scope(mine, "step"):
        inner = scratch_dir(mine, "x")
        spark.range(2).write.parquet(inner)
    with pytest.raises(RuntimeError), scratch_scope(mine, "step"):
        spark.range(2).write.parquet(scratch_dir(mine, "x"))
        raise RuntimeError
    assert list_folder(spark, application_folder(mine)) == []
    kept, running = scratch_dir(mine, "y"), scratch_dir(other, "z")
    for folder in (kept, running):
        spark.range(2).write.parquet(folder)
    assert sweep_scratch(mine, own=False) == [] and list_folder(spark, kept)
    assert sweep_scratch(mine) == [application_folder(mine)]
    assert not list_folder(spark, kept) and list_folder(spark, running)
    assert sweep_scratch(mine, older_than_hours=-1) == [application_folder(other)]


def test_a_refresh_that_fails_switches_no_view(spark, raw, tmp_path):
    refresh_models(raw, str(tmp_path), "one")
    before = {name: spark.table(name).inputFiles() for name in CLEANED}
    broken = raw | {"operating_exp": raw["operating_exp"].withColumn("CMTE_ID", F.raise_error(F.lit("broken")).cast("string"))}
    with pytest.raises(Exception):
        refresh_models(broken, str(tmp_path), "two")
    with pytest.raises(ValueError, match="previous load stays"):
        refresh_models(raw, str(tmp_path), "three", min_rows={"src_candidates": 10**9})
    assert {name: spark.table(name).inputFiles() for name in CLEANED} == before


def test_another_cycle(raw):
    name = "fct_candidate_indiv_cont"
    assert rows_of(model(name, raw, cycle=2024)) == rows_of(model(name, raw))
    assert rows_of(model(name, raw, cycle=2022)) != rows_of(model(name, raw))


def test_dimension_tables_do_not_pile_up(raw, tmp_path):
    for _ in range(3):
        assert rows_of(mart_from_raw("fct_cand_committee_trans", raw, str(tmp_path)))
    files = [f for f in tmp_path.rglob("*.parquet") if f.is_file()]
    folders = {f.parent for f in files}
    assert len(folders) == 2 and len(files) <= 16


@pytest.mark.parametrize("name", list(MARTS))
def test_marts_are_the_same_over_written_dimensions(raw, tmp_path, name):
    assert rows_of(mart_from_raw(name, raw, str(tmp_path))) == rows_of(model(name, raw))
