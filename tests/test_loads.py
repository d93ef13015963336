"""Staging, matching columns, the tolerance, and refreshing a table."""

import datetime as dt
import glob
import os
import re
import time
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import plan_of, rows_of, text_files
from tallybook.functions.typing import _no_number, _no_such_day, lenient, unconvertible
from tallybook.operators.load import (
    delimited_files, full_refresh, load_report, match_by_name, match_by_position, parquet_files, skip_bad_files,
    unmatched_names,
)
from tallybook.operators.frames import rename_positional
from tallybook.operators.keys import repeated_keys
from tallybook.plans.jobs import ingest_bulk, load_bulk, read_key_audit, read_line_report, read_rejects
from tallybook.schemas import BULK, COMPACT_DATE, BulkFormat, columns
from tallybook.scratch import application_folder, list_folder, scratch_dir
from tallybook.sources.delimited import LINE, lenient_lines, line_columns, line_field, read_delimited, read_lenient, split_lines
from tallybook.sources.inventory import inventory
from tallybook.sources.staged import (
    _packed, read_manifest, read_staged_delimited, read_staged_parquet, run_state, stage_delimited, stage_parquet, stored_bytes,
)
from testbed.fixtures import break_inside
from testbed.queries import QUERIES, bulk_text, orders_in_files, spoilt_lines

TARGET = columns("id string, n int, day date")


def lines(good: int, bad: int, bad_line: str, tag: str) -> list[str]:
    return [f"{tag}{i}|{i}|01312024" for i in range(good)] + [bad_line] * bad


def load(spark, path, report, **options):
    rows = delimited_files(spark, path, TARGET, header=False, quoted=False)
    return skip_bad_files(match_by_position(rows, TARGET), TARGET, report, COMPACT_DATE, **options)


@pytest.mark.parametrize("bad_line", ["X|1", "X|1|01312024|more", "X|one|01312024", "X|1|02302024"])
def test_tolerance_is_per_file_and_five_percent_is_still_kept(spark, tmp_path, bad_line):
    path = text_files(tmp_path / "in", clean=lines(3, 0, bad_line, "a"), edge=lines(19, 1, bad_line, "b"),
                      over=lines(18, 2, bad_line, "c"), broken=[bad_line])
    report = f"{tmp_path}/report"
    loaded = rows_of(load(spark, path, report))
    assert {row[0][0] for row in loaded} == {"a", "b"}
    assert len(loaded) == 3 + 19
    assert {row[2] for row in loaded} == {dt.date(2024, 1, 31)}
    counts = load_report(spark, report).select(F.regexp_extract("file", r"(\w+)\.txt", 1), "n_rows", "n_bad", "skipped")
    assert rows_of(counts) == [("broken", 1, 1, True), ("clean", 3, 0, False), ("edge", 20, 1, False),
                               ("over", 20, 2, True)]


def test_no_bad_file_and_empty_values_are_no_errors(spark, tmp_path):
    path = text_files(tmp_path / "in", a=["a|1|", "b||01312024", "|2|01312024"])
    report = f"{tmp_path}/report"
    assert len(rows_of(load(spark, path, report))) == 3
    counts = load_report(spark, report).select("n_rows", "n_bad", "n_without_key", "skipped")
    assert rows_of(counts) == [(3, 0, 1, False)]


def test_tolerance_can_be_set(spark, tmp_path):
    path = text_files(tmp_path / "in", a=lines(9, 1, "X|x|", "a"))
    assert len(rows_of(load(spark, path, f"{tmp_path}/r1", tolerated_percent=10))) == 9
    assert rows_of(load(spark, path, f"{tmp_path}/r2", tolerated_percent=9)) == []


def test_skipped_files_are_dropped_without_moving_the_others(spark, tmp_path):
    path = text_files(tmp_path / "in", a=lines(9, 0, "", "a"), b=["X|x|"])
    plan = plan_of(load(spark, path, f"{tmp_path}/report"))
    assert "BroadcastHashJoin LeftAnti" in plan and "Exchange hashpartitioning" not in plan


def test_header_lines_and_quotes_of_every_file(spark, tmp_path):
    schema = columns("code string, label string")
    path = text_files(tmp_path / "in", a=["Any|Names", 'A|"x|y"'], b=["Any|Names", 'B|"say ""hi"""'])
    rows = match_by_position(delimited_files(spark, path, schema), schema)
    assert rows_of(skip_bad_files(rows, schema, f"{tmp_path}/report")) == [("A", "x|y"), ("B", 'say "hi"')]


def test_match_by_name_minds_the_case(spark):
    rows = spark.createDataFrame([("a", 1, "x")], "cand_id string, CAND_YR int, extra string")
    target = columns("CAND_ID string, CAND_YR int")
    assert unmatched_names(rows, target) == ["CAND_ID"]
    matched = match_by_name(rows, target)
    assert matched.columns == ["CAND_ID", "CAND_YR"] and rows_of(matched) == [(None, 1)]


def test_parquet_values_that_do_not_convert_count_as_bad(spark, tmp_path):
    target = columns("id string, paid amount, absent int")
    good, bad = [(str(i), "1.5") for i in range(19)], [("bad", "n/a")]
    root, to = f"{tmp_path}/t", f"{tmp_path}/to"
    for day, values in (("30", good + bad), ("31", bad * 20)):
        file = spark.createDataFrame(values, "id string, paid string").coalesce(1)
        file.write.parquet(f"{root}/run_date=2024-03-{day}")
    loaded = load_bulk(spark, root, "2024-03-30", target, to, "one", "test_parquet_load")
    assert rows_of(loaded) == sorted((i, Decimal("1.50"), None) for i, _ in good)
    with pytest.raises(ValueError, match="every file was skipped"):
        load_bulk(spark, root, "2024-03-31", target, to, "two", "test_parquet_load")
    assert spark.table("test_parquet_load").count() == 19, "the table keeps its rows"
    with pytest.raises(ValueError, match="previous load stays"):
        load_bulk(spark, root, "2024-03-30", target, to, "three", "test_parquet_load", min_rows=20)


def test_typed_parquet_needs_no_conversion_checks(spark, tmp_path):
    spark.createDataFrame([("a", 1)], "id string, n int").write.parquet(f"{tmp_path}/t")
    target = columns("id string, n int")
    rows = match_by_name(parquet_files(spark, f"{tmp_path}/t"), target)
    assert "try_cast" not in plan_of(skip_bad_files(rows, target, f"{tmp_path}/report"))


def test_staging_a_date_again_replaces_only_that_date(spark, tmp_path):
    root = f"{tmp_path}/staged"
    for run_date, value in (("2024-01-01", "old"), ("2024-01-02", "other"), ("2024-01-01", "new")):
        stage_parquet(spark.createDataFrame([(value,)], "v string"), root, run_date)
    assert rows_of(read_staged_parquet(spark, root, "2024-01-01")) == [("new",)]
    assert rows_of(read_staged_parquet(spark, root, "2024-01-02")) == [("other",)]
    read = read_staged_parquet(spark, root, "2024-01-01").inputFiles()
    assert {file.split("/")[-2] for file in read} == {"run_date=2024-01-01"}
    with pytest.raises(ValueError):
        read_staged_parquet(spark, root, "01/01/2024")


def test_runs_may_differ_in_their_columns(spark, tmp_path):
    root = f"{tmp_path}/staged"
    stage_parquet(spark.createDataFrame([("a",)], "v string"), root, "2024-01-01")
    stage_parquet(spark.createDataFrame([(1, "b")], "n int, w string"), root, "2024-01-02")
    assert read_staged_parquet(spark, root, "2024-01-01").columns == ["v"]
    assert read_staged_parquet(spark, root, "2024-01-02").columns == ["n", "w"]


def test_staged_delimited_counts_columns_by_position(spark, tmp_path):
    root = f"{tmp_path}/staged"
    stage_delimited(spark.createDataFrame([("007", "a|b")], "x string, y string"), root, "2024-01-01")
    rows = read_staged_delimited(spark, root, "2024-01-01", columns("code string, label string"))
    assert rows.columns == ["code", "label"] and rows_of(rows) == [("007", "a|b")]


def test_refresh_replaces_and_a_failed_one_keeps_the_rows(spark, tmp_path):
    root, two = f"{tmp_path}/t", spark.createDataFrame([(1,), (2,)], "n int")
    full_refresh(two, root, "a", "refreshed")
    full_refresh(two, root, "b", "refreshed")
    assert rows_of(spark.table("refreshed")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="previous load stays"):
        full_refresh(two.where("n > 5"), root, "c", "refreshed", min_rows=1)
    assert rows_of(spark.table("refreshed")) == [(1,), (2,)]
    full_refresh(spark.table("refreshed").where("n = 1"), root, "d", "refreshed")
    assert rows_of(spark.table("refreshed")) == [(1,)], "a table can be refreshed from itself"


def test_refresh_into_the_catalog(spark, tmp_path):
    for load_id, n in (("a", 1), ("b", 2)):
        full_refresh(spark.createDataFrame([(n,)], "n int"), f"{tmp_path}/t", load_id, "kept", database="default")
    try:
        assert rows_of(spark.table("default.kept")) == [(2,)]
    finally:
        spark.sql("DROP VIEW default.kept")


def session(**settings: str) -> SimpleNamespace:
    get = {key.replace("_", "."): value for key, value in settings.items()}.get
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: get(key, default)))


def test_scratch_is_fresh_and_in_the_shared_folder():
    cluster = session(spark_checkpoint_dir="hdfs://shared/folder/")
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first != second and first.startswith("hdfs://shared/folder/tallybook/session/x-")


def test_without_a_shared_folder_scratch_lies_in_the_warehouse():
    assert scratch_dir(session(spark_sql_warehouse_dir="s3://house"), "x").startswith("s3://house/_scratch/tallybook/session/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session(spark_sql_warehouse_dir="file:/home/me/house", spark_master="yarn"), "x")


def test_staging_a_date_with_no_rows_leaves_none(spark, tmp_path):
    root, some = f"{tmp_path}/staged", spark.createDataFrame([("a", 1)], "v string, n int")
    stage_parquet(some.limit(0), root, "2024-01-02")
    assert read_staged_parquet(spark, root, "2024-01-02").schema == some.schema
    for run_date, rows in (("2024-01-01", some), ("2024-01-01", some.limit(0))):
        stage_parquet(rows, root, run_date)
    assert rows_of(read_staged_parquet(spark, root, "2024-01-01")) == []
    schema = columns("v string, n string")
    for rows, left in ((some, [("a", "1")]), (some.limit(0), [])):
        stage_delimited(rows, f"{root}-text", "2024-01-01")
        assert rows_of(read_staged_delimited(spark, f"{root}-text", "2024-01-01", schema)) == left


def test_files_of_one_run_may_have_other_columns(spark, tmp_path):
    root, folder = f"{tmp_path}/r", f"{tmp_path}/r/run_date=2024-01-01"
    spark.createDataFrame([(1,)], "ID int").coalesce(1).write.parquet(folder)
    spark.createDataFrame([(2, 7)], "ID int, N int").coalesce(1).write.mode("append").parquet(folder)
    target = columns("ID int, N int")
    assert rows_of(load_bulk(spark, root, "2024-01-01", target, f"{tmp_path}/t", "a", "other_columns")) == [(1, None), (2, 7)]


def test_an_odd_file_is_skipped_and_reported(spark, tmp_path):
    root, folder = f"{tmp_path}/r", f"{tmp_path}/r/run_date=2024-01-01"
    good = spark.createDataFrame([(i, i) for i in range(3)], "ID int, N int").coalesce(1)
    good.write.parquet(folder)
    good.limit(0).write.mode("append").parquet(folder)
    spark.createDataFrame([(9, "x")], "ID int, N string").coalesce(1).write.mode("append").parquet(folder)
    (tmp_path / "r" / "run_date=2024-01-01" / "part-9.parquet").write_bytes(b"PAR1 this is no table PAR1")
    loaded = load_bulk(spark, root, "2024-01-01", columns("ID int, N int"), f"{tmp_path}/t", "a", "odd_files")
    assert rows_of(loaded) == [(0, 0), (1, 1), (2, 2)]
    report = load_report(spark, f"{tmp_path}/t/reports/a").select("n_rows", "n_bad", "skipped")
    assert rows_of(report) == [(0, 0, False), (0, 0, True), (1, 1, True), (3, 0, False)]


def test_names_are_matched_with_case_file_by_file(spark, tmp_path):
    root, folder = f"{tmp_path}/r", f"{tmp_path}/r/run_date=2024-01-01"
    spark.createDataFrame([(1, 10)], "ID int, N int").coalesce(1).write.parquet(folder)
    spark.createDataFrame([(2, 20)], "id int, n int").coalesce(1).write.mode("append").parquet(folder)
    spark.createDataFrame([("x", 30)], "id string, N int").coalesce(1).write.mode("append").parquet(folder)
    loaded = load_bulk(spark, root, "2024-01-01", columns("ID int, N int"), f"{tmp_path}/t", "a", "cased")
    assert rows_of(loaded) == [(1, 10), (None, 30), (None, None)]
    assert spark.conf.get("spark.sql.caseSensitive") == "false", "the caller's session stays as it is"


@pytest.fixture
def broken_run(spark, tmp_path):
    """A staged run of a good file and one whose later row groups are zeroed."""
    root, folder = f"{tmp_path}/r", f"{tmp_path}/r/run_date=2024-01-01"
    rows = spark.range(20_000).selectExpr("CAST(id AS INT) AS ID", "sha1(CAST(id AS STRING)) AS HASH")
    rows.coalesce(1).write.option("parquet.block.size", 64 << 10).parquet(f"{folder}/bad")
    break_inside(spark, f"{folder}/bad")
    rows.where("ID < 10").coalesce(1).write.parquet(f"{folder}/good")
    return root


def test_a_file_broken_inside_is_skipped_whole(spark, tmp_path, broken_run):
    target = columns("ID int, HASH string")
    loaded = load_bulk(spark, broken_run, "2024-01-01", target, f"{tmp_path}/t", "a", "broken")
    assert loaded.count() == 10
    report = load_report(spark, f"{tmp_path}/t/reports/a").selectExpr(
        "file LIKE '%/bad/%'", "skipped", "fault LIKE 'broken inside: % of 20000 rows'", "n_rows < 20000")
    assert rows_of(report) == [(False, False, None, True), (True, True, True, True)]
    read = load_report(spark, f"{tmp_path}/t/reports/a").where("skipped").first().n_rows
    assert 0 < read < 20_000, "some of its rows could be read, none was taken"


def test_no_list_of_files_in_the_driver(spark, tmp_path, monkeypatch):
    """Many small files of two kinds: neither jobs nor collected rows grow with them."""
    from pyspark.sql import DataFrame

    counts = []
    for n in (5, 60):
        root, folder = f"{tmp_path}/{n}", f"{tmp_path}/{n}/run_date=2024-01-01"
        spark.range(n).selectExpr("id AS ID", "id AS N").repartition(n).write.parquet(f"{folder}/a")
        spark.range(n).selectExpr("id AS ID", "CAST(id AS STRING) AS N").repartition(n).write.parquet(f"{folder}/b")
        collected, collect = [], DataFrame.collect
        monkeypatch.setattr(DataFrame, "collect", lambda df: collected.append(rows := collect(df)) or rows)
        spark.sparkContext.setJobGroup(f"load-{n}", "")
        loaded = load_bulk(spark, root, "2024-01-01", columns("ID bigint, N bigint"), f"{tmp_path}/t{n}", "a", "many")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"load-{n}"))
        monkeypatch.setattr(DataFrame, "collect", collect)
        assert loaded.count() == 2 * n
        plan = plan_of(inventory(spark, folder), "extended")
        assert "LocalRelation" not in plan and "LocalTableScan" not in plan
        counts.append((jobs, sum(map(len, collected))))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0][1] == counts[1][1] and counts[1][0] <= counts[0][0] + 2


def test_whole_files_are_read_by_spark_from_other_stores(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    (tmp_path / "t" / "odd.parquet").write_bytes(b"no table")
    shown = [rows_of(inventory(spark, f"{tmp_path}/t", opened).selectExpr(
        "regexp_extract(file, '[^/]+$', 0)", "n_rows", "fault IS NULL", "types['id']")) for opened in (("file",), ())]
    assert shown[0] == shown[1] and ("odd.parquet", 0, False, None) in shown[0]


def test_a_refused_ingest_leaves_the_table_alone(spark, tmp_path):
    root, table = f"{tmp_path}/staged", f"{tmp_path}/t"
    good = text_files(tmp_path / "good", a=[f"g{i}|2024|1.50|1/31/2024|" for i in range(10)])
    ingest_bulk(spark, good, SPENDING, root, "2024-01-01")
    load_bulk(spark, root, "2024-01-01", SPENDING.schema, table, "a", "spending")
    wrong = text_files(tmp_path / "wrong", a=["only|two"] * 5, b=["x"])
    for run_date in ("2024-01-02", "2024-01-01"):
        with pytest.raises(ValueError, match="refused"):
            ingest_bulk(spark, wrong, SPENDING, root, run_date)
        with pytest.raises(ValueError, match="not staged"):
            load_bulk(spark, root, run_date, SPENDING.schema, table, f"b-{run_date}", "spending")
    assert spark.table("spending").count() == 10
    assert read_staged_parquet(spark, root, "2024-01-01").count() == 10, "what was staged before stays"
    assert read_rejects(spark, root, "2024-01-02").count() == 6
    told = rows_of(read_manifest(spark, root, "2024-01-01"))
    assert told == [(1, "staging", None, None, None, None), (2, "staged", 1, 10, 0, 0), (3, "staging", None, None, None, None),
                    (4, "refused", 2, 6, 6, 2)]
    ingest_bulk(spark, good, SPENDING, root, "2024-01-02")
    assert load_bulk(spark, root, "2024-01-02", SPENDING.schema, table, "c", "spending").count() == 10


def test_an_ingest_that_fails_midway_is_not_loaded(spark, tmp_path):
    bulk, root = BulkFormat(columns("id string, n int")), f"{tmp_path}/staged"
    for lines, state in ((["a|1"], "staged"), (["a|one"], "staging")):
        try:
            ingest_bulk(spark, text_files(tmp_path / "in", a=lines), bulk, root, "2024-01-01")
        except Exception:
            assert state == "staging"
        assert run_state(spark, root, "2024-01-01").state == state
    with pytest.raises(ValueError, match="not staged"):
        load_bulk(spark, root, "2024-01-01", bulk.schema, f"{tmp_path}/t", "a", "midway")


def test_staged_rows_are_clustered(spark, tmp_path):
    """One committee holds a third of all rows: it is dealt over files, and others lie in few."""
    rows = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot', CONCAT('c', id % 500)) AS CMTE_ID", "id % 7 AS STATE", "id AS SUB_ID")
    stage_parquet(rows.repartition(8), f"{tmp_path}/s", "2024-01-01", ("CMTE_ID", "STATE", "SUB_ID"))
    staged = read_staged_parquet(spark, f"{tmp_path}/s", "2024-01-01")
    files = staged.groupBy("CMTE_ID").agg(F.count_distinct("_metadata.file_path").alias("files"))
    assert files.where("CMTE_ID <> 'hot' AND files > 2").count() == 0 and files.where("CMTE_ID = 'hot'").first().files > 2
    assert rows_of(staged) == rows_of(rows)


def test_lines_are_dealt_as_text_and_come_back_as_they_were(spark, tmp_path):
    """Fields with quotes, blanks and nothing in them; packed files tell their text's size, and each line is counted once."""
    bulk = BulkFormat(columns("CMTE_ID string, NAME string, DAY date, AMT amount, SUB_ID bigint"), "MMddyyyy", cluster=("CMTE_ID", "DAY", "SUB_ID"))
    path = text_files(tmp_path / "in", a=[f'C{i % 7}|"a\\" {i % 3} |0131202{i % 4}|{i}.50|{i}' for i in range(900)], b=["||||", "C1| ||-1|"])
    ingest_bulk(spark, path, bulk, f"{tmp_path}/s", "2024-01-01")
    staged = read_staged_parquet(spark, f"{tmp_path}/s", "2024-01-01")
    assert rows_of(staged) == rows_of(read_delimited(spark, path, bulk)) and staged.schema.fields[3].dataType == bulk.schema[3].dataType
    assert run_state(spark, f"{tmp_path}/s", "2024-01-01").lines == 902
    spark.read.text(path).write.text(f"{tmp_path}/packed", compression="gzip")
    packed = sum(os.path.getsize(p) for p in glob.glob(f"{tmp_path}/packed/*.gz"))
    assert stored_bytes(spark, f"{tmp_path}/packed") == 6 * packed
    moved = _packed(read_delimited(spark, path, bulk), ("CMTE_ID", "SUB_ID"))
    assert moved.columns == ["CMTE_ID", "SUB_ID", "_line"]


def test_repeated_keys_are_found_and_can_refuse_a_load(spark, tmp_path):
    root, target = f"{tmp_path}/s", columns("ID bigint, PART string")
    rows = spark.range(5000).selectExpr("IF(id % 3 = 0, 7, id) AS ID", "CAST(id % 2 AS STRING) AS PART")
    stage_parquet(rows, root, "2024-01-01")
    load_bulk(spark, root, "2024-01-01", target, f"{tmp_path}/t", "a", "keyed", unique=("ID",))
    assert rows_of(read_key_audit(spark, f"{tmp_path}/t", "a")) == [(7, 1668)]
    with pytest.raises(ValueError, match="ID repeats"):
        load_bulk(spark, root, "2024-01-01", target, f"{tmp_path}/t", "b", "keyed", unique=("ID",), refuse_repeats=True)
    assert rows_of(repeated_keys(rows, "ID", "PART")) == [(7, "0", 834), (7, "1", 834)]  # id 7 itself is odd
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    assert rows_of(repeated_keys(nulls, "k")) == [(None, 2)] and rows_of(repeated_keys(nulls.limit(0), "k")) == []
    plan = plan_of(repeated_keys(rows, "ID"))
    assert "BroadcastHashJoin LeftSemi" in plan


def test_too_few_columns_are_refused(spark, tmp_path):
    path = text_files(tmp_path / "in", a=["1|2"])
    rows = delimited_files(spark, path, columns("a string, b string"), header=False, quoted=False)
    with pytest.raises(ValueError, match="2 columns for the 3"):
        match_by_position(rows, TARGET)


def test_renaming_is_done_at_once(spark):
    rows = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_positional(rows, ["b", "a"]).first().asDict() == {"b": 1, "a": 2}
    assert rename_positional(rows, ["b", "c"]).columns == ["b", "c"]
    with pytest.raises(ValueError):
        rename_positional(rows, ["a", "b", "c"])


SPENDING = BulkFormat(columns("id string, year smallint, amt amount, day date"), "M/d/yyyy", trailing_delimiter=True, lenient=True)


def test_lenient_ingest_keeps_no_shifted_line(spark, tmp_path):
    good = [f"g{i}|2024|1.50|1/31/2024|" for i in range(38)]
    path = text_files(tmp_path / "in", fine=[*good, "x|g|2024|1.50|1/31/2024|", "short|1"],
                      over=["a|b|2024|1.5|1/31/2024|"] * 9 + ["c|2024|1.5|1/31/2024|"],
                      values=["v|20x4|0.004|2/30/2024|", "w|2024|12.345|1/1/2024|", "u||-7||"])
    root = f"{tmp_path}/staged"
    ingest_bulk(spark, path, SPENDING, root, "2024-01-01")
    staged = read_staged_parquet(spark, root, "2024-01-01")
    assert {r.id for r in staged.collect()} == {*(f"g{i}" for i in range(38)), "v", "w", "u"}
    assert rows_of(staged.where("id < 'x' AND id > 'h'")) == [
        ("u", None, Decimal("-7.00"), None), ("v", None, None, None), ("w", 2024, None, dt.date(2024, 1, 1))]
    name = F.regexp_extract("file", r"(\w+)\.txt", 1)
    assert rows_of(read_line_report(spark, root, "2024-01-01").select(name, "n_rows", "n_wrong", "n_nulled", "skipped")) == [
        ("fine", 40, 2, 0, False), ("over", 10, 9, 0, True), ("values", 3, 0, 4, False)]
    lines = rows_of(read_rejects(spark, root, "2024-01-01").where(name == "fine").select("line"))
    assert lines == [("short|1",), ("x|g|2024|1.50|1/31/2024|",)]
    ingest_bulk(spark, text_files(tmp_path / "none"), SPENDING, root, "2024-01-01")
    assert read_staged_parquet(spark, root, "2024-01-01").count() == 0


def test_another_column_order_comes_from_the_header_file(spark, tmp_path):
    bulk = BulkFormat(columns("CAND_ID string, CMTE_ID string"))
    path, names = text_files(tmp_path / "in", a=["C1|K1"]), text_files(tmp_path / "names", a=["CMTE_ID,CAND_ID"])
    ingest_bulk(spark, path, bulk, f"{tmp_path}/s", "2024-01-01", dictionary=names)
    assert rows_of(read_staged_parquet(spark, f"{tmp_path}/s", "2024-01-01")) == [("K1", "C1")]
    other = text_files(tmp_path / "other", a=["CMTE_ID,CAND"])
    with pytest.raises(ValueError, match="differ"):
        ingest_bulk(spark, f"{tmp_path}/not there", bulk, f"{tmp_path}/s", "2024-01-01", dictionary=other)


@pytest.mark.parametrize("amount", ["12.345", "0.004", "1e-3", "-0.001", "99999999999999999.00"])
def test_an_amount_that_would_be_rounded_is_a_bad_value(spark, tmp_path, amount):
    bulk = BulkFormat(columns("amt amount"))
    path = text_files(tmp_path / "in", a=[amount])
    with pytest.raises(Exception):
        read_delimited(spark, path, bulk).collect()
    assert rows_of(read_lenient(spark, path, bulk)) == [(None,)]
    fine = text_files(tmp_path / "fine", a=["12.340", "5", "1e2", "-.50"])
    assert rows_of(read_delimited(spark, fine, bulk)) == sorted([(Decimal(v),) for v in ("12.34", "5.00", "100.00", "-0.50")],
                                                                  key=str)


@pytest.mark.parametrize("date_format", ["MMddyyyy", "M/d/yyyy"])
def test_days_that_do_not_exist_are_refused_before_they_are_parsed(spark, date_format):
    """For every month and day: what the guard refuses is no date, and it refuses all days that no year has."""
    shape = "format_string('%02d%02d%d', m, d, y)" if date_format == "MMddyyyy" else "concat_ws('/', m, d, y)"
    days = spark.range(14 * 34 * 3).selectExpr("id % 14 AS m", "CAST(id / 14 AS INT) % 34 AS d", "2023 + CAST(id / 476 AS INT) AS y")
    seen = days.selectExpr("m", "d", f"{shape} AS day").union(spark.sql("SELECT 0, 0, explode(array('2/x/2024', 'none', '', '1/1/24', NULL))"))
    parsed = F.try_to_date("day", date_format)
    told = seen.select("m", "d", _no_such_day(F.col("day"), date_format).alias("refused"), parsed.alias("parsed"),
                       lenient(F.col("day"), T.DateType(), date_format).alias("typed"))
    assert told.where("NOT typed <=> parsed OR refused AND parsed IS NOT NULL").count() == 0
    assert told.where("NOT refused AND (m = 13 OR d > 31 OR m = 2 AND d = 30 OR m = 4 AND d = 31)").count() == 0


def test_numbers_with_letters_are_refused_before_they_are_parsed(spark):
    said = ["unknown", "n/a", "1e2", "1E2", "NaN", "12.34", "-5", "+5", " 7 ", ".5", "5.", "true", "", None, "1d", "12345678901234567"]
    rows = spark.createDataFrame([(v,) for v in said], "v string")
    amount = T.DecimalType(18, 2)
    told = rows.select("v", _no_number(F.col("v")).alias("refused"), F.expr("try_cast(v AS decimal(18,2))").alias("cast"),
                       lenient(F.col("v"), amount).alias("typed"))
    assert told.where("NOT typed <=> cast").count() == 0
    assert {r.v for r in told.where("refused").collect()} == {"unknown", "n/a", "NaN", "1d"}
    yes = spark.createDataFrame([(True,)], "v boolean")
    assert yes.select(lenient(F.col("v"), amount)).first()[0] == 1


def test_spoilt_lines_are_made_after_they_were_dealt(spark, sf_dir):
    lines = spoilt_lines(spark, sf_dir, BULK["operating_exp"])
    moved = re.search(r"Exchange\nInput \[\d+\]: \[(.*?)\]", plan_of(lines)).group(1)
    assert "l_orderkey" in moved and "line#" not in moved
    tasks = lines.select("file_no", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(tasks) == len({r.file_no for r in tasks}) == len({r.task for r in tasks}) == 16


def test_landing_files_do_not_grow_with_the_data(spark):
    counts = []
    for sf in ("sf0.001", "sf0.01"):
        counts.append(orders_in_files(spark, f"/root/testdata/{sf}").select("file_no").distinct().count())
    assert counts[0] == counts[1] == 16


NOTES = BulkFormat(columns("ID bigint, NOTE string, DAY date, AMT amount"), "M/d/yyyy", trailing_delimiter=True, lenient=True,
                   cluster=("NOTE", "ID"))


def test_lines_are_split_without_a_parser_as_the_parser_splits_them(spark, tmp_path):
    """Lines that are blank, short, long, quoted, without values, of other line ends or of bytes that are no text."""
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.txt").write_bytes(
        b'1|"a|1/31/2024|1.50|\r\n2||||\n \t \n\n3|  b "c" |2/30/2024|x|\n4|short\n5|long|1/1/2024|1|2|\n6|\xff\xfe|1/1/2024|7|\n||||\n|\n')
    (tmp_path / "in" / "b.txt").write_bytes("7|é\\|12/9/0999|1e2|\nno delimiter".encode())
    shown = [*NOTES.names, "_malformed", "_file"]
    parsed, split = lenient_lines(spark, f"{tmp_path}/in", NOTES), split_lines(spark, f"{tmp_path}/in", NOTES)
    good = F.col("_malformed").isNull()
    assert rows_of(split.where(good).select(shown)) == rows_of(parsed.where(good).select(shown))
    wrong = [rows_of(rows.where(~good).select("_malformed", "_file", F.col("ID").isNull())) for rows in (split, parsed)]
    assert [row[:2] for row in wrong[0]] == [row[:2] for row in wrong[1]] and len(wrong[0]) == 4
    assert "Scan csv" not in plan_of(split) and "Scan csv" in plan_of(parsed)
    whole = split.where(good).select(LINE)
    assert rows_of(line_columns(whole, NOTES, NOTES.names)) == rows_of(split.where(good).select(NOTES.names))
    fields = whole.select(*(line_field(n, NOTES, NOTES.names).alias(n) for n in NOTES.names))
    assert rows_of(fields) == rows_of(split.where(good).select(NOTES.names))


def test_lenient_ingest_with_wrong_lines_and_without(spark, tmp_path):
    """What is staged, by a header file too, is what the parser and the casts gave."""
    clean = [f"{i}|n{i % 3}|{i % 14}/{i % 32}/2024|{i}.{i % 1000}|" for i in range(200)]
    some = clean + ["short"] * 4
    text_files(tmp_path / "names", h=["ID|NOTE|DAY|AMT".replace("|", ",")])
    for name, files in (("clean", {"a": clean}), ("some", {"a": some, "b": clean}), ("refused", {"a": clean, "b": ["short", "1||||"]})):
        path = text_files(tmp_path / name, **files)
        for dictionary in (None, f"{tmp_path}/names"):
            root = f"{tmp_path}/staged-{name}-{bool(dictionary)}"
            ingest_bulk(spark, path, NOTES, root, "2024-03-30", dictionary=dictionary)
            kept = read_lenient(spark, path if name != "refused" else f"{path}/a.txt", NOTES)
            assert rows_of(read_staged_parquet(spark, root, "2024-03-30")) == rows_of(kept)
            report = rows_of(read_line_report(spark, root, "2024-03-30").select("n_rows", "n_wrong", "skipped"))
            assert report == {"clean": [(200, 0, False)], "some": [(200, 0, False), (204, 4, False)],
                              "refused": [(2, 1, True), (200, 0, False)]}[name]


@pytest.mark.parametrize("form", ["M/d/yyyy", "MMddyyyy"])
def test_days_without_the_parser_are_those_of_the_parser(spark, form):
    pad = (1, 1) if form == "M/d/yyyy" else (2, 2)
    cut = "/" if form == "M/d/yyyy" else ""
    texts = [f"{m:0{pad[0]}d}{cut}{d:0{pad[1]}d}{cut}{y}" for m in range(15) for d in range(34)
             for y in ("2024", "2023", "1900", "0999", "0000", "24", "12024")]
    texts += ["", " 1/2/2024", "1/2/2024 ", "01/02/2024", "-1/2/2024", "1//2024", "1/2/2024/", "0102202x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", lenient(F.col("t"), T.DateType(), form).alias("day"), F.try_to_date("t", form).alias("parsed"),
        unconvertible(F.col("t"), T.DateType(), form).alias("bad"))
    assert rows.where("NOT (day <=> parsed) OR bad != (parsed IS NULL)").collect() == []
    plain = spark.createDataFrame([("1/2/2024" if cut else "01022024",)], "t string")
    assert "as date)" in plan_of(plain.select(lenient(F.col("t"), T.DateType(), form)), "extended").split("gettimestamp")[0]


def test_packed_bulk_text_has_the_same_lines(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b" ', dt.date(2024, 1, 31), Decimal("1.50")), (None, None, None, None), (2, "", None, None)],
                                 NOTES.schema)
    texts = [bulk_text(rows, NOTES, f"{tmp_path}/{packed}", packed=packed) for packed in (True, False)]
    assert rows_of(spark.read.text(texts[0])) == rows_of(spark.read.text(texts[1]))
    assert glob.glob(f"{texts[0]}/*.snappy") and stored_bytes(spark, texts[0]) == 4 * sum(
        os.path.getsize(p) for p in glob.glob(f"{texts[0]}/*.snappy"))


def shuffled(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size())} if files.size() else set()


def test_a_staged_run_leaves_no_shuffle_on_the_disks(spark, tmp_path):
    """What was moved for a run goes when the run is written, whose files are in order as before."""
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", {f for f in shuffled(spark) if f.startswith("shuffle_")}
    was = spark.conf.get(name, "false")
    rows = spark.range(40_000).selectExpr("CONCAT('c', id * 7 % 1999) AS CMTE_ID", "id % 7 AS STATE", "id AS SUB_ID")
    stage_parquet(rows.repartition(4), f"{tmp_path}/s", "2024-01-01", ("CMTE_ID", "STATE", "SUB_ID"))
    until = time.time() + 20
    while (left := {f for f in shuffled(spark) if f.startswith("shuffle_")} - before) and time.time() < until:
        time.sleep(0.5)
    assert not left and spark.conf.get(name, "false") == was
    files = glob.glob(f"{tmp_path}/s/run_date=2024-01-01/*.parquet")
    assert len(files) == 8
    for file in files:
        keys = [tuple(r) for r in spark.read.parquet(file).coalesce(1).collect()]
        assert keys == sorted(keys)
    assert rows_of(read_staged_parquet(spark, f"{tmp_path}/s", "2024-01-01")) == rows_of(rows)


@pytest.mark.parametrize("query", ["ingest_committee_trans", "ingest_operating_exp_spoilt", "load_after_refused_ingest"])
def test_made_text_is_gone_once_it_is_staged(spark, sf_dir, query):
    def texts() -> set[str]:
        return {n for n, _ in list_folder(spark, application_folder(spark)) if n.startswith("text-")}
    before = texts()
    rows = QUERIES[query](spark, sf_dir)
    assert texts() == before and rows.count() > 0


def test_a_refresh_in_order_takes_less_disk(spark, tmp_path, monkeypatch):
    """Rows whose ids repeat or are missing, in bounded runs: the same rows, each run in order, in smaller files."""
    monkeypatch.setattr("tallybook.operators.load.RUN_ROWS", 20_000)
    rows = spark.range(100_000, numPartitions=2).select(
        F.when(F.col("id") % 50 != 0, F.pmod(F.xxhash64("id"), F.lit(90_000_000))).alias("SUB_ID"),
        (F.col("id") % 3).cast("decimal(18,2)").alias("AMT"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 28).cast("int")).alias("DAY"),
        (F.col("id") % 5).alias("n")).withColumn("IMAGE", F.concat(F.lit("IMG"), F.col("SUB_ID").cast("string"))).unionAll(
        spark.sql("SELECT 7L, 1.00BD, DATE'2024-01-01', 1L, 'IMG7' FROM range(3)"))
    rows = rows.withColumn("AMT", F.col("AMT").cast("decimal(18,2)"))
    full_refresh(rows, f"{tmp_path}/plain", "a", "unordered_rows")
    ordered = full_refresh(rows, f"{tmp_path}/ordered", "a", "ordered_rows", order=("SUB_ID",))
    assert ordered.dtypes == rows.dtypes and rows_of(ordered) == rows_of(rows)
    size = {k: sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/{k}/load_id=a/*.parquet")) for k in ("plain", "ordered")}
    assert size["ordered"] < 0.9 * size["plain"]
    ids = [r.SUB_ID for r in spark.read.parquet(max(glob.glob(f"{tmp_path}/ordered/load_id=a/*.parquet"), key=os.path.getsize)).coalesce(1).collect()]
    falls = sum(b is not None and (a is None or b < a) for a, b in zip(ids, ids[1:]))
    assert 0 < falls < 6
