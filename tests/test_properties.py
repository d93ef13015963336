"""Random inputs against plain Python."""

import random
from collections import Counter, defaultdict
from decimal import Decimal
from html import escape

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows_of, text_files
from tallybook.functions.codes import DESIGNATION, INCUMBENCY, label, zip5
from tallybook.operators.load import delimited_files, match_by_position, skip_bad_files
from tallybook.plans.models import model
from tallybook.schemas import RAW, columns
from tallybook.sources.delimited import read_text_columns, write_delimited
from tallybook.sources.html import first_table
from test_models import frame

WORDS = st.text(st.characters(codec="utf-8", exclude_categories=("Cs", "Cc", "Zs", "Zl", "Zp")), min_size=1, max_size=8)
GRIDS = st.integers(1, 4).flatmap(
    lambda width: st.lists(st.lists(WORDS, min_size=width, max_size=width), min_size=1, max_size=5))


@settings(max_examples=200, deadline=None)
@given(GRIDS, st.booleans(), st.sampled_from(["", "<p>before <b>", "<!-- <table> -->", "<script>'<table>'</script>"]))
def test_any_grid_comes_back_from_a_page(grid, end_tags, before):
    td, tr = ("</td>", "</tr>") if end_tags else ("", "")
    body = "".join("<tr>" + "".join(f"<td class='x'> {escape(cell)}\n{td}" for cell in row) + tr for row in grid)
    assert first_table(f"{before}<table>{body}</table><table><tr><td>other</table>") == grid


def test_labels_of_random_codes(spark):
    rng = random.Random(7)
    codes = [(rng.choice(["A", "B", "J", "I", "C", "?", "", None]), rng.choice(["123456789", "12", "", None]))
             for _ in range(200)]
    shown = spark.createDataFrame(codes, "code string, zip string").select(
        "code", "zip", label(F.col("code"), DESIGNATION), label(F.col("code"), INCUMBENCY, keep_unknown=False),
        zip5(F.col("zip")))
    assert Counter(map(tuple, shown.collect())) == Counter(
        (c, z, DESIGNATION.get(c, c), INCUMBENCY.get(c), z and z[:5]) for c, z in codes)


def test_random_text_survives_quoted_files(spark, tmp_path):
    rng = random.Random(11)
    text = lambda: "".join(rng.choice('ab"|\\ \',;é') for _ in range(rng.randrange(1, 9)))
    rows = [(text(), text(), str(i)) for i in range(500)]
    schema = columns("a string, b string, i string")
    write_delimited(spark.createDataFrame(rows, schema), f"{tmp_path}/t")
    assert rows_of(read_text_columns(spark, f"{tmp_path}/t", schema, header=True, quoted=True)) == sorted(rows)


def test_tolerance_of_random_files(spark, tmp_path):
    rng, target, files, kept = random.Random(5), columns("id string, n int"), {}, []
    for i in range(40):
        lines = [f"{i}-{j}|{j}" if rng.random() > i / 400 else rng.choice([f"{j}", f"{j}|x", f"{j}|1|2"])
                 for j in range(rng.choice([1, 19, 20, 21, 40, 100]))]
        good = [line for line in lines if line.count("|") == 1 and line.split("|")[1].isdigit()]
        files[f"f{i}"] = lines
        if (len(lines) - len(good)) * 100 <= 5 * len(lines):
            kept += good
    rows = delimited_files(spark, text_files(tmp_path / "in", **files), target, header=False, quoted=False)
    loaded = skip_bad_files(match_by_position(rows, target), target, f"{tmp_path}/report")
    assert rows_of(loaded) == sorted((line.split("|")[0], int(line.split("|")[1])) for line in kept)
    assert 0 < len(kept) < sum(map(len, files.values()))


def test_candidate_totals_with_copies_everywhere(spark):
    """Codes, candidates, links and contributions all repeat; a join of everything, summed in Python, agrees."""
    rng = random.Random(3)
    pick = lambda *values: rng.choice(values)
    raw = {
        "political_parties": [dict(party_code=c, party_code_desc=d) for c, d in (("P", "Pa"), ("P", "Pb"), ("Q", "Qa"))],
        "report_types": [dict(rp_typ_code=c, rp_typ=c) for c in ("M", "M", "Y")],
        "transaction_types": [dict(trans_tp=c, trans_tp_desc=c) for c in ("15", "16")],
        "candidates": [dict(CAND_ID=pick("K1", "K2", "K3", None), CAND_NAME=pick("A", "B"),
                            CAND_PTY_AFFILIATION=pick("P", "Q", "R", None), CAND_ELECTION_YR=pick(2022, 2024, 2024),
                            CAND_OFFICE=pick("H", "House", "X"), CAND_OFFICE_ST=pick("TX", None)) for _ in range(12)],
        "cand_cmte_link": [dict(CAND_ID=pick("K1", "K2", "K4", None), CMTE_ID=pick("C1", "C1", "C2", "C3", None),
                                CAND_ELECTION_YR=pick(2022, 2024, 2024)) for _ in range(25)],
        "indiv_contributions": [dict(CMTE_ID=pick("C1", "C1", "C2", "C4", None), RPT_TP=pick("M", "Y", "Z", None),
                                     TRANSACTION_TP=pick("15", "17"), ENTITY_TP=pick("IND", "ORG", None),
                                     TRANSACTION_AMT=pick(None, Decimal(rng.randrange(-500, 9999)) / 100))
                                for _ in range(80)],
    }
    groups = defaultdict(list)
    for k in raw["candidates"]:
        for p in raw["political_parties"]:
            for l in raw["cand_cmte_link"]:
                if (k["CAND_PTY_AFFILIATION"] != p["party_code"] or k["CAND_ID"] is None or k["CAND_ID"] != l["CAND_ID"]
                        or {k["CAND_ELECTION_YR"], l["CAND_ELECTION_YR"]} != {2024}):
                    continue
                for c in raw["indiv_contributions"]:
                    if c["CMTE_ID"] is not None and c["CMTE_ID"] == l["CMTE_ID"] and c["TRANSACTION_TP"] == "15":
                        copies = sum(r["rp_typ_code"] == c["RPT_TP"] for r in raw["report_types"])
                        group = (k["CAND_NAME"], p["party_code_desc"], k["CAND_OFFICE_ST"], k["CAND_OFFICE"])
                        if copies:
                            groups[group] += [c["TRANSACTION_AMT"]] * copies
    expected = sorted(
        ((name, party, state, {"H": "House"}.get(office, office), None,
          sum(paid) if (paid := [a for a in amounts if a is not None]) else None)
         for (name, party, state, office), amounts in groups.items()),
        key=lambda row: [(v is None, str(v)) for v in row])
    tables = {name: frame(spark, name, *rows) for name, rows in raw.items()}
    assert rows_of(model("fct_candidate_indiv_cont", tables)) == expected
    assert len(expected) > 5 and set(tables) <= set(RAW)
