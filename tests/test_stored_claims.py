"""Claims kept in files: the same rows as in one pass, with little of them moved."""

import datetime as dt

import pytest
from conftest import plan, rows

from smeltery.operators import dedupe, rollup
from smeltery.plans import medallion, registry as R

CLAIMS = ("claim_id string, patient_id string, service_date date, procedure_code string, diagnosis_code string, "
          "provider_id string, claim_type string, paid_amount double, allowed_amount double, tie int")


@pytest.fixture
def claims(spark, folder):
    """A patient with most claims, one without an id, keys that repeat and keys with nulls."""
    lines = []
    for i in range(400):
        patient = None if i % 7 == 0 else "hot" if i % 2 else f"p{i % 23}"
        lines.append((
            f"c{i}" if i % 50 else None, patient, dt.date(2024, 1 + i % 3, 1) if i % 11 else None,
            f"P{i % 9}" if i % 5 else None, f"D{i % 4}" if i % 6 else None, f"N{i}", "AB"[i % 2] if i % 3 else None,
            float("nan") if i == 9 else i / 7 if i % 8 else None, float(i), i))
    lines += [(*line[:-1], 1000 - i) for i, line in enumerate(lines[:60])] + lines[:5]
    spark.createDataFrame(lines, CLAIMS).write.parquet(f"{folder}/claims")
    return spark.read.parquet(f"{folder}/claims")


@pytest.mark.parametrize("keep", [None, rollup.PATIENT_INPUTS])
@pytest.mark.parametrize("max_repeated", [0, 1000])
def test_stored_claims_keep_the_same_survivors(claims, folder, max_repeated, keep):
    got = dedupe.pick_one_of_stored(claims, dedupe.CLAIM_KEYS, ["tie"], scratch=f"{folder}/repeated", keep=keep,
                                    max_repeated=max_repeated)
    want = dedupe.pick_one_per_key(claims, dedupe.CLAIM_KEYS, ["tie"], keep=keep)
    assert got.columns == want.columns
    assert [str(r) for r in rows(got)] == [str(r) for r in rows(want)]


@pytest.mark.parametrize("gathered_rows", [0, 50, 10_000])
def test_stored_patients_are_summed_up_alike(claims, gathered_rows):
    got = rollup.stored_patient_summary(claims, gathered_rows)
    want = rollup.patient_summary(claims)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert rows(got) == rows(want)


def test_stored_months_and_procedures_are_summed_up_alike(claims):
    for roll_up in (rollup.monthly_spend, rollup.procedure_cost):
        got, want = roll_up(claims, stored=True), roll_up(claims)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert [str(r) for r in rows(got)] == [str(r) for r in rows(want)]


def test_patient_summary_moves_a_claim_once(spark, small):
    assert "Expand" not in plan(R.gold_patient_summary(spark, small))


def test_published_gold_moves_narrow_rows(claims):
    gold = medallion.claims_gold(claims)
    assert "Expand" not in plan(gold[medallion.GOLD_PATIENT])
    for name in (medallion.GOLD_MONTHLY, medallion.GOLD_PROCEDURE):
        text = plan(gold[name])
        text = text[text.index("== Physical Plan =="):]
        assert not [line for line in text.splitlines() if "keys=" in line and "patient_id" in line and "partial_sum" in line]


def test_a_claim_that_does_not_repeat_is_not_ranked(claims, folder):
    text = plan(dedupe.dedupe_claims(claims, ["tie"], scratch=f"{folder}/repeated"))
    text = text[text.index("== Physical Plan =="):]
    assert text.index("Union") < text.index("LeftAnti") < text.index("LeftSemi")
    assert "Exchange hashpartitioning" not in text[:text.index("LeftAnti")]
