"""Which encounters a run picks, step by step."""

from datetime import date, datetime, timedelta

import pytest

from stayflow.operators import cohort
from stayflow.operators.cohort import RunWindow
from stayflow.plans.schemas import OUTPUT
from stayflow.plans.unit_activity import find_encounters

from .fixtures import DAY, WINDOW, Hospital

OLD = DAY - timedelta(days=30)
NAMES = [p.split(" ")[0] for p in OUTPUT.split(", ")]


def stored(spark, rows):
    out = []
    for csn, har, status, end, billed in rows:
        row = dict.fromkeys(NAMES)
        row.update(PAT_ENC_CSN=csn, HSP_ACCOUNT_ID=har, UNIT_STATUS=status, UNIT_OUT_DTTM=end, BILLED_AS_OP=billed)
        out.append(tuple(row.values()))
    return spark.createDataFrame(out, OUTPUT)


@pytest.fixture(scope="module")
def inputs(spark):
    h = Hospital(spark)
    past = [(11, OLD, OLD + timedelta(hours=5))]
    end = OLD + timedelta(hours=5)
    h.encounter(1, [(11, 0, 60)], disch=60)
    h.encounter(2, past, disch=end)  # stored with another end
    h.encounter(3, past, disch=end, base_class=2)  # stored as inpatient
    h.encounter(4, past, disch=end)  # stored as outpatient
    h.encounter(5, past, disch=end)  # stored as it is
    # account 906 was merged into 907 in the window; 8 is another encounter of 907
    h.encounter(6, past, har=906, disch=end, combine_har=907, combine_dttm=DAY)
    h.encounter(7, past, har=907, disch=end)
    h.encounter(8, past, har=907, disch=end)
    # merged long ago: found only as a sibling of an encounter with recent activity
    h.encounter(9, past, har=910, disch=end, combine_har=911, combine_dttm=OLD)
    h.encounter(10, [(11, 0, 60)], har=911, disch=60)
    h.encounter(11, past, har=911, disch=end)
    h.encounter(12, [(40, 0, 60)], disch=60, pat_class=999)  # no unit, other class
    h.encounter(13, [(40, 0, 60)], disch=60, pat_class=102)  # no unit, kept class
    h.encounter(14, [(11, 0, 60)], disch=60, base_class=3)  # billed as outpatient on a unit
    h.encounter(15, [(11, 0, 60)], disch=60, base_class=2, pat_class=138)
    h.encounter(16, past, disch=end, tot_chgs=5000)  # charged, never stored
    h.encounter(17, [(11, 0, 60)], disch=60, pat_class=104)
    known = stored(
        spark,
        [
            (2, 1002, "DISCHARGED", end + timedelta(hours=1), 0),
            (3, 1003, "DISCHARGED", end, 0),
            (4, 1004, "DISCHARGED", end, 1),
            (5, 1005, "DISCHARGED", end, 0),
        ],
    )
    return h.tables(), known


def picked(inputs, window, **kwargs):
    return {r["csn"]: r["billed_as_op"] for r in find_encounters(*inputs, window, **kwargs).collect()}


EXPECTED = {1: 0, 2: 0, 3: 1, 4: 0, 6: 0, 7: 0, 8: 0, 10: 0, 11: 0, 13: 0, 14: 1, 16: 0}


def test_steps(inputs):
    assert picked(inputs, WINDOW) == EXPECTED


def test_historical_runs_skip_the_comparison(inputs):
    assert picked(inputs, WINDOW, compare=False) == {
        k: v for k, v in EXPECTED.items() if k not in (2, 3, 4)
    }


def test_changed_ends_rest_on_the_first_days_of_a_month(inputs, monkeypatch):
    """The comparison of discharge times is asked for on the third, not on the first and second."""
    asked = []
    real = cohort.changed_end
    monkeypatch.setattr(cohort, "changed_end", lambda *a, **k: asked.append(a[2].as_of.day) or real(*a, **k))
    for day in (1, 2, 3):
        find_encounters(*inputs, RunWindow(date(2024, 3, day)))
    assert asked == [3]


def test_changed_end_needs_no_account(spark):
    stored = spark.createDataFrame([(1, 10, "DISCHARGED", datetime(2024, 3, 9), 0), (2, None, "DISCHARGED", datetime(2024, 3, 9), 0)], "csn long, har long, unit_status string, unit_out_dttm timestamp_ntz, billed_as_op int")
    now = spark.createDataFrame([(1, 10, datetime(2024, 3, 9)), (2, None, datetime(2024, 3, 10))], "csn long, har long, disch_dttm timestamp_ntz")
    got = cohort.changed_end(stored, now, RunWindow(date(2024, 3, 12))).collect()
    assert [(r["csn"], r["har"]) for r in got] == [(2, None)]


def test_window_bounds():
    w = RunWindow(date(2024, 3, 12))
    assert (w.start, w.end) == (datetime(2024, 3, 9), datetime(2024, 3, 13))
    assert w.year_before == datetime(2023, 3, 10)
