"""Golden encounters through the whole build, one build for all of them."""

from decimal import Decimal

import pytest

from stayflow.plans.schemas import OUTPUT
from stayflow.plans.unit_activity import build

from .fixtures import WINDOW, Hospital, at


@pytest.fixture(scope="module")
def built(spark):
    h = Hospital(spark)
    enc = h.encounter
    enc(1, [(10, 0, 60), (11, 60, 200)], disch=200)
    enc(2, [(11, 0, 60), (40, 60, 90), (11, 90, 200)], disch=200)
    enc(3, [(10, 0, 60), (40, 60, 90), (11, 90, 200)], disch=200)
    enc(4, [(10, 0, 60), (11, 60, 150), (10, 150, 300)], disch=300)
    enc(5, [(10, 0, at(60, 59)), (11, at(60, 59), at(63, 1)), (10, at(63, 1), 200)], disch=200)
    enc(6, [(20, 0, 600, 37)], disch=600)
    h.care(6, 100, 1)
    h.care(6, 300, 37)
    h.care(6, 310, 37)
    h.care(6, 400, 1, subtype=2)
    enc(7, [(20, 0, 600, 37)], disch=600)
    h.care(7, 100, 1)
    h.care(7, at(100, 30), 37)
    enc(8, [(20, 0, 600, 37)], disch=600)
    for k in range(12):
        h.care(8, 10 + 10 * k, 37 if k % 2 else 1)
    enc(9, [(20, 0, 600, None)], disch=600)
    enc(10, [(60, 0, 100), (11, 100, 200)], disch=200)
    enc(11, [(50, 0, 30), (11, 30, 100), (40, 100, 130)], disch=130)
    enc(12, [(50, 0, 30), (40, 30, 90)], disch=90)
    enc(13, [(11, 0, 30), (11, 30, None), (11, 60, 100)], disch=100)
    enc(14, [(11, 0, 100), (10, 100, None), (40, 150, 170)])
    enc(15, [(50, 0, None)])
    enc(16, [(20, 0, 100, 1)], har=2016, disch=100)
    enc(17, [(10, 200, 300)], har=2016, disch=300)
    enc(18, [(20, 0, 100, 37)], har=2018, disch=100)
    enc(19, [(30, 200, 300, 37)], har=2018, disch=300)
    enc(20, [(11, 0, 100)], disch=100)
    enc(21, [(11, 0, 100)], disch=100)
    enc(22, [(11, 0, 100)], disch=100)
    for har, code, amount in [(1020, 1, 50), (1021, 1, 50), (1021, 2, 5), (1022, 1, 50), (1022, 1, -50)]:
        h.charge(har, code, amount)
    enc(23, [(11, 0, 100)], pat_class=153, disch=100)
    enc(24, [(11, 0, 60), (41, 60, 70), (42, 70, 80), (50, 80, 85), (5, 85, 86), (11, 90, 200)], disch=200)
    enc(25, [(11, 0, 60), (42, 60, 90), (12, 90, 200)], disch=200)
    enc(26, [(70, 0, 600, 37)], disch=600)
    h.care(26, 100, 1)
    enc(27, [(11, 0, 50), (4056, 60, 70), (4015, 75, 80), (12, 90, 200)], disch=200)
    enc(28, [(11, 0, 100)], base_class=2, disch=100)
    enc(29, [(11, 0, 100)], pat_class=103, disch=100)
    enc(30, [(41, 0, 100)], pat_class=999, disch=100)
    stored = spark.createDataFrame([], OUTPUT)
    table = build(h.tables(), stored, WINDOW, owner="tester")
    out = {}
    for r in table.orderBy("PAT_ENC_CSN", "LINE").collect():
        out.setdefault(r["PAT_ENC_CSN"], []).append(r)
    return table, out


def col(stays, *names):
    picked = [tuple(s[n] for n in names) for s in stays]
    return [p[0] for p in picked] if len(names) == 1 else picked


def test_schema(built):
    names = [p.split(" ")[0] for p in OUTPUT.split(", ")]
    assert built[0].columns == names
    assert dict(built[0].dtypes)["ICU_BOUNCE_BACK_HRS_CSN"] == "decimal(16,2)"


def test_icu_then_ward(built):
    stays = built[1][1]
    assert col(stays, "UNIT_STAY_TYPE") == ["CRITICAL CARE", "MED/SURG"]
    assert col(stays, "IP_UNIT_TRACKER_CSN") == [1, 2] and col(stays, "ICU_TRACKER_CSN") == [1, None]
    assert col(stays, "NEXT_IP_UNIT_STAY_TYPE_CSN") == ["MED/SURG", "DISCHARGED"]
    assert col(stays, "UNIT_STATUS") == ["TRANSFER FROM UNIT", "DISCHARGED"]
    assert col(stays, "NEXT_IP_DEPT_ID") == ["11", None]
    assert col(stays, "HOSP", "HUP_SITE") == [("HUP", "HUP-Main")] * 2
    assert col(stays, "TABLE_OWNER") == ["tester"] * 2


def test_round_trip_is_churn(built):
    stays = built[1][2]
    assert col(stays, "UNIT_IN_DTTM", "UNIT_OUT_DTTM", "ANCILLARY_VISITS") == [(at(0), at(200), 1)]


def test_gap_gets_its_own_row(built):
    stays = built[1][3]
    assert col(stays, "UNIT_STAY_TYPE") == ["CRITICAL CARE", "NON IP UNIT: OR", "MED/SURG"]
    assert stays[0]["NEXT_IP_UNIT_STAY_TYPE_CSN"] == "MED/SURG"
    # the row that fills the gap looks ahead for its next unit
    assert (stays[1]["NEXT_IP_UNIT_STAY_TYPE_CSN"], stays[1]["NEXT_IP_DEPT_ID"]) == ("MED/SURG", "11")
    assert (stays[1]["NORMAL_NEWBORN_YN"], stays[1]["HOSPICE_ADMISSION_YN"]) == (None, None)
    assert (stays[1]["ANCILLARY_VISITS"], stays[1]["CEDAR_SPRUCE_TXN_YN"]) == (0, 0)
    assert (stays[0]["NORMAL_NEWBORN_YN"], stays[0]["HOSPICE_ADMISSION_YN"]) == (0, 0)


def test_bounce_back(built):
    assert built[1][4][0]["ICU_BOUNCE_BACK_HRS_CSN"] == Decimal("1.50")
    assert built[1][4][0]["ICU_BOUNCE_BACK_HRS_HAR"] == Decimal("1.50")
    # three minute boundaries crossed
    assert built[1][5][0]["ICU_BOUNCE_BACK_HRS_CSN"] == Decimal("0.10")


def test_level_of_care_splits(built):
    assert col(built[1][6], "UNIT_STAY_TYPE", "UNIT_IN_DTTM", "UNIT_OUT_DTTM") == [
        ("CRITICAL CARE", at(0), at(100)),
        ("MED/SURG", at(100), at(300)),
        ("CRITICAL CARE", at(300), at(600)),
    ]
    assert len(built[1][7]) == 2  # the second change comes within a minute
    assert len(built[1][8]) == 11  # ten cuts at most
    assert col(built[1][9], "UNIT_STAY_TYPE") == ["CRITICAL CARE"]
    assert col(built[1][26], "UNIT_STAY_TYPE", "HOSP", "HUP_SITE") == [
        ("CRITICAL CARE", "CCH", None),
        ("MED/SURG", "CCH", None),
    ]


def test_no_dated_record_means_no_type(built):
    first, second = built[1][10]
    assert first["UNIT_STAY_TYPE"] is None and first["IP_UNIT_TRACKER_CSN"] is None
    assert first["HUP_SITE"] == "HUP-Main"  # from the current record
    assert second["IP_UNIT_TRACKER_CSN"] == 1
    # it is no unit row, so it looks ahead
    assert first["NEXT_IP_UNIT_STAY_TYPE_CSN"] == "MED/SURG"


def test_rows_around_units(built):
    assert col(built[1][11], "UNIT_STAY_TYPE") == ["NON IP UNIT: ED", "MED/SURG", "NON IP UNIT: OR"]
    # the ward is left for the OR, which the patient does not leave alive
    assert col(built[1][11], "UNIT_STATUS") == ["TRANSFER FROM UNIT", "TRANSFER FROM UNIT", "DISCHARGED"]
    assert built[1][11][1]["NEXT_IP_UNIT_STAY_TYPE_CSN"] == "PT TXN TO NON-IP LOC"
    assert col(built[1][12], "UNIT_STAY_TYPE") == ["NON IP UNIT: ED", "NON IP UNIT: OR"]
    assert built[1][12][1]["NEXT_IP_UNIT_STAY_TYPE_HAR"] == "DISCHARGED"


def test_orphan_rows(built):
    # the open middle row goes, the row after it starts a stay; the first row never closes
    assert col(built[1][13], "UNIT_IN_DTTM", "UNIT_OUT_DTTM", "UNIT_STATUS") == [
        (at(0), None, None),
        (at(60), at(100), "DISCHARGED"),
    ]


def test_still_in_unit(built):
    stays = built[1][14]
    assert col(stays, "UNIT_STATUS") == ["TRANSFER FROM UNIT", "PATIENT IN UNIT"]
    assert stays[1]["NEXT_IP_UNIT_STAY_TYPE_CSN"] == "PATIENT CURRENTLY IN UNIT"
    assert 15 not in built[1]


def test_cross_site_accounts(built):
    first, second = built[1][16][0], built[1][17][0]
    assert first["CEDAR_SPRUCE_TXN_YN"] == second["CEDAR_SPRUCE_TXN_YN"] == 1
    assert first["NEXT_IP_UNIT_STAY_TYPE_HAR"] == "TRANSFER TO HUP-MAIN; CRITICAL CARE"
    assert first["NEXT_IP_UNIT_STAY_TYPE_CSN"] == "DISCHARGED"
    assert (first["IP_UNIT_TRACKER_HAR"], second["IP_UNIT_TRACKER_HAR"]) == (1, 2)
    # towards Pavilion the bounce-back is counted
    assert built[1][18][0]["NEXT_IP_UNIT_STAY_TYPE_HAR"] == "TRANSFER TO HUP-PAVILION; CRITICAL CARE"
    assert built[1][18][0]["ICU_BOUNCE_BACK_HRS_HAR"] == Decimal("1.70")


def test_flags(built):
    assert [built[1][c][0]["NORMAL_NEWBORN_YN"] for c in (20, 21, 22)] == [1, 0, 0]
    assert [built[1][c][0]["HOSPICE_ADMISSION_YN"] for c in (22, 23)] == [0, 1]


def test_churn_counts_ancillary_places_only(built):
    # two ancillary places and another ED; department 5 is unknown
    assert col(built[1][24], "ANCILLARY_VISITS") == [3]


def test_labels(built):
    # no specialty gives no label
    assert col(built[1][25], "UNIT_STAY_TYPE") == ["MED/SURG", None, "MED/SURG"]
    # in a gap the department of the following stay is tested
    assert col(built[1][27], "UNIT_STAY_TYPE") == [
        "MED/SURG",
        "NON IP UNIT: Observation",
        "NON IP UNIT: Obstetrics",
        "MED/SURG",
    ]


def test_cohort_rules(built):
    assert built[1][28][0]["BILLED_AS_OP"] == 1
    assert 29 not in built[1]  # emergency class
    assert 30 not in built[1]  # never on a unit


def test_extraction_time(built):
    assert {r["EXTRACTION_DTTM_APPROX"] for s in built[1].values() for r in s} == {at(600)}


def test_lines_run_from_one_and_stays_do_not_overlap(built):
    for stays in built[1].values():
        lines = col(stays, "LINE")
        assert lines == list(range(lines[0], lines[0] + len(lines)))
        for a, b in zip(stays, stays[1:]):
            assert a["UNIT_OUT_DTTM"] is None or a["UNIT_OUT_DTTM"] <= b["UNIT_IN_DTTM"]
