"""Tables the unit-activity build reads and writes.

Keys: ``csn`` is one encounter, ``har`` a hospital account, which can hold several encounters.
Times are local wall-clock times.
"""

from __future__ import annotations

INPUTS = {
    # who was where; pat_out_dttm is NULL while the patient is still there
    "movements": "csn long, event_id long, dept_id long, in_dttm timestamp_ntz, "
    "out_dttm timestamp_ntz, pat_out_dttm timestamp_ntz",
    "encounters": "csn long, har long, dept_id long, pat_class int, admit_dttm timestamp_ntz, "
    "disch_dttm timestamp_ntz, inp_adm_dttm timestamp_ntz",
    # combine_har is the account this one was merged into
    "accounts": "har long, pat_id string, prim_csn long, combine_har long, "
    "combine_dttm timestamp_ntz, adm_dttm timestamp_ntz, base_class int, acct_class int, "
    "tot_chgs decimal(18,2)",
    "dept": "dept_id long, name string, specialty string, grp11 int, grp4 string, rev_loc_id long",
    "dept_history": "dept_id long, start_date timestamp_ntz, end_date timestamp_ntz, grp11 int, "
    "grp4 string, rev_loc_id long",
    "loc_events": "event_id long, csn long, effective_dttm timestamp_ntz, level_of_care int, "
    "event_subtype int",
    "loc": "loc_id long, parent_loc_id long, grp7 int",
    "entity": "grp7 int, name string",
    "charges": "har long, rev_code_id long, amount decimal(18,2)",
    "rev_codes": "rev_code_id long, revenue_code string",
}

OUTPUT = (
    "PAT_ENC_CSN long, LINE int, HSP_ACCOUNT_ID long, UNIT_STAY_TYPE string, "
    "ADT_DEPARTMENT_ID long, UNIT_IN_DTTM timestamp_ntz, UNIT_OUT_DTTM timestamp_ntz, "
    "UNIT_STATUS string, IP_UNIT_TRACKER_CSN int, ICU_TRACKER_CSN int, NEXT_IP_DEPT_ID string, "
    "NEXT_IP_UNIT_STAY_TYPE_CSN string, IP_UNIT_TRACKER_HAR int, ICU_TRACKER_HAR int, "
    "NEXT_IP_UNIT_STAY_TYPE_HAR string, ANCILLARY_VISITS int, "
    "ICU_BOUNCE_BACK_HRS_CSN decimal(16,2), ICU_BOUNCE_BACK_HRS_HAR decimal(16,2), "
    "BILLED_AS_OP int, CEDAR_SPRUCE_TXN_YN int, NORMAL_NEWBORN_YN int, "
    "EXTRACTION_DTTM_APPROX timestamp_ntz, HOSP string, HUP_SITE string, "
    "HOSPICE_ADMISSION_YN int, TABLE_OWNER string"
)
