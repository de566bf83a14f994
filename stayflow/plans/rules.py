"""Institution rules of the unit-activity table, kept as data.

All codes, names and labels below are fixed values: results depend on them exactly.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayflow.functions.columns import first_label, like_ci

DATA_BEGINS = datetime(2017, 7, 1)

# patient and account classes
EMERGENCY_CLASSES = (103, 104)
INPATIENT_BASE_CLASS = 1
OUTPATIENT_BASE_CLASSES = (2, 3)
KEPT_CLASSES = (101, 102, 125, 10014)
LABOR_OUTPATIENT_CLASS = 138
HOSPICE_CLASSES = (153, 121)
MISSED_ACCOUNT_CLASS = 101
MISSED_ACCOUNT_MIN_CHARGES = 1000

# department groups
UNIT_GROUPS = (1, 2, 3, 4)
ICU_GROUP = 4
ANCILLARY_GROUP = 6
GROUP_TYPES = {
    1: "PSYCHIATRY",
    2: "WOMENS SERVICES",
    3: "MED/SURG",
    4: "CRITICAL CARE",
    5: "REHAB",
    6: "NON-CENSUS AREAS",
    7: "LTACH",
    8: "HOSPICE",
}
UNKNOWN_GROUP = "review"
CRITICAL = "CRITICAL CARE"
WARD = "MED/SURG"

# level of care
CRITICAL_LEVELS = (36, 37)
CANCELLED_SUBTYPE = 2

# units whose type follows the level of care: at admission to the unit ...
MIXED_HOSPITALS = ("CCH", "MCP", "PAH")
MIXED_SITE_HOSPITAL = "HUP"
MIXED_SITE_GROUP = "HUP54"
MIXED_DEPARTMENTS = (4161, 4146)
# ... and also during the stay
SPLIT_HOSPITALS = ("CCH", "MCP")

# places that are not inpatient units
NON_IP = "NON IP UNIT"
ED_DEPARTMENTS = (5602, 5836, 5412)
ED_NAME = "% EMERGENCY DEPARTMENT%"
EDOU_DEPARTMENTS = (4056, 4140, 4143)
OR_NAME = "% OR"
LD_DEPARTMENT = 4015
ED_AND_EDOU_DEPARTMENTS = (5602, 4140, 4056, 4143)
MAIN_ED = 5602

# next unit
NEXT_TYPES = ("LTACH", "CRITICAL CARE", "WOMENS SERVICES", "MED/SURG", "REHAB")
STILL_HERE = "PATIENT CURRENTLY IN UNIT"
DISCHARGED = "DISCHARGED"
NON_IP_NEXT = "PT TXN TO NON-IP LOC"
NOT_A_BOUNCE_CSN = ("CRITICAL CARE", "PATIENT CURRENTLY IN UNIT")
NOT_A_BOUNCE_HAR = (
    "CRITICAL CARE",
    "PATIENT CURRENTLY IN UNIT",
    "TRANSFER TO HUP-MAIN; CRITICAL CARE",
    "TRANSFER TO HUP-CEDAR; CRITICAL CARE",
)

# sites of the hospital that has several: first matching rule wins
SITE_HOSPITAL = "HUP"
SITE_RULES = (
    ("grp4", ("HUPW",), "HUP-Main"),
    ("rev_loc_id", (10345,), "HUP-Cedar_Psych"),
    ("grp4", ("HUP54",), "HUP-Cedar"),
    ("grp4", ("HUPE",), "HUP-Pavilion"),
    ("rev_loc_id", (10103, 10107), "HUP-Main"),
    ("rev_loc_id", (10243, 10242), "Rittenhouse"),
)
UNKNOWN_SITE = "Needs Investigation"
CROSS_SITE = "HUP-Cedar"
CROSS_SITES = ("HUP-Cedar", "HUP-Main", "HUP-Pavilion")

# newborn revenue codes
NEWBORN_CODE = "0171"
NICU_CODES = ("0173", "0174")


def unit_type(group: str, site_group: str, dept: str, hospital: str, level: str) -> Column:
    """Unit type of a movement.

    In a mixed ICU a known level of care below critical makes it a ward stay; an unknown level
    leaves it critical.
    """
    mixed = F.col(hospital).isin(*MIXED_HOSPITALS) | (
        (F.col(hospital) == MIXED_SITE_HOSPITAL)
        & ((F.col(site_group) == MIXED_SITE_GROUP) | F.col(dept).isin(*MIXED_DEPARTMENTS))
    )
    ward_in_icu = (F.col(group) == ICU_GROUP) & mixed & ~F.col(level).isin(*CRITICAL_LEVELS)
    by_group = [(F.col(group) == code, name) for code, name in GROUP_TYPES.items()]
    return first_label([(ward_in_icu, WARD), *by_group], F.lit(UNKNOWN_GROUP))


def care_type(level: str) -> Column:
    """Unit type a level-of-care event stands for."""
    return F.when(F.col(level).isin(*CRITICAL_LEVELS), CRITICAL).when(
        F.col(level).isNotNull(), WARD
    )


def splits_on_care(group: str, site_group: str, hospital: str) -> Column:
    return (F.col(group) == ICU_GROUP) & (
        F.col(hospital).isin(*SPLIT_HOSPITALS) | (F.col(site_group) == MIXED_SITE_GROUP)
    )


def non_ip_label(dept: Column, current_type: Column, name: Column, specialty: Column) -> Column:
    """Label of a place that is not an inpatient unit."""
    return first_label(
        [
            (dept.isin(*ED_DEPARTMENTS) | like_ci(name, ED_NAME), f"{NON_IP}: ED"),
            (dept.isin(*EDOU_DEPARTMENTS) & (current_type == NON_IP), f"{NON_IP}: EDOU"),
            (like_ci(name, OR_NAME), f"{NON_IP}: OR"),
            (dept == LD_DEPARTMENT, f"{NON_IP}: LD"),
        ],
        F.concat(F.lit(f"{NON_IP}: "), specialty),
    )


def site(columns: dict[str, str]) -> Column:
    """Site by the first matching rule; ``columns`` maps rule columns to actual ones."""
    return first_label(
        [(F.col(columns[c]).isin(*values), label) for c, values, label in SITE_RULES],
        F.lit(UNKNOWN_SITE),
    )


# how many changes of the level of care cut one stay, and how far the next unit is looked for
MOST_CUTS = 10
ROWS_AHEAD = 4
