"""A small hospital: helpers that build the input tables from a few lines per encounter."""

from datetime import date, datetime, timedelta

from stayflow.operators.cohort import RunWindow
from stayflow.plans.schemas import INPUTS

DAY = datetime(2024, 3, 10)
WINDOW = RunWindow(date(2024, 3, 12))

# dept_id: (name, specialty, grp11, grp4, rev_loc_id)
DEPARTMENTS = {
    10: ("MAIN ICU", "Critical", 4, "HUPW", 10103),
    11: ("MAIN WARD", "Medicine", 3, "HUPW", 10103),
    12: ("MAIN WARD TWO", "Medicine", 3, "HUPW", 10103),
    20: ("CEDAR ICU", "Critical", 4, "HUP54", 10345 - 1),
    21: ("CEDAR WARD", "Medicine", 3, "HUP54", 10345 - 1),
    30: ("PAVILION ICU", "Critical", 4, "HUPE", 1),
    40: ("MAIN OR", "Surgery", 6, "X", 10103),
    41: ("RADIOLOGY", "Imaging", 6, "X", 10243),
    42: ("NO SPECIALTY", None, 6, "X", 10103),
    50: ("BIG EMERGENCY DEPARTMENT", "Emergency", 6, "X", 10103),
    60: ("NEW UNIT", "Medicine", 3, "HUPW", 10103),  # no dated record
    70: ("COUNTY ICU", "Critical", 4, "CC", 2),
    4056: ("EDOU", "Observation", 6, "X", 10103),
    4015: ("LABOR", "Obstetrics", 6, "X", 10103),
}


def at(minutes=0, seconds=0):
    return DAY + timedelta(minutes=minutes, seconds=seconds)


class Hospital:
    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in INPUTS}
        self.event = 0
        for dept, (name, specialty, grp11, grp4, loc) in DEPARTMENTS.items():
            self.rows["dept"].append((dept, name, specialty, grp11, grp4, loc))
            if dept != 60:
                self.rows["dept_history"].append(
                    (dept, datetime(2010, 1, 1), datetime(2100, 1, 1), grp11, grp4, loc)
                )
        for loc in (10103, 10344, 10345, 10242, 10243, 1):
            self.rows["loc"].append((loc, 900, None))
        self.rows["loc"] += [(2, 901, None), (900, None, 30), (901, None, 31)]
        self.rows["entity"] += [(30, "HUP"), (31, "CCH")]
        self.rows["rev_codes"] += [(1, "0171"), (2, "0173"), (3, "0174"), (4, "0999")]

    def encounter(self, csn, moves, har=None, pat_class=101, base_class=1, disch=None, account=True, dept=11, **acct):
        """``moves``: (dept, start minute, end minute or None); times may also be datetimes."""
        har = csn + 1000 if har is None else har
        when = [m if isinstance(m, datetime) else None if m is None else at(m) for m in (disch,)][0]
        self.rows["encounters"].append((csn, har, dept, pat_class, DAY, when, DAY))
        if account and har not in {a[0] for a in self.rows["accounts"]}:
            self.account(har, prim_csn=csn, base_class=base_class, **acct)
        return [self.move(csn, *m) for m in moves]

    def account(self, har, prim_csn=None, combine_har=None, combine_dttm=None, base_class=1, acct_class=101, tot_chgs=0):
        self.rows["accounts"].append((har, "p", prim_csn, combine_har, combine_dttm, DAY, base_class, acct_class, tot_chgs))

    def move(self, csn, dept, start, end, level=None, out=None):
        self.event += 1
        start = start if isinstance(start, datetime) else at(start)
        end = end if isinstance(end, datetime) or end is None else at(end)
        self.rows["movements"].append((csn, self.event, dept, start, out or end or at(5000), end))
        self.rows["loc_events"].append((self.event, csn, start, level, 1))
        return self.event

    def care(self, csn, minute, level, subtype=1):
        self.event += 1
        when = minute if isinstance(minute, datetime) else at(minute)
        self.rows["loc_events"].append((self.event, csn, when, level, subtype))

    def charge(self, har, code, amount):
        self.rows["charges"].append((har, code, amount))

    def tables(self):
        from decimal import Decimal

        def fix(name, row):
            if name == "accounts":
                return (*row[:-1], Decimal(row[-1]))
            if name == "charges":
                return (*row[:-1], Decimal(row[-1]))
            return row

        return {
            name: self.spark.createDataFrame([fix(name, r) for r in data], INPUTS[name])
            for name, data in self.rows.items()
        }
