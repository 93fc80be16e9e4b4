"""Run configuration: thresholds, code sets and table naming.

Everything a job needs besides its input tables lives in one frozen
dataclass so that a run is reproducible from its config alone (the config
hash goes into the run-metrics row).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from dataclasses import asdict, dataclass, field


# ---------------------------------------------------------------------------
# Business-rule constants and code lists that must equal the
# source project's for results to agree.  Kept together and in source order.
# ---------------------------------------------------------------------------
INIT_HOSP_THRESHOLD_DAYS = 4
READMIT_THRESHOLD_DAYS = 30
HOSP_STAY_GAP_DAYS = 4
NEWBORN_SERVICE_WINDOW_DAYS = 4
HIGH_COST_CLAIM_THRESHOLD = 500000
NICU_LOW_COST_PER_DAY_THRESHOLD = 150
INAPPROPRIATE_NICU_MAX_LOS = 5
LONG_STAY_THRESHOLD = 3
NICU_MS_DRG_RANGE = (580, 640)
NICU_APR_DRG_RANGE = (789, 795)
NICU_REV_CODE_RANGE = (170, 179)
ROOM_BOARD_REV_PREFIXES = ("011", "012", "013", "014", "015", "016", "017", "020")
MANAGEABLE_CPT_CODES = ("99233", "99479", "99480", "99478", "99231", "99232", "99462")
CRITICAL_CARE_CPT_CODES = ("99468", "99469", "99471", "99472")
POS_INPATIENT = "21"
POS_EMERGENCY = "23"
DISCHARGE_STATUS_DEATH = "20"
DISCHARGE_STATUS_AMA = "07"
DISCHARGE_STATUS_TRANSFERS = ("02", "05", "66", "43", "62", "63", "65")
DISCHARGE_STATUS_SNF = "30"
DISCHARGE_STATUS_HOME = ("01", "06")
DISCHARGE_STATUS_EXCLUDED = ("04", "41", "50", "51", "70", "03", "64")
# Claim-type rules (first match wins): inpatient, then emergency.
IP_REVENUE_RANGE = ("0100", "0210")
IP_REVENUE_EXTRA = "0987"
IP_PROC_RANGES = (("99221", "99239"), ("99251", "99255"), ("99261", "99263"))
ER_PROC_CODES = ("99281", "99282", "99283", "99284", "99285", "99286", "99287", "99288")
ER_REVENUE_PREFIX = "045"
ER_REVENUE_EXTRA = "0981"
# Outpatient site-of-service places of service and provider-category rules.
SOS_PLACES_OF_SERVICE = ("22", "24", "19", "99")
FACILITY_REV_PATTERN = r"^(01|02|03|05|06|049|045)"
PROFESSIONAL_REV_PATTERN = r"^(04|07|08|09)"
FACILITY_POS = ("21", "22", "23", "31", "32", "33", "34")
PROFESSIONAL_POS = ("11", "12", "20", "49", "50")
PROFESSIONAL_PROC_RANGES = ((10000, 69999), (70000, 79999))
FACILITY_PROC_RANGES = ((80000, 89999),)
# Request ETL.
OPEN_STATUS = ("Not Started", "In Progress", "Waiting")
COMPLETE_STATUS = ("Complete", "Completed")
DAYS_ON_STATUS_THRESHOLD = 14
REQUEST_URL_PREFIX = "https://requests.example.org/DispForm.aspx?ID="
# Logical request fields and the candidate source column names, first existing wins.
REQUEST_COLUMN_CANDIDATES = {
    "ID": ("ID", "REQUEST_ID"),
    "TITLE": ("TITLE", "REQUEST_TITLE", "NAME"),
    "REQUEST_DATE": ("REQUEST_DATE", "REQUESTDATE", "CREATED", "CREATED_DATE"),
    "CLIENT": ("CLIENT", "CLIENT_NAME", "CUSTOMER"),
    "MARKET": ("MARKET", "MARKET_NAME"),
    "REQUESTOR": ("REQUESTOR", "REQUESTER", "REQUESTED_BY"),
    "CLIENT_TYPE": ("CLIENT_TYPE_DETAIL", "CLIENT_TYPE", "CLIENTTYPE"),
    "OVERALL_STATUS": ("OVERALL_STATUS", "STATUS", "REQUEST_STATUS", "OVERALLSTATUS"),
    "PRODUCTS_REQUESTED": ("PRODUCTS_REQUESTED", "PRODUCTS", "PRODUCTSREQUESTED"),
    "SALESFORCE_ID": ("SALESFORCE_ID", "SALESFORCEID", "SF_ID"),
    "STATUS_CHANGE_DATE": ("STATUS_CHANGE_DATE", "STATUSCHANGEDATE", "MODIFIED", "MODIFIED_DATE"),
    "CLOSED_DATE": ("CLOSED_DATE", "CLOSEDDATE", "DATE_CLOSED"),
    "PTRR": ("PTRR",),
}
# Data-QA thresholds.
QA_CRITICAL_NULL_PCT = 50
QA_WARNING_NULL_PCT = 10
QA_GOOD_POPULATION_PCT = 90
QA_FAIR_POPULATION_PCT = 50
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ClaimsConfig:
    """Frozen run configuration; validated on construction."""

    client: str = "DEMO"
    table_suffix: str = ""
    database: str = ""
    init_hosp_threshold_days: int = INIT_HOSP_THRESHOLD_DAYS
    readmit_threshold_days: int = READMIT_THRESHOLD_DAYS
    hosp_stay_gap_days: int = HOSP_STAY_GAP_DAYS
    newborn_service_window_days: int = NEWBORN_SERVICE_WINDOW_DAYS
    high_cost_threshold: int = HIGH_COST_CLAIM_THRESHOLD
    low_cost_per_day: int = NICU_LOW_COST_PER_DAY_THRESHOLD
    inappropriate_max_los: int = INAPPROPRIATE_NICU_MAX_LOS
    long_stay_threshold: int = LONG_STAY_THRESHOLD
    study_months: int = 24
    runout_months: int = 3
    # Reference code sets (illustrative values for the fixtures; real lists are
    # loaded from reference tables in production and passed in here).
    newborn_rev_codes: tuple = ("0170", "0171", "0172", "0173", "0174")
    nicu_rev_codes: tuple = ("0173", "0174")
    newborn_icd_codes: tuple = ("Z3800", "Z3830", "Z3861")
    singleton_icd_codes: tuple = ("Z3800",)
    twin_icd_codes: tuple = ("Z3830",)
    multiple_icd_codes: tuple = ("Z3861",)
    nicu_msdrg_codes: tuple = ("593",)
    nicu_aprdrg_codes: tuple = ("790",)
    birthweight_icd: tuple = (("P0714", "Low"), ("P0734", "Very Low"))
    gest_age_icd: tuple = (("P0732", "Preterm"),)
    nas_icd_code: str = "P961"
    # Skew controls: number of salt buckets for per-group ranking, number of
    # interval starts of a key that one cell of its time line holds.
    rank_salt_buckets: int = 16
    range_cell_starts: int = 64
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if not self.client:
            raise ValueError("client must be set")
        if self.table_suffix and not self.table_suffix.startswith("_"):
            raise ValueError("table_suffix must start with underscore or be empty")
        if self.init_hosp_threshold_days < 1:
            raise ValueError("init_hosp_threshold_days must be >= 1")
        if self.readmit_threshold_days < 1:
            raise ValueError("readmit_threshold_days must be >= 1")
        if self.hosp_stay_gap_days < 0:
            raise ValueError("hosp_stay_gap_days must be >= 0")
        if self.rank_salt_buckets < 1 or self.range_cell_starts < 1:
            raise ValueError("skew controls must be positive")

    def code_sets(self) -> dict:
        """Flag name -> code tuple, for the flag operators."""
        return {
            "NEWBORN_ICD": self.newborn_icd_codes,
            "SINGLE": self.singleton_icd_codes,
            "TWIN": self.twin_icd_codes,
            "MULTIPLE": self.multiple_icd_codes,
            "NEWBORN_REV": self.newborn_rev_codes,
            "NICU_REV": self.nicu_rev_codes,
            "NICU_MSDRG": self.nicu_msdrg_codes,
            "NICU_APRDRG": self.nicu_aprdrg_codes,
        }

    def config_hash(self) -> str:
        d = asdict(self)
        d.pop("extra", None)
        return hashlib.sha256(json.dumps(d, sort_keys=True, default=str).encode()).hexdigest()


@dataclass(frozen=True)
class StudyWindow:
    """Birth/study window and run-out, as produced by the window operator."""

    start: dt.date
    mid: dt.date
    end: dt.date
    runout_end: dt.date

    def __post_init__(self):
        if not (self.start <= self.mid <= self.end <= self.runout_end):
            raise ValueError(f"window out of order: {self}")


# Fixture window (what the 24-month rule yields on the test data).
FIXTURE_WINDOW = StudyWindow(
    start=dt.date(1999, 8, 1),
    mid=dt.date(2000, 8, 1),
    end=dt.date(2001, 7, 31),
    runout_end=dt.date(2001, 10, 31),
)
FIXTURE_AS_OF = dt.date(2001, 12, 31)


def table_name(table_type: str, cfg: ClaimsConfig) -> str:
    """Name resolver: logical table type -> qualified table name."""
    prefix = f"{cfg.database}." if cfg.database else ""
    c = cfg.client
    if table_type == "medical":
        return f"{prefix}FA_MEDICAL_{c}"
    if table_type == "membership":
        return f"{prefix}FA_MEMBERSHIP_{c}"
    if table_type == "ps_membership":
        return f"{prefix}PS_MEMBERSHIP_{c}{cfg.table_suffix}"
    if table_type == "ps_newborns":
        return f"{prefix}PS_NEWBORNS_{c}{cfg.table_suffix}"
    if table_type.startswith("ref_"):
        return f"{prefix}{table_type[4:].upper()}"
    raise ValueError(f"Unknown table type: {table_type}")
